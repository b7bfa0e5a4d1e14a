"""Latest-row picks, frames, and running results that survive one very hot key.

A plain window puts all rows of a key into one task. Picks of the first k rows are safe: Spark
trims every map task to k rows per key before the shuffle. Running results over raw rows go
through :func:`chunked_scan`, which splits each key by a chunk of its order (an hour, a day),
scans the chunks in parallel and then carries one summary row per chunk forward.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

FIRST = Window.unboundedPreceding
LAST = Window.unboundedFollowing


def window(keys: Sequence[str], *order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def whole(keys: Sequence[str], *order) -> WindowSpec:
    """Frame over all rows of the key, stated because the default frame ends at the current row."""
    return window(keys, *order).rowsBetween(FIRST, LAST)


def running(keys: Sequence[str], *order) -> WindowSpec:
    return window(keys, *order).rowsBetween(FIRST, Window.currentRow)


def trailing(keys: Sequence[str], rows: int, *order) -> WindowSpec:
    """Current row and the ``rows - 1`` before it; equals days on a dense spine."""
    return window(keys, *order).rowsBetween(-(rows - 1), Window.currentRow)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key. ``order`` must end in a unique column."""
    name = rank or "_rank"
    picked = df.withColumn(name, F.row_number().over(window(keys, *order))).where(F.col(name) <= k)
    return picked if rank else picked.drop(name)


def latest(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return top_k(df, keys, [F.col(c).desc_nulls_last() for c in order])


def earliest(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return top_k(df, keys, [F.col(c).asc_nulls_last() for c in order])


def first_of_few(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """First row per key for keys that rarely repeat: one shuffle and one sort.

    A rank filter would also sort every task's rows before the shuffle, which drops next to nothing here.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_later", F.lag(F.lit(True)).over(w)).where(F.col("_later").isNull()).drop("_later")


def latest_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "is_latest") -> DataFrame:
    """Keep all rows, mark the latest. The maximum per key is a plain aggregate joined back, so a
    hot key neither sorts in one task nor blocks the skew split of the join."""
    marks = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_top"))
    return (
        df.join(marks, list(keys), "left")
        .withColumn(name, F.struct(*order).eqNullSafe(F.col("_top")))
        .drop("_top")
    )


def group_stats(df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, **aggs: Column) -> DataFrame:
    """Aggregates over the whole partition as extra columns: aggregate, then join back.

    ``df`` is read twice. In a chain of calls give the first frame as ``source`` of all of them, or
    write the frame down between them; otherwise every call doubles the reads.
    """
    stats = (df if source is None else source).groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return df.join(stats, list(keys), "left")


def chunked_scan(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    *,
    row_number: str | None = None,
    sums: dict[str, Column] | None = None,
    fills: dict[str, str] | None = None,
    lags: dict[str, str] | None = None,
    leads: dict[str, str] | None = None,
) -> DataFrame:
    """Running results per key without holding a key in one task.

    ``chunk`` must grow with ``order`` (such as the hour of the ordering time) and ``order`` must be
    unique within the key. ``sums`` gives running totals up to and including the row, ``fills`` the
    last non-null value so far, ``lags``/``leads`` the neighbouring row's value.
    """
    sums, fills, lags, leads = sums or {}, fills or {}, lags or {}, leads or {}
    keys = list(keys)
    df = df.withColumn("_chunk", chunk)
    inner = window([*keys, "_chunk"], *order)
    upto = inner.rowsBetween(FIRST, Window.currentRow)
    position = F.struct(*order)

    out = df.withColumn("_n", F.row_number().over(inner))
    for name, expr in sums.items():
        out = out.withColumn(name, F.sum(expr).over(upto))
    for name, source in fills.items():
        out = out.withColumn(name, F.last(source, ignorenulls=True).over(upto))
    for name, source in lags.items():
        out = out.withColumn(name, F.lag(source).over(inner))
    if leads:
        out = out.withColumn("_has_next", F.lead(F.lit(True), 1, False).over(inner))
        for name, source in leads.items():
            out = out.withColumn(name, F.lead(source).over(inner))

    parts = [F.count(F.lit(1)).alias("_rows")]
    parts += [F.sum(e).alias(f"_sum_{n}") for n, e in sums.items()]
    parts += [F.max_by(s, F.when(F.col(s).isNotNull(), position)).alias(f"_fill_{n}") for n, s in fills.items()]
    parts += [F.max_by(s, position).alias(f"_lag_{n}") for n, s in lags.items()]
    parts += [F.min_by(s, position).alias(f"_lead_{n}") for n, s in leads.items()]
    across = window(keys, "_chunk")
    before = across.rowsBetween(FIRST, -1)
    carried = [F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before")]
    carried += [F.sum(f"_sum_{n}").over(before).alias(f"_carry_{n}") for n in sums]
    carried += [F.last(f"_fill_{n}", ignorenulls=True).over(before).alias(f"_carry_{n}") for n in fills]
    carried += [F.lag(f"_lag_{n}").over(across).alias(f"_carry_{n}") for n in lags]
    carried += [F.lead(f"_lead_{n}").over(across).alias(f"_carry_{n}") for n in leads]
    chunks = df.groupBy(*keys, "_chunk").agg(*parts).select(*keys, "_chunk", *carried)

    on = [out[k].eqNullSafe(chunks[k]) for k in [*keys, "_chunk"]]
    joined = out.join(chunks, on, "left")
    columns = [out[c] for c in df.columns if c != "_chunk"]
    if row_number:
        columns.append((F.col("_n") + F.col("_rows_before")).cast("bigint").alias(row_number))
    for n in sums:
        carry = F.col(f"_carry_{n}")
        columns.append(F.when(carry.isNull(), out[n]).when(out[n].isNull(), carry).otherwise(out[n] + carry).alias(n))
    columns += [F.coalesce(out[n], F.col(f"_carry_{n}")).alias(n) for n in fills]
    columns += [F.when(F.col("_n") == 1, F.col(f"_carry_{n}")).otherwise(out[n]).alias(n) for n in lags]
    columns += [F.when(F.col("_has_next"), out[n]).otherwise(F.col(f"_carry_{n}")).alias(n) for n in leads]
    return joined.select(*columns)


def max_from_here(df: DataFrame, keys: Sequence[str], chunk: Column, order: str, value: str, name: str) -> DataFrame:
    """Largest value from the row to the end of its key, scanned in chunks of the order: a hot key is no single task.

    ``chunk`` must grow with ``order``. Each chunk hands its maximum to the chunks before it.
    """
    df = df.withColumn("_chunk", chunk)
    here = F.max(value).over(Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(0, Window.unboundedFollowing))
    after = F.max("_max").over(Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(1, Window.unboundedFollowing))
    chunks = df.groupBy(*keys, "_chunk").agg(F.max(value).alias("_max")).select(*[F.col(k).alias(f"_k_{k}") for k in [*keys, "_chunk"]], after.alias("_after"))
    out = df.withColumn(name, here)
    joined = out.join(chunks, [out[k].eqNullSafe(chunks[f"_k_{k}"]) for k in [*keys, "_chunk"]], "left")
    return joined.withColumn(name, F.greatest(name, "_after")).drop("_after", "_chunk", *[f"_k_{k}" for k in [*keys, "_chunk"]])


def running_total_overall(df: DataFrame, order: str, value: Column, name: str, block: Column) -> DataFrame:
    """Running total over a whole table that is already one row per ``order`` value.

    ``block`` (such as the year of a day) splits the scan; only one row per block is scanned alone.
    """
    return chunked_scan(df.withColumn("_all", F.lit(1)), ["_all"], block, [order], sums={name: value}).drop("_all")


def trailing_sums(df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, tuple[str, int]]) -> DataFrame:
    """Sums over the current row and the ``n - 1`` before it, as differences of running sums.

    A sliding frame adds up its rows anew for every row; two running sums cost the same for any n.
    ``sums`` names (column, n); the column must be an integer or a decimal without NULLs.
    """
    w = window(keys, order)
    columns = {c for c, _ in sums.values()}
    run = df.withColumns({f"_run_{c}": F.sum(c).over(running(keys, order)) for c in columns})
    out = run.withColumns({name: F.col(f"_run_{c}") - F.coalesce(F.lag(f"_run_{c}", n).over(w), F.lit(0)) for name, (c, n) in sums.items()})
    return out.drop(*[f"_run_{c}" for c in columns])


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], suffix: str = "_filled") -> DataFrame:
    """Last known value per key on a spine (rows per key bounded by its days)."""
    w = running(keys, order)
    return df.withColumns({c + suffix: F.last(c, ignorenulls=True).over(w) for c in columns})


def next_value(df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], name: str, source: DataFrame | None = None) -> DataFrame:
    """``lead(value)`` in the order of (value, tie) without sorting a whole key in one task.

    The next distinct value comes from a scan over distinct values; rows that share a value point at
    that value again unless they are the last of them. ``tie`` must be unique among equal values.
    """
    last = (df if source is None else source).groupBy(*keys, value).agg(F.max(F.struct(*tie)).alias("_last"))
    steps = last.withColumn("_after", F.lead(value).over(window(keys, value)))
    right = steps.select(*[F.col(k).alias(f"_k_{k}") for k in [*keys, value]], "_last", "_after")
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*keys, value]]
    joined = df.join(right, on, "left")
    following = F.when(F.struct(*tie) < F.col("_last"), F.col(value)).otherwise(F.col("_after"))
    return joined.withColumn(name, following).drop("_last", "_after", *[f"_k_{k}" for k in [*keys, value]])


#: Ranks of a key that lie together in :func:`leads_by_rank`.
RANKS = 4096


def leads_by_rank(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], value: str, offsets: Sequence[int]) -> DataFrame:
    """``lead(value, n)`` for several n as columns ``_lead_<n>``: rows are ranked by chunks and lie in blocks of ranks, and the first
    rows of a block are shown to the block before it too, so no key is sorted in one task and a row moves once."""
    ranked = chunked_scan(df, keys, chunk, order, row_number="_rank")
    own = F.floor((F.col("_rank") - 1) / RANKS)
    shown = F.when((own > 0) & ((F.col("_rank") - 1) % RANKS < max(offsets)), F.array(own, own - 1)).otherwise(F.array(own))
    w = window([*keys, "_block"], "_rank")
    led = ranked.withColumn("_block", F.explode(shown)).withColumns({f"_lead_{n}": F.lead(value, n).over(w) for n in offsets})
    return led.where(F.col("_block") == own).drop("_block")
