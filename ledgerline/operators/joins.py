"""Joins that plain equality does not express, rewritten so that no nested loop is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join where NULL equals NULL; the key columns of the left side are kept."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]
    joined = left.join(right, on, how)
    return joined.drop(*[f"_r_{k}" for k in keys]) if how not in ("left_semi", "left_anti") else joined


def dense_days(df: DataFrame, first: str | Column, last: str | Column, name: str = "activity_date") -> DataFrame:
    """One row per day of the span carried by each row: the spine without a range join."""
    lo, hi = (F.col(x) if isinstance(x, str) else x for x in (first, last))
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )
    return df.withColumn(name, F.explode(days))


def contain_join(points: DataFrame, spans: DataFrame, day: str, start: str, end: str, how: str = "inner",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Match each point's day with the spans that contain it (both ends included).

    Every span becomes one row per day, so the match is an equality on the day.
    """
    spread = dense_days(spans, start, end, "_day")
    points = points.withColumn("_day", F.col(day).cast("date"))
    return points.join(spread, ["_day", *keys], how).drop("_day")


def range_bucket_join(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: int,
                      how: str = "left") -> DataFrame:
    """Match a number with the ranges that hold it: equality on the bucket, then the bounds.

    A range that spans several buckets is repeated once per bucket. The ranges of one bucket are
    bounded by its width when ranges do not overlap; a hot bucket of points is split by AQE.
    """
    spread = ranges.withColumn(
        "_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width)))
    )
    points = points.withColumn("_bucket", F.floor(F.col(value) / width))
    on = (points["_bucket"] == spread["_bucket"]) & points[value].between(spread[low], spread[high])
    return points.join(spread, on, how).drop("_bucket")


def product(left: DataFrame, right: DataFrame, buckets: int = 16) -> DataFrame:
    """All pairs of two small sides, as an equality on a bucket: each right row has one, each left row stands in all."""
    spread = left.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return spread.join(right.withColumn("_bucket", F.pmod(F.xxhash64(*right.columns), F.lit(buckets)).cast("int")), "_bucket").drop("_bucket")


def prefix_join(full: DataFrame, prefixes: DataFrame, text: str, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``full`` whose ``text`` starts with the other side's ``prefix``, within equal keys.

    A text is cut only at the lengths that prefixes have (read first, at most one number per length), so the match is an equality, a text is repeated
    at most once per such length, and a hot key holds no pairs that do not match.
    """
    lengths = sorted(r[0] for r in prefixes.select(F.length(prefix)).distinct().collect() if r[0] is not None)
    cut = F.explode(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(text)))
    parts = full.withColumn("_length", cut).withColumn("_part", F.left(F.col(text), F.col("_length"))).drop("_length")
    return parts.join(prefixes.withColumn("_part", F.col(prefix)), [*keys, "_part"]).drop("_part")


def either_key_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str,
                    left_id: str, right_id: str) -> DataFrame:
    """``l.a = r.k OR l.b = r.k`` as a union of equi joins, each pair once."""
    pairs = None
    for key in left_keys:
        hit = left.select(left_id, F.col(key).alias("_k")).join(
            right.select(right_id, F.col(right_key).alias("_k")), "_k"
        ).select(left_id, right_id)
        pairs = hit if pairs is None else pairs.unionByName(hit)
    return left.join(pairs.distinct(), left_id).join(right, right_id)


def as_of_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, last_day: str) -> DataFrame:
    """Validity interval of each row: up to the day before the key's next start."""
    from pyspark.sql import Window

    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return df.withColumn(end, F.coalesce(F.date_sub(following, 1), F.to_date(F.lit(last_day))))


def last_before(events: DataFrame, history: DataFrame, keys: Sequence[str], event_time: str, history_time: str,
                carry: Sequence[str], chunk: Column | None = None, tie: str | None = None) -> DataFrame:
    """Each event with the ``carry`` columns of the latest history row strictly before it (or NULLs).

    Both sides are laid into one time line and filled forward: linear in the rows, whatever the
    number of history rows before an event, and split by ``chunk`` (default: the day).
    """
    from .windows import chunked_scan

    payload = F.struct(F.col(history_time), *carry)
    line = events.select(
        F.struct(*events.columns).alias("_event"), *keys, F.col(event_time).alias("_at"), F.lit(0).alias("_side"),
        (F.col(tie) if tie else F.lit(0)).cast("string").alias("_tie"),
        F.lit(None).cast(history.select(payload.alias("p")).schema["p"].dataType).alias("_seen"),
    ).unionByName(
        history.select(
            *keys, F.col(history_time).alias("_at"), F.lit(1).alias("_side"),
            F.xxhash64(*carry).cast("string").alias("_tie"), payload.alias("_seen"),
        ),
        allowMissingColumns=True,
    )
    by = F.col("_at").cast("date") if chunk is None else chunk
    filled = chunked_scan(line, keys, by, ["_at", "_side", "_tie"], fills={"_last": "_seen"}).where(F.col("_side") == 0)
    return filled.select("_event.*", *[F.col(f"_last.{c}").alias(c) for c in [history_time, *carry]])


def hierarchy_paths(edges: DataFrame, sep: str = " > ") -> DataFrame:
    """Root, path and level of every node of ``edges(id, parent, name)`` that a root (no parent) reaches.

    Every round joins each open node with the node it points to and takes over that node's pointer, so
    the known path doubles and a tree of depth d needs log2(d) joins. Each round writes down only the nodes
    that were open. Nodes under a missing parent drop out. A path cannot be longer than there are nodes, so a node that
    claims to be deeper is on a cycle or below one, and that fails.
    """
    nodes = edges.select(
        "id", F.col("parent").alias("up"), "name", F.col("id").alias("root_id"), F.col("name").alias("root_name"), F.col("name").alias("path"), F.lit(0).alias("level")
    )
    nodes = materialize(nodes, "hierarchy")
    total, done = nodes.count(), nodes.where(F.col("up").isNull())
    while True:
        pending = nodes.where(F.col("up").isNotNull())
        deepest = pending.agg(F.max("level")).first()[0]
        if deepest is None:
            return done.drop("up")
        if deepest >= total:
            raise ValueError("the hierarchy has a cycle")
        above = done.unionByName(pending).select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("root_id").alias("_root_id"), F.col("root_name").alias("_root_name"), F.col("path").alias("_path"),
            F.col("level").alias("_level"),
        )
        jumped = pending.join(above, "up").select(
            "id", F.col("_up").alias("up"), "name", F.col("_root_id").alias("root_id"), F.col("_root_name").alias("root_name"),
            F.concat("_path", F.lit(sep), "path").alias("path"), (F.col("_level") + F.col("level") + 1).alias("level"),
        )
        nodes = materialize(jumped, "hierarchy")
        done = done.unionByName(nodes.where(F.col("up").isNull()))


def full_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer joins over the same key, the key coalesced at every step."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, list(keys), "full")
    return out


def presence_join(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of keys as a spine, then one left join per sparse source."""
    spine = None
    for frame in frames:
        part = frame.select(*keys)
        spine = part if spine is None else spine.unionByName(part)
    out = spine.distinct()
    for frame in frames:
        out = out.join(frame, list(keys), "left")
    return out


def trailing_distinct(active: DataFrame, keys: Sequence[str], member: str, day: str, span: int, name: str) -> DataFrame:
    """Exact distinct members per key seen on the day or the ``span - 1`` days before it.

    Each member-day covers the days up to its next active day or the end of the span. Summing the
    start and end marks of these covers per day and running over days counts every member once,
    without copying a member-day ``span`` times.
    """
    from pyspark.sql import Window

    days = active.select(*keys, member, F.col(day).cast("date").alias(day)).distinct()
    nxt = F.lead(day).over(Window.partitionBy(*keys, member).orderBy(day))
    stop = F.least(F.date_add(day, span), F.coalesce(nxt, F.date_add(day, span)))
    covers = days.withColumn("_stop", stop)
    marks = covers.select(*keys, F.col(day), F.lit(1).alias("_d")).unionAll(
        covers.select(*keys, F.col("_stop").alias(day), F.lit(-1).alias("_d"))
    ).groupBy(*keys, day).agg(F.sum("_d").alias("_d"))
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    steps = marks.withColumn(name, F.sum("_d").over(w)).drop("_d")
    until = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    return dense_days(steps.withColumn("_until", F.date_sub(until, 1)).withColumnRenamed(day, "_from")
                      .where(F.col("_until").isNotNull()), "_from", "_until", day).select(*keys, day, name)


def first_seen_running(active: DataFrame, keys: Sequence[str], member: str, day: str, name: str) -> DataFrame:
    """Distinct members per key up to each day: first days counted, then a running sum of days."""
    from pyspark.sql import Window

    firsts = active.groupBy(*keys, member).agg(F.min(F.col(day).cast("date")).alias(day))
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return firsts.groupBy(*keys, day).agg(F.count("*").alias("_new")).select(
        *keys, day, F.sum("_new").over(w).alias(name)
    )


def interval_sums(df: DataFrame, keys: Sequence[str], start: str, end: str, measures: Sequence[str], frm: str = "from_day", to: str = "to_day") -> DataFrame:
    """Sum of the measures of all intervals in force, as steps ``[frm, to]`` per key (both ends included).

    Every interval gives one mark where it starts and one after it ends; a running sum over the marked
    days gives the steps. So a year-long interval costs two rows, not 365. ``_open`` counts intervals.
    """
    from pyspark.sql import Window

    # Both marks come from one pass over the rows: a union would read, shuffle and sort the input twice.
    mark = lambda day, sign: F.struct(day.alias(frm), *[(F.col(m) * sign).alias(m) for m in measures], F.lit(sign).alias("_open"))
    columns = [*measures, "_open"]
    both = df.select(*keys, F.explode(F.array(mark(F.col(start), 1), mark(F.date_add(end, 1), -1))).alias("_mark")).select(*keys, "_mark.*")
    marks = both.groupBy(*keys, frm).agg(*[F.sum(c).alias(c) for c in columns])
    w = Window.partitionBy(*keys).orderBy(frm)
    steps = marks.select(
        *keys, frm, F.date_sub(F.lead(frm).over(w), 1).alias(to), *[F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in columns]
    )
    return steps.where(F.col("_open") > 0)
