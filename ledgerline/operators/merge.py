"""Incremental loads on plain parquet: every merge is a join that gives the new state of a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# ---------------------------------------------------------------- water marks


def high_water_mark(target: DataFrame, column: str):
    """Largest value as a Python literal, so that the filter built from it reaches the parquet scan."""
    return target.agg(F.max(column)).first()[0]


def since_mark(source: DataFrame, target: DataFrame, column: str, back: timedelta = timedelta(0),
               inclusive: bool = True) -> DataFrame:
    """Source rows at or after the target's mark, moved back by a late-arrival allowance."""
    mark = high_water_mark(target, column)
    if mark is None:
        return source
    limit = F.lit(mark - back)
    return source.where(F.col(column) >= limit if inclusive else F.col(column) > limit)


def source_marks(target: DataFrame, tag: str, column: str) -> dict:
    """Latest value per source as Python literals; there is one row per source."""
    return {r[0]: r[1] for r in target.groupBy(tag).agg(F.max(column)).collect()}


def per_source_marks(source: DataFrame, target: DataFrame, tag: str, column: str) -> DataFrame:
    """Rows newer than the mark of their own source; sources without a mark are taken whole.

    The marks are literals of the filter, which reaches the scan; rows of several relations are better filtered one by one
    before their union.
    """
    marks = {k: v for k, v in source_marks(target, tag, column).items() if k is not None and v is not None}
    if not marks:
        return source
    by_mark: dict = {}
    for name, mark in marks.items():
        by_mark.setdefault(mark, []).append(name)
    unknown = F.col(tag).isNull() | ~F.col(tag).isin(sorted(marks))
    return source.where(reduce(lambda a, b: a | b, [F.col(tag).isin(sorted(names)) & (F.col(column) > F.lit(mark)) for mark, names in by_mark.items()], unknown))


def slowest_source_mark(target: DataFrame, tag: str, column: str):
    """Oldest of the per-source maxima."""
    return target.groupBy(tag).agg(F.max(column).alias("m")).agg(F.min("m")).first()[0]


# ---------------------------------------------------------------- new state of a table


def in_partitions(target: DataFrame, new: DataFrame, partition: str | None) -> DataFrame:
    """The target's rows in the partitions of the batch, named as literals so that the scan is pruned."""
    if partition is None:
        return target
    touched = [r[0] for r in new.select(partition).distinct().collect()]
    return target.where(F.col(partition).isin([v for v in touched if v is not None]) | (F.col(partition).isNull() if None in touched else F.lit(False)))


def write_partitions(state: DataFrame, path: str, partition: str) -> None:
    """Replace just the partitions that occur in ``state``; the others are not read or written. Write a state down before it goes back to its own path."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def incremental_append(new: DataFrame, target: DataFrame, key: Sequence[str], partition: str | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not in the target.

    ``partition`` names a column that a key never changes (a day, say): then only the target's partitions
    that occur in the batch are read.
    """
    return new.join(in_partitions(target, new, partition).select(*key), list(key), "left_anti")


def incremental_merge(new: DataFrame, target: DataFrame, key: Sequence[str], update: Sequence[str] | None = None, partition: str | None = None) -> DataFrame:
    """Update the listed columns where the key matches, insert the other new rows.

    With ``partition`` the result holds the touched partitions only, for :func:`write_partitions`.
    """
    target = in_partitions(target, new, partition)
    update = list(update) if update is not None else [c for c in target.columns if c not in key]
    n = new.select(*key, *[F.col(c).alias(f"_n_{c}") for c in target.columns if c not in key]).withColumn("_new", F.lit(True))
    t = target.withColumn("_old", F.lit(True))
    joined = t.join(n, list(key), "full")

    def merged(c: str) -> Column:
        fresh = F.col("_old").isNull()
        if c in update:
            fresh = fresh | F.col("_new").isNotNull()
        return F.when(fresh, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[F.col(c) if c in key else merged(c) for c in target.columns])


def delete_insert(new: DataFrame, target: DataFrame, key: Sequence[str], partition: str | None = None) -> DataFrame:
    """Replace all rows of the keys that occur in the new batch.

    With ``partition`` the result holds the touched partitions only, for :func:`write_partitions`.
    """
    target = in_partitions(target, new, partition)
    kept = target.join(new.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(new)


def widest(a: str, b: str) -> str:
    """Common type of two simple types: text swallows all, else the wider number."""
    if a == b:
        return a
    order = ["boolean", "tinyint", "smallint", "int", "bigint", "float", "double"]
    if a in order and b in order:
        return max(a, b, key=order.index)
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp_ntz"
    return "string"


def union_relations(frames: dict[str, DataFrame] | Sequence[DataFrame], include: Sequence[str] | None = None,
                    exclude: Sequence[str] = (), source_column: str | None = None) -> DataFrame:
    """Union over the superset of columns: missing ones are NULL, differing types are widened."""
    named = frames if isinstance(frames, dict) else {str(i): f for i, f in enumerate(frames)}
    types: dict[str, str] = {}
    for frame in named.values():
        for name, dtype in frame.dtypes:
            if name in exclude or (include is not None and name not in include):
                continue
            types[name] = widest(types[name], dtype) if name in types else dtype

    def aligned(tag: str, frame: DataFrame) -> DataFrame:
        have = set(frame.columns)
        cols = [(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return frame.select(*cols, *([F.lit(tag).alias(source_column)] if source_column else []))

    return reduce(DataFrame.unionAll, [aligned(tag, frame) for tag, frame in named.items()])


def schema_evolve(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Base with the columns only the delta has, NULL filled, added in alphabetical order."""
    extra = sorted(set(delta.columns) - set(base.columns))
    types = dict(delta.dtypes)
    return base.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in extra])


def merge_delta_into_base(base: DataFrame, delta: DataFrame, key: str = "id", ts: str = "received_at",
                          prune_days: int = 7, later: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New base rows and the rest of the delta after an insert-only merge.

    Only the base slice from ``prune_days`` before the delta's first arrival is searched for the
    key, as a literal that prunes files and date partitions. ``later`` is the delta as it stands when the merge
    has run. Returns (rows to append, rows of ``later`` that the merge has not seen, which stay in the delta).
    """
    later = delta if later is None else later
    first = delta.agg(F.min(ts)).first()[0]
    if first is None:
        return delta, later
    searched = base.where(F.col(ts) >= F.lit(first - timedelta(days=prune_days)))
    fresh = delta.join(searched.select(key), key, "left_anti")
    return fresh, later.join(delta.select(key), key, "left_anti")


def merged_base(base: DataFrame, delta: DataFrame, key: str = "id", ts: str = "received_at", prune_days: int = 7) -> DataFrame:
    fresh, _ = merge_delta_into_base(base, delta, key, ts, prune_days)
    evolved = schema_evolve(base, delta)
    return evolved.unionByName(fresh, allowMissingColumns=True)


def read_base_plus_delta(base: DataFrame, delta: DataFrame, key: str = "id", exclude: Sequence[str] = ()) -> DataFrame:
    """Base rows whose id is not in the delta, and all delta rows, without the excluded columns."""
    return base.join(delta.select(key), key, "left_anti").drop(*exclude).unionByName(delta.drop(*exclude), allowMissingColumns=True)


def build_delta(source: DataFrame, base: DataFrame, key: str = "id", ts: str = "received_at", days: int = 2, delta: DataFrame | None = None) -> DataFrame:
    """Source rows since ``days`` before the mark whose id the base does not hold in that same time.

    The mark is the latest arrival in the base or in the delta as it stands. An id whose base row is older comes
    back, as the base is only searched in the pruned slice.
    """
    marks = [m for m in (high_water_mark(x, ts) for x in (base, delta) if x is not None) if m is not None]
    if not marks:
        return source
    since = F.lit(max(marks) - timedelta(days=days))
    return source.where(F.col(ts) >= since).join(base.where(F.col(ts) >= since).select(key), key, "left_anti")


def update_from(target: DataFrame, source: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set the columns from the matching source row, leave other rows alone."""
    s = source.select(*key, *[F.col(c).alias(f"_s_{c}") for c in columns]).withColumn("_hit", F.lit(True))
    joined = target.join(s, list(key), "left")
    return joined.select(
        *[F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in target.columns]
    )


def delete_using(target: DataFrame, source: DataFrame, key: Sequence[str], predicate=None) -> DataFrame:
    """Target rows without a source row of the same key that also meets ``predicate(target, source)``."""
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns])
    on = [target[k] == s[f"_s_{k}"] for k in key]
    if predicate is not None:
        on.append(predicate(lambda c: target[c], lambda c: s[f"_s_{c}"]))
    return target.join(s, on, "left_anti")


def sync_diff(desired: DataFrame, current: DataFrame, key: Sequence[str], columns: Sequence[str],
              insert_missing: bool = False) -> DataFrame:
    """Rows whose values differ from the destination's, NULL equal to NULL."""
    cur = current.select(*key, F.struct(*columns).alias("_current"))
    joined = desired.join(cur, list(key), "left" if insert_missing else "inner")
    return joined.where(~F.struct(*columns).eqNullSafe(F.col("_current"))).drop("_current")
