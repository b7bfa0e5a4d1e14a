"""Aggregates, pivots and melts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import slug


def consensus(c: Column | str) -> Column:
    """The value if all non-null values of the group agree, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c))


def agreed_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups in which every column has exactly one value, with these values."""
    agg = df.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in columns],
        *[F.max(c).alias(f"_max_{c}") for c in columns],
    )
    for c in columns:
        agg = agg.where(F.col(c) == F.col(f"_max_{c}"))
    return agg.select(*keys, *columns)


def joined_set(c: Column | str, sep: str = ",") -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def pivot_known(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], prefix: str = "",
                suffix: str = "", then: Column | int = 1, otherwise: Column | int | None = 0,
                agg=F.sum, extra: Sequence[Column] = ()) -> DataFrame:
    """One column per value: ``agg(CASE WHEN column = value THEN then ELSE otherwise END)``."""
    then = then if isinstance(then, Column) else F.lit(then)

    def cell(v):
        case = F.when(F.col(column) == v, then)
        return case if otherwise is None else case.otherwise(otherwise)

    return df.groupBy(*keys).agg(*extra, *[agg(cell(v)).alias(f"{prefix}{slug(str(v))}{suffix}") for v in values])


def pivot_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a category column, one result column each: name the values where a rule table has them."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def pivot_from_data(df: DataFrame, keys: Sequence[str], column: str, **options) -> DataFrame:
    return pivot_known(df, keys, column, pivot_values(df, column), **options)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str, keep_null: bool = False) -> DataFrame:
    out = df.unpivot(list(ids), list(values), variable, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def ranked_label_max(rank_of: dict[str, int], c: Column | str) -> Column:
    """Highest ranked label of the group."""
    c = F.col(c) if isinstance(c, str) else c
    rank = None
    for label, r in rank_of.items():
        rank = F.when(c == label, r) if rank is None else rank.when(c == label, r)
    top = F.max(rank)
    out = None
    for label, r in rank_of.items():
        out = F.when(top == r, label) if out is None else out.when(top == r, label)
    return out


def most_frequent(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key, ties to the larger value; counts are combined before the shuffle."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).count()
    return counts.groupBy(*keys).agg(F.max_by(column, F.struct("count", column)).alias(column), F.max("count").alias("votes"))


def spread(df: DataFrame, per_task: int, *keys: str) -> DataFrame:
    """``df`` in as many tasks as its rows ask for, by the keys' hash: for slow work on small rows, where bytes say nothing about time."""
    return df.repartition(max(1, -(-df.count() // per_task)), *keys)
