"""Data checks: each returns the failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that occur more than once; rows with a NULL key are left out."""
    kept = df
    for c in columns if len(columns) == 1 else ():
        kept = kept.where(F.col(c).isNotNull())
    return kept.groupBy(*columns).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low if inclusive else c <= low)
    if high is not None:
        bad = bad | (c > high if inclusive else c >= high)
    return df.where(bad)


def expression_is_true(df: DataFrame, expression: Column | str) -> DataFrame:
    e = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~F.coalesce(e, F.lit(False)))


def not_empty_string(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(column) == "")


def sequential_values(df: DataFrame, keys: Sequence[str], column: str, step: int = 1) -> DataFrame:
    """Rows of a daily spine whose next row is not ``step`` days later."""
    nxt = F.lead(column).over(Window.partitionBy(*keys).orderBy(column))
    return df.withColumn("next_value", nxt).where(F.datediff("next_value", column) != step)


def one_to_one(df: DataFrame, left: str, right: str) -> DataFrame:
    """Left values that are paired with several right values."""
    return df.groupBy(left).agg(F.countDistinct(right).alias("n_values")).where(F.col("n_values") > 1)


def coverage_gap(actual: DataFrame, plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations missing on either side, NULL equal to NULL, with the side that lacks them."""
    a = actual.select(*keys).distinct()
    p = plan.select(*keys).distinct()

    def missing(x, y, label):
        on = [x[k].eqNullSafe(y[k]) for k in keys]
        return x.join(y, on, "left_anti").withColumn("missing_from", F.lit(label))

    return missing(a, p, "plan").unionByName(missing(p, a, "data"))


def overlap(delta: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Counts that show whether delta rows are already in the base: one row."""
    known = base.select(key).distinct().withColumn("_known", F.lit(1))
    return delta.join(known, key, "left").agg(
        F.count("*").alias("delta_rows"), F.count("_known").alias("shared_rows")
    )


def severity(failures: DataFrame, warn_if: int = 0, error_if: int | None = None) -> DataFrame:
    """One row with the number of failing rows and pass / warn / error."""
    n = F.col("failures")
    status = F.when(n > error_if, "error") if error_if is not None else F.when(F.lit(False), "error")
    return failures.agg(F.count("*").alias("failures")).withColumn(
        "status", status.when(n > warn_if, "warn").otherwise("pass")
    )


def new_names(events: DataFrame, name: str, ts: str, since: Column) -> DataFrame:
    """Event names first seen at or after ``since``."""
    return events.groupBy(name).agg(F.min(ts).alias("first_seen")).where(F.col("first_seen") >= since)


def check(df: DataFrame, rules: dict[str, DataFrame]) -> DataFrame:
    """Failure count per named rule."""
    out = None
    for rule, failing in rules.items():
        part = failing.agg(F.count("*").alias("failures")).withColumn("rule", F.lit(rule))
        out = part if out is None else out.unionByName(part)
    return out.select("rule", "failures")
