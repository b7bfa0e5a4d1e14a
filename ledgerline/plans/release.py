"""Releases, issues and contributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..functions.rules import first_match
from ..operators import joins, windows

# Part of a fix version and the component it stands for, in rule order.
COMPONENTS = [("mobile", "Mobile"), ("desktop", "Desktop"), ("playbooks", "Playbooks"), ("ir", "IR"), ("cloud", "Cloud"), ("apps", "Apps")]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def version_release_dates(seed: DataFrame) -> DataFrame:
    """Typed release table with its development window: the 17th of the month before up to the planned day."""
    planned = F.to_date("release_date")
    month_before = F.add_months(planned, -1)
    return seed.select(
        "version", F.concat(F.lit("v"), F.regexp_extract("version", r"^(\d+\.\d+)", 1)).alias("short_version"), text.version_part("version", 1).alias("version_major"),
        text.version_part("version", 2).alias("version_minor"), text.version_part("version", 3).alias("version_patch"), planned.alias("planned_release_date"),
        F.col("supported").cast("boolean").alias("is_supported"), F.col("release_number").cast("int").alias("release_number"),
        F.date_add(F.trunc(month_before, "month"), 16).alias("release_start_date"), F.coalesce(F.to_date("actual_release_date"), planned).alias("actual_release_date"),
        F.to_date("rc1_date").alias("rc1_date"),
    )


def releases(dates: DataFrame) -> DataFrame:
    """Releases with a release candidate, with the versions before and after. The table is one row per release."""
    line = windows.chunked_scan(
        dates.where(F.col("rc1_date").isNotNull()).withColumn("_all", F.lit(1)), ["_all"], F.floor(F.col("release_number") / 100), ["release_number"],
        lags={"previous_release_version": "short_version"}, leads={"next_release_version": "short_version"},
    )
    return line.drop("_all")


def fix_versions(issues: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per issue and target version, parsed, with the release dates of its short version.

    ``issues``: issue_id, fix_versions (JSON array of ``{name}``).
    """
    names = F.from_json("fix_versions", "array<struct<name:string>>")
    rows = issues.select("issue_id", F.explode(names).alias("v")).select("issue_id", F.col("v.name").alias("fix_version"))
    v = F.col("fix_version")
    number = lambda pattern, n=1: text.nth_match(v, pattern, n).try_cast("int")
    component = first_match([(v.ilike(f"%{part}%"), name) for part, name in COMPONENTS])
    month = first_match([(v.like(f"v%({m}%)"), F.lit(True)) for m in MONTHS], False)
    parsed = rows.where(text.full_match(v, r"(?i).*v\d+\.\d+.*")).select(
        "issue_id", v, text.first_match(v, r"v\d+\.\d+").alias("semver"), number(r"v(\d+)").alias("version_major"), number(r"\.(\d+)").alias("version_minor"),
        number(r"\.(\d+)", 2).alias("version_patch"), component.alias("component"), F.to_date(text.first_match(v, r"\d{2}/\d{2}/\d{2}"), "MM/dd/yy").alias("cloud_release_date"),
        (month & component.isNull()).alias("is_on_prem_release"), v.like("Cloud%v%").alias("is_cloud_release"),
    )
    known = dates.select(F.col("short_version").alias("semver"), "release_start_date", "rc1_date", "planned_release_date", "actual_release_date")
    return parsed.join(known, "semver", "left")


def labels(issues: DataFrame) -> DataFrame:
    return issues.select("issue_id", F.explode("labels").alias("label"))


def issues_snapshot(issues: DataFrame, dates: DataFrame) -> DataFrame:
    """Issues with the release in whose window they were created and the release of the week before.

    ``issues``: issue_id, created_at, updated_at, status, environment. Windows are spread over their days, so
    both lookups are equalities on the day, refined by the time of day at the ends.
    """
    rc = dates.where(F.col("rc1_date").isNotNull())
    at = F.col("created_at")
    midnight = lambda c: F.col(c).cast("timestamp_ntz")

    def lookup(spans: DataFrame, name: str) -> DataFrame:
        hits = joins.contain_join(issues.select("issue_id", "created_at"), spans, "created_at", "_start", "_end").where(at <= midnight("_end"))
        return hits.select("issue_id", *[c for c in (name, "rc1_date", "planned_release_date") if c in hits.columns])

    during = lookup(rc.select(F.col("version").alias("release_timeframe_version"), "rc1_date", "planned_release_date", F.col("release_start_date").alias("_start"), F.col("planned_release_date").alias("_end")), "release_timeframe_version")
    after = lookup(rc.select(F.col("version").alias("created_after_release_version"), F.col("actual_release_date").alias("_start"), F.date_add("actual_release_date", 7).alias("_end")), "created_after_release_version")
    x = issues.join(during, "issue_id", "left").join(after, "issue_id", "left")
    closed = F.when(F.col("status").isin("Closed", "Done"), F.col("updated_at"))
    return x.select(
        "issue_id", "created_at", closed.alias("closed_at"), "status", F.coalesce("environment", F.lit("Undefined")).alias("environment"), F.datediff(closed, "created_at").alias("lead_time_in_days"),
        "release_timeframe_version", F.coalesce(at.between(midnight("rc1_date"), midnight("planned_release_date")), F.lit(False)).alias("is_created_after_rc1_cut"), "created_after_release_version",
    )


def contributors(pull_requests: DataFrame) -> DataFrame:
    return pull_requests.groupBy("author").agg(
        F.min("merged_at").alias("min_contribution"), F.max("merged_at").alias("max_contribution"), F.count("*").alias("total_contributions")
    )
