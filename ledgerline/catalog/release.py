"""Release, issue and contribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import release as plan
from . import standins as s
from .registry import query

# One release per order month: version 5.<n>, planned on the 16th, candidate on the 5th for most of them.
s.define("release_dates", """
SELECT '5.' || n || '.0' AS version, 'v5.' || n AS short_version, 5 AS version_major, CAST(n AS INTEGER) AS version_minor, 0 AS version_patch, m + 15 AS planned_release_date, n % 2 = 0 AS is_supported, CAST(n AS INTEGER) AS release_number, (m - INTERVAL 1 MONTH)::DATE + 16 AS release_start_date,
 CASE WHEN n % 3 = 0 THEN m + 17 ELSE m + 15 END AS actual_release_date, CASE WHEN n % 7 > 0 THEN m + 4 END AS rc1_date FROM (SELECT m, row_number() OVER (ORDER BY m) - 1 AS n FROM (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS m FROM orders))""")


def release_dates(t):
    month = F.trunc("o_orderdate", "month")
    months = t.orders.select(month.alias("m")).distinct()
    first = t.orders.agg(F.trunc(F.min("o_orderdate"), "month")).first()[0]
    n = (F.year("m") - F.year(F.lit(first))) * 12 + F.month("m") - F.month(F.lit(first))
    seed = months.withColumn("n", n).select(
        F.concat(F.lit("5."), "n", F.lit(".0")).alias("version"), F.date_add("m", 15).cast("string").alias("release_date"), F.when(F.col("n") % 2 == 0, "true").otherwise("false").alias("supported"),
        F.col("n").cast("string").alias("release_number"), F.when(F.col("n") % 3 == 0, F.date_add("m", 17).cast("string")).alias("actual_release_date"),
        F.when(F.col("n") % 7 > 0, F.date_add("m", 4).cast("string")).alias("rc1_date"),
    )
    return plan.version_release_dates(seed)


_NAMES = ["CASE o_orderkey % 4 WHEN 0 THEN 'v5.' || (o_custkey % 90) || ' (Mar 2021)' WHEN 1 THEN 'Cloud 01/15/21 v5.' || (o_custkey % 90) || '.2' WHEN 2 THEN 'Mobile v1.' || (o_custkey % 40) ELSE 'Backlog' END",
          "CASE WHEN o_orderstatus = 'F' THEN 'v5.' || (o_custkey % 80) || '.1' END"]


def issues(t):
    key, c = F.col("o_orderkey"), F.col("o_custkey")
    first = (
        F.when(key % 4 == 0, F.concat(F.lit("v5."), c % 90, F.lit(" (Mar 2021)"))).when(key % 4 == 1, F.concat(F.lit("Cloud 01/15/21 v5."), c % 90, F.lit(".2")))
        .when(key % 4 == 2, F.concat(F.lit("Mobile v1."), c % 40)).otherwise("Backlog")
    )
    second = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("v5."), c % 80, F.lit(".1")))
    names = F.filter(F.array(first, second), lambda x: x.isNotNull())
    return t.orders.select(
        F.concat(F.lit("i"), key).alias("issue_id"), F.to_json(F.transform(names, lambda x: F.struct(x.alias("name")))).alias("fix_versions"), F.array("o_orderpriority", "o_orderstatus").alias("labels"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("created_at"), (F.col("o_orderdate") + F.make_dt_interval((key % 60).cast("int"))).alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", "Done").when(F.col("o_orderstatus") == "P", "Closed").otherwise("Open").alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "cloud").alias("environment"),
    )


@query("j101_fix_versions", s.with_("release_dates") + rf"""
, v AS (SELECT 'i' || o_orderkey AS issue_id, unnest([{_NAMES[0]}, {_NAMES[1]}]) AS fix_version FROM orders),
p AS (SELECT issue_id, fix_version, regexp_extract(fix_version, 'v[0-9]+\.[0-9]+') AS semver, CAST(regexp_extract(fix_version, 'v([0-9]+)', 1) AS INTEGER) AS version_major, CAST(regexp_extract(fix_version, '\.([0-9]+)', 1) AS INTEGER) AS version_minor, TRY_CAST(regexp_extract_all(fix_version, '\.([0-9]+)', 1)[2] AS INTEGER) AS version_patch,
  CASE WHEN fix_version LIKE 'Mobile%' THEN 'Mobile' WHEN fix_version LIKE 'Cloud%' THEN 'Cloud' END AS component, CASE WHEN fix_version LIKE 'Cloud%' THEN DATE '2021-01-15' END AS cloud_release_date, fix_version LIKE 'v%(Mar%)' AS is_on_prem_release, fix_version LIKE 'Cloud%v%' AS is_cloud_release FROM v WHERE fix_version IS NOT NULL AND fix_version <> 'Backlog')
SELECT p.*, release_start_date, rc1_date, planned_release_date, actual_release_date FROM p LEFT JOIN release_dates d ON d.short_version = p.semver""")
def _(t):
    return plan.fix_versions(issues(t), release_dates(t))


@query("j102_labels", "SELECT 'i' || o_orderkey AS issue_id, unnest([o_orderpriority, o_orderstatus]) AS label FROM orders")
def _(t):
    return plan.labels(issues(t))


@query("j103_releases", s.with_("release_dates") + """
SELECT *, lag(short_version) OVER (ORDER BY release_number) AS previous_release_version, lead(short_version) OVER (ORDER BY release_number) AS next_release_version FROM release_dates WHERE rc1_date IS NOT NULL""")
def _(t):
    return plan.releases(release_dates(t))


@query("j104_issues_snapshot", s.with_("release_dates") + """
, r AS (SELECT * FROM release_dates WHERE rc1_date IS NOT NULL),
i AS (SELECT 'i' || o_orderkey AS issue_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created_at, o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS updated_at, CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'P' THEN 'Closed' ELSE 'Open' END AS status, CASE WHEN o_orderpriority = '1-URGENT' THEN 'cloud' END AS environment FROM orders)
SELECT issue_id, created_at, CASE WHEN status <> 'Open' THEN updated_at END AS closed_at, status, coalesce(environment, 'Undefined') AS environment, CASE WHEN status <> 'Open' THEN CAST(date_diff('day', created_at, updated_at) AS INTEGER) END AS lead_time_in_days, a.version AS release_timeframe_version,
 coalesce(created_at >= a.rc1_date AND created_at <= a.planned_release_date, false) AS is_created_after_rc1_cut, b.version AS created_after_release_version
FROM i LEFT JOIN r a ON created_at >= a.release_start_date AND created_at <= a.planned_release_date LEFT JOIN r b ON created_at >= b.actual_release_date AND created_at <= b.actual_release_date + 7""")
def _(t):
    return plan.issues_snapshot(issues(t), release_dates(t))


@query("j105_contributors", "SELECT c_name AS author, min(o_orderdate) AS min_contribution, max(o_orderdate) AS max_contribution, count(*) AS total_contributions FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def _(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("author"), F.col("o_orderdate").alias("merged_at"))
    return plan.contributors(rows)
