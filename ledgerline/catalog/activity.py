"""Activity, spine, retention and server queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import activity as plan, calendars
from . import standins as s
from .registry import mart, query

START = "2024-01-01"
DAY = "'2024-01-31'"

# ---------------------------------------------------------------- shapes

s.define("current_tracks", "SELECT * FROM tracks WHERE event IN ('click', 'view', 'purchase')", "tracks")
s.define("legacy_tracks", "SELECT * FROM tracks WHERE event IN ('purchase', 'signup', 'error')", "tracks")


def current_tracks(t):
    return s.tracks(t).where(F.col("event").isin("click", "view", "purchase"))


def legacy_tracks(t):
    return s.tracks(t).where(F.col("event").isin("purchase", "signup", "error"))


def _daily_sql(source: str) -> str:
    return f"""
SELECT md5(activity_date || '-' || server_id || '-' || user_id) AS daily_user_id, activity_date, server_id, user_id, true AS is_active, max(received_on) AS received_at_date,
 CAST(sum(CASE WHEN kind = 'd' THEN 1 ELSE 0 END) AS BIGINT) AS is_desktop, CAST(sum(CASE WHEN kind = 'w' THEN 1 ELSE 0 END) AS BIGINT) AS is_webapp
FROM (SELECT DISTINCT "timestamp"::DATE AS activity_date, server_id, user_id, received_at::DATE AS received_on,
   CASE WHEN context_user_agent LIKE '%Electron%' THEN 'd' WHEN context_user_agent IS NOT NULL THEN 'w' END AS kind FROM {source} WHERE received_at <= TIMESTAMP '2024-01-31 00:00:00')
GROUP BY ALL"""


s.define("current_daily", _daily_sql("current_tracks"), "current_tracks")
s.define("legacy_daily", _daily_sql("legacy_tracks"), "legacy_tracks")


def current_daily(t):
    return plan.user_daily_activity(current_tracks(t), s.AS_OF, START)


def legacy_daily(t):
    return plan.user_daily_activity(legacy_tracks(t), s.AS_OF, START)


s.define("merged_days", """
SELECT coalesce(s.activity_date, l.activity_date) AS activity_date, coalesce(s.server_id, l.server_id) AS server_id, coalesce(s.user_id, l.user_id) AS user_id,
 true AS is_active, coalesce(s.is_desktop > 0, false) AS is_client_desktop, coalesce(s.is_webapp > 0, false) AS is_client_webapp,
 coalesce(l.is_desktop > 0, false) AS is_legacy_desktop, coalesce(l.is_webapp > 0, false) AS is_legacy_webapp, coalesce(s.is_desktop, l.is_desktop) > 0 AS is_desktop,
 coalesce(s.is_webapp, l.is_webapp) > 0 AS is_webapp, coalesce(s.is_desktop, l.is_desktop) = 0 AND coalesce(s.is_webapp, l.is_webapp) = 0 AS is_unknown
FROM current_daily s FULL JOIN legacy_daily l ON s.daily_user_id = l.daily_user_id""", "current_daily", "legacy_daily")


def _flag_columns() -> str:
    out = []
    for m in plan.METRICS:
        out.append(f"coalesce({m}, false) AS {m}_today")
        for n in (7, 30):
            out.append(f"bool_or(coalesce({m}, false)) OVER (PARTITION BY s.server_id, s.user_id ORDER BY s.activity_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {m}_last_{n}_days")
    return ",\n ".join(out)


s.define("user_spine", f"""
SELECT s.activity_date, s.server_id, s.user_id, {_flag_columns()}
FROM (SELECT server_id, user_id, unnest(generate_series(min(activity_date)::TIMESTAMP, TIMESTAMP {DAY}, INTERVAL 1 DAY))::DATE AS activity_date FROM merged_days GROUP BY server_id, user_id) s
LEFT JOIN merged_days m ON s.activity_date = m.activity_date AND s.server_id = m.server_id AND s.user_id = m.user_id""", "merged_days")


def user_spine(t):
    return plan.user_activity_spined(current_daily(t), legacy_daily(t), s.AS_OF)


# Reports of many small servers: one server per user of the events.
s.define("server_reports", f"""
SELECT 'v' || user_id AS server_id, ts AS "timestamp", event_id, event_type, k, '9.' || (k % 3) || '.' || (k % 5) AS version_full,
 CASE k % 4 WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' END AS operating_system, CASE k % 2 WHEN 0 THEN 'postgres' END AS database_type,
 CASE k % 5 WHEN 0 THEN '12.3.1' WHEN 1 THEN '13beta2' WHEN 2 THEN '8.0' WHEN 3 THEN 'n/a' END AS database_version, k % 3 = 0 AS edition,
 CASE WHEN user_id % 3 = 0 THEN 'i' || (user_id // 6) END AS installation_id, CASE WHEN user_id % 2 = 0 THEN 'kubernetes' END AS installation_type,
 '10.' || (user_id % 7) || '.' || k || '.' || (user_id % 250) AS server_ip, k AS daily_active_users, k * 10 AS monthly_active_users, k * 30 AS count_registered_users,
 k % 9 AS count_registered_deactivated_users, k * 7 AS count_posts, k % 6 AS count_teams
FROM (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k FROM events)""")


def server_reports(t):
    k, u = F.col("k"), F.col("user_id")
    return t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).select(
        F.concat(F.lit("v"), u).alias("server_id"), F.col("ts").alias("timestamp"), "event_id", "event_type", "k",
        F.concat(F.lit("9."), k % 3, F.lit("."), k % 5).alias("version_full"), s.pick(k % 4, ["linux", "windows"]).alias("operating_system"),
        s.pick(k % 2, ["postgres"]).alias("database_type"), s.pick(k % 5, ["12.3.1", "13beta2", "8.0", "n/a"]).alias("database_version"),
        (k % 3 == 0).alias("edition"), F.when(u % 3 == 0, F.concat(F.lit("i"), F.floor(u / 6))).alias("installation_id"),
        F.when(u % 2 == 0, "kubernetes").alias("installation_type"), F.concat(F.lit("10."), u % 7, F.lit("."), k, F.lit("."), u % 250).alias("server_ip"),
        k.alias("daily_active_users"), (k * 10).alias("monthly_active_users"), (k * 30).alias("count_registered_users"),
        (k % 9).alias("count_registered_deactivated_users"), (k * 7).alias("count_posts"), (k % 6).alias("count_teams"),
    )


TELEMETRY = ["version_full", "operating_system", "database_type", "database_version", "edition", "installation_id", "installation_type", "server_ip"]
ACTIVITY = ["daily_active_users", "monthly_active_users", "count_registered_users", "count_registered_deactivated_users", "count_posts", "count_teams"]
# Report kind per event type.
KINDS = {"telemetry": "click", "legacy": "view", "diagnostics": "error", "activity": "signup", "legacy_activity": "purchase"}

for _kind, _event in KINDS.items():
    s.define(f"{_kind}_daily_report", f"""
SELECT *, "timestamp"::DATE AS server_date, md5(server_id || '-' || "timestamp"::DATE) AS daily_server_id,
 list(DISTINCT version_full) OVER (PARTITION BY server_id, "timestamp"::DATE) AS reported_versions FROM server_reports
WHERE event_type = '{_event}' QUALIFY row_number() OVER (PARTITION BY server_id, "timestamp"::DATE ORDER BY "timestamp" DESC, event_id DESC) = 1""", "server_reports")


def daily_report(t, kind: str):
    rows = server_reports(t).where(F.col("event_type") == KINDS[kind])
    if kind == "diagnostics":
        rows = rows.select(
            "server_id", "timestamp", "event_id", "version_full", "operating_system", "database_type", F.col("edition").alias("is_enterprise_ready"), "server_ip",
            F.col("daily_active_users").alias("count_active_users"), F.col("count_registered_users").alias("count_users"), "count_teams",
        )
        columns = [c for c in rows.columns if c not in ("server_id", "timestamp", "event_id")]
        return plan.latest_daily(rows, columns, s.AS_OF, tie="event_id", reported="version_full")
    if kind in ("telemetry", "legacy"):
        return plan.latest_daily(rows, TELEMETRY, s.AS_OF, tie="event_id", reported="version_full")
    return plan.latest_daily(rows, ACTIVITY, s.AS_OF, tie="event_id")


def _both(a: str, b: str, c: str) -> str:
    return f"coalesce({a}.{c}, {b}.{c})"


s.define("server_spine", f"""
SELECT md5(s.server_id || '-' || s.activity_date) AS daily_server_id, s.server_id, s.activity_date, s.age_in_days, coalesce(t.version_full, l.version_full, d.version_full) AS version_full,
 coalesce(t.operating_system, l.operating_system, d.operating_system) AS operating_system, coalesce(t.database_type, l.database_type, d.database_type) AS database_type,
 {_both('t', 'l', 'database_version')} AS database_version,
 CASE {_both('t', 'l', 'database_version')} WHEN '12.3.1' THEN '12.3' WHEN '13beta2' THEN '13.0' WHEN '8.0' THEN '8.0' END AS database_version_semver,
 coalesce(t.edition, l.edition, d.edition) AS is_enterprise_ready, CASE coalesce(t.edition, l.edition, d.edition) WHEN true THEN 'E0' WHEN false THEN 'TE' ELSE 'Unknown' END AS binary_edition,
 t.installation_id, CASE WHEN t.server_id IS NOT NULL THEN t.installation_id IS NOT NULL END AS is_cloud, coalesce(t.server_ip, d.server_ip) AS server_ip, t.installation_type,
 CAST(len(list_distinct(coalesce(t.reported_versions, []) || coalesce(l.reported_versions, []) || coalesce(d.reported_versions, []))) AS INTEGER) AS count_reported_versions,
 coalesce(a.daily_active_users, b.daily_active_users, d.daily_active_users, 0) AS daily_active_users, coalesce(a.monthly_active_users, b.monthly_active_users, 0) AS monthly_active_users,
 coalesce(a.count_registered_users, b.count_registered_users, d.count_registered_users, 0) AS count_registered_users,
 coalesce(a.count_registered_deactivated_users, b.count_registered_deactivated_users, 0) AS count_registered_deactivated_users,
 {_both('a', 'b', 'count_registered_users')} - {_both('a', 'b', 'count_registered_deactivated_users')} AS count_registered_active_users,
 coalesce(a.count_posts, b.count_posts, 0) AS count_posts, coalesce(a.count_teams, b.count_teams, d.count_teams, 0) AS count_teams,
 t.server_id IS NOT NULL AS has_telemetry_data, l.server_id IS NOT NULL AS has_legacy_telemetry_data, d.server_id IS NOT NULL AS has_diagnostics_data,
 a.server_id IS NULL AND b.server_id IS NULL AS is_missing_activity_data
FROM (SELECT server_id, d::DATE AS activity_date, CAST(d::DATE - f AS INTEGER) AS age_in_days FROM (SELECT server_id, min(server_date) AS f, unnest(generate_series(min(server_date)::TIMESTAMP, max(server_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d
   FROM (SELECT server_id, server_date FROM telemetry_daily_report UNION ALL SELECT server_id, server_date FROM legacy_daily_report UNION ALL SELECT server_id, server_date FROM diagnostics_daily_report) GROUP BY 1)) s
LEFT JOIN telemetry_daily_report t ON s.server_id = t.server_id AND s.activity_date = t.server_date LEFT JOIN legacy_daily_report l ON s.server_id = l.server_id AND s.activity_date = l.server_date
LEFT JOIN diagnostics_daily_report d ON s.server_id = d.server_id AND s.activity_date = d.server_date LEFT JOIN activity_daily_report a ON s.server_id = a.server_id AND s.activity_date = a.server_date
LEFT JOIN legacy_activity_daily_report b ON s.server_id = b.server_id AND s.activity_date = b.server_date""",
         *[f"{k}_daily_report" for k in KINDS])


def server_spine(t):
    return plan.server_activity_spined(*[daily_report(t, k) for k in KINDS], START)


# ---------------------------------------------------------------- calendars


@query("j01_date_spine", """
SELECT unnest(generate_series((SELECT min(ts)::DATE::TIMESTAMP FROM events), (SELECT max(ts) FROM events), INTERVAL 1 HOUR))::TIMESTAMP AS hour
EXCEPT SELECT TIMESTAMP '1900-01-01'""")
def _(t):
    return calendars.spine_of(t.events, "ts", "day").join(
        calendars.spine_of(t.events, "ts", "hour", "hour"), F.to_date("hour") == F.col("date_day"), "right"
    ).select("hour")


@query("j02_dim_date", f"""
WITH d AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), TIMESTAMP '2001-07-25', INTERVAL 1 DAY))::DATE AS d), t AS (SELECT DATE '2001-07-25' AS today)
SELECT d AS date_day, left(dayname(d), 3) AS day_name, last_day(d) AS last_day_of_month, weekofyear(d)::INTEGER AS week_actual, month(d)::INTEGER AS month_actual, year(d)::INTEGER AS year_actual, quarter(d)::INTEGER AS quarter_actual,
 isodow(d) = 7 AS is_last_day_of_week, d = last_day(d) AS is_last_day_of_month,
 {", ".join(f'''d = CASE WHEN date_trunc('month', d) = date_trunc('month', today) THEN CASE WHEN isodow(today) = {i} THEN today ELSE today - CAST((isodow(today) - {i} + 6) % 7 + 1 AS INTEGER) END
   ELSE last_day(d) - CAST((isodow(last_day(d)) - {i} + 6) % 7 + 1 AS INTEGER) END AS is_last_{n}_of_month''' for i, n in enumerate(["mon", "tue", "wed", "thu", "fri", "sat", "sun"], 1))}
FROM d, t""")
def _(t):
    spine = calendars.spine_of(t.orders.where(F.col("o_orderdate") <= s.ts("2001-07-25 00:00:00")), "o_orderdate")
    return calendars.dim_date(spine, "2001-07-25")


@query("j03_fiscal_calendar", """
WITH d AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY))::DATE AS d),
h AS (SELECT o_orderdate::DATE AS d, max(o_orderpriority) AS holiday_name, 'all' AS holiday_region FROM orders WHERE o_totalprice > 499500 GROUP BY 1),
f AS (SELECT *, CASE WHEN month(d) < 2 THEN year(d) ELSE year(d) + 1 END AS fy, CASE WHEN month(d) < 2 THEN 4 WHEN month(d) < 5 THEN 1 WHEN month(d) < 8 THEN 2 WHEN month(d) < 11 THEN 3 ELSE 4 END AS fq FROM d),
g AS (SELECT *, (date_trunc('quarter', d - INTERVAL 1 MONTH) + INTERVAL 1 MONTH)::DATE AS fqs, make_date(fy - 1, 2, 1) AS fys FROM f)
SELECT g.d AS date_day, fy::INTEGER AS fiscal_year, fq::INTEGER AS fiscal_quarter, (dayofweek(g.d) + 1)::INTEGER AS day_of_week, (g.d - CAST(dayofweek(g.d) AS INTEGER))::DATE AS first_day_of_week,
 CAST(g.d - fqs + 1 AS INTEGER) AS day_of_fiscal_quarter, CAST(g.d - fys + 1 AS INTEGER) AS day_of_fiscal_year, fqs AS first_day_of_fiscal_quarter, last_day((fqs + INTERVAL 2 MONTH)::DATE) AS last_day_of_fiscal_quarter,
 CAST((date_trunc('week', g.d)::DATE - date_trunc('week', fys)::DATE) // 7 + 1 AS INTEGER) AS week_of_fiscal_year, CAST(CASE WHEN month(g.d) = 1 THEN 12 ELSE month(g.d) - 1 END AS INTEGER) AS month_of_fiscal_year,
 fy || '-Q' || fq AS fiscal_quarter_name, 'FY' || right(fy::VARCHAR, 2) || '-Q' || fq AS fiscal_quarter_name_fy, fy || '-' || left(monthname(g.d), 3) AS fiscal_month_name,
 CAST(dense_rank() OVER (ORDER BY fy, fq) AS INTEGER) AS fiscal_quarter_number_absolute, holiday_name, holiday_region, holiday_name IS NOT NULL AS is_holiday
FROM g LEFT JOIN h ON g.d = h.d""")
def _(t):
    day = F.to_date("o_orderdate").alias("date")
    holidays = t.orders.where(F.col("o_totalprice") > 499500).groupBy(day).agg(F.max("o_orderpriority").alias("name")).withColumn("region", F.lit("all"))
    cal = calendars.fiscal_calendar(calendars.spine_of(t.orders, "o_orderdate"), holidays)
    return cal.select(
        "date_day", "fiscal_year", "fiscal_quarter", "day_of_week", "first_day_of_week", "day_of_fiscal_quarter", "day_of_fiscal_year",
        "first_day_of_fiscal_quarter", "last_day_of_fiscal_quarter", "week_of_fiscal_year", "month_of_fiscal_year", "fiscal_quarter_name",
        "fiscal_quarter_name_fy", "fiscal_month_name", "fiscal_quarter_number_absolute",
        "holiday_name", "holiday_region", "is_holiday",
    )


# ---------------------------------------------------------------- users


@query("j04_user_daily_activity", s.with_("current_daily") + "SELECT * FROM current_daily")
def _(t):
    return current_daily(t)


@query("j05_user_activity_spined", s.with_("user_spine") + "SELECT * FROM user_spine")
def _(t):
    return user_spine(t)


_COUNTS = ", ".join(f"count(*) FILTER ({m}_{suffix}) AS {span}_{name}" for m, name in plan.FACT_COLUMNS.items() for span, suffix in plan.SPANS.items())
s.define("active_users", f"""
SELECT md5(server_id || '-' || activity_date) AS daily_server_id, activity_date, server_id, {_COUNTS} FROM user_spine GROUP BY ALL""", "user_spine")


# Server reports of the twenty servers the users belong to.
s.define("own_reports", """
SELECT server_id, "timestamp"::DATE AS activity_date, arg_max(k, ("timestamp", event_id)) AS server_daily_active_users, arg_max(k * 10, ("timestamp", event_id)) AS server_monthly_active_users,
 arg_max(k * 7, ("timestamp", event_id)) AS count_posts, arg_max('9.' || (k % 3), ("timestamp", event_id)) AS version_full, arg_max(k % 5 = 0, ("timestamp", event_id)) AS is_missing_activity_data
FROM tracks WHERE event = 'signup' GROUP BY ALL""", "tracks")


def own_reports(t):
    at = F.struct("timestamp", "event_id")
    k = F.col("k")
    return s.tracks(t).where(F.col("event") == "signup").groupBy("server_id", F.to_date("timestamp").alias("activity_date")).agg(
        F.max_by(k, at).alias("daily_active_users"), F.max_by(k * 10, at).alias("monthly_active_users"), F.max_by(k * 7, at).alias("count_posts"),
        F.max_by(F.concat(F.lit("9."), k % 3), at).alias("version_full"), F.max_by(k % 5 == 0, at).alias("is_missing_activity_data"),
    )


@query("j06_active_users_fact", s.with_("active_users", "own_reports") + f"""
SELECT md5(coalesce(u.server_id, r.server_id) || '-' || coalesce(u.activity_date, r.activity_date)) AS daily_server_id, coalesce(u.activity_date, r.activity_date) AS activity_date, coalesce(u.server_id, r.server_id) AS server_id,
 {", ".join(f"coalesce({span}_{name}, 0) AS {span}_{name}" for name in plan.FACT_COLUMNS.values() for span in plan.SPANS)},
 coalesce(server_daily_active_users, 0) AS server_daily_active_users, coalesce(server_monthly_active_users, 0) AS server_monthly_active_users, coalesce(count_posts, 0) AS count_posts,
 md5(coalesce(version_full, '_dbt_utils_surrogate_key_null_')) AS version_id, coalesce(is_missing_activity_data, true) AS is_missing_server_activity_data,
 u.server_id IS NOT NULL AS has_user_telemetry_data, r.server_id IS NOT NULL AS has_server_telemetry_data
FROM active_users u FULL JOIN own_reports r ON u.server_id = r.server_id AND u.activity_date = r.activity_date""")
def _(t):
    return plan.active_users_fact(current_daily(t), legacy_daily(t), s.AS_OF, own_reports(t))


@query("j07_latest_daily", s.with_("telemetry_daily_report") + """
SELECT server_id, server_date, daily_server_id, version_full, operating_system, edition, array_to_string(list_sort(reported_versions), ',') AS reported, CAST(len(reported_versions) AS INTEGER) AS count_reported_versions FROM telemetry_daily_report""")
def _(t):
    d = daily_report(t, "telemetry")
    return d.select(
        "server_id", "server_date", "daily_server_id", "version_full", "operating_system", "edition",
        F.array_join("reported_versions", ",").alias("reported"), "count_reported_versions",
    )


@query("j08_server_activity_spined", s.with_("server_spine") + "SELECT * FROM server_spine")
def _(t):
    return server_spine(t).drop("reported_versions", "database_version_major", "database_version_minor")


@query("j09_product_activity_spined", s.with_("active_users", "own_reports") + """
, c AS (SELECT * FROM active_users),
s AS (SELECT server_id, min(d) AS a, max(e) AS b FROM (SELECT server_id, min(activity_date) AS d, max(activity_date) AS e FROM c GROUP BY 1 UNION ALL SELECT server_id, min(activity_date), max(activity_date) FROM own_reports GROUP BY 1) GROUP BY 1),
x AS (SELECT server_id, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS activity_date FROM s)
SELECT md5(x.server_id || '-' || x.activity_date) AS daily_server_id, x.server_id, x.activity_date, coalesce(daily_active_users, 0) AS daily_active_users, coalesce(weekly_active_users, 0) AS weekly_active_users,
 coalesce(monthly_active_users, 0) AS monthly_active_users, coalesce(server_daily_active_users, 0) AS server_daily_active_users, coalesce(server_monthly_active_users, 0) AS server_monthly_active_users,
 coalesce(r.count_posts, 0) AS count_registered_users, c.server_id IS NOT NULL AS has_client_data, r.server_id IS NOT NULL AS has_server_data
FROM x LEFT JOIN c ON x.server_id = c.server_id AND x.activity_date = c.activity_date LEFT JOIN own_reports r ON x.server_id = r.server_id AND x.activity_date = r.activity_date""")
def _(t):
    # The client metric is activity on either pipeline, so the merged days stand in for the product's events.
    daily = plan._merged_flags(current_daily(t), legacy_daily(t))
    client = plan.product_user_activity(daily, s.AS_OF)
    server = own_reports(t).withColumnsRenamed({"activity_date": "server_date", "count_posts": "count_registered_users"})
    return plan.product_activity_spined(client, server, START)


@query("j10_active_servers_fact", s.with_("server_spine") + """
SELECT daily_server_id, s.server_id, s.activity_date, md5(coalesce(version_full, '_dbt_utils_surrogate_key_null_')) AS version_id, installation_type,
 CASE WHEN count_registered_active_users IS NULL THEN 'Unknown' WHEN count_registered_active_users < 10 THEN '< 10' WHEN count_registered_active_users < 100 THEN '10-100' WHEN count_registered_active_users < 250 THEN '100-250'
  WHEN count_registered_active_users < 500 THEN '250-500' WHEN count_registered_active_users < 1000 THEN '500-1000' WHEN count_registered_active_users < 2500 THEN '1000-2500' ELSE '>=2500' END AS registered_user_bin,
 daily_active_users, count_registered_active_users, is_enterprise_ready, count_reported_versions, has_telemetry_data, has_legacy_telemetry_data, has_diagnostics_data, is_missing_activity_data,
 l.server_id IS NULL AS is_missing_license_data
FROM server_spine s LEFT JOIN (SELECT DISTINCT server_id, "timestamp"::DATE AS d FROM server_reports WHERE k >= 50) l ON l.server_id = s.server_id AND l.d = s.activity_date""")
def _(t):
    licences = server_reports(t).where(F.col("k") >= 50).select("server_id", F.to_date("timestamp").alias("activity_date"))
    return plan.active_servers_fact(server_spine(t), licences)


@query("j11_retention_at_day", s.with_("active_users", "own_reports") + """
, life AS (SELECT server_id, min(activity_date) AS f FROM active_users GROUP BY 1)
SELECT l.server_id, f AS active_since_date, u.server_id IS NOT NULL AS is_active_at_day_28, coalesce(daily_active_users, 0) AS daily_active_users, coalesce(server_daily_active_users, 0) AS server_daily_active_users
FROM life l LEFT JOIN active_users u ON u.server_id = l.server_id AND u.activity_date = f + 28 LEFT JOIN own_reports r ON r.server_id = l.server_id AND r.activity_date = f + 28""")
def _(t):
    fact = mart(plan.active_users_fact(current_daily(t), legacy_daily(t), s.AS_OF, own_reports(t)), "active-users")
    info = fact.where("has_user_telemetry_data").groupBy("server_id").agg(F.min("activity_date").alias("first_activity_date"))
    ages = fact.join(info, "server_id").select("daily_server_id", F.datediff("activity_date", "first_activity_date").alias("age_in_days"))
    return plan.retention_at_day(fact, info, ages)


FIRST = s.with_("tracks") + """, f AS (SELECT user_id, server_id, min("timestamp") AS t0, md5(user_id || '-' || server_id) AS id FROM tracks GROUP BY user_id, server_id)"""


@query("j12_retention_window", FIRST + """
SELECT t0 AS first_active_timestamp, f.server_id, f.user_id, count(t.id) > 0 AS is_retained, max(t."timestamp") AS retained_timestamp, f.id FROM f
LEFT JOIN tracks t ON t.user_id = f.user_id AND t."timestamp" BETWEEN t0 + INTERVAL 168 HOUR AND t0 + INTERVAL 192 HOUR WHERE t0 + INTERVAL 192 HOUR <= TIMESTAMP '2024-01-31' GROUP BY ALL""")
def _(t):
    return plan.retention_window(s.tracks(t), s.AS_OF, 168, 192)


@query("j13_retention_flags", FIRST + f"""
SELECT f.id, f.user_id, f.server_id, t0 AS first_active_timestamp,
 {", ".join(f'bool_or(t."timestamp" BETWEEN t0 + INTERVAL {a} DAY AND t0 + INTERVAL {b} DAY) AS retention_{n}_flag' for n, (a, b) in plan.RETENTION_BANDS.items())}
FROM f JOIN tracks t ON t.user_id = f.user_id GROUP BY ALL""")
def _(t):
    return plan.retention_flags(s.tracks(t))


@query("j14_retention_age_band", FIRST + """
, g AS (SELECT f.*, (SELECT max(t."timestamp")::DATE FROM tracks t WHERE t.user_id = f.user_id) AS last_day FROM f)
SELECT id, user_id, server_id, t0 AS first_active_timestamp, last_day AS last_active_date, CASE WHEN last_day - t0::DATE = 0 THEN 'AGE 0' WHEN last_day - t0::DATE < 7 THEN 'AGE 1 - 6' WHEN last_day - t0::DATE < 28 THEN 'AGE 7 - 27' ELSE 'AGE 28+' END AS age FROM g""")
def _(t):
    return plan.retention_age_band(s.tracks(t))


# Events of a few busy days per user, so that users fall out of and come back into the monthly window.
s.define("segment_events", """
SELECT id, event_id, user_id, server_id, event, CASE WHEN k = 0 THEN 'system_admin' WHEN k < 50 THEN 'system_user' END AS user_role, "timestamp", "timestamp" + to_days(CAST(k // 10 * 40 AS INTEGER)) AS received_at,
 CASE WHEN context_user_agent LIKE '%Electron%' THEN 'Desktop' WHEN event = 'purchase' THEN 'Mobile' ELSE 'WebApp' END AS client, CASE event WHEN 'click' THEN 'ui' WHEN 'view' THEN 'performance' ELSE 'api' END AS category FROM tracks""", "tracks")


def segment_events(t):
    k = F.col("k")
    client = F.when(F.contains("context_user_agent", F.lit("Electron")), "Desktop").when(F.col("event") == "purchase", "Mobile").otherwise("WebApp")
    return s.tracks(t).select(
        "id", "event_id", "user_id", "server_id", "event", F.when(k == 0, "system_admin").when(k < 50, "system_user").alias("user_role"), "timestamp",
        (F.col("timestamp") + F.make_dt_interval((F.floor(k / 10) * 40).cast("int"))).alias("received_at"), client.alias("client"),
        F.when(F.col("event") == "click", "ui").when(F.col("event") == "view", "performance").otherwise("api").alias("category"),
    )


s.define("segments", """
SELECT *, total_events > 0 AS active, mau_segment IN ('First Time MAU', 'Reengaged MAU', 'Current MAU') AS mau, md5(date || '-' || user_id || '-' || server_id) AS id FROM (
SELECT date, user_id, server_id, f AS first_active_date, system_admin, system_user, total_events, desktop_events, web_app_events, mobile_events, api_events, ui_events, max_timestamp,
 CASE WHEN f = date AND total_events > 0 THEN 'First Time MAU' WHEN sum(total_events) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) = 0 AND total_events > 0 THEN 'Reengaged MAU'
  WHEN sum(total_events) OVER (w ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) > 0 THEN 'Current MAU' WHEN sum(total_events) OVER (w ROWS BETWEEN 31 PRECEDING AND 31 PRECEDING) > 0 THEN 'Newly Disengaged' ELSE 'Disengaged' END AS mau_segment,
 sum(total_events) OVER (w ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)::BIGINT AS events_last_30_days, sum(total_events) OVER (w ROWS BETWEEN 31 PRECEDING AND CURRENT ROW)::BIGINT AS events_last_31_days,
 sum(total_events) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS events_alltime, max(total_events) OVER (w ROWS UNBOUNDED PRECEDING) AS max_events, sum(mobile_events) OVER (w ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)::BIGINT AS mobile_events_last_30_days,
 sum(mobile_events) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS mobile_events_alltime, max(mobile_events) OVER (w ROWS UNBOUNDED PRECEDING) AS max_mobile_events, max(CASE WHEN total_events > 0 THEN date END) OVER (w ROWS UNBOUNDED PRECEDING) AS last_active_date
FROM (SELECT d.date, d.user_id, d.server_id, d.f, coalesce(bool_or(user_role = 'system_admin'), false) AS system_admin, coalesce(bool_or(coalesce(user_role, 'none') <> 'system_admin' AND e.id IS NOT NULL), true) OR count(e.id) = 0 AS system_user,
   count(e.id) AS total_events, count(e.id) FILTER (client = 'Desktop') AS desktop_events, count(e.id) FILTER (client = 'WebApp') AS web_app_events, count(e.id) FILTER (client = 'Mobile') AS mobile_events,
   count(e.id) FILTER (category = 'api') AS api_events, count(e.id) FILTER (category = 'ui') AS ui_events, max(e.received_at) AS max_timestamp
 FROM (SELECT user_id, server_id, min(received_at)::DATE AS f, unnest(generate_series(min(received_at)::DATE::TIMESTAMP, greatest(max(received_at)::DATE, DATE '2025-03-01')::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM segment_events GROUP BY 1, 2) d
 LEFT JOIN segment_events e ON e.user_id = d.user_id AND e.server_id = d.server_id AND e.received_at::DATE = d.date WHERE d.date < DATE '2025-03-01' GROUP BY ALL)
WINDOW w AS (PARTITION BY user_id, server_id ORDER BY date))""", "segment_events")


def segments(t):
    return plan.mau_segments(segment_events(t), "2025-03-01", ["api", "ui"])


@query("j15_mau_segments", s.with_("segments") + "SELECT * FROM segments")
def _(t):
    return segments(t)


@query("j16_server_events_by_date", s.with_("segments") + """
, p AS (SELECT "timestamp"::DATE AS date, server_id, count(*) FILTER (event = 'purchase') AS post_events, count(*) FILTER (event = 'signup') AS invite_members_events FROM segment_events WHERE event IN ('purchase', 'signup') GROUP BY 1, 2)
SELECT s.date, s.server_id, md5(s.date || '-' || s.server_id) AS id, min(first_active_date) AS first_active_date, max(last_active_date) AS last_active_date, count(DISTINCT user_id) FILTER (active) AS dau_total,
 count(DISTINCT user_id) FILTER (active AND mobile_events > 0) AS mobile_dau, count(DISTINCT user_id) FILTER (active AND system_admin) AS system_admin_dau, count(DISTINCT user_id) FILTER (mau) AS mau_total,
 count(DISTINCT user_id) FILTER (mau_segment = 'First Time MAU') AS first_time_mau, count(DISTINCT user_id) FILTER (mau_segment = 'Reengaged MAU') AS reengaged_mau, count(DISTINCT user_id) FILTER (mau_segment = 'Current MAU') AS current_mau,
 count(DISTINCT user_id) FILTER (mau AND system_admin) AS system_admin_mau, sum(total_events)::BIGINT AS total_events, sum(events_alltime)::BIGINT AS events_alltime, count(DISTINCT user_id) AS users,
 max(post_events) AS post_events, max(invite_members_events) AS invite_members_events
FROM segments s LEFT JOIN p ON p.date = s.date AND p.server_id = s.server_id GROUP BY 1, 2""")
def _(t):
    out = plan.server_events_by_date(mart(segments(t), "segments"), segment_events(t), ["purchase"], ["signup"])
    return out.drop("desktop_events", "web_app_events", "mobile_events", "api_events", "ui_events", "events_last_30_days", "events_last_31_days")


@query("j17_user_events_by_date", s.with_("tracks") + f"""
, cur AS (SELECT * FROM tracks WHERE event IN ('click', 'view') AND "timestamp" >= TIMESTAMP '2024-01-15'), cut AS (SELECT server_id, min("timestamp")::DATE AS c FROM cur GROUP BY 1),
both_ AS (SELECT 'current' AS source, * FROM cur UNION ALL SELECT 'legacy', t.* FROM tracks t LEFT JOIN cut ON cut.server_id = t.server_id WHERE event IN ('purchase', 'signup') AND (c IS NULL OR "timestamp"::DATE < c)),
a AS (SELECT source, "timestamp"::DATE AS date, server_id, user_id, lower(event) AS event_name, context_user_agent, count(*) AS total_events, max("timestamp") AS max_timestamp, min("timestamp") AS min_timestamp, any_value(k % 6) AS m FROM both_ WHERE "timestamp" < TIMESTAMP '2024-01-31' GROUP BY ALL)
SELECT source, date, server_id, user_id, event_name, context_user_agent, total_events, max_timestamp, min_timestamp,
 CASE m WHEN 0 THEN 'Electron' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'iPhone' ELSE 'Other' END AS browser, CASE m WHEN 0 THEN 'desktop' ELSE 'web_app' END AS event_type,
 CASE m WHEN 0 THEN total_events ELSE 0 END AS desktop_events FROM a""")
def _(t):
    rows = s.tracks(t)
    cur = rows.where(F.col("event").isin("click", "view") & (F.col("timestamp") >= s.ts("2024-01-15 00:00:00")))
    out = plan.user_events_by_date(cur, rows.where(F.col("event").isin("purchase", "signup")), s.AS_OF)
    return out.select(
        "source", "date", "server_id", "user_id", "event_name", "context_user_agent", "total_events", "max_timestamp", "min_timestamp", "browser",
        "event_type", "desktop_events",
    )


s.define("details", """
SELECT date, user_id, server_id, min(CASE WHEN total_events > 0 THEN date END) OVER w AS first_active_date, max(CASE WHEN total_events > 0 THEN date END) OVER w AS last_active_date, count(CASE WHEN total_events > 0 THEN 1 END) OVER w AS days_active,
 count(CASE WHEN mobile_events > 0 THEN 1 END) OVER w AS mobile_active_days, count(CASE WHEN mau THEN 1 END) OVER w AS days_in_mau, count(CASE WHEN mau_segment = 'Reengaged MAU' THEN 1 END) OVER w AS reengaged_count,
 count(CASE WHEN NOT mau AND events_alltime > 0 THEN 1 END) OVER w AS days_not_in_mau, sum(web_app_events) OVER w::BIGINT AS webapp_events_alltime,
 sum(total_events) OVER w / count(CASE WHEN events_alltime > 0 THEN 1 END) OVER w AS avg_events_per_day FROM segments WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS UNBOUNDED PRECEDING)""", "segments")
DETAIL_COLUMNS = [
    "date", "user_id", "server_id", "first_active_date", "last_active_date", "days_active", "mobile_active_days", "days_in_mau", "reengaged_count",
    "days_not_in_mau", "webapp_events_alltime", "avg_events_per_day",
]


@query("j18_user_daily_details", s.with_("details") + "SELECT * FROM details")
def _(t):
    return plan.user_daily_details(mart(segments(t), "segments")).select(*DETAIL_COLUMNS)


@query("j19_user_fact", s.with_("details") + f"""
, o AS (SELECT user_id, event, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS n FROM segment_events)
SELECT d.*, d.server_id AS first_server_id, 1::BIGINT AS server_count, {", ".join(f"x.e{i + 1} AS {n}_event" for i, n in enumerate(plan.ORDINALS))}, least(x.n, 10)::BIGINT AS events_performed
FROM details d JOIN (SELECT user_id, {", ".join(f"max(CASE WHEN n = {i + 1} THEN event END) AS e{i + 1}" for i in range(10))}, count(*) AS n FROM o GROUP BY 1) x USING (user_id)
WHERE d.date = DATE '2025-02-28'""")
def _(t):
    details = mart(plan.user_daily_details(mart(segments(t), "segments")).select(*DETAIL_COLUMNS), "user-days")
    return plan.user_fact(details, segment_events(t))


# ---------------------------------------------------------------- servers over time

s.define("security_days", """
SELECT server_id, "timestamp"::DATE AS date, arg_max(version_full, ("timestamp", event_id)) AS version, arg_max((edition)::VARCHAR, ("timestamp", event_id)) AS edition, max(k) AS user_count FROM server_reports WHERE event_type = 'error' GROUP BY ALL""", "server_reports")
s.define("server_days", """
SELECT server_id, "timestamp"::DATE AS date, arg_max(version_full, ("timestamp", event_id)) AS version, arg_max(operating_system, ("timestamp", event_id)) FILTER (operating_system IS NOT NULL) AS operating_system FROM server_reports WHERE event_type IN ('click', 'view') GROUP BY ALL""", "server_reports")


def security_days(t):
    at = F.struct("timestamp", "event_id")
    return server_reports(t).where(F.col("event_type") == "error").groupBy("server_id", F.to_date("timestamp").alias("date")).agg(
        F.max_by("version_full", at).alias("version"), F.max_by(F.col("edition").cast("string"), at).alias("edition")
    )


def server_days(t):
    at = F.struct("timestamp", "event_id")
    known = F.when(F.col("operating_system").isNotNull(), at)
    return server_reports(t).where(F.col("event_type").isin("click", "view")).groupBy("server_id", F.to_date("timestamp").alias("date")).agg(
        F.max_by("version_full", at).alias("version"), F.max_by("operating_system", known).alias("operating_system")
    )


s.define("filled_days", """
SELECT s.server_id, s.date, last_value(coalesce(b.version, a.version) IGNORE NULLS) OVER w AS version, last_value(a.edition IGNORE NULLS) OVER w AS edition, last_value(b.operating_system IGNORE NULLS) OVER w AS operating_system,
 a.server_id IS NOT NULL AS in_security, b.server_id IS NOT NULL AS in_server, a.server_id IS NULL AND b.server_id IS NULL AS tracking_disabled, md5(s.date || '-' || s.server_id) AS id
FROM (SELECT server_id, unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM (SELECT server_id, date FROM security_days UNION ALL SELECT server_id, date FROM server_days) GROUP BY 1) s
LEFT JOIN security_days a ON a.server_id = s.server_id AND a.date = s.date LEFT JOIN server_days b ON b.server_id = s.server_id AND b.date = s.date
WINDOW w AS (PARTITION BY s.server_id ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "security_days", "server_days")


def filled_days(t):
    return plan.server_daily_details_filled(security_days(t), server_days(t), s.AS_OF, ["version", "edition", "operating_system"])


@query("j20_server_daily_details_filled", s.with_("filled_days") + "SELECT * FROM filled_days")
def _(t):
    return filled_days(t)


s.define("upgrade_days", """
SELECT date, server_id, pv AS prev_version, version AS current_version, pe AS prev_edition, edition AS current_edition, id FROM (SELECT *, lag(version) OVER w AS pv, lag(edition) OVER w AS pe FROM filled_days WHERE NOT tracking_disabled WINDOW w AS (PARTITION BY server_id ORDER BY date))
WHERE split_part(version, '.', 2) || split_part(version, '.', 3) > split_part(coalesce(pv, version), '.', 2) || split_part(coalesce(pv, version), '.', 3) OR (edition = 'true' AND pe = 'false')""", "filled_days")


@query("j22_server_upgrades", s.with_("upgrade_days") + "SELECT * FROM upgrade_days")
def _(t):
    return plan.server_upgrades(filled_days(t), s.AS_OF)


s.define("server_events", """
SELECT 'v' || user_id AS server_id, 'u' || (event_id % 7) || '-' || user_id AS user_id, ts + to_days(CAST(k // 2 AS INTEGER)) AS "timestamp", CASE event_type WHEN 'view' THEN 'performance' ELSE 'api' END AS category
FROM (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k FROM events)""")


def server_events(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.concat(F.lit("v"), "user_id").alias("server_id"), F.concat(F.lit("u"), F.col("event_id") % 7, F.lit("-"), "user_id").alias("user_id"),
        (F.col("ts") + F.make_dt_interval(F.floor(k / 2).cast("int"))).alias("timestamp"),
        F.when(F.col("event_type") == "view", "performance").otherwise("api").alias("category"),
    )


_BANDS = {**plan.SERVER_BANDS, "28day_above": (28, None)}


def _band_sql(lo, hi):
    upper = f'BETWEEN f + INTERVAL {lo} DAY AND f + INTERVAL {hi} DAY' if hi else f"> f + INTERVAL {lo} DAY"
    return f'''category <> 'performance' AND e."timestamp" {upper}'''


@query("j21_server_fact", s.with_("upgrade_days", "server_events") + f"""
, base AS (SELECT server_id, min(date) FILTER (in_security OR in_server) AS first_active_date, max(date) FILTER (in_security OR in_server) AS last_active_date, min(date) FILTER (in_security) AS first_telemetry_active_date,
  max(date) FILTER (in_security) AS last_telemetry_active_date, arg_min(version, date) FILTER (version IS NOT NULL) AS first_server_version, arg_max(version, date) FILTER (version IS NOT NULL) AS version, arg_min(edition, date) FILTER (edition IS NOT NULL) AS first_server_edition,
  arg_max(edition, date) FILTER (edition IS NOT NULL) AS server_edition FROM filled_days GROUP BY 1),
sizes AS (SELECT server_id, max(k) AS au, max(k * 30) AS max_registered_users, max(k * 7) AS max_posts, {", ".join(f"min(CASE WHEN k * 30 > {n} THEN \"timestamp\"::DATE END) AS first_{x}reg_users_date" for n, x in plan.MILESTONES)} FROM server_reports GROUP BY 1),
u AS (SELECT server_id, count(*) FILTER (current_version > prev_version) AS version_upgrade_count, count(*) FILTER (prev_edition = 'false' AND current_edition = 'true') AS edition_upgrade_count FROM upgrade_days GROUP BY 1),
e AS (SELECT e.server_id, {", ".join(f"bool_or({_band_sql(*b)}) AS retention_{n}_flag, count(DISTINCT CASE WHEN {_band_sql(*b)} THEN user_id END) AS retention_{n}_users" for n, b in _BANDS.items())},
  count(DISTINCT user_id) AS active_users_alltime, max(e."timestamp")::DATE AS last_event_date, count(DISTINCT e."timestamp"::DATE) AS days_active, CAST((DATE {DAY} - min(e."timestamp"::DATE)) - count(DISTINCT e."timestamp"::DATE) AS BIGINT) AS days_inactive
  FROM server_events e JOIN (SELECT server_id, first_active_date::TIMESTAMP AS f FROM base) b ON b.server_id = e.server_id GROUP BY 1),
l AS (SELECT server_id, min(CASE WHEN event_type <> 'signup' THEN "timestamp"::DATE END) AS first_paid_license_date, max(CASE WHEN event_type <> 'signup' THEN "timestamp"::DATE END) AS last_paid_license_date, min(CASE WHEN event_type = 'signup' THEN "timestamp"::DATE END) AS first_trial_license_date,
  max(CASE WHEN event_type = 'signup' THEN "timestamp"::DATE END) AS last_trial_license_date, max(installation_id) AS company, max(CASE WHEN event_type <> 'signup' THEN "timestamp"::DATE + 365 END) AS paid_license_expire_date FROM server_reports GROUP BY 1),
x AS (SELECT base.*, greatest(coalesce(au, 0), coalesce(active_users_alltime, 0)) AS max_active_user_count, sizes.* EXCLUDE (server_id, au), u.* EXCLUDE (server_id), e.* EXCLUDE (server_id), l.* EXCLUDE (server_id)
 FROM base LEFT JOIN sizes USING (server_id) LEFT JOIN u USING (server_id) LEFT JOIN e USING (server_id) LEFT JOIN l USING (server_id))
SELECT *, min(first_active_date) OVER (PARTITION BY coalesce(lower(company), server_id)) AS customer_first_active_date, min(first_paid_license_date) OVER (PARTITION BY coalesce(lower(company), server_id)) AS customer_first_paid_license_date FROM x""")
def _(t):
    details = mart(filled_days(t), "server-days")
    k, day = F.col("k"), F.to_date("timestamp")
    raw = server_reports(t)
    reports = raw.select("server_id", day.alias("date"), (k * 30).alias("user_count"), k.alias("active_users"), (k * 7).alias("posts"))
    licences = raw.select(
        "server_id", (F.col("event_type") == "signup").alias("trial"), day.alias("issued_date"), F.date_add(day, 365).alias("expire_date"),
        F.col("installation_id").alias("company"),
    )
    return plan.server_fact(details, reports, server_events(t), plan.server_upgrades(details, s.AS_OF), licences, s.AS_OF)


# ---------------------------------------------------------------- plugins

s.define("plugin_events", """
SELECT id, server_id, '1.' || CASE WHEN "timestamp" < TIMESTAMP '2024-01-10' + to_days(CAST(user_id[2:] AS INTEGER) % 20 % 5) THEN 0 ELSE 1 END AS plugin_version, user_id, "timestamp", CASE event WHEN 'click' THEN 'playbook' ELSE 'incident' END AS event,
 CASE k % 3 WHEN 0 THEN 'create' WHEN 1 THEN 'update' ELSE 'end' END AS action FROM tracks""", "tracks")


def plugin_events(t):
    k = F.col("k")
    switch = s.ts("2024-01-10 00:00:00") + F.make_dt_interval((F.substring("user_id", 2, 9).cast("int") % 20 % 5))
    return s.tracks(t).select(
        "id", "server_id", F.when(F.col("timestamp") < switch, "1.0").otherwise("1.1").alias("plugin_version"), "user_id", "timestamp",
        F.when(F.col("event") == "click", "playbook").otherwise("incident").alias("event"),
        F.when(k % 3 == 0, "create").when(k % 3 == 1, "update").otherwise("end").alias("action"),
    )


ACTIONS = {"playbooks_created": ("playbook", "create"), "playbooks_edited": ("playbook", "update"), "ended_incident": ("incident", "end")}
s.define("plugin_days", f"""
SELECT d.date, md5(d.date || '-' || d.server_id || '-' || d.plugin_version) AS id, d.server_id, d.plugin_version, d.first_version_date, d.last_version_date, min(e."timestamp") AS first_active, max(e."timestamp") AS last_active, count(DISTINCT e.user_id) AS version_users_to_date,
 {", ".join(f"count(CASE WHEN event = '{a}' AND action = '{b}' AND e.\"timestamp\"::DATE = d.date THEN 1 END) AS {n}, count(CASE WHEN event = '{a}' AND action = '{b}' THEN 1 END) AS {n}_alltime" for n, (a, b) in ACTIONS.items())},
 {", ".join(f"count(DISTINCT CASE WHEN e.\"timestamp\"::DATE >= d.date - {n} THEN e.user_id END) AS {x}_active_users_version" for x, n in (("daily", 0), ("weekly", 7), ("monthly", 30)))},
 {", ".join(f"(SELECT count(DISTINCT p.user_id) FROM plugin_events p WHERE p.server_id = d.server_id AND p.\"timestamp\"::DATE BETWEEN d.date - {n} AND d.date) AS {x}_active_users" for x, n in (("daily", 0), ("weekly", 7), ("monthly", 30)))}
FROM (SELECT *, unnest(generate_series(first_version_date::TIMESTAMP, TIMESTAMP {DAY}, INTERVAL 1 DAY))::DATE AS date FROM (SELECT server_id, plugin_version, t::DATE AS first_version_date, coalesce((lead(t) OVER (PARTITION BY server_id ORDER BY t) - INTERVAL 1 DAY)::DATE, DATE {DAY}) AS last_version_date
  FROM (SELECT server_id, plugin_version, min("timestamp") AS t FROM plugin_events GROUP BY 1, 2))) d
JOIN plugin_events e ON e.server_id = d.server_id AND e.plugin_version = d.plugin_version AND e."timestamp"::DATE <= d.date GROUP BY ALL""", "plugin_events")


@query("j23_plugin_daily_usage", s.with_("plugin_days") + "SELECT * FROM plugin_days")
def _(t):
    return plan.plugin_daily_usage(plugin_events(t), s.AS_OF, ACTIONS)


@query("j23_plugin_fact", s.with_("plugin_days") + f"""
SELECT server_id, min(date) AS first_active_date, max(last_active) AS last_active_date, max(plugin_version) AS current_plugin_version, max(version_users_to_date) AS users_max, max(daily_active_users) AS daily_active_users_max,
 max(weekly_active_users) AS weekly_active_users_max, max(monthly_active_users) AS monthly_active_users_max, {", ".join(f"sum(CASE WHEN date = last_version_date THEN {a}_alltime ELSE 0 END)::BIGINT AS {a}" for a in ACTIONS)},
 count(DISTINCT CASE WHEN daily_active_users > 0 THEN date END) AS days_active FROM plugin_days GROUP BY 1""")
def _(t):
    return plan.plugin_fact(mart(plan.plugin_daily_usage(plugin_events(t), s.AS_OF, ACTIONS), "plugin-days"), list(ACTIONS))


# ---------------------------------------------------------------- summaries


def _days(t, kind):
    return daily_report(t, kind).select("server_id", "server_date")


s.define("summary", """
SELECT server_id, count(DISTINCT d) FILTER (tag = 's') AS count_server_active_days, count(DISTINCT d) FILTER (tag = 'u') AS count_user_active_days, count(DISTINCT d) FILTER (tag = 'd') AS count_diagnostics_active_days,
 min(d) FILTER (tag = 's') AS server_telemetry_first_date, max(d) FILTER (tag = 's') AS server_telemetry_last_date, min(d) FILTER (tag = 'u') AS user_telemetry_first_date, max(d) FILTER (tag = 'u') AS user_telemetry_last_date,
 min(d) FILTER (tag = 'd') AS diagnostics_telemetry_first_date, max(d) FILTER (tag = 'd') AS diagnostics_telemetry_last_date
FROM (SELECT server_id, "timestamp"::DATE AS d, CASE WHEN event_type IN ('click', 'view') THEN 's' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS tag FROM server_reports WHERE k < 6 OR event_type <> 'click') GROUP BY 1""", "server_reports")


def summary(t):
    raw = server_reports(t).where((F.col("k") < 6) | (F.col("event_type") != "click"))
    days = lambda *kinds: raw.where(F.col("event_type").isin(*kinds)).select("server_id", F.to_date("timestamp"))
    return plan.server_summary([days("click"), days("view")], [days("signup"), days("purchase")], days("error"))


@query("j24_server_summary", s.with_("summary") + "SELECT * FROM summary")
def _(t):
    return summary(t)


FIRSTS = ["binary_edition", "count_registered_active_users"]
LASTS = ["binary_edition", "count_registered_active_users", "daily_active_users", "monthly_active_users", "server_ip"]


def _first_last_sql(key: str, lasts) -> str:
    first = ", ".join(f"arg_min({{'v': {c}}}, (activity_date, daily_server_id)).v AS first_{c}" for c in FIRSTS)
    last = ", ".join(f"arg_max({{'v': {c}}}, (activity_date, daily_server_id)).v AS last_{c}" for c in lasts)
    return f"SELECT {key}, min(activity_date) AS first_activity_date, max(activity_date) AS last_activity_date, {first}, {last}"


@query("j25_server_first_last", s.with_("server_spine") + _first_last_sql("server_id", LASTS) + " FROM server_spine GROUP BY 1")
def _(t):
    return plan.first_last_summary(server_spine(t), "server_id", FIRSTS, LASTS)


@query("j25_installation_first_last", s.with_("server_spine") + _first_last_sql("installation_id", ["server_id"]) + ", count(DISTINCT server_id) AS count_server_ids FROM server_spine WHERE installation_id IS NOT NULL GROUP BY 1")
def _(t):
    return plan.first_last_summary(server_spine(t), "installation_id", FIRSTS, ["server_id"], "server_id")


s.define("subscription_rows", """
SELECT 'i' || (o_custkey // 3) AS installation_id, 'host' || (o_custkey // 6) AS hostname, o_orderdate AS created_at, o_orderkey FROM orders WHERE o_orderstatus = 'F'""")


def subscription_rows(t):
    return t.orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("i"), F.floor(F.col("o_custkey") / 3)).alias("installation_id"), F.concat(F.lit("host"), F.floor(F.col("o_custkey") / 6)).alias("hostname"),
        F.col("o_orderdate").alias("created_at"),
    )


s.define("hosting", """
SELECT server_id, CASE WHEN coalesce(c, 0) > 0 AND coalesce(o, 0) = 0 THEN 'Cloud' WHEN coalesce(c, 0) = 0 AND coalesce(o, 0) > 0 THEN 'Self-hosted' ELSE 'Unknown' END AS hosting_type, x.installation_id, hostname AS cloud_hostname
FROM (SELECT coalesce(v.server_id, u.server_id) AS server_id, c, o, installation_id FROM (SELECT server_id, count(*) FILTER (is_cloud) AS c, count(*) FILTER (NOT is_cloud) AS o, arg_max({'v': installation_id}, activity_date).v AS installation_id FROM server_spine GROUP BY 1) v
  FULL JOIN (SELECT DISTINCT server_id FROM user_spine WHERE is_active_today) u ON u.server_id = v.server_id) x
LEFT JOIN (SELECT installation_id, hostname FROM subscription_rows QUALIFY row_number() OVER (PARTITION BY hostname ORDER BY created_at DESC, installation_id DESC) = 1) s ON s.installation_id = x.installation_id""",
         "server_spine", "user_spine", "subscription_rows")


def spines(t):
    """Server and user spine as marts."""
    return mart(server_spine(t), "server-spine"), mart(user_spine(t), "user-spine")


def hosting(t, spine, users):
    return plan.hosting_type(spine, users.where("is_active_today"), subscription_rows(t))


@query("j26_hosting_type", s.with_("hosting") + "SELECT * FROM hosting")
def _(t):
    return hosting(t, *spines(t))


s.define("exclusions", """
SELECT DISTINCT server_id, reason FROM (SELECT server_id, CASE WHEN server_ip = '10.3.5.3' THEN 'Restricted IP' END AS a, CASE WHEN k = 1 THEN 'Ran Tests' END AS b, CASE WHEN k * 30 < 40 THEN 'Active Users > Registered Users' END AS c, CASE WHEN version_full = '9.2.4' THEN 'Custom Build Version Format' END AS d
  FROM server_reports WHERE event_type = 'error') UNPIVOT (reason FOR x IN (a, b, c, d))
UNION ALL SELECT server_id, CASE WHEN count_server_active_days = 1 AND count_user_active_days = 0 THEN 'Single day server-side telemetry only' WHEN count_server_active_days = 0 AND count_user_active_days = 1 THEN 'Single day user telemetry only'
   WHEN count_server_active_days = 1 THEN 'Single day telemetry only' ELSE 'Single day security only' END FROM summary WHERE count_server_active_days = 1 OR (count_server_active_days = 0 AND (count_user_active_days = 1 OR count_diagnostics_active_days = 1))
UNION ALL SELECT server_id, 'Invalid server id' FROM summary WHERE length(server_id) <> 3""", "server_reports", "summary")


def _exclusion_parts(t):
    logs = server_reports(t).where(F.col("event_type") == "error").select(
        "server_id", "server_ip", (F.col("k") == 1).alias("has_run_unit_tests"), (F.col("k") * 30).alias("count_users"), F.lit(40).alias("count_active_users"),
        (F.col("version_full") == "9.2.4").alias("is_custom_build_version_format"),
    )
    days = mart(summary(t), "server-summary")
    return [plan.security_exclusions(logs, ["10.3.5.3"]), plan.single_day_exclusions(days), plan.invalid_id_exclusions(days, 3)]


@query("j27_excludable_entities", s.with_("exclusions") + """
SELECT server_id, bool_or(reason = 'Ran Tests') AS has_reason_ran_tests, bool_or(reason = 'Active Users > Registered Users') AS has_reason_active_users___registered_users,
 bool_or(reason = 'Custom Build Version Format') AS has_reason_custom_build_version_format, bool_or(reason = 'Invalid server id') AS has_reason_invalid_server_id FROM exclusions GROUP BY 1""")
def _(t):
    reasons = ["Ran Tests", "Active Users > Registered Users", "Custom Build Version Format", "Invalid server id"]
    out = plan.excludable_entities(_exclusion_parts(t), reasons)
    return out.select(
        "server_id", "has_reason_ran_tests", "has_reason_active_users___registered_users", "has_reason_custom_build_version_format", "has_reason_invalid_server_id"
    )


@query("j28_server_info", s.with_("hosting") + """
, st AS (""" + _first_last_sql("server_id", LASTS) + """ FROM server_spine GROUP BY 1), ut AS (SELECT server_id, min(activity_date) AS f, max(activity_date) AS l FROM user_spine WHERE is_active_today GROUP BY 1),
lic AS (SELECT server_id, 'k' || k AS license_id FROM server_reports WHERE k > 50 QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY "timestamp"::DATE DESC, 'k' || k DESC) = 1),
cus AS (SELECT installation_id, hostname AS name FROM subscription_rows QUALIFY row_number() OVER (PARTITION BY installation_id ORDER BY created_at DESC, hostname DESC) = 1)
SELECT server_id, least(st.first_activity_date, ut.f) AS first_activity_date, greatest(st.last_activity_date, ut.l) AS last_activity_date, st.last_binary_edition, st.last_server_ip, h.hosting_type, h.installation_id, h.cloud_hostname,
 CASE WHEN st.last_server_ip IS NULL THEN 'Unknown' ELSE coalesce(n_name, 'Unknown') END AS last_known_ip_country,
 CASE h.hosting_type WHEN 'Self-hosted' THEN coalesce(p_name, 'Unknown') WHEN 'Cloud' THEN coalesce(cus.name, 'Unknown') ELSE coalesce(p_name, cus.name, 'Unknown') END AS company_name
FROM st FULL JOIN ut USING (server_id) LEFT JOIN hosting h USING (server_id) LEFT JOIN nation ON n_nationkey = TRY_CAST(split_part(st.last_server_ip, '.', 3) AS INTEGER) LEFT JOIN lic USING (server_id) LEFT JOIN part ON 'k' || p_partkey = license_id
LEFT JOIN cus ON cus.installation_id = h.installation_id""")
def _(t):
    spine, user_days = spines(t)
    overview = plan.first_last_summary(spine, "server_id", FIRSTS, LASTS)
    octet = F.split_part("last_server_ip", F.lit("."), F.lit(3)).try_cast("int")
    countries = overview.join(t.nation, octet == F.col("n_nationkey")).select("server_id", F.col("n_name").alias("last_known_ip_country"))
    licences = server_reports(t).where(F.col("k") > 50).select("server_id", F.concat(F.lit("k"), "k").alias("license_id"), F.to_date("timestamp").alias("date"))
    known = t.part.select(F.concat(F.lit("k"), "p_partkey").alias("license_id"), F.col("p_name").alias("company_name"))
    customers = subscription_rows(t).withColumnRenamed("hostname", "name")
    users = user_days.where("is_active_today")
    out = plan.server_info(overview, users, hosting(t, spine, user_days), countries, licences, known, customers)
    return out.select(
        "server_id", "first_activity_date", "last_activity_date", "last_binary_edition", "last_server_ip", "hosting_type", "installation_id",
        "cloud_hostname", "last_known_ip_country", "company_name",
    )


@query("j29_daily_config", s.with_("server_spine") + """
, ldap AS (SELECT server_id, "timestamp"::DATE AS d, arg_max({'v': database_type}, "timestamp").v AS ldap_type FROM server_reports WHERE event_type = 'click' GROUP BY ALL),
svc AS (SELECT server_id, "timestamp"::DATE AS d, arg_max(k, "timestamp") AS session_days, arg_max({'v': operating_system}, "timestamp").v AS web_mode FROM server_reports WHERE event_type = 'view' GROUP BY ALL),
alls AS (SELECT server_id, "timestamp"::DATE AS d, arg_max({'v': database_type}, "timestamp").v AS ldap_type, arg_max(k * 2, "timestamp") AS session_days FROM server_reports WHERE event_type = 'signup' GROUP BY ALL)
SELECT daily_server_id, s.server_id, s.activity_date, coalesce(alls.ldap_type, ldap.ldap_type) AS ldap_type, coalesce(alls.session_days, svc.session_days) AS session_days, web_mode, ldap.server_id IS NOT NULL AS has_segment_telemetry_data, svc.server_id IS NOT NULL AS has_rudder_telemetry_data
FROM server_spine s LEFT JOIN ldap ON ldap.server_id = s.server_id AND ldap.d = activity_date LEFT JOIN svc ON svc.server_id = s.server_id AND svc.d = activity_date LEFT JOIN alls ON alls.server_id = s.server_id AND alls.d = activity_date""")
def _(t):
    raw = server_reports(t)
    part = lambda kind, **cols: raw.where(F.col("event_type") == kind).select("server_id", "timestamp", *[F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in cols.items()])
    sections = {
        "ldap": part("click", ldap_type="database_type", has_segment=F.lit(True), has_rudder=F.lit(False)),
        "service": part("view", session_days="k", web_mode="operating_system", has_segment=F.lit(False), has_rudder=F.lit(True)),
    }
    combined = part("signup", ldap_type="database_type", session_days=F.col("k") * 2)
    return plan.daily_config(mart(server_spine(t), "server-spine"), sections, combined, s.AS_OF)


@query("j30_feature_flag_details", s.with_("server_reports") + """
SELECT server_id, "timestamp"::DATE AS server_date, md5(server_id || '-' || "timestamp"::DATE) AS daily_server_id, edition AS test_feature, k > 50 AS apps_enabled FROM server_reports
QUALIFY row_number() OVER (PARTITION BY server_id, "timestamp"::DATE ORDER BY "timestamp" DESC, event_id DESC) = 1""")
def _(t):
    flags = server_reports(t).select(
        "server_id", "timestamp", F.col("event_id").alias("id"), F.col("edition").alias("test_feature"), (F.col("k") > 50).alias("apps_enabled")
    )
    return plan.feature_flag_details(flags, ["test_feature", "apps_enabled"], s.AS_OF)
