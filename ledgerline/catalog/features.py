"""Feature usage and event registry queries."""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import agent_patterns
from ..operators import merge
from ..plans import features as plan
from ..session import scratch_path
from ..sources import files
from . import standins as s
from .registry import mart, query

AS_OF = "2024-01-31"
START = "2024-01-01"

# A small tracking plan, in rule order.
PLAN = [
    {"event_name": "click", "category": "ui", "event_type": "low", "property_name": None, "property_value": None, "feature_name": "navigation"},
    {"event_name": "click", "category": "ui", "event_type": "high", "property_name": "context_user_agent", "property_value": None, "feature_name": "shortcuts"},
    {"event_name": "purchase", "category": "api", "event_type": "low", "property_name": "tier", "property_value": "t1", "feature_name": "upgrade"},
    {"event_name": "purchase", "category": "api", "event_type": "high", "property_name": None, "property_value": None, "feature_name": "upgrade"},
    {"event_name": "view", "category": "ui", "event_type": "low", "property_name": None, "property_value": None, "feature_name": "preview"},
]

s.define("feature_events", """
SELECT id AS event_id, event AS event_name, CASE WHEN event IN ('click', 'view') THEN 'ui' ELSE 'api' END AS category, CASE WHEN k < 50 THEN 'low' ELSE 'high' END AS event_type, 't' || (k % 3) AS tier, CASE WHEN k % 4 > 0 THEN 'a' || (k % 4) END AS event_action,
 server_id, user_id, "timestamp", received_at, context_user_agent FROM tracks""", "tracks")


def feature_events(t):
    k = F.col("k")
    return s.tracks(t).select(
        F.col("id").alias("event_id"), F.col("event").alias("event_name"), F.when(F.col("event").isin("click", "view"), "ui").otherwise("api").alias("category"),
        F.when(k < 50, "low").otherwise("high").alias("event_type"), F.concat(F.lit("t"), k % 3).alias("tier"),
        F.when(k % 4 > 0, F.concat(F.lit("a"), k % 4)).alias("event_action"), "server_id", "user_id", "timestamp", "received_at", "context_user_agent",
    )


s.define("attributed", """
SELECT received_at::DATE AS received_at_date, "timestamp"::DATE AS activity_date, server_id, user_id, event_id, event_name,
 CASE WHEN event_name = 'click' AND event_type = 'low' THEN 'navigation' WHEN event_name = 'click' AND context_user_agent IS NOT NULL THEN 'shortcuts' WHEN event_name = 'purchase' AND (tier = 't1' OR event_type = 'high') THEN 'upgrade'
  WHEN event_name = 'view' AND event_type = 'low' THEN 'preview' ELSE 'unknown_features' END AS feature_name FROM feature_events WHERE received_at <= TIMESTAMP '2024-01-31'""", "feature_events")


def attributed(t):
    # The plan lies in a seed file, as a user keeps it; its rows are read in a fixed order.
    path = scratch_path(t.spark, "tracking-plan")
    columns = "nr int, event_name string, category string, event_type string, property_name string, property_value string, feature_name string"
    t.spark.createDataFrame([(n, *r.values()) for n, r in enumerate(PLAN)], columns).write.csv(path, header=True)
    return plan.attribute_features(feature_events(t), plan.load_rules(files.seed(t.spark, path, columns)), AS_OF)


@query("j31_attribute_features", s.with_("attributed") + "SELECT * FROM attributed")
def _(t):
    return attributed(t)


@query("j32_attribute_features_server", s.with_("attributed") + """
SELECT * FROM attributed WHERE received_at_date >= DATE '2024-01-18' AND event_id NOT IN (SELECT event_id FROM attributed WHERE received_at_date <= DATE '2024-01-20')""")
def _(t):
    rows = feature_events(t)
    named = rows.join(attributed(t).select("event_id", "feature_name"), "event_id")
    copies = named.unionByName(named.withColumn("timestamp", F.col("timestamp") - F.expr("interval 1 second")))
    target = attributed(t).where(F.col("received_at_date") <= s.day("2024-01-20"))
    return plan.attribute_features_server(copies, target, AS_OF)


s.define("usage", """
SELECT md5(activity_date || '-' || server_id || '-' || user_id) AS daily_user_id, activity_date, server_id, user_id, count(*) FILTER (feature_name = 'navigation') AS count_navigation, count(*) FILTER (feature_name = 'shortcuts') AS count_shortcuts,
 count(*) FILTER (feature_name = 'upgrade') AS count_upgrade, count(*) FILTER (feature_name = 'preview') AS count_preview, count(*) FILTER (feature_name = 'unknown_features') AS count_unknown_features, count(*) FILTER (feature_name <> 'unknown_features') AS count_known_features, count(*) AS count_total
FROM attributed GROUP BY ALL""", "attributed")


FEATURES = ["navigation", "preview", "shortcuts", "unknown_features", "upgrade"]


def usage(t):
    return plan.feature_usage_per_user_day(attributed(t), FEATURES)


@query("j33_feature_usage_per_user_day", s.with_("usage") + "SELECT * FROM usage")
def _(t):
    return usage(t)


@query("j33_feature_usage_recent", s.with_("attributed") + """
, m AS (SELECT min(m) - 2 AS since FROM (SELECT event_name, max(received_at_date) AS m FROM attributed WHERE received_at_date < DATE '2024-01-25' OR event_name = 'click' GROUP BY 1))
SELECT activity_date, server_id, user_id, count(*) FILTER (feature_name = 'upgrade') AS count_upgrade, count(*) AS count_total FROM attributed, m WHERE received_at_date >= since GROUP BY ALL""")
def _(t):
    rows = attributed(t)
    loaded = rows.where((F.col("received_at_date") < s.day("2024-01-25")) | (F.col("event_name") == "click"))
    since = merge.slowest_source_mark(loaded, "event_name", "received_at_date") - timedelta(days=2)
    out = plan.feature_usage_per_user_day(rows, FEATURES, since=since)
    return out.select("activity_date", "server_id", "user_id", "count_upgrade", "count_total")


s.define("planned", """
SELECT "timestamp"::DATE AS activity_date, server_id, user_id, count(DISTINCT event_id) FILTER (p) AS count_playbooks, count(DISTINCT event_id) FILTER (p) AS count_known_features, count(DISTINCT event_id) FILTER (NOT p) AS count_unknown_features, count(DISTINCT event_id) AS count_total
FROM (SELECT *, event_name = 'signup' AND (event_action IS NULL OR event_action = 'a1') AS p FROM feature_events WHERE received_at <= TIMESTAMP '2024-01-31' AND event_name IN ('signup', 'error')) GROUP BY ALL""", "feature_events")


def planned(t):
    rows = feature_events(t).where(F.col("event_name").isin("signup", "error"))
    covered = F.col("event_action").isNull() | (F.col("event_action") == "a1")
    known = rows.where((F.col("event_name") == "signup") & covered).select("event_name", "event_action")
    return plan.planned_usage_per_user_day(rows, known, "playbooks", AS_OF)


@query("j33_planned_usage_per_user_day", s.with_("planned") + "SELECT *, md5(activity_date || '-' || server_id || '-' || user_id) AS daily_user_id FROM planned")
def _(t):
    return planned(t)


s.define("full_usage", """
SELECT md5(x.activity_date || '-' || x.server_id || '-' || x.user_id) AS daily_user_id, x.*, coalesce(u.count_navigation, 0) AS count_navigation, coalesce(u.count_shortcuts, 0) AS count_shortcuts, coalesce(u.count_upgrade, 0) AS count_upgrade, coalesce(u.count_preview, 0) AS count_preview,
 coalesce(p.count_playbooks, 0) AS count_playbooks, coalesce(u.count_known_features, 0) + coalesce(p.count_known_features, 0) AS count_known_features, coalesce(u.count_unknown_features, 0) + coalesce(p.count_unknown_features, 0) AS count_unknown_features,
 coalesce(u.count_total, 0) + coalesce(p.count_total, 0) AS count_total
FROM (SELECT activity_date, server_id, user_id FROM usage UNION SELECT activity_date, server_id, user_id FROM planned) x LEFT JOIN usage u USING (activity_date, server_id, user_id) LEFT JOIN planned p USING (activity_date, server_id, user_id)""", "usage", "planned")


def full_usage(t):
    return plan.merge_partial_usage({"main": usage(t), "playbooks": planned(t)})


@query("j34_merge_partial_usage", s.with_("full_usage") + "SELECT * FROM full_usage")
def _(t):
    return full_usage(t)


COUNTERS = ["count_navigation", "count_shortcuts", "count_upgrade", "count_preview", "count_playbooks", "count_known_features", "count_unknown_features", "count_total"]
_METRICS = ", ".join(
    f"coalesce({c}, 0) AS {c}_events_daily, coalesce(sum({c}) OVER w, 0)::BIGINT AS {c}_events_monthly, CASE WHEN coalesce({c}, 0) > 0 THEN 1 ELSE 0 END AS {c}_users_daily, CASE WHEN coalesce(sum({c}) OVER w, 0) > 0 THEN 1 ELSE 0 END AS {c}_users_monthly"
    for c in COUNTERS
)
s.define("feature_spine", f"""
SELECT x.server_id, x.user_id, x.activity_date, {_METRICS}, CASE WHEN u.server_id IS NULL THEN 0 ELSE 1 END AS is_active, max(CASE WHEN u.server_id IS NULL THEN 0 ELSE 1 END) OVER w AS is_active_monthly
FROM (SELECT server_id, user_id, unnest(generate_series(min(activity_date)::TIMESTAMP, least(DATE '{AS_OF}', max(activity_date) + 7)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS activity_date FROM full_usage WHERE server_id IN (SELECT server_id FROM full_usage WHERE count_known_features > 0) GROUP BY server_id, user_id) x
LEFT JOIN full_usage u ON u.server_id = x.server_id AND u.user_id = x.user_id AND u.activity_date = x.activity_date
WINDOW w AS (PARTITION BY x.server_id, x.user_id ORDER BY x.activity_date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""", "full_usage")


def feature_spine(t):
    return plan.feature_spine(mart(full_usage(t), "usage"), AS_OF, START, 7)


@query("j35_feature_spine", s.with_("feature_spine") + "SELECT * FROM feature_spine")
def _(t):
    return feature_spine(t)


@query("j36_feature_daily_snapshot", s.with_("feature_spine", "tracks") + f"""
, g AS (SELECT server_id, activity_date, {", ".join(f"sum({c}_{m})::BIGINT AS {c}_{m}" for c in COUNTERS for m in ("events_daily", "events_monthly", "users_daily", "users_monthly"))}, sum(is_active)::BIGINT AS client_daily_active_users, sum(is_active_monthly)::BIGINT AS client_monthly_active_users FROM feature_spine GROUP BY ALL),
r AS (SELECT server_id, "timestamp"::DATE AS activity_date, max(k) AS dau, max(k * 9) AS cru FROM tracks WHERE event = 'error' GROUP BY ALL)
SELECT md5(g.server_id || '-' || g.activity_date) AS daily_server_id, g.*, coalesce(dau, 0) AS server_daily_active_users, coalesce(cru, 0) AS count_registered_users FROM g LEFT JOIN r USING (server_id, activity_date)""")
def _(t):
    k = F.col("k")
    reported = s.tracks(t).where(F.col("event") == "error").groupBy("server_id", F.to_date("timestamp").alias("activity_date")).agg(
        F.max(k).alias("daily_active_users"), F.max(k * 9).alias("count_registered_users")
    )
    return plan.feature_daily_snapshot(mart(feature_spine(t), "feature-spine"), reported, ["daily_active_users", "count_registered_users"])


# ---------------------------------------------------------------- registry


def _count_sql(source: str, where: str) -> str:
    return f"""SELECT md5(received_at::DATE || '-{source}-' || event_name || '-' || category) AS daily_event_id, md5('{source}-' || event_name || '-' || category) AS event_id, received_at::DATE AS received_at_date, '{source}' AS source, event_name, category,
 count(DISTINCT event_id) AS event_count FROM feature_events WHERE received_at <= TIMESTAMP '2024-01-31' AND {where} GROUP BY ALL"""


s.define("daily_web", _count_sql("web", "category = 'ui'"), "feature_events")
s.define("daily_portal", _count_sql("portal", "category = 'api'"), "feature_events")


def daily_counts(t):
    rows = feature_events(t)
    by = ["event_name", "category"]
    return {
        "web": plan.daily_event_count(rows.where(F.col("category") == "ui"), by, "web", AS_OF),
        "portal": plan.daily_event_count(rows.where(F.col("category") == "api"), by, "portal", AS_OF),
    }


@query("j37_daily_event_count", s.with_("daily_web") + "SELECT * FROM daily_web")
def _(t):
    return daily_counts(t)["web"]


@query("j38_event_registry_dim", s.with_("daily_web", "daily_portal") + """
SELECT DISTINCT event_id, source, event_name, category FROM (SELECT * FROM daily_web UNION ALL SELECT * FROM daily_portal)""")
def _(t):
    return plan.event_registry(daily_counts(t))[0]


@query("j38_event_registry_snapshot", s.with_("daily_web", "daily_portal") + """
SELECT DISTINCT daily_event_id AS id, received_at_date AS event_date, event_id, event_count FROM (SELECT * FROM daily_web UNION ALL SELECT * FROM daily_portal)""")
def _(t):
    return plan.event_registry(daily_counts(t))[1]


@query("j39_event_first_last_seen", """
SELECT md5(lower(event_type) || '-' || c) AS event_id, lower(event_type) AS event_name, c AS event_category, min(ts)::DATE AS date_added, max(ts)::DATE AS last_triggered
FROM (SELECT *, CASE WHEN CAST(props ->> '$.k' AS INTEGER) < 40 THEN 'action' ELSE 'g' || (CAST(props ->> '$.k' AS INTEGER) // 40) || CASE WHEN event_type = 'view' THEN user_id % 50 ELSE 0 END END AS c FROM events) GROUP BY ALL""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    other = F.concat(F.lit("G"), F.floor(k / 40), F.when(F.col("event_type") == "view", F.col("user_id") % 50).otherwise(0))
    rows = t.events.select(F.upper("event_type").alias("event"), F.when(k < 40, "Actions").otherwise(other).alias("category"), F.col("ts").alias("timestamp"))
    recent = F.col("timestamp") >= s.ts("2024-01-12 00:00:00")
    return plan.event_first_last_seen([rows.where(recent), rows.where(~recent)], AS_OF)


@query("j40_union_event_family", s.with_("tracks") + """
, r AS (SELECT 'web' AS source_relation, id, event, received_at, k, NULL::VARCHAR AS server_id FROM tracks WHERE event IN ('click', 'view') UNION ALL SELECT 'portal', id, event, received_at, NULL, server_id FROM tracks WHERE event IN ('signup', 'purchase', 'error'))
SELECT * FROM r WHERE event <> 'error' AND received_at > CASE source_relation WHEN 'web' THEN (SELECT max(received_at) FROM r WHERE source_relation = 'web' AND received_at < TIMESTAMP '2024-01-20') ELSE TIMESTAMP '2000-01-01' END""")
def _(t):
    rows = s.tracks(t)
    relations = {
        "web": rows.where(F.col("event").isin("click", "view")).select("id", "event", "received_at", "k"),
        "portal": rows.where(F.col("event").isin("signup", "purchase", "error")).select("id", "event", "received_at", "server_id"),
    }
    loaded = relations["web"].where(F.col("received_at") < s.ts("2024-01-20 00:00:00")).select(F.lit("web").alias("source_relation"), "received_at")
    return plan.union_event_family(relations, loaded, ["error"])


@query("j41_community_tracks", s.with_("feature_events") + """
SELECT event_id, event_name, server_id, "timestamp", received_at::DATE AS received_at_date, 'tracks' AS source_relation FROM feature_events WHERE server_id = 's7'""")
def _(t):
    rows = feature_events(t)
    copies = rows.unionByName(rows.withColumn("timestamp", F.col("timestamp") - F.expr("interval 1 hour")))
    out = plan.community_tracks(copies, "s7", "tracks")
    return out.select("event_id", "event_name", "server_id", "timestamp", "received_at_date", "source_relation")


@query("j41_event_mart", s.with_("tracks") + """
SELECT 'rc' AS source_relation, id, event, "timestamp", received_at, "timestamp"::DATE AS event_date FROM tracks WHERE event IN ('view', 'error') AND received_at > (SELECT max(received_at) FROM tracks WHERE event IN ('view', 'error') AND received_at < TIMESTAMP '2024-01-10')
UNION ALL SELECT 'prod', id, event, "timestamp", received_at, "timestamp"::DATE FROM tracks WHERE event IN ('click', 'purchase') AND received_at > (SELECT max(received_at) FROM tracks WHERE event IN ('click', 'purchase') AND received_at < TIMESTAMP '2024-01-20')""")
def _(t):
    rows = s.tracks(t).select("id", "event", "timestamp", "received_at")
    rc, prod = rows.where(F.col("event").isin("view", "error")), rows.where(F.col("event").isin("click", "purchase"))
    before = lambda df, name, limit: df.where(F.col("received_at") < s.ts(limit)).select(F.lit(name).alias("source_relation"), "received_at")
    loaded = before(rc, "rc", "2024-01-10 00:00:00").unionByName(before(prod, "prod", "2024-01-20 00:00:00"))
    return plan.event_mart({"rc": rc, "prod": prod}, loaded)


@query("j42_user_agent_registry", s.with_("tracks") + """
SELECT DISTINCT context_user_agent, md5(context_user_agent) AS user_agent_id, CASE k % 6 WHEN 0 THEN 'Electron' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'iPhone' END AS browser_family,
 CASE k % 6 WHEN 0 THEN 'Windows' WHEN 2 THEN 'Linux' WHEN 3 THEN 'Mac' WHEN 4 THEN 'iPhone' END AS os_family FROM tracks WHERE context_user_agent IS NOT NULL AND k % 6 <> 1""")
def _(t):
    rows = s.tracks(t)
    known = rows.where(F.contains("context_user_agent", F.lit("Chrome/119"))).select(F.md5("context_user_agent").alias("user_agent_id")).distinct()
    sources = [rows.where(F.col("event") == "click"), rows.where(F.col("event") != "click")]
    return plan.user_agent_registry(sources, known).select("context_user_agent", "user_agent_id", "browser_family", "os_family")


AGENT_SEED = os.path.join(os.path.dirname(os.path.abspath(__file__)), "seeds", "agent_patterns.csv")

# Agent texts of many kinds; {v} is a number of the event.
AGENT_TEXTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/{v}.0.5481 Electron/23.2.0 Desktop/5.{v}.1 Safari/537.36",
    "Mozilla/5.0 (Windows NT 6.3; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.0.0.0 Safari/537.36 Edg/{v}.0.1370.34",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:{v}.0) Gecko/20100101 Firefox/{v}.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_{v}) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.{v} Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_{v} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.{v} Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPad; CPU OS 15_{v}_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/{v}.0.4664 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android {v}; SM-S{v}B) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/{v}.0 Chrome/106.0.5249.126 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 9; S{v}_EEA Build/PPR1.1; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/{v}.0.4638.74 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 7.0; Nexus {v} Build/NBD90Z) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.0.2785.124 Mobile Safari/537.36",
    "Mozilla/5.0 (Android 13; Mobile; rv:{v}.0) Gecko/{v}.0 Firefox/{v}.0",
    "Mozilla/5.0 (compatible; Googlebot/2.{v}; +http://www.google.com/bot.html)",
    "curl/8.{v}.2",
    "Go-http-client/{v}.1",
    "Unnamed client {v}",
]
AGENT_COLUMNS = {
    "browser": ["browser_version_major", "browser_version_minor", "browser_version_patch"],
    "system": ["os_version_major", "os_version_minor", "os_version_patch", "os_version_patch_minor"],
}

s.define("agent_events", f"""
SELECT id, event, replace({s.pick_sql(f"CAST(event_id % {len(AGENT_TEXTS)} AS INTEGER)", AGENT_TEXTS)}, '{{v}}', CAST(event_id % 47 AS VARCHAR)) AS agent FROM tracks""", "tracks")
s.define("agent_rules", rf"""
SELECT position, kind, replace(pattern, '<v>', '{agent_patterns.VERSION}') || '()' AS pattern, family, version, brand, model FROM read_csv('{AGENT_SEED}', header = true, delim = ',', quote = '', escape = '',
 columns = {{'position': 'INTEGER', 'kind': 'VARCHAR', 'word': 'VARCHAR', 'pattern': 'VARCHAR', 'family': 'VARCHAR', 'version': 'VARCHAR', 'brand': 'VARCHAR', 'model': 'VARCHAR'}})""")
s.define("agent_hits", """
SELECT agent, kind, family, coalesce(nullif(version, ''), nullif(part, '')) AS version, nullif(brand, '') AS brand, nullif(replace(model, '$1', coalesce(part, '')), '') AS model, replace(family, '$1', coalesce(part, '')) AS name
FROM (SELECT a.agent, r.*, regexp_extract(a.agent, r.pattern, 1) AS part, row_number() OVER (PARTITION BY a.agent, r.kind ORDER BY r.position) AS place
  FROM (SELECT DISTINCT agent FROM agent_events) a JOIN agent_rules r ON regexp_matches(a.agent, r.pattern)) WHERE place = 1""", "agent_events", "agent_rules")


def _version_sql(kind: str) -> str:
    return ", ".join(f"nullif(list_extract(regexp_split_to_array(max(CASE WHEN kind = '{kind}' THEN version END), '[._]'), {n}), '') AS {name}" for n, name in enumerate(AGENT_COLUMNS[kind], 1))


s.define("agent_parts", f"""
SELECT a.agent, coalesce(max(CASE WHEN kind = 'browser' THEN name END), 'Other') AS browser_family, {_version_sql("browser")}, coalesce(max(CASE WHEN kind = 'system' THEN name END), 'Other') AS os_family, {_version_sql("system")},
 coalesce(max(CASE WHEN kind = 'device' THEN name END), 'Other') AS device_family, max(CASE WHEN kind = 'device' THEN brand END) AS device_brand, max(CASE WHEN kind = 'device' THEN model END) AS device_model
FROM (SELECT DISTINCT agent FROM agent_events) a LEFT JOIN agent_hits h ON a.agent = h.agent GROUP BY a.agent""", "agent_events", "agent_hits")


def agent_events(t):
    number = F.col("event_id") % 47
    texts = s.pick((F.col("event_id") % len(AGENT_TEXTS)).cast("int"), AGENT_TEXTS)
    return s.tracks(t).select("id", "event", F.replace(texts, F.lit("{v}"), number.cast("string")).alias("agent"))


@query("i03_agent_patterns", s.with_("agent_events", "agent_parts") + "SELECT e.id, p.* EXCLUDE (agent) FROM agent_events e LEFT JOIN agent_parts p ON e.agent = p.agent")
def _(t):
    rows = agent_events(t)
    parsed = agent_patterns.parse_by_patterns(rows, "agent", agent_patterns.load_patterns(AGENT_SEED))
    return rows.join(parsed, "agent", "left").drop("agent", "event")


@query("j42_agent_pattern_registry", s.with_("agent_parts") + """
SELECT md5(agent) AS user_agent_id, * FROM agent_parts WHERE agent NOT IN (SELECT agent FROM agent_events WHERE event = 'view')""")
def _(t):
    rows = agent_events(t)
    known = rows.where(F.col("event") == "view").select(F.md5("agent").alias("user_agent_id")).distinct()
    sources = [rows.where(F.col("event") == e) for e in ("click", "view", "purchase", "error", "signup")]
    return plan.user_agent_registry(sources, known, "agent", agent_patterns.load_patterns(AGENT_SEED))
