"""Access log, download, visit, geography and schema drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregate import spread
from ..plans import calendars, web as plan
from . import standins as s
from .registry import mart, query

# ---------------------------------------------------------------- security pings

s.define("pings", """
SELECT 'v' || (user_id // 5) AS server_id, ts AS log_at, '10.' || (user_id % 7) || '.' || k || '.9' AS server_ip, event_id, k, user_id, event_type, CASE event_type WHEN 'error' THEN '9.' || (k % 3) || '.dev' ELSE '9.' || (k % 3) || '.' || (k % 5) END AS build,
 k * 2 AS uc, CASE WHEN k > 90 THEN k * 3 ELSE k END AS auc, 'n' || (k % 4) AS location FROM (SELECT *, CAST(props ->> '$.k' AS INTEGER) AS k FROM events)""")


def pings(t):
    """Raw security log lines: the fields sit in the query string."""
    k, u = F.get_json_object("props", "$.k").cast("int"), F.col("user_id")
    minor = F.when(F.col("event_type") == "error", "dev").otherwise((k % 5).cast("string"))
    pair = lambda name, value: F.concat(F.lit(f"&{name}="), value)
    query_string = F.concat(
        F.lit("id=v"), F.floor(u / 5), pair("b", F.concat(F.lit("9."), k % 3, F.lit("."), minor)), pair("be", F.when(k % 2 == 0, "true").otherwise("false")),
        pair("db", F.when(k % 3 == 0, "postgres").otherwise("mysql")), pair("os", F.lit("linux")), pair("uc", k * 2), pair("tc", k % 6),
        pair("auc", F.when(k > 90, k * 3).otherwise(k)), pair("ut", F.when(k == 7, 1).otherwise(0)),
    )
    # The table may come as one row group, so rows are spread by their number before the slow work on each.
    return spread(t.events.select("event_id", "ts", "user_id", "event_type", "props"), 20_000, "event_id").select(
        F.col("ts").alias("log_at"), F.when(F.col("event_type") == "view", "/other").otherwise("/security").alias("uri"), F.lit("GET").alias("method"),
        F.lit("Go-http-client/1.1").alias("user_agent"), F.concat(F.lit("10."), u % 7, F.lit("."), k, F.lit(".9")).alias("server_ip"), query_string.alias("query"),
        F.concat(F.lit("n"), k % 4).alias("location"),
    )


@query("j43_security_log_entries", s.with_("pings") + """
SELECT log_at::DATE AS log_date, log_at, server_ip, server_id, 9 AS version_major, k % 3 AS version_minor, CASE WHEN event_type <> 'error' THEN k % 5 END AS version_patch, build AS version_full, k % 2 = 0 AS is_enterprise_ready,
 CASE WHEN k % 3 = 0 THEN 'postgres' ELSE 'mysql' END AS database_type, 'linux' AS operating_system, uc AS count_users, k % 6 AS count_teams, auc AS count_active_users, k = 7 AS has_run_unit_tests, event_type = 'error' AS is_custom_build_version_format FROM pings WHERE event_type <> 'view'""")
def _(t):
    return plan.security_log_entries(pings(t), s.AS_OF, skip=["plyr"])


@query("j43_daily_security_pick", s.with_("pings") + """
, c AS (SELECT *, log_at::DATE AS log_date, date_trunc('hour', log_at) AS h FROM pings WHERE event_type NOT IN ('view', 'error') AND k <> 7 AND uc >= auc),
loc AS (SELECT server_id, log_date, auc, server_ip, h, location FROM c GROUP BY server_id, log_date, auc, server_ip, h, location QUALIFY row_number() OVER (PARTITION BY server_id, log_date, auc, server_ip, h ORDER BY count(*) DESC, location DESC) = 1),
l AS (SELECT 'v' || o_custkey AS server_id, 'k' || o_orderkey AS license_id, o_orderpriority = '5-LOW' AS trial, DATE '2024-01-01' + CAST(o_orderkey % 20 AS INTEGER) AS issued_date, DATE '2024-01-01' + CAST(o_orderkey % 20 + 9 AS INTEGER) AS expire_date FROM orders),
m AS (SELECT *, bool_or(trial) OVER (PARTITION BY server_id) AND bool_or(NOT trial) OVER (PARTITION BY server_id) AS mixed FROM l),
p AS (SELECT c.server_id, c.log_date, c.auc AS count_active_users, c.uc AS count_users, c.log_at, c.server_ip, c.build AS version_full, count(*) OVER (PARTITION BY c.server_id, c.log_date) AS occurrences, h, auc FROM c QUALIFY row_number() OVER (PARTITION BY c.server_id, c.log_date ORDER BY auc DESC, log_at DESC) = 1)
SELECT p.server_id, p.log_date, count_active_users, count_users, log_at, p.server_ip, version_full, occurrences, location, max(CASE WHEN NOT mixed OR NOT trial THEN license_id END) AS license_id1, max(CASE WHEN mixed AND trial THEN license_id END) AS license_id2
FROM p LEFT JOIN loc ON loc.server_id = p.server_id AND loc.log_date = p.log_date AND loc.auc = p.auc AND loc.server_ip = p.server_ip AND loc.h = p.h LEFT JOIN m ON m.server_id = p.server_id AND p.log_date BETWEEN issued_date AND expire_date GROUP BY ALL""")
def _(t):
    raw = pings(t)
    # Written once: three results start from the fields, and taking a query string apart is the slow part.
    fields = mart(plan.security_log_entries(raw, s.AS_OF), "security-log")
    entries = fields.join(raw.select("log_at", "server_ip", "location").distinct(), ["log_at", "server_ip"])
    offset = (F.col("o_orderkey") % 20).cast("int")
    licences = t.orders.select(
        F.concat(F.lit("v"), "o_custkey").alias("server_id"), F.concat(F.lit("k"), "o_orderkey").alias("license_id"), (F.col("o_orderpriority") == "5-LOW").alias("trial"),
        F.date_add(s.day("2024-01-01"), offset).alias("issued_date"), F.date_add(s.day("2024-01-01"), offset + 9).alias("expire_date"),
    )
    out = plan.daily_security_pick(entries, licences, s.AS_OF, ["10.0.0.1"])
    return out.select(
        "server_id", "log_date", "count_active_users", "count_users", "log_at", "server_ip", "version_full", "occurrences", "location", "license_id1", "license_id2"
    )


# ---------------------------------------------------------------- downloads

_FILE = """CASE l_returnflag WHEN 'A' THEN '/5.' || l_linenumber || '.' || (q % 4) || CASE WHEN q % 3 = 0 THEN '/x-team-linux-amd64.tar.gz' WHEN q % 3 = 1 THEN '/x-enterprise-windows-amd64.zip' ELSE '/x-linux.tar.gz' END
 WHEN 'N' THEN '/desktop/4.' || l_linenumber || '.0/app' || CASE q % 3 WHEN 0 THEN '-win.exe' WHEN 1 THEN '-mac.zip' ELSE '-linux.deb' END ELSE '/docs/' || q END"""
s.define("release_logs", f"""
SELECT l_orderkey || '-' || l_partkey AS request_id, l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS log_at, {_FILE} AS uri, CAST(l_extendedprice * 100 AS BIGINT) AS response_bytes, CASE WHEN l_linestatus = 'O' THEN 200 ELSE 206 + 200 * (q % 2) END AS status,
 '10.0.' || l_suppkey || '.' || (l_orderkey % 50) AS client_ip, CASE q % 5 WHEN 0 THEN 'POST' ELSE 'GET' END AS http_method, 'Mozilla/5.0%20(Windows%2520NT)%20Firefox/' || (l_linenumber * 10) AS user_agent, l_returnflag, q, l_linenumber
FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem)""")


def release_logs(t):
    q = F.col("l_quantity").cast("int")
    number = F.col("l_linenumber")
    server = F.when(q % 3 == 0, "/x-team-linux-amd64.tar.gz").when(q % 3 == 1, "/x-enterprise-windows-amd64.zip").otherwise("/x-linux.tar.gz")
    desktop = F.when(q % 3 == 0, "-win.exe").when(q % 3 == 1, "-mac.zip").otherwise("-linux.deb")
    uri = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("/5."), number, F.lit("."), q % 4, server))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("/desktop/4."), number, F.lit(".0/app"), desktop))
        .otherwise(F.concat(F.lit("/docs/"), q))
    )
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_partkey").alias("request_id"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=(F.col("l_partkey") % 1440).cast("int"))).alias("log_at"), uri.alias("uri"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("response_bytes"),
        F.when(F.col("l_linestatus") == "O", 200).otherwise(206 + 200 * (q % 2)).alias("status"),
        F.concat(F.lit("10.0."), "l_suppkey", F.lit("."), F.col("l_orderkey") % 50).alias("client_ip"), F.when(q % 5 == 0, "POST").otherwise("GET").alias("http_method"),
        F.concat(F.lit("Mozilla/5.0%20(Windows%2520NT)%20Firefox/"), number * 10).alias("user_agent"),
    )


s.define("release_entries", """
SELECT *, log_at::DATE AS log_date, 'Mozilla/5.0 (Windows NT) Firefox/' || (l_linenumber * 10) AS agent, CASE l_returnflag WHEN 'N' THEN 'desktop' WHEN 'A' THEN CASE WHEN q % 3 = 0 THEN 'team' ELSE 'enterprise' END END AS download_type,
 CASE l_returnflag WHEN 'N' THEN CASE q % 3 WHEN 0 THEN 'windows' WHEN 1 THEN 'mac' ELSE 'linux' END WHEN 'A' THEN CASE q % 3 WHEN 1 THEN 'windows' ELSE 'linux' END END AS operating_system,
 CASE l_returnflag WHEN 'A' THEN '5.' || l_linenumber || '.' || (q % 4) WHEN 'N' THEN '4.' || l_linenumber || '.0' END AS version FROM release_logs""", "release_logs")
DOWNLOAD = ["request_id", "log_at", "client_ip", "uri", "download_type", "operating_system", "version", "version_minor", "ua_browser_family", "daily_ip_id", "client_fingerprint"]


@query("j44_downloads", s.with_("release_entries") + """
SELECT request_id, log_at, client_ip, uri, download_type, operating_system, version, l_linenumber AS version_minor, 'Firefox' AS ua_browser_family, md5(log_date || '-' || client_ip) AS daily_ip_id, md5(client_ip || '-' || agent) AS client_fingerprint
FROM release_entries WHERE response_bytes > 1000000 AND status < 300 AND version IS NOT NULL AND http_method = 'GET' QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY log_at, client_ip, uri) = 1""")
def _(t):
    # dealt by request first: the paths are parsed by all tasks, and the rows of a request are together already
    return plan.downloads(plan.release_log_entries(release_logs(t).repartition("request_id"))).select(*DOWNLOAD)


@query("j44_daily_first_downloads", s.with_("release_entries") + """
SELECT log_date, client_ip, min(log_at) AS first_download_timestamp, md5(log_date || '-' || client_ip) AS daily_ip_id FROM release_entries WHERE response_bytes > 0 AND status < 300 AND version IS NOT NULL GROUP BY ALL""")
def _(t):
    return plan.daily_first_downloads(plan.release_log_entries(release_logs(t)))


@query("j45_downloads_outlier_filtered", s.with_("release_entries") + """
, d AS (SELECT * FROM release_entries WHERE response_bytes > 0 AND status < 300 AND version IS NOT NULL),
u AS (SELECT uri, avg(response_bytes) AS a, stddev_samp(response_bytes) AS sd, sum(response_bytes)::DOUBLE / count(*) AS bytes_uri_avg FROM d GROUP BY 1), f AS (SELECT client_ip, min(log_at) AS first_install_at FROM d GROUP BY 1)
SELECT request_id, log_at, d.uri, response_bytes, bytes_uri_avg, first_install_at FROM d JOIN u USING (uri) JOIN f USING (client_ip) WHERE response_bytes > 1000000 AND NOT coalesce(abs(response_bytes - a) > sd, false)""")
def _(t):
    out = plan.downloads_outlier_filtered(mart(plan.release_log_entries(release_logs(t)), "release-entries"))
    return out.select("request_id", "log_at", "uri", "response_bytes", "bytes_uri_avg", "first_install_at")


# ---------------------------------------------------------------- requests and visits

REGIONS = ["eu", "us", "test"]
s.define("balancer", """
SELECT event_id, ts AS request_at, ['eu', 'us', 'test'][CAST(user_id % 3 + 1 AS INTEGER)] AS region, CASE event_type WHEN 'click' THEN '/api/v1/send_push' WHEN 'view' THEN '/api/v1/ack' ELSE '/api/v1/other' END AS path, event_type,
 CAST(props ->> '$.k' AS INTEGER) AS k FROM events""")


def balancer(t):
    k = F.get_json_object("props", "$.k").cast("int")
    path = F.when(F.col("event_type") == "click", "/api/v1/send_push").when(F.col("event_type") == "view", "/api/v1/ack").otherwise("/api/v1/other")
    line = F.concat(F.when(k == 3, "GET").otherwise("POST"), F.lit(" https://push.example.com:443"), path, F.when(k == 5, " broken line").otherwise(" HTTP/1.1"))
    rows = t.events.select(
        F.col("ts").alias("request_at"), s.pick((F.col("user_id") % 3).cast("int"), REGIONS).alias("region"), line.alias("request"),
        F.when(k == 9, 500).otherwise(200).alias("status"), (F.col("event_type") == "click").alias("is_push"),
    )
    return plan.parse_request_line(rows)


@query("j46_hourly_request_counts", s.with_("balancer") + """
SELECT date_trunc('hour', request_at) AS request_date_hour, count(*) FILTER (event_type = 'click') AS count_send_push, count(*) FILTER (event_type = 'view') AS count_send_ack FROM balancer
WHERE event_type IN ('click', 'view') AND k NOT IN (3, 5, 9) AND request_at > TIMESTAMP '2024-01-03' GROUP BY 1""")
def _(t):
    return plan.hourly_request_counts(balancer(t), "2024-01-03")


@query("j46_notification_stats", s.with_("balancer") + f"""
SELECT date_hour, {", ".join(f"count(*) FILTER (event_type = '{e}' AND region = '{r}') AS count_{r}_send_{n}" for r in REGIONS for e, n in (("click", "push"), ("view", "ack")))}
FROM (SELECT unnest(generate_series((SELECT date_trunc('hour', min(request_at)) FROM balancer), (SELECT max(request_at) FROM balancer), INTERVAL 1 HOUR)) AS date_hour) h
LEFT JOIN balancer b ON date_trunc('hour', request_at) = date_hour AND event_type IN ('click', 'view') AND k NOT IN (3, 5, 9) GROUP BY 1""")
def _(t):
    logs = balancer(t)
    spine = calendars.spine_of(t.events, "ts", "hour", "date_hour")
    # Each region has an old and a new log; here pushes and acknowledgements sit in different ones.
    part = lambda r, push: plan.hourly_request_counts(logs.where((F.col("region") == r) & (F.col("is_push") == push)), "2000-01-01")
    return plan.notification_stats(spine, {r: [part(r, True), part(r, False)] for r in REGIONS})


@query("j47_page_visits", """
WITH p AS (SELECT url LIKE 'https%' AS secure, regexp_replace(url, '^https?://[^/]+', '') AS path, split_part(split_part(url, '//', 2), '/', 1) AS host, CAST(length(html) AS BIGINT) AS n FROM pages)
SELECT 'main' AS site, DATE '2024-01-01' AS start_date, DATE '2024-01-31' AS end_date, path AS pagepath, host AS pagetitle, count(*) AS uniquepageviews, sum(n)::BIGINT AS pageviews FROM p WHERE secure GROUP BY ALL
UNION ALL SELECT 'handbook', DATE '2024-01-01', DATE '2024-01-31', split_part(path, '/en/', 2), host, count(*), sum(n)::BIGINT FROM p WHERE NOT secure GROUP BY ALL""")
def _(t):
    path = F.regexp_replace("url", "^https?://[^/]+", "")
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    rows = t.pages.select(
        "url", s.day("2024-01-01").alias("start_date"), s.day("2024-01-31").alias("end_date"), path.alias("pagepath"), host.alias("pagetitle"),
        F.lit(1).cast("bigint").alias("uniquepageviews"), F.length("html").cast("bigint").alias("pageviews"),
    )
    secure = F.col("url").startswith("https")
    return plan.page_visits({"main": rows.where(secure), "handbook": rows.where(~secure)}, {"handbook": "/en/"})


@query("j47_signup_funnel", s.with_("tracks") + """
SELECT id, CASE event WHEN 'click' THEN 'pageview_getting_started' WHEN 'view' THEN 'pageview_verify_email' WHEN 'purchase' THEN 'pageview_company_name' ELSE 'pageview_create_workspace' END AS type,
 CASE event WHEN 'click' THEN 'cloud_account_creation_start' WHEN 'view' THEN 'cloud_account_creation_verify' WHEN 'purchase' THEN 'cloud_account_creation_company' ELSE 'cloud_account_creation_workspace' END AS category
FROM tracks WHERE k >= 10 AND event <> 'error' AND received_at > (SELECT max(received_at) FROM tracks WHERE k >= 10 AND event <> 'error' AND received_at < TIMESTAMP '2024-01-20' AND event_id % 3 = 0)""")
def _(t):
    step = F.when(F.col("event") == "click", "signup").when(F.col("event") == "view", "verify-email").when(F.col("event") == "purchase", "company-name").when(
        F.col("event") == "signup", "create-workspace").otherwise("elsewhere")
    pages = s.tracks(t).select("id", "received_at", F.concat(F.when(F.col("k") < 10, "/site/").otherwise("/cloud/"), step).alias("path"))
    # Only the view of a third of the older pages was loaded; older ones that were missed stay out.
    loaded = plan.signup_funnel_events(pages.where((F.col("received_at") < s.ts("2024-01-20 00:00:00")) & (F.col("id").cast("long") % 3 == 0)))
    return plan.signup_funnel_events(pages, loaded).select("id", "type", "category")


# ---------------------------------------------------------------- geography

s.define("ip_blocks", """
SELECT n_nationkey, (10 * 16777216 + n_nationkey // 4 * 65536 + n_nationkey % 4 * 16384)::BIGINT AS lo, (10 * 16777216 + n_nationkey // 4 * 65536 + n_nationkey % 4 * 16384 + 16383)::BIGINT AS hi, CASE WHEN n_nationkey <> 8 THEN n_name END AS country FROM nation""")
s.define("visitors", """
SELECT *, split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536 + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT AS n FROM access_log""", "access_log")


def ranges(t):
    key = F.col("n_nationkey")
    blocks = t.nation.select(F.concat(F.lit("10."), F.floor(key / 4), F.lit("."), key % 4 * 64, F.lit(".0/18")).alias("network"), key.alias("geoname_id"))
    locations = t.nation.where(key != 8).select(key.alias("geoname_id"), F.col("n_name").alias("country_name"))
    return plan.country_ranges(blocks, locations)


@query("j48_docs_feedback_geo", s.with_("visitors", "ip_blocks") + """
SELECT page_id, ip AS client_ip, country AS geolocated_country_name, CASE page_id % 6 WHEN 0 THEN 'Electron' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'iPhone' END AS ua_browser_family FROM visitors LEFT JOIN ip_blocks ON n BETWEEN lo AND hi""")
def _(t):
    feedback = s.access_log(t).select("page_id", F.col("ip").alias("client_ip"), F.col("user_agent").alias("context_user_agent"))
    return plan.docs_feedback_geo(feedback, ranges(t)).select("page_id", "client_ip", "geolocated_country_name", "ua_browser_family")


@query("j49_ip_to_country", s.with_("visitors", "ip_blocks") + """
SELECT 'v' || page_id AS server_id, CASE WHEN status = 404 THEN 'none' ELSE ip END AS last_server_ip, CASE WHEN status = 404 THEN 'Unknown' ELSE coalesce(country, 'Unknown') END AS last_known_ip_country FROM visitors LEFT JOIN ip_blocks ON n BETWEEN lo AND hi""")
def _(t):
    servers = s.access_log(t).select(
        F.concat(F.lit("v"), "page_id").alias("server_id"), F.when(F.col("status") == 404, "none").otherwise(F.col("ip")).alias("last_server_ip")
    )
    return plan.ip_to_country(servers, ranges(t))


# ---------------------------------------------------------------- schema drift

s.define("column_history", """
SELECT DISTINCT ts::DATE AS snapshot_date, 's' || (user_id % 2) AS table_schema, event_type AS table_name, 'c' || (CAST(props ->> '$.k' AS INTEGER) // 4) AS column_name FROM events""")


def column_history(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.to_date("ts").alias("snapshot_date"), F.concat(F.lit("s"), F.col("user_id") % 2).alias("table_schema"), F.col("event_type").alias("table_name"),
        F.concat(F.lit("c"), F.floor(k / 4)).alias("column_name"),
    ).distinct()


@query("j50_table_drift", s.with_("column_history") + """
, c AS (SELECT table_schema, table_name, snapshot_date, count(*) AS column_count FROM column_history GROUP BY ALL)
SELECT * FROM (SELECT *, lag(column_count) OVER w AS prev_column_count, CASE WHEN lag(column_count) OVER w IS NULL THEN 'New Table' WHEN lag(column_count) OVER w <> column_count THEN 'New Column' END AS update_type FROM c WINDOW w AS (PARTITION BY table_schema, table_name ORDER BY snapshot_date)) WHERE update_type IS NOT NULL""")
def _(t):
    return plan.table_drift(column_history(t))


@query("j50_column_drift", s.with_("column_history") + """
SELECT table_schema, table_name, column_name, min(snapshot_date) AS date_added FROM column_history GROUP BY ALL HAVING min(snapshot_date) > (SELECT min(snapshot_date) FROM column_history)""")
def _(t):
    return plan.column_drift(column_history(t))
