"""Scalar functions, user-defined functions and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import agents, arith, dates, payload, rules, text
from . import standins as s
from .registry import query

TRACKS = s.with_("tracks")
LOG = s.with_("access_log")


@query("h01_coalesce", "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, CASE WHEN o_orderpriority = '5-LOW' THEN 1 END, 0) AS v FROM orders")
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), F.when(F.col("o_orderpriority") == "5-LOW", 1.0), F.lit(0.0)).alias("v"),
    )


@query("h02_iff_case_decode", """
SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size, CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'open' ELSE 'lost' END AS state FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_totalprice") > 100000, "big").otherwise("small").alias("size"),
        F.expr("decode(o_orderstatus, 'F', 'won', 'O', 'open', 'lost')").alias("state"),
    )


@query("h03_nullif", "SELECT p_partkey, nullif(p_type, 'PROMO') AS type FROM part")
def _(t):
    return t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("type"))


@query("h04_least_greatest", """
WITH x AS (SELECT s_suppkey, s_acctbal AS a, CASE WHEN s_nationkey > 5 THEN s_nationkey * 100.0::DOUBLE END AS b FROM supplier)
SELECT s_suppkey, CASE WHEN b IS NOT NULL THEN least(a, b) END AS lo, CASE WHEN b IS NOT NULL THEN greatest(a, b) END AS hi FROM x""")
def _(t):
    b = F.when(F.col("s_nationkey") > 5, F.col("s_nationkey") * F.lit(100.0))
    return t.supplier.select("s_suppkey", arith.strict_least("s_acctbal", b).alias("lo"), arith.strict_greatest("s_acctbal", b).alias("hi"))


@query("h05_case_functions", "SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, upper(p_type[1]) || lower(p_type[2:]) AS cap FROM part")
def _(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("lo"), F.upper("p_name").alias("up"), F.initcap("p_type").alias("cap"))


@query("h06_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS name FROM part")
def _(t):
    return t.part.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"))


@query("h07_split_part", "SELECT page_id, split_part(split_part(url, '//', 2), '/', 1) AS host, split_part(url, '/', 9) AS missing FROM pages")
def _(t):
    host = F.split_part(F.split_part("url", F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    return t.pages.select("page_id", host.alias("host"), F.split_part("url", F.lit("/"), F.lit(9)).alias("missing"))


@query("h08_split_size", "SELECT page_id, CAST(len(string_split(url, '/')) AS INTEGER) AS parts FROM pages")
def _(t):
    return t.pages.select("page_id", F.size(F.split("url", "/")).alias("parts"))


@query("h09_substring", "SELECT doc_id, substring(text, 3, 5) AS mid, left(text, 4) AS head, right(text, 4) AS tail FROM documents")
def _(t):
    return t.documents.select(
        "doc_id", F.substring("text", 3, 5).alias("mid"), F.left("text", F.lit(4)).alias("head"), F.right("text", F.lit(4)).alias("tail")
    )


@query("h10_position", "SELECT page_id, CAST(instr(url, 'example') AS INTEGER) AS at, contains(url, '?') AS has_query FROM pages")
def _(t):
    return t.pages.select("page_id", F.instr("url", "example").alias("at"), F.contains("url", F.lit("?")).alias("has_query"))


@query("h11_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def _(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("h12_replace", "SELECT page_id, replace(replace(url, 'http://', ''), '/', '%2F') AS u FROM pages")
def _(t):
    bare = F.replace("url", F.lit("http://"), F.lit(""))
    return t.pages.select("page_id", F.replace(bare, F.lit("/"), F.lit("%2F")).alias("u"))


@query("h13_concat", "SELECT c_custkey, c_name || '/' || nullif(c_mktsegment, 'BUILDING') AS label FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("/"), F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("label"))


@query("h14_regexp_substr", r"""
SELECT page_id, nullif(regexp_extract(url, '[0-9]+'), '') AS first_number, nullif(regexp_extract(url, '([a-z]+)=([a-z0-9]+)', 2), '') AS first_value,
  regexp_extract_all(url, '([a-z]+)=([a-z0-9]+)', 2)[2] AS second_value, nullif(regexp_extract(url, 'EXAMPLE\.([a-z]+)', 1, 'i'), '') AS tld FROM pages""")
def _(t):
    pair = "([a-z]+)=([a-z0-9]+)"
    return t.pages.select(
        "page_id", F.regexp_substr("url", F.lit("[0-9]+")).alias("first_number"), text.nth_match("url", pair, 1, 2).alias("first_value"),
        text.nth_match("url", pair, 2, 2).alias("second_value"), text.first_match("url", r"(?i)EXAMPLE\.([a-z]+)", 1).alias("tld"),
    )


@query("h15_regexp_like", "SELECT page_id, regexp_full_match(url, 'https://.*') AS secure, regexp_full_match(url, 'https') AS partial FROM pages")
def _(t):
    return t.pages.select("page_id", text.full_match("url", "https://.*").alias("secure"), text.full_match("url", "https").alias("partial"))


@query("h16_regexp_replace", "SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS u FROM pages")
def _(t):
    return t.pages.select("page_id", F.regexp_replace("url", "[0-9]+", "#").alias("u"))


@query("h17_regexp_instr", """
SELECT page_id, CASE WHEN regexp_matches(url, '[0-9]+') THEN CAST(instr(url, regexp_extract(url, '[0-9]+')) AS INTEGER) ELSE 0 END AS at FROM pages""")
def _(t):
    return t.pages.select("page_id", F.regexp_instr("url", F.lit("[0-9]+")).alias("at"))


@query("h18_date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%d/%m/%Y') AS day, strftime(o_orderdate, '%B') AS name FROM orders")
def _(t):
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.date_format("o_orderdate", "MMMM").alias("name"),
    )


@query("h19_to_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.to_date(F.date_format("o_orderdate", "MM/dd/yyyy"), "MM/dd/yyyy").alias("d"))


@query("h20_to_timestamp", "SELECT event_id, date_trunc('second', ts) AS from_seconds, date_trunc('millisecond', ts) AS from_millis, ts AS from_text FROM events")
def _(t):
    at = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id", dates.epoch_seconds(F.unix_timestamp(at)).alias("from_seconds"), dates.epoch_millis(F.unix_millis(at)).alias("from_millis"),
        F.to_timestamp_ntz(F.col("ts").cast("string")).alias("from_text"),
    )


@query("h21_try_conversions", """
SELECT page_id, TRY_CAST(split_part(split_part(url, '/', 5), '?', 1) AS INTEGER) AS number, TRY_CAST(split_part(url, '/', 5) AS DECIMAL(10,2))::DOUBLE AS price, NULL::TIMESTAMP AS at FROM pages""")
def _(t):
    part = F.split_part("url", F.lit("/"), F.lit(5))
    return t.pages.select(
        "page_id", F.split_part(part, F.lit("?"), F.lit(1)).try_cast("int").alias("number"), part.try_cast("decimal(10,2)").cast("double").alias("price"),
        F.try_to_timestamp("url").cast("timestamp_ntz").alias("at"),
    )


@query("h22_date_trunc", """
SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('week', ts)::DATE AS week, date_trunc('month', ts)::DATE AS month, date_trunc('quarter', ts)::DATE AS quarter FROM events""")
def _(t):
    return t.events.select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        *[F.trunc("ts", unit).alias(unit) for unit in ("week", "month", "quarter")],
    )


@query("h23_date_add", """
SELECT o_orderkey, (o_orderdate::DATE + 30) AS plus_days, (o_orderdate - INTERVAL 1 MONTH)::DATE AS minus_month, o_orderdate + INTERVAL 36 HOUR AS plus_hours FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", F.date_add("o_orderdate", 30).alias("plus_days"), F.add_months("o_orderdate", -1).alias("minus_month"),
        (F.col("o_orderdate") + F.expr("interval 36 hours")).alias("plus_hours"),
    )


@query("h24_boundary_datediff", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', o_orderdate, l_shipdate) AS days, (date_trunc('week', l_shipdate)::DATE - date_trunc('week', o_orderdate)::DATE) // 7 AS weeks, date_diff('month', o_orderdate, l_shipdate) AS months,
  date_diff('quarter', o_orderdate, l_shipdate) AS quarters, date_diff('year', o_orderdate, l_shipdate) AS years, date_diff('hour', o_orderdate, l_shipdate) AS hours FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    a, b = "o_orderdate", "l_shipdate"
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.datediff(b, a).cast("bigint").alias("days"),
        dates.weeks_crossed(a, b).cast("bigint").alias("weeks"), dates.months_crossed(a, b).cast("bigint").alias("months"),
        dates.quarters_crossed(a, b).cast("bigint").alias("quarters"), dates.years_crossed(a, b).cast("bigint").alias("years"),
        dates.hours_crossed(a, b).alias("hours"),
    )


@query("h25_extract", """
SELECT o_orderkey, extract('year' FROM o_orderdate) AS y, extract('quarter' FROM o_orderdate) AS q, extract('month' FROM o_orderdate) AS m, extract('day' FROM o_orderdate) AS d,
  extract('dow' FROM o_orderdate) AS dow, extract('week' FROM o_orderdate) AS w, epoch(o_orderdate)::BIGINT AS epoch FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", *[e.cast("bigint").alias(n) for n, e in {
            "y": F.year(d), "q": F.quarter(d), "m": F.month(d), "d": F.dayofmonth(d), "dow": F.dayofweek(d) - 1, "w": F.weekofyear(d),
            "epoch": F.unix_timestamp(d.cast("timestamp"))}.items()],
    )


@query("h26_last_day", "SELECT o_orderkey, last_day(o_orderdate) AS month_end, (date_trunc('week', o_orderdate) + INTERVAL 6 DAY)::DATE AS week_end FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.last_day("o_orderdate").alias("month_end"), dates.week_end("o_orderdate").alias("week_end"))


@query("h27_day_names", """
SELECT o_orderkey, left(dayname(o_orderdate), 3) AS dn, left(monthname(o_orderdate), 3) AS mn, weekofyear(o_orderdate) AS w, dayofmonth(o_orderdate) AS dm,
  (o_orderdate::DATE - CAST(CASE WHEN (isodow(o_orderdate) + 6 - 4) % 7 = 0 THEN 7 ELSE (isodow(o_orderdate) + 7 - 5 ) % 7 + CASE WHEN isodow(o_orderdate) = 5 THEN 7 ELSE 0 END END AS INTEGER))::DATE AS previous_friday FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.dayname(d).alias("dn"), F.monthname(d).alias("mn"), F.weekofyear(d).cast("bigint").alias("w"),
        F.dayofmonth(d).cast("bigint").alias("dm"), dates.previous_weekday(d, "Fri").alias("previous_friday"),
    )


@query("h28_convert_timezone", """
SELECT event_id, ts - INTERVAL 8 HOUR AS pacific FROM events""")
def _(t):
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), "ts").alias("pacific"))


@query("h29_as_of", "SELECT o_orderkey, o_orderdate::DATE <= DATE '1999-06-30' AS is_past, (DATE '1999-06-30' - o_orderdate::DATE)::INTEGER AS age FROM orders")
def _(t):
    as_of = s.day("1999-06-30")
    return t.orders.select("o_orderkey", (F.to_date("o_orderdate") <= as_of).alias("is_past"), F.datediff(as_of, "o_orderdate").alias("age"))


@query("h30_round_abs", "SELECT c_custkey, abs(c_acctbal) AS a, CAST(round(c_acctbal) AS BIGINT) AS r FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("a"), F.round("c_acctbal").cast("bigint").alias("r"))


@query("h31_casts", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS txt, TRY_CAST(c_mktsegment AS INTEGER) AS bad, CAST(c_acctbal AS DECIMAL(18,1))::DOUBLE AS dec FROM customer")
def _(t):
    return t.customer.select(
        "c_custkey", F.col("c_custkey").cast("string").alias("txt"), F.col("c_mktsegment").try_cast("int").alias("bad"),
        F.col("c_acctbal").cast("decimal(18,1)").cast("double").alias("dec"),
    )


@query("h32_div0", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity / l_discount END AS r FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", arith.div0("l_quantity", "l_discount").alias("r"))


@query("h33_array_build", """
SELECT p_partkey, array_to_string(list_sort(list_distinct([p_type, p_brand] || [p_type, p_name])), ',') AS words FROM part""")
def _(t):
    both = F.array_distinct(F.concat(F.array("p_type", "p_brand"), F.array("p_type", "p_name")))
    return t.part.select("p_partkey", F.array_join(F.array_sort(both), ",").alias("words"))


@query("h34_array_access", "SELECT page_id, list_contains(string_split(url, '/'), 'en') AS english, string_split(url, '/')[3] AS host, list_sort(string_split(url, '/'))[1] AS low FROM pages")
def _(t):
    parts = F.split("url", "/")
    return t.pages.select(
        "page_id", F.array_contains(parts, "en").alias("english"), F.get(parts, F.lit(2)).alias("host"), F.get(F.array_sort(parts), F.lit(0)).alias("low")
    )


@query("h35_array_to_string", "SELECT page_id, array_to_string(string_split(url, '/'), ' ') AS words FROM pages")
def _(t):
    return t.pages.select("page_id", F.array_join(F.split("url", "/"), " ").alias("words"))


@query("h36_json", """
WITH j AS (SELECT event_id, '{"plan":{"price-id":' || (props ->> '$.k') || ',"name":"' || event_type || '"},"tags":["a","' || user_id || '"]}' AS doc FROM events)
SELECT event_id, CAST(doc -> '$.plan."price-id"' AS INTEGER) AS price, doc ->> '$.plan.name' AS name, doc ->> '$.tags[1]' AS tag, doc ->> '$.nothing' AS missing FROM j""")
def _(t):
    doc = F.concat(
        F.lit('{"plan":{"price-id":'), F.get_json_object("props", "$.k"), F.lit(',"name":"'), "event_type",
        F.lit('"},"tags":["a","'), "user_id", F.lit('"]}'),
    )
    return t.events.withColumn("doc", doc).select(
        "event_id", payload.variant_field("doc", "$.plan['price-id']", "int").alias("price"), payload.variant_field("doc", "$.plan.name", "string").alias("name"),
        payload.json_field("doc", "$.tags[1]").alias("tag"), payload.variant_field("doc", "$.nothing", "string").alias("missing"),
    )


@query("h37_parse_ip", LOG + """
SELECT page_id, CASE WHEN status = 404 THEN NULL ELSE split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536 + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT END AS number,
  (split_part(ip, '.', 1)::BIGINT * 65536 + split_part(ip, '.', 2)::BIGINT * 256 + split_part(ip, '.', 3)::BIGINT // 16 * 16) * 256 AS net_start,
  (split_part(ip, '.', 1)::BIGINT * 65536 + split_part(ip, '.', 2)::BIGINT * 256 + split_part(ip, '.', 3)::BIGINT // 16 * 16 + 16) * 256 - 1 AS net_end FROM access_log""")
def _(t):
    low, high = text.cidr_bounds(F.concat("ip", F.lit("/20")))
    bad = F.when(F.col("status") == 404, F.concat("ip", F.lit(".x"))).otherwise(F.col("ip"))
    return s.access_log(t).select("page_id", text.ipv4_number(bad).alias("number"), low.alias("net_start"), high.alias("net_end"))


@query("h38_md5", "SELECT doc_id, md5(text) AS h FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5("text").alias("h"))


@query("h39_surrogate_key", """
SELECT c_custkey, md5(c_custkey || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '_dbt_utils_surrogate_key_null_')) AS key, md5(c_custkey || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) AS old_key FROM customer""")
def _(t):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey", text.surrogate_key("c_custkey", segment).alias("key"), text.surrogate_key("c_custkey", segment, old=True).alias("old_key")
    )


@query("h40_uuid5", """
WITH h AS (SELECT c_custkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_name)) AS d FROM customer)
SELECT c_custkey, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', d[17]), 1) || d[18:20] || '-' || d[21:32] AS id FROM h""")
def _(t):
    return t.customer.select("c_custkey", text.uuid5("6ba7b810-9dad-11d1-80b4-00c04fd430c8", "c_name").alias("id"))


@query("h41_safe_add", "SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), 0) + coalesce(nullif(s_nationkey, 7), 0) AS total FROM supplier")
def _(t):
    return t.supplier.select(
        "s_suppkey", arith.safe_add(F.nullif("s_nationkey", F.lit(3)), F.nullif("s_nationkey", F.lit(7))).alias("total")
    )


@query("h42_convert_bytes", "SELECT doc_id, CAST(round(n_chars * 100 / 1024.0::DOUBLE) AS BIGINT) AS kb_cents FROM documents")
def _(t):
    return t.documents.select("doc_id", (arith.convert_bytes("n_chars", "kb") * 100).cast("bigint").alias("kb_cents"))


@query("h43_deterministic_key", "SELECT c_custkey, true AS in_range FROM customer")
def _(t):
    bucket = arith.stable_bucket("c_name", 1000)
    return t.customer.select("c_custkey", (bucket.between(0, 999) & (bucket == arith.stable_bucket("c_name", 1000))).alias("in_range"))


# ---------------------------------------------------------------- user-defined and table functions


@query("i01_parse_query_string", r"""
WITH q AS (SELECT page_id, CASE WHEN url LIKE '%?%' THEN regexp_extract(url, '\?([^#]*)', 1) || '&page=9&empty=' ELSE 'page=1%202&ref=a+b' END AS qs FROM pages)
SELECT page_id, CASE WHEN qs LIKE 'page=2&%' THEN '2' WHEN qs LIKE 'page=1%' THEN '1 2' ELSE '9' END AS page, CASE WHEN qs LIKE '%ref=x%' THEN 'x' WHEN qs LIKE '%a+b' THEN 'a b' END AS ref,
  CASE WHEN qs LIKE '%empty=%' THEN '' END AS empty, CASE WHEN qs LIKE '%utm_source=feed%' THEN 'feed' END AS utm FROM q""")
def _(t):
    found = F.regexp_extract("url", r"\?([^#]*)", 1)
    qs = F.when(F.contains("url", F.lit("?")), F.concat(found, F.lit("&page=9&empty="))).otherwise("page=1%202&ref=a+b")
    m = t.pages.select("page_id", text.parse_query_string(qs).alias("m"))
    return m.select("page_id", *[F.col("m")[k].alias(n) for k, n in {"page": "page", "ref": "ref", "empty": "empty", "utm_source": "utm"}.items()])


@query("i02_query_string_field", r"SELECT page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def _(t):
    return t.pages.select("page_id", text.query_string_field("url", "ref").alias("ref"), text.query_string_field("url", "page").alias("page"))


@query("i03_enrich_user_agents", TRACKS + """
SELECT id, CASE k % 6 WHEN 0 THEN 'Electron' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'iPhone' END AS browser_family,
  CASE k % 6 WHEN 0 THEN '110' WHEN 1 THEN '119' WHEN 2 THEN '118' WHEN 3 THEN '16' END AS browser_version_major,
  CASE k % 6 WHEN 0 THEN 'Windows' WHEN 1 THEN 'Windows' WHEN 2 THEN 'Linux' WHEN 3 THEN 'Mac' WHEN 4 THEN 'iPhone' END AS os_family FROM tracks""")
def _(t):
    return agents.enrich_user_agents(s.tracks(t), "context_user_agent").select("id", "browser_family", "browser_version_major", "os_family")


@query("i04_user_agent_rules", TRACKS + """
SELECT id, CASE k % 6 WHEN 0 THEN 'Electron' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'iPhone' ELSE 'Other' END AS browser,
  CASE k % 6 WHEN 0 THEN 'Windows' WHEN 1 THEN 'Windows' WHEN 2 THEN 'Linux' WHEN 3 THEN 'Mac' WHEN 4 THEN 'iPhone' ELSE 'Other' END AS os,
  CASE k % 6 WHEN 0 THEN '5.3.1' WHEN 1 THEN '119.0.0.0' WHEN 2 THEN '118.0' WHEN 3 THEN '16.1' ELSE 'Other' END AS version,
  CASE k % 6 WHEN 0 THEN 'NT 10.0' WHEN 1 THEN 'NT 6.1' WHEN 2 THEN 'x86_64; rv:109.0' WHEN 3 THEN '10_15_7' WHEN 4 THEN '16_2' ELSE 'Unknown' END AS os_version FROM tracks""")
def _(t):
    ua = "context_user_agent"
    return s.tracks(t).select(
        "id", agents.browser(ua).alias("browser"), agents.operating_system(ua).alias("os"), agents.browser_version(ua).alias("version"),
        agents.os_version(ua).alias("os_version"),
    )


@query("i05_decode_payload", "SELECT o_orderkey, o_custkey::VARCHAR AS customer, o_totalprice AS price FROM orders")
def _(t):
    body = F.to_json(F.struct(F.col("o_custkey").alias("customer"), F.struct(F.col("o_totalprice").alias("price")).alias("terms")))
    signed = F.concat(body.cast("binary"), F.unhex(F.concat(F.lit("00FF7D"), F.left(F.md5(F.col("o_orderkey").cast("string")), F.lit(16)))))
    coded = t.orders.select("o_orderkey", F.base64(signed).alias("payload"))
    doc = payload.decode_payload_json("payload")
    return coded.withColumn("doc", doc).select(
        "o_orderkey", payload.json_field("doc", "$.customer").alias("customer"), payload.json_field("doc", "$.terms.price", "double").alias("price")
    )


MAILS = """m AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'a.b@firm.com' WHEN 1 THEN 'a b@firm.com' WHEN 2 THEN 'a@b@firm.com' WHEN 3 THEN 'user' || c_custkey || '@corp.ru' ELSE 'x@spam.net' END AS email FROM customer)"""


def _mails(t):
    pick = F.col("c_nationkey") % 5
    email = (
        F.when(pick == 0, "a.b@firm.com").when(pick == 1, "a b@firm.com").when(pick == 2, "a@b@firm.com")
        .when(pick == 3, F.concat(F.lit("user"), "c_custkey", F.lit("@corp.ru"))).otherwise("x@spam.net")
    )
    return t.customer.select("c_custkey", email.alias("email"))


@query("i06_validate_email", f"WITH {MAILS} SELECT c_custkey, email LIKE '%_@__%.__%' AND email NOT LIKE '% %' AND email NOT LIKE '%@%@%' AS valid FROM m")
def _(t):
    return _mails(t).select("c_custkey", text.valid_email("email").alias("valid"))


@query("i07_blocked_email", f"WITH {MAILS} SELECT c_custkey, email LIKE '%.ru' OR split_part(email, '@', 2) IN ('spam.net') AS blocked FROM m")
def _(t):
    return _mails(t).select("c_custkey", text.is_blocked_email("email", [".ru", ".by"], ["spam.net"]).alias("blocked"))


@query("i08_email_regex", f"WITH {MAILS} SELECT c_custkey, regexp_full_match(upper(email), '[A-Z0-9.]+@[A-Z0-9.-]+[.][A-Z]{{2,4}}') AS valid FROM m")
def _(t):
    return _mails(t).select("c_custkey", text.email_matches_pattern("email").alias("valid"))


@query("i09_fiscal_calendar_functions", """
WITH d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)
SELECT d, CASE WHEN month(d) < 2 THEN year(d) ELSE year(d) + 1 END::BIGINT AS fy, CASE WHEN month(d) < 2 THEN 4 WHEN month(d) < 5 THEN 1 WHEN month(d) < 8 THEN 2 WHEN month(d) < 11 THEN 3 ELSE 4 END::BIGINT AS fq,
  make_date(CASE WHEN month(d) < 2 THEN year(d) - 1 ELSE year(d) END, 2, 1) AS fy_start, make_date(CASE WHEN month(d) < 2 THEN year(d) ELSE year(d) + 1 END, 1, 31) AS fy_end,
  (date_trunc('quarter', d - INTERVAL 1 MONTH) + INTERVAL 1 MONTH)::DATE AS fq_start, last_day((date_trunc('quarter', d - INTERVAL 1 MONTH) + INTERVAL 3 MONTH)::DATE) AS fq_end FROM d""")
def _(t):
    d = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(
        "d", dates.fiscal_year("d").cast("bigint").alias("fy"), dates.fiscal_quarter("d").cast("bigint").alias("fq"),
        dates.fiscal_year_start("d").alias("fy_start"), dates.fiscal_year_end("d").alias("fy_end"),
        dates.fiscal_quarter_start("d").alias("fq_start"), dates.fiscal_quarter_end("d").alias("fq_end"),
    )


@query("i10_named_constant", "SELECT c_custkey, c_acctbal > (SELECT max(s_acctbal) FROM supplier WHERE s_nationkey = 4) AS above FROM customer")
def _(t):
    constants = t.supplier.where(F.col("s_nationkey") == 4).agg(F.max("s_acctbal").alias("limit"))
    limit = constants.first()["limit"]
    return t.customer.select("c_custkey", (F.col("c_acctbal") > F.lit(limit)).alias("above"))


@query("i11_flatten_array", "SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", F.explode("embedding").alias("v")).withColumn("v", F.col("v").cast("double"))


@query("i12_split_to_rows", r"""
SELECT page_id, split_part(pair, '=', 1) AS key, split_part(pair, '=', 2) AS value FROM (SELECT page_id, unnest(string_split(regexp_extract(url, '\?([^#]*)', 1), '&')) AS pair FROM pages WHERE url LIKE '%?%')""")
def _(t):
    qs = F.regexp_extract("url", r"\?([^#]*)", 1)
    pairs = t.pages.where(F.contains("url", F.lit("?"))).select("page_id", F.explode(F.split(qs, "&")).alias("pair"))
    return pairs.select("page_id", F.split_part("pair", F.lit("="), F.lit(1)).alias("key"), F.split_part("pair", F.lit("="), F.lit(2)).alias("value"))


# Seat-count patterns, the first that matches gives the number.
SEAT_PATTERNS = [
    r"(?i)(\d+,\d+)\s+Total",
    r"(?i)(\d+)\s+Total",
    r"(?i)(\d+,\d+)\s+Seats Total",
    r"(?i)(\d+)\s+Seats Total",
    r"(?i)Total\s+(\d+,\d+)",
    r"(?i)Total\s+(\d+)",
    r"(?i)(\d+,\d+)\s+Seat",
    r"(?i)(\d+)\s+Seat",
    r"(?i)(\d+) - Seat",
    r"(?i)(\d+)_seat",
    r"(?i)qty:(\d+)",
    r"(?i)(\d+)\s+Users",
    r"(?i)(\d+)-Users",
    r"(?i)E10/(\d+)",
    r"(?i)E10-(\d+)",
]


@query("i13_seats_from_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'N' THEN 1000 + l_quantity::INTEGER ELSE l_quantity::INTEGER END AS seats FROM lineitem""")
def _(t):
    q = F.col("l_quantity").cast("int")
    name = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.concat(F.lit("Renewal of "), q))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("Plan qty:"), q))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("Deal 1,0"), F.lpad(q.cast("string"), 2, "0"), F.lit(" seats total")))
        .otherwise(F.concat(F.lit("E10-"), q, F.lit(" x")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.seats_from_text(name, SEAT_PATTERNS).alias("seats"))


@query("i14_version_split", """
WITH v AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'dev' ELSE (user_id % 9) || '.' || (props ->> '$.k') || CASE WHEN event_type = 'view' THEN '' ELSE '.' || (event_id % 5) END END AS v FROM events)
SELECT event_id, TRY_CAST(nullif(split_part(v, '.', 1), '') AS INTEGER) AS major, TRY_CAST(nullif(split_part(v, '.', 2), '') AS INTEGER) AS minor, TRY_CAST(nullif(split_part(v, '.', 3), '') AS INTEGER) AS patch FROM v""")
def _(t):
    long = F.concat(F.col("user_id") % 9, F.lit("."), F.get_json_object("props", "$.k"))
    v = F.when(F.col("event_type") == "error", "dev").when(F.col("event_type") == "view", long).otherwise(
        F.concat(long, F.lit("."), F.col("event_id") % 5)
    )
    return t.events.withColumn("v", v).select(
        "event_id", *[text.version_part("v", n).alias(p) for n, p in ((1, "major"), (2, "minor"), (3, "patch"))]
    )


@query("i15_database_version", """
SELECT event_id, CASE event_type WHEN 'click' THEN '12.' || (user_id % 9) WHEN 'view' THEN '8.0' WHEN 'signup' THEN (user_id % 4) || '.0' WHEN 'error' THEN '14.0' END AS semver FROM events""")
def _(t):
    u = F.col("user_id")
    v = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("12."), u % 9, F.lit(".3-pg")))
        .when(F.col("event_type") == "view", "8.0").when(F.col("event_type") == "signup", F.concat(u % 4, F.lit("beta2")))
        .when(F.col("event_type") == "error", "14devel").otherwise("unknown")
    )
    return t.events.withColumn("v", v).select("event_id", text.database_semver("v").alias("semver"))


@query("i16_clean_host", r"SELECT page_id, regexp_extract(url, '^https?://(?:www\.)?([^/?#]*)', 1) AS host FROM pages")
def _(t):
    return t.pages.select("page_id", text.clean_host("url").alias("host"))


@query("i17_form_field", "SELECT c_custkey, 'user' || c_custkey || '@firm.com' AS email, NULL::VARCHAR AS phone FROM customer")
def _(t):
    mail = F.concat(F.lit("user"), "c_custkey", F.lit("@firm.com"))
    form = F.concat(F.lit('a:2:{s:5:"Email";s:'), F.length(mail), F.lit(':"'), mail, F.lit('";s:4:"Name";s:1:"x";}'))
    return t.customer.withColumn("form", form).select(
        "c_custkey", payload.php_field("form", "Email").alias("email"), payload.php_field("form", "Phone").alias("phone")
    )


@query("i18_event_client", TRACKS + """
SELECT id, CASE WHEN event IN ('click', 'view') AND k % 6 = 0 THEN 'Desktop' WHEN event = 'signup' THEN 'Customer Portal' WHEN event = 'purchase' THEN 'Mobile' ELSE 'WebApp' END AS client FROM tracks""")
def _(t):
    source = rules.first_match(
        [(F.col("event").isin("click", "view"), "webapp_events"), (F.col("event") == "signup", "portal_events"), (F.col("event") == "purchase", "mobile_events")],
        "other",
    )
    return s.tracks(t).withColumn("source", source).select("id", agents.event_client("source", "context_user_agent").alias("client"))
