"""Projections, predicates, joins, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import arith, rules, text
from ..operators import joins, windows
from . import standins as s
from .registry import query

TRACKS = s.with_("tracks")
DEALS = s.with_("deals", "lines")

# ---------------------------------------------------------------- projections and predicates


@query("b01_rename_cast", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS closed_on, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders""")
def _(t):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").cast("date").alias("closed_on"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


@query("b02_star_except", "SELECT * EXCLUDE (p_name, p_size) FROM part")
def _(t):
    return t.part.drop("p_name", "p_size")


@query("b03_case_bucket", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS band FROM customer""")
def _(t):
    return t.customer.select(
        "c_custkey", arith.band("c_acctbal", [(0, "debt"), (1000, "low"), (5000, "mid")], "high").alias("band")
    )


RULES = [("click", None, "navigation"), ("purchase", 7, "lucky sale"), ("purchase", None, "sale"), ("view", 3, "preview")]


@query("b04_rule_table_case", TRACKS + """
SELECT id, CASE WHEN event = 'click' THEN 'navigation' WHEN event = 'purchase' AND k = 7 THEN 'lucky sale' WHEN event = 'purchase' THEN 'sale'
  WHEN event = 'view' AND k = 3 THEN 'preview' ELSE 'unknown' END AS feature FROM tracks""")
def _(t):
    tests = [(rules.equals_all({"event": e, "k": k}), f) for e, k, f in RULES]
    return s.tracks(t).select("id", rules.first_match(tests, "unknown").alias("feature"))


@query("b05_blank_to_null", """
SELECT p_partkey, CASE WHEN trim(replace(p_name, 'red widget', '  ')) IN ('', 'small ring') THEN NULL ELSE trim(replace(p_name, 'red widget', '  ')) END AS name FROM part""")
def _(t):
    return t.part.select(
        "p_partkey",
        text.blank_to_null(F.replace("p_name", F.lit("red widget"), F.lit("  ")), "small ring").alias("name"),
    )


@query("b06_like_any", """
SELECT page_id, url LIKE '%.org/%' OR url LIKE '%.net/%' AS other_domain, url ILIKE '%SPAM%' OR url ILIKE 'https://M.%' AS flagged FROM pages""")
def _(t):
    return t.pages.select(
        "page_id",
        F.expr("url LIKE ANY ('%.org/%', '%.net/%')").alias("other_domain"),
        F.expr("url ILIKE ANY ('%SPAM%', 'https://M.%')").alias("flagged"),
    )


@query("b07_in_list", "SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderstatus IN ('F', 'P')")
def _(t):
    return t.orders.where(
        ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & F.col("o_orderstatus").isin("F", "P")
    ).select("o_orderkey")


@query("b08_regex_full_match", """
SELECT page_id, url FROM pages WHERE regexp_full_match(url, 'https?://(m|www)\\.[a-z-]+\\.example\\.(com|org)/[a-z]{2}/[0-9]+')""")
def _(t):
    return t.pages.where(
        text.full_match("url", r"https?://(m|www)\.[a-z-]+\.example\.(com|org)/[a-z]{2}/[0-9]+")
    ).select("page_id", "url")


@query("b09_future_guard", TRACKS + "SELECT id FROM tracks WHERE received_at <= TIMESTAMP '2024-01-30 12:00:00'")
def _(t):
    return s.tracks(t).where(F.col("received_at") <= s.ts("2024-01-30 12:00:00")).select("id")


@query("b10_soft_delete", """
WITH c AS (SELECT *, c_acctbal < 0 AS is_deleted FROM customer) SELECT c_custkey, c_name FROM c WHERE NOT is_deleted""")
def _(t):
    flagged = t.customer.withColumn("is_deleted", F.col("c_acctbal") < 0)
    return flagged.where(~F.col("is_deleted")).select("c_custkey", "c_name")


@query("b11_presence_flags", """
SELECT c_custkey, o_custkey IS NOT NULL AS has_orders FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey""")
def _(t):
    won = t.orders.where(F.col("o_orderstatus") == "F").select("o_custkey").distinct()
    return t.customer.join(won, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.col("o_custkey").isNotNull().alias("has_orders")
    )


@query("b12_tuple_distinct", """
WITH x AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS a, CASE WHEN c_acctbal > 0 THEN nullif(c_mktsegment, 'BUILDING') END AS b,
  c_nationkey AS m, c_nationkey % 5 AS n FROM customer)
SELECT c_custkey FROM x WHERE a IS DISTINCT FROM b OR m IS DISTINCT FROM n""")
def _(t):
    a = F.nullif("c_mktsegment", F.lit("BUILDING"))
    x = t.customer.select(
        "c_custkey", a.alias("a"), F.when(F.col("c_acctbal") > 0, a).alias("b"),
        F.col("c_nationkey").alias("m"), (F.col("c_nationkey") % 5).alias("n"),
    )
    return x.where(~F.struct("a", "m").eqNullSafe(F.struct("b", "n"))).select("c_custkey")


@query("b13_alias_reuse", """
SELECT c_custkey, floor(c_acctbal / 100) AS hundreds, floor(c_acctbal / 100) % 7 AS rest FROM customer WHERE floor(c_acctbal / 100) % 7 > 2""")
def _(t):
    return (
        t.customer.withColumn("hundreds", F.floor(F.col("c_acctbal") / 100).cast("double"))
        .withColumn("rest", F.col("hundreds") % 7)
        .where(F.col("rest") > 2)
        .select("c_custkey", "hundreds", "rest")
    )


@query("b14_generated_columns", TRACKS + """
SELECT server_id, count(*) FILTER (event = 'click') AS count_click, count(*) FILTER (event = 'error') AS count_error,
 count(*) FILTER (event = 'purchase') AS count_purchase, count(*) FILTER (event = 'signup') AS count_signup, count(*) FILTER (event = 'view') AS count_view
FROM tracks GROUP BY server_id""")
def _(t):
    names = ["click", "error", "purchase", "signup", "view"]
    return s.tracks(t).groupBy("server_id").agg(
        *[F.count_if(F.col("event") == n).alias(f"count_{text.slug(n)}") for n in names]
    )


@query("b16_between", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'")
def _(t):
    return t.lineitem.where(
        F.col("l_quantity").between(10, 20)
        & F.col("l_shipdate").between(s.ts("1997-01-01 00:00:00"), s.ts("1997-12-31 00:00:00"))
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("b17_spam_exclusion", "SELECT page_id, url FROM pages WHERE url NOT LIKE '%spam%' AND url NOT LIKE '%cheap%' AND url NOT LIKE '%pills%' AND url NOT LIKE '%utm_source%'")
def _(t):
    spam = [F.col("url").like(f"%{w}%") for w in ("spam", "cheap", "pills", "utm_source")]
    return t.pages.where(~reduce(lambda a, b: a | b, spam)).select("page_id", "url")


@query("b18_malformed_rows", """
WITH r AS (SELECT page_id, CASE WHEN url LIKE '%?%' THEN 'GET ' || url ELSE 'GET ' || url || ' HTTP/1.1' END AS request FROM pages)
SELECT page_id, string_split(request, ' ')[2] AS url FROM r WHERE len(string_split(request, ' ')) = 3""")
def _(t):
    get = F.concat(F.lit("GET "), "url")
    r = t.pages.select(
        "page_id", F.when(F.contains("url", F.lit("?")), get).otherwise(F.concat(get, F.lit(" HTTP/1.1"))).alias("request")
    )
    return r.where(F.size(F.split("request", " ")) == 3).select("page_id", F.split_part("request", F.lit(" "), F.lit(2)).alias("url"))


@query("b19_source_tag", "SELECT s_name AS name, 'supplier' AS source FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer")
def _(t):
    return t.supplier.select(F.col("s_name").alias("name"), F.lit("supplier").alias("source")).unionAll(
        t.customer.select("c_name", F.lit("customer"))
    )


# ---------------------------------------------------------------- joins


@query("c01_inner_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


WON = "won AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000 GROUP BY 1)"


def _won(t) -> DataFrame:
    return t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)).groupBy("o_custkey").agg(
        F.count("*").alias("n")
    )


@query("c02_left_join", f"WITH {WON} SELECT c_custkey, n FROM customer LEFT JOIN won ON o_custkey = c_custkey")
def _(t):
    return t.customer.join(_won(t), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n")


@query("c03_right_join", f"WITH {WON} SELECT c_custkey, n FROM won RIGHT JOIN customer ON o_custkey = c_custkey")
def _(t):
    return _won(t).join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "right").select("c_custkey", "n")


@query("c04_full_join", """
WITH a AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal < 2000 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM a FULL JOIN b ON a.k = b.k""")
def _(t):
    a = t.customer.where(F.col("c_acctbal") > 9000).groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = t.supplier.where(F.col("s_acctbal") < 2000).groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full").select(
        "k", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers")
    )


@query("c05_full_join_chain", """
WITH f AS (SELECT o_custkey AS k, count(*) AS f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), o AS (SELECT o_custkey AS k, count(*) AS o FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
p AS (SELECT o_custkey AS k, count(*) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), d AS (SELECT c_custkey AS k, count(*) AS d FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT k, f, o, p, d FROM f FULL JOIN o USING (k) FULL JOIN p USING (k) FULL JOIN d USING (k)""")
def _(t):
    frames = [
        t.orders.where(F.col("o_orderstatus") == x.upper()).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(x))
        for x in "fop"
    ]
    debt = t.customer.where(F.col("c_acctbal") < 0).groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("d"))
    return joins.full_outer_chain([*frames, debt], ["k"])


@query("c06_composite_key", """
SELECT a.server_id, a.day, a.n AS clicks, b.n AS errors FROM (SELECT user_id % 20 AS server_id, ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY ALL) a
JOIN (SELECT user_id % 20 AS server_id, ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL) b ON a.server_id = b.server_id AND a.day = b.day""")
def _(t):
    daily = lambda e, n: t.events.where(F.col("event_type") == e).groupBy(
        (F.col("user_id") % 20).alias("server_id"), F.to_date("ts").alias("day")
    ).agg(F.count("*").alias(n))
    return daily("click", "clicks").join(daily("error", "errors"), ["server_id", "day"])


@query("c07_exists", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def _(t):
    big = t.orders.where(F.col("o_totalprice") > 450000)
    return t.customer.join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("c08_not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def _(t):
    big = t.orders.where(F.col("o_totalprice") > 450000)
    return t.customer.join(big, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("c09_in_subquery", "SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_discount >= 0.1 AND l_quantity = 50)")
def _(t):
    hot = t.lineitem.where((F.col("l_discount") >= 0.1) & (F.col("l_quantity") == 50)).select(F.col("l_suppkey").alias("s_suppkey"))
    return t.supplier.join(hot, "s_suppkey", "left_semi").select("s_suppkey")


@query("c10_not_in_subquery", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT nullif(l_partkey, 0) FROM lineitem WHERE l_quantity > 45 AND nullif(l_partkey, 0) IS NOT NULL)""")
def _(t):
    sold = t.lineitem.where(F.col("l_quantity") > 45).select(F.nullif("l_partkey", F.lit(0)).alias("p_partkey")).dropna()
    return t.part.join(sold, "p_partkey", "left_anti").select("p_partkey")


@query("c11_left_is_null", "SELECT p_partkey FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_discount = 0) ON l_partkey = p_partkey WHERE l_partkey IS NULL")
def _(t):
    full_price = t.lineitem.where(F.col("l_discount") == 0)
    return t.part.join(full_price, F.col("l_partkey") == F.col("p_partkey"), "left_anti").select("p_partkey")


@query("c12_cross_join", "SELECT n_name, m.priority FROM nation CROSS JOIN (SELECT DISTINCT o_orderpriority AS priority FROM orders) m")
def _(t):
    priorities = t.orders.select(F.col("o_orderpriority").alias("priority")).distinct()
    return joins.product(t.nation.select("n_name"), priorities)


@query("c13_open_spine", TRACKS + """
, first AS (SELECT user_id, CAST(min("timestamp") AS DATE) AS d FROM tracks GROUP BY 1)
SELECT user_id, CAST(g AS DATE) AS activity_date FROM (SELECT user_id, unnest(generate_series(d::TIMESTAMP, TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS g FROM first)""")
def _(t):
    first = s.tracks(t).groupBy("user_id").agg(F.to_date(F.min("timestamp")).alias("d"))
    return joins.dense_days(first, "d", s.day(s.AS_OF)).select("user_id", "activity_date")


@query("c14_closed_spine", TRACKS + """
, span AS (SELECT user_id, event, min("timestamp")::DATE AS a, max("timestamp")::DATE AS b FROM tracks GROUP BY ALL)
SELECT user_id, event, CAST(g AS DATE) AS activity_date FROM (SELECT *, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS g FROM span)""")
def _(t):
    span = s.tracks(t).groupBy("user_id", "event").agg(
        F.to_date(F.min("timestamp")).alias("a"), F.to_date(F.max("timestamp")).alias("b")
    )
    return joins.dense_days(span, "a", "b").select("user_id", "event", "activity_date")


RELEASES = """rel AS (SELECT row_number() OVER (ORDER BY g) AS version, g::DATE AS starts, (g + INTERVAL 1 MONTH - INTERVAL 1 DAY)::DATE AS ends
 FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders)::TIMESTAMP, (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)) AS g))"""


def _monthly_releases(t) -> DataFrame:
    months = t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).select(
        F.posexplode(F.expr("sequence(a, b, interval 1 month)")).alias("pos", "starts")
    )
    return months.select((F.col("pos") + 1).cast("bigint").alias("version"), "starts", F.last_day("starts").alias("ends"))


@query("c15_interval_containment", f"WITH {RELEASES} SELECT o_orderkey, version FROM orders JOIN rel ON o_orderdate BETWEEN starts AND ends")
def _(t):
    return joins.contain_join(t.orders, _monthly_releases(t), "o_orderdate", "starts", "ends").select("o_orderkey", "version")


@query("c16_second_window", f"""
WITH {RELEASES} SELECT o_orderkey, r.version, n.version AS week_after_version FROM orders
JOIN rel r ON o_orderdate BETWEEN r.starts AND r.ends LEFT JOIN rel n ON o_orderdate BETWEEN n.ends + 1 AND n.ends + 7""")
def _(t):
    rel = _monthly_releases(t)
    after = rel.select(
        F.col("version").alias("week_after_version"), F.date_add("ends", 1).alias("from_day"), F.date_add("ends", 7).alias("to_day")
    )
    inside = joins.contain_join(t.orders, rel, "o_orderdate", "starts", "ends")
    both = joins.contain_join(inside, after, "o_orderdate", "from_day", "to_day", "left")
    return both.select("o_orderkey", "version", "week_after_version")


ADDRESSES = s.with_("access_log") + """
, num AS (SELECT page_id, ip, split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536 + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT AS n FROM access_log),
nets AS (SELECT '10.' || x || '.' || y * 64 || '.0/18' AS network, (10 * 16777216 + x * 65536 + y * 64 * 256)::BIGINT AS lo,
   (10 * 16777216 + x * 65536 + y * 64 * 256 + 16383)::BIGINT AS hi, n_name AS country
   FROM (SELECT n_name, n_nationkey // 4 AS x, n_nationkey % 4 AS y FROM nation))
"""


def _networks(t) -> DataFrame:
    key = F.col("n_nationkey")
    nets = t.nation.select(
        F.concat(F.lit("10."), F.floor(key / 4), F.lit("."), key % 4 * 64, F.lit(".0/18")).alias("network"),
        F.col("n_name").alias("country"),
    )
    low, high = text.cidr_bounds("network")
    return nets.withColumns({"range_start": low, "range_end": high})


@query("c17_ip_range_join", ADDRESSES + "SELECT page_id, ip, country FROM num LEFT JOIN nets ON n BETWEEN lo AND hi")
def _(t):
    hits = s.access_log(t).withColumn("ip_number", text.ipv4_number("ip"))
    return joins.range_bucket_join(hits, _networks(t), "ip_number", "range_start", "range_end", 1 << 16).select(
        "page_id", "ip", "country"
    )


@query("c18_rate_in_force", """
WITH r AS (SELECT o_orderpriority AS product, o_orderdate::DATE AS starts, max(o_totalprice) AS rate FROM orders WHERE o_orderdate = date_trunc('month', o_orderdate) GROUP BY ALL),
i AS (SELECT *, coalesce(lead(starts) OVER (PARTITION BY product ORDER BY starts) - 1, DATE '2001-12-31')::DATE AS ends FROM r)
SELECT o_orderkey, rate FROM orders LEFT JOIN i ON product = o_orderpriority AND o_orderdate::DATE BETWEEN starts AND ends""")
def _(t):
    first_days = t.orders.where(F.dayofmonth("o_orderdate") == 1)
    rates = first_days.groupBy(F.col("o_orderpriority").alias("product"), F.to_date("o_orderdate").alias("starts")).agg(
        F.max("o_totalprice").alias("rate")
    )
    spans = joins.as_of_intervals(rates, ["product"], "starts", "ends", "2001-12-31")
    usage = t.orders.withColumnRenamed("o_orderpriority", "product")
    return joins.contain_join(usage, spans, "o_orderdate", "starts", "ends", "left", ["product"]).select("o_orderkey", "rate")


@query("c19_last_touch", TRACKS + """
SELECT p.id, v.id AS touch_id, v."timestamp" AS touched_at FROM tracks p LEFT JOIN tracks v
  ON v.user_id = p.user_id AND v.event = 'view' AND v."timestamp" < p."timestamp"
WHERE p.event = 'purchase' QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY v."timestamp" DESC NULLS LAST, v.id DESC) = 1""")
def _(t):
    rows = s.tracks(t)
    fills = rows.where(F.col("event") == "purchase").select("id", "user_id", "timestamp")
    views = rows.where(F.col("event") == "view").select("user_id", F.col("timestamp").alias("touched_at"), F.col("id").alias("touch_id"))
    return joins.last_before(fills, views, ["user_id"], "timestamp", "touched_at", ["touch_id"], tie="id").select(
        "id", "touch_id", "touched_at"
    )


@query("c20_follow_up_window", TRACKS + """
, first AS (SELECT user_id, min("timestamp") AS t0 FROM tracks GROUP BY 1)
SELECT f.user_id, count(t.id) AS follow_ups FROM first f LEFT JOIN tracks t ON t.user_id = f.user_id
 AND t."timestamp" >= t0 + INTERVAL 168 HOUR AND t."timestamp" < t0 + INTERVAL 192 HOUR GROUP BY 1""")
def _(t):
    rows = s.tracks(t)
    first = rows.groupBy("user_id").agg(F.min("timestamp").alias("t0"))
    inside = (F.col("timestamp") >= F.col("t0") + F.expr("interval 168 hours")) & (
        F.col("timestamp") < F.col("t0") + F.expr("interval 192 hours")
    )
    return rows.join(first, "user_id").groupBy("user_id").agg(F.count_if(inside).alias("follow_ups"))


@query("c21_previous_day", TRACKS + """
, d AS (SELECT server_id, "timestamp"::DATE AS day, count(*) AS n FROM tracks GROUP BY ALL)
SELECT a.server_id, a.day, a.n, b.n AS n_before, a.n - coalesce(b.n, 0) AS delta FROM d a LEFT JOIN d b ON a.server_id = b.server_id AND b.day = a.day - 1""")
def _(t):
    daily = s.tracks(t).groupBy("server_id", F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))
    w = windows.window(["server_id"], "day")
    before = F.when(F.lag("day").over(w) == F.date_sub("day", 1), F.lag("n").over(w))
    return daily.withColumn("n_before", before).withColumn("delta", F.col("n") - F.coalesce("n_before", F.lit(0)))


@query("c22_max_timestamp", TRACKS + """
SELECT server_id, "timestamp"::DATE AS day, arg_max(id, "timestamp") AS id, max("timestamp") AS latest_at FROM tracks GROUP BY ALL""")
def _(t):
    return s.tracks(t).groupBy("server_id", F.to_date("timestamp").alias("day")).agg(
        F.max_by("id", "timestamp").alias("id"), F.max("timestamp").alias("latest_at")
    )


FEED = """WITH feed AS (SELECT o_custkey AS id, o_orderkey AS sequence, epoch(o_orderdate)::BIGINT // 86400 AS batch, o_totalprice AS v FROM orders)"""


def change_feed(t) -> DataFrame:
    """Rows of a change feed: several versions per id with a sequence and a batch number."""
    return t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("sequence"),
        F.datediff("o_orderdate", F.lit("1970-01-01")).cast("bigint").alias("batch"), F.col("o_totalprice").alias("v"),
    )


@query("c23_two_column_latest", FEED + """
SELECT f.* FROM feed f JOIN (SELECT id, max(sequence) AS s, max(batch) AS b FROM feed GROUP BY id) m ON f.id = m.id AND sequence = s AND batch = b""")
def _(t):
    feed = change_feed(t)
    both = windows.group_stats(feed, ["id"], top_sequence=F.max("sequence"), top_batch=F.max("batch"))
    return both.where((F.col("sequence") == F.col("top_sequence")) & (F.col("batch") == F.col("top_batch"))).drop(
        "top_sequence", "top_batch"
    )


ACCOUNTS = """WITH acc AS (SELECT c_custkey AS id, CASE WHEN c_acctbal < 5000 THEN c_nationkey::BIGINT END AS parent, c_name AS name, c_acctbal FROM customer)"""


def accounts(t) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 5000, F.col("c_nationkey").cast("bigint")).alias("parent"),
        F.col("c_name").alias("name"), "c_acctbal",
    )


@query("c24_parent_self_join", ACCOUNTS + """
SELECT a.id, coalesce(p.id, a.id) AS master_id, coalesce(p.name, a.name) AS master_name FROM acc a LEFT JOIN acc p ON a.parent = p.id""")
def _(t):
    a = accounts(t)
    p = a.select(F.col("id").alias("parent"), F.col("name").alias("parent_name"))
    return a.join(p, "parent", "left").select(
        "id",
        F.when(F.col("parent_name").isNotNull(), F.col("parent")).otherwise(F.col("id")).alias("master_id"),
        F.coalesce("parent_name", "name").alias("master_name"),
    )


@query("c25_children_sum", ACCOUNTS + """
SELECT a.id, CAST(coalesce(sum(CAST(c.c_acctbal AS DECIMAL(18,2))), 0) AS DOUBLE) AS children_balance, count(c.id) AS children FROM acc a LEFT JOIN acc c ON c.parent = a.id GROUP BY a.id""")
def _(t):
    a = accounts(t)
    kids = a.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(
        F.sum(arith.money("c_acctbal")).alias("total"), F.count("*").alias("kids")
    )
    return a.join(kids, "id", "left").select(
        "id", F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("children_balance"), F.coalesce("kids", F.lit(0)).alias("children")
    )


@query("c26_either_key", """
WITH o AS (SELECT o_orderkey, 'n' || o_custkey % 25 AS mail_a, 'n' || o_orderkey % 25 AS mail_b FROM orders), n AS (SELECT n_nationkey, 'n' || n_nationkey AS mail FROM nation)
SELECT o_orderkey, n_nationkey FROM o JOIN n ON mail_a = mail OR mail_b = mail""")
def _(t):
    o = t.orders.select(
        "o_orderkey", F.concat(F.lit("n"), F.col("o_custkey") % 25).alias("mail_a"), F.concat(F.lit("n"), F.col("o_orderkey") % 25).alias("mail_b")
    )
    n = t.nation.select("n_nationkey", F.concat(F.lit("n"), "n_nationkey").alias("mail"))
    return joins.either_key_join(o, n, ["mail_a", "mail_b"], "mail", "o_orderkey", "n_nationkey").select("o_orderkey", "n_nationkey")


NULLABLE = """WITH a AS (SELECT event_type AS event, nullif(CAST(props ->> '$.k' AS INTEGER) % 4, 0) AS action, count(*) AS n FROM events GROUP BY ALL),
p AS (SELECT DISTINCT event_type AS event, nullif(CAST(props ->> '$.k' AS INTEGER) % 2, 0) AS action FROM events)"""


def _nullable(t):
    k = F.get_json_object("props", "$.k").cast("int")
    a = t.events.groupBy(F.col("event_type").alias("event"), F.nullif(k % 4, F.lit(0)).alias("action")).agg(F.count("*").alias("n"))
    p = t.events.select(F.col("event_type").alias("event"), F.nullif(k % 2, F.lit(0)).alias("action")).distinct()
    return a, p


@query("c27_null_safe_key", NULLABLE + "SELECT a.* FROM a JOIN p ON a.event = p.event AND (a.action = p.action OR a.action IS NULL AND p.action IS NULL)")
def _(t):
    a, p = _nullable(t)
    return joins.null_safe_join(a, p, ["event", "action"])


@query("c28_coalesced_key", NULLABLE + "SELECT a.* FROM a JOIN p ON a.event = p.event AND coalesce(a.action, -1) = coalesce(p.action, -1)")
def _(t):
    a, p = _nullable(t)
    filled = lambda df: df.withColumn("action_key", F.coalesce("action", F.lit(-1)))
    return filled(a).join(filled(p).drop("action"), ["event", "action_key"]).drop("action_key")


@query("c29_case_insensitive_key", """
SELECT c_custkey, n_name FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'nation_' ELSE 'Nation_' END || c_nationkey AS place FROM customer) JOIN nation ON lower(place) = lower(n_name)""")
def _(t):
    spelled = F.when(F.col("c_acctbal") < 0, "nation_").otherwise("Nation_")
    c = t.customer.select("c_custkey", F.lower(F.concat(spelled, "c_nationkey")).alias("place"))
    return c.join(t.nation, F.col("place") == F.lower("n_name")).select("c_custkey", "n_name")


@query("c30_derived_key", """
SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, 'info@firm' || (c_custkey % 100) || '.com' AS email FROM customer)
JOIN (SELECT s_suppkey, 'firm' || s_suppkey || '.com' AS domain FROM supplier) ON string_split(email, '@')[2] = domain""")
def _(t):
    mails = t.customer.select("c_custkey", F.concat(F.lit("info@firm"), F.col("c_custkey") % 100, F.lit(".com")).alias("email"))
    firms = t.supplier.select("s_suppkey", F.concat(F.lit("firm"), "s_suppkey", F.lit(".com")).alias("domain"))
    return mails.withColumn("domain", text.email_domain("email")).join(firms, "domain").select("c_custkey", "s_suppkey")


@query("c31_prefix_like", """
SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND CAST(c_custkey AS VARCHAR) LIKE s_suppkey || '%'""")
def _(t):
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_custkey").cast("string").alias("code"))
    suppliers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_suppkey").cast("string").alias("prefix"))
    return joins.prefix_join(customers, suppliers, "code", "prefix", ["nation"]).select("c_custkey", "s_suppkey")


@query("c32_delimited_key", """
WITH l AS (SELECT o_orderkey, o_custkey || ',' || (o_custkey + 1) AS keys FROM orders) SELECT o_orderkey, c_custkey FROM l JOIN customer ON list_contains(string_split(keys, ','), CAST(c_custkey AS VARCHAR))""")
def _(t):
    listed = t.orders.select("o_orderkey", F.concat_ws(",", "o_custkey", F.col("o_custkey") + 1).alias("keys"))
    each = listed.select("o_orderkey", F.explode(F.split("keys", ",")).alias("key"))
    return each.join(t.customer, F.col("key").cast("bigint") == F.col("c_custkey")).select("o_orderkey", "c_custkey")


@query("c33_truncated_key", """
SELECT o_orderkey, n_name FROM (SELECT o_orderkey, 'NATION_' || (o_custkey % 10) || 'xyz' AS long_key FROM orders) JOIN nation ON left(long_key, 8) = n_name""")
def _(t):
    o = t.orders.select("o_orderkey", F.concat(F.lit("NATION_"), F.col("o_custkey") % 10, F.lit("xyz")).alias("long_key"))
    return o.join(t.nation, F.left("long_key", F.lit(8)) == F.col("n_name")).select("o_orderkey", "n_name")


@query("c34_rank_key", DEALS + """
, y AS (SELECT account_id, close_date, opportunity_id, type, is_won, CAST(year(close_date) AS INTEGER) AS yr FROM deals),
lost AS (SELECT *, row_number() OVER (PARTITION BY account_id, yr ORDER BY close_date, opportunity_id) AS n FROM y WHERE NOT is_won),
won AS (SELECT *, row_number() OVER (PARTITION BY account_id, yr ORDER BY close_date, opportunity_id) AS n FROM y WHERE is_won)
SELECT lost.opportunity_id AS expired_id, won.opportunity_id AS renewed_id FROM lost LEFT JOIN won
  ON concat_ws('-', lost.account_id, lost.yr, lost.n) = concat_ws('-', won.account_id, won.yr, won.n)""")
def _(t):
    d = s.deals(t).withColumn("yr", F.year("close_date"))
    w = windows.window(["account_id", "yr"], "close_date", "opportunity_id")

    def ranked(rows, name):
        key = F.concat_ws("-", "account_id", "yr", F.row_number().over(w))
        return rows.select(key.alias("rank_key"), F.col("opportunity_id").alias(name))

    return ranked(d.where(~F.col("is_won")), "expired_id").join(
        ranked(d.where("is_won"), "renewed_id"), "rank_key", "left"
    ).select("expired_id", "renewed_id")


@query("c35_hierarchy", """
WITH RECURSIVE e AS (SELECT 'R' || r_regionkey AS id, NULL::VARCHAR AS parent, r_name AS name FROM region UNION ALL
 SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer),
tree AS (SELECT id, name, id AS root_id, name AS root_name, name AS path, 0 AS level FROM e WHERE parent IS NULL UNION ALL
 SELECT e.id, e.name, root_id, root_name, path || ' > ' || e.name, level + 1 FROM e JOIN tree ON e.parent = tree.id)
SELECT * FROM tree""")
def _(t):
    edges = t.region.select(
        F.concat(F.lit("R"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name")
    ).unionAll(
        t.nation.select(F.concat(F.lit("N"), "n_nationkey"), F.concat(F.lit("R"), "n_regionkey"), "n_name")
    ).unionAll(t.customer.select(F.concat(F.lit("C"), "c_custkey"), F.concat(F.lit("N"), "c_nationkey"), "c_name"))
    return joins.hierarchy_paths(edges)


@query("c36_star_assembly", """
SELECT k, c.n AS customers, s.n AS suppliers, o.n AS big_orders FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9500 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal < 500
 UNION SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 499000)
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9500 GROUP BY 1) c USING (k)
LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal < 500 GROUP BY 1) s USING (k)
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 499000 GROUP BY 1) o USING (k)""")
def _(t):
    rich = t.customer.where(F.col("c_acctbal") > 9500).groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    poor = t.supplier.where(F.col("s_acctbal") < 500).groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    big = t.orders.where(F.col("o_totalprice") > 499000).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("k")
    ).agg(F.count("*").alias("big_orders"))
    return joins.presence_join([rich, poor, big], ["k"])


@query("c37_scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'O') - INTERVAL 30 DAY")
def _(t):
    top = t.orders.where(F.col("o_orderstatus") == "O").agg(F.max("o_orderdate")).first()[0]
    return t.orders.where(F.col("o_orderdate") >= F.lit(top) - F.expr("interval 30 days")).select("o_orderkey")


@query("c38_correlated_scalar", "SELECT o_orderkey, o_orderdate = (SELECT min(o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey) AS is_first_day FROM orders o")
def _(t):
    first = windows.group_stats(t.orders, ["o_custkey"], first_day=F.min("o_orderdate"))
    return first.select("o_orderkey", (F.col("o_orderdate") == F.col("first_day")).alias("is_first_day"))


@query("c39_trailing_distinct_users", """
WITH a AS (SELECT DISTINCT 's' || (user_id % 20) AS server_id, user_id, ts::DATE AS day FROM events)
SELECT server_id, CAST(g AS DATE) AS day, count(DISTINCT user_id) AS users FROM (SELECT *, unnest(generate_series(day::TIMESTAMP, day + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS g FROM a) GROUP BY ALL""")
def _(t):
    rows = t.events.select(F.concat(F.lit("s"), F.col("user_id") % 20).alias("server_id"), "user_id", F.to_date("ts").alias("day"))
    out = joins.trailing_distinct(rows, ["server_id"], "user_id", "day", 7, "users")
    return out.where(F.col("users") > 0)


@query("c40_cumulative_join", """
WITH a AS (SELECT DISTINCT event_type, user_id, ts::DATE AS day FROM events), d AS (SELECT DISTINCT event_type, day FROM a)
SELECT d.event_type, d.day, count(DISTINCT a.user_id) AS users_to_date FROM d JOIN a ON a.event_type = d.event_type AND a.day <= d.day GROUP BY ALL""")
def _(t):
    rows = t.events.select("event_type", "user_id", F.to_date("ts").alias("day"))
    steps = joins.first_seen_running(rows, ["event_type"], "user_id", "day", "users_to_date")
    days = rows.select("event_type", "day").distinct()
    filled = windows.forward_fill(days.join(steps, ["event_type", "day"], "left"), ["event_type"], "day", ["users_to_date"])
    return filled.select("event_type", "day", F.col("users_to_date_filled").alias("users_to_date"))


@query("c41_validity_intervals", """
WITH c AS (SELECT o_custkey, o_orderdate::DATE AS starts, max(o_orderpriority) AS priority FROM orders GROUP BY ALL)
SELECT o_custkey, priority, starts, coalesce(lead(starts) OVER (PARTITION BY o_custkey ORDER BY starts) - 1, DATE '2002-01-01')::DATE AS ends FROM c""")
def _(t):
    changes = t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("starts")).agg(F.max("o_orderpriority").alias("priority"))
    return joins.as_of_intervals(changes, ["o_custkey"], "starts", "ends", "2002-01-01")


@query("c42_join_key_by_row", """
SELECT o_orderkey, s_name FROM orders JOIN supplier ON CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey % 100 WHEN o_orderstatus = 'F' THEN o_orderkey % 100 ELSE o_custkey // 15 END = s_suppkey""")
def _(t):
    urgent, won = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "F"
    parts = [
        (urgent, F.col("o_custkey") % 100),
        (~urgent & won, F.col("o_orderkey") % 100),
        (~urgent & ~won, F.floor(F.col("o_custkey") / 15)),
    ]
    out = [
        t.orders.where(test).select("o_orderkey", key.cast("bigint").alias("s_suppkey")).join(t.supplier, "s_suppkey").select("o_orderkey", "s_name")
        for test, key in parts
    ]
    return reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------- sorts and top-k


@query("f01_order_by", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL ORDER BY c_mktsegment, n DESC, c_nationkey")
def _(t):
    return t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n")).orderBy(
        "c_mktsegment", F.desc("n"), "c_nationkey"
    )


@query("f02_top_one", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def _(t):
    return windows.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("f03_top_k", TRACKS + """
SELECT user_id, id, CAST(row_number() OVER w AS INTEGER) AS n FROM tracks WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id) QUALIFY row_number() OVER w <= 10""")
def _(t):
    first = windows.top_k(s.tracks(t), ["user_id"], [F.asc("timestamp"), F.asc("event_id")], 10, rank="n")
    return first.select("user_id", "id", "n")


@query("f04_nulls_last", """
WITH x AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS won FROM orders)
SELECT o_custkey, o_orderkey, won FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY won DESC NULLS LAST, o_orderdate DESC NULLS LAST, o_orderkey) = 1""")
def _(t):
    x = t.orders.withColumn("won", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))
    order = [F.col("won").desc_nulls_last(), F.col("o_orderdate").desc_nulls_last(), F.asc("o_orderkey")]
    return windows.top_k(x, ["o_custkey"], order).select("o_custkey", "o_orderkey", "won")


# ---------------------------------------------------------------- set operations


@query("g01_union_all", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k")))


@query("g02_union_distinct", "SELECT c_nationkey AS k, 'x' AS tag FROM customer UNION SELECT s_nationkey, 'x' FROM supplier")
def _(t):
    both = t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k")))
    return both.withColumn("tag", F.lit("x")).distinct()


@query("g03_key_union", """
SELECT DISTINCT id, id IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 1) AS small_sale, id IN (SELECT p_partkey FROM part WHERE p_size > 45) AS big_part
FROM (SELECT l_partkey AS id FROM lineitem WHERE l_quantity = 1 UNION SELECT p_partkey FROM part WHERE p_size > 45)""")
def _(t):
    sold = t.lineitem.where(F.col("l_quantity") == 1).select(F.col("l_partkey").alias("id")).distinct().withColumn("small_sale", F.lit(True))
    big = t.part.where(F.col("p_size") > 45).select(F.col("p_partkey").alias("id")).withColumn("big_part", F.lit(True))
    return joins.presence_join([sold, big], ["id"]).fillna(False)


@query("g04_set_difference", "SELECT DISTINCT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000")
def _(t):
    rich = t.supplier.where(F.col("s_acctbal") > 8000).select(F.col("s_nationkey").alias("k"))
    return t.customer.select(F.col("c_nationkey").alias("k")).distinct().join(rich, "k", "left_anti")


@query("g05_null_filler", """
SELECT c_custkey AS id, c_mktsegment AS segment, NULL::INTEGER AS size FROM customer UNION ALL SELECT p_partkey, NULL, p_size FROM part""")
def _(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("int").alias("size")
    ).unionByName(
        t.part.select(F.col("p_partkey").alias("id"), F.lit(None).cast("string").alias("segment"), F.col("p_size").alias("size"))
    )
