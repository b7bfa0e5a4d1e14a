"""Aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arith, dates
from ..operators import aggregate, windows
from . import standins as s
from .registry import query

TRACKS = s.with_("tracks")


@query("d01_group_by", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_qty
FROM lineitem GROUP BY ALL""")
def _(t):
    total = F.sum(arith.money("l_quantity")).cast("double")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        total.alias("sum_qty"), F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"),
        (total / F.count("*")).alias("avg_qty"),
    )


@query("d02_group_by_all", "SELECT c_mktsegment, c_nationkey % 5 AS zone, count(*) AS n FROM customer GROUP BY ALL")
def _(t):
    return t.spark.sql(
        "SELECT c_mktsegment, c_nationkey % 5 AS zone, count(*) AS n FROM {customer} GROUP BY ALL", customer=t.customer
    )


@query("d03_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


@query("d04_conditional_count_distinct", """
SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts, count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS cheap_orders FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"),
        F.countDistinct(F.when(F.col("l_discount") > 0.05, F.col("l_orderkey"))).alias("cheap_orders"),
    )


@query("d05_count_if", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS won, count(*) FILTER (o_orderstatus = 'P') AS lost FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("won"), F.count_if(F.col("o_orderstatus") == "P").alias("lost")
    )


@query("d06_conditional_sum", """
SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS won_amount FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", arith.money("o_totalprice"))).cast("double").alias("won_amount")
    )


@query("d07_bool_or", "SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_won, bool_and(o_totalprice > 10000) AS all_big FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "F").alias("any_won"), F.bool_and(F.col("o_totalprice") > 10000).alias("all_big")
    )


@query("d08_distinct_array", "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(aggregate.joined_set("o_orderpriority").alias("priorities"))


@query("d09_sorted_array", "SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_quantity::INTEGER)), '|') AS sizes FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set(F.col("l_quantity").cast("int"))), lambda x: x.cast("string")), "|").alias("sizes")
    )


@query("d10_listagg_distinct", "SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY 1")
def _(t):
    return t.spark.sql(
        "SELECT o_custkey, listagg(DISTINCT o_orderstatus, '; ') WITHIN GROUP (ORDER BY o_orderstatus) AS statuses FROM {o} GROUP BY 1",
        o=t.orders,
    )


@query("d11_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 10")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where(F.col("n") >= 10)


@query("d12_pivot_known", """
SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS f, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o,
 CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS p FROM orders GROUP BY 1""")
def _(t):
    return aggregate.pivot_known(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"])


@query("d13_pivot_from_data", """
SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS top_1_urgent, max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END) AS top_2_high,
 max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END) AS top_3_medium, max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice END) AS top_4_not_specified,
 max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS top_5_low FROM orders GROUP BY 1""")
def _(t):
    return aggregate.pivot_from_data(
        t.orders, ["o_custkey"], "o_orderpriority", prefix="top_", then=F.col("o_totalprice"), otherwise=None, agg=F.max
    )


WIDE = "SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'paid' END AS account, CASE WHEN s_nationkey < 12 THEN 'west' END AS place FROM supplier"


def _wide(t):
    return t.supplier.select(
        "s_suppkey", F.when(F.col("s_acctbal") > 0, "paid").alias("account"), F.when(F.col("s_nationkey") < 12, "west").alias("place")
    )


@query("d14_unpivot", f"SELECT * FROM (UNPIVOT ({WIDE}) ON account, place INTO NAME reason VALUE detail)")
def _(t):
    return aggregate.melt(_wide(t), ["s_suppkey"], ["account", "place"], "reason", "detail")


@query("d15_melt", f"WITH w AS ({WIDE}) SELECT s_suppkey, 'account' AS question, account AS answer FROM w UNION ALL SELECT s_suppkey, 'place', place FROM w")
def _(t):
    return aggregate.melt(_wide(t), ["s_suppkey"], ["account", "place"], "question", "answer", keep_null=True)


@query("d16_consensus_value", "SELECT l_orderkey, CASE WHEN min(l_returnflag) = max(l_returnflag) THEN max(l_returnflag) END AS flag FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(aggregate.consensus("l_returnflag").alias("flag"))


@query("d17_consensus_filter", """
SELECT l_orderkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1 AND count(DISTINCT l_linestatus) = 1""")
def _(t):
    return aggregate.agreed_groups(t.lineitem, ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@query("d18_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("d19_safe_ratio", """
WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS won, count(*) FILTER (o_orderstatus = 'P') AS lost FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN lost = 0 THEN 0 ELSE won / lost END AS div0_ratio, won / nullif(lost, 0) AS null_ratio FROM c""")
def _(t):
    c = t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("won"), F.count_if(F.col("o_orderstatus") == "P").alias("lost")
    )
    return c.select("o_custkey", arith.div0("won", "lost").alias("div0_ratio"), arith.div_null("won", "lost").alias("null_ratio"))


@query("d20_clamp", """
SELECT o_custkey, CAST(least(sum(CAST(o_totalprice AS DECIMAL(18,2))), 1000000) AS DOUBLE) AS capped, CAST(greatest(sum(CAST(o_totalprice AS DECIMAL(18,2))) - 2000000, 0) AS DOUBLE) AS above FROM orders GROUP BY 1""")
def _(t):
    total = F.sum(arith.money("o_totalprice"))
    return t.orders.groupBy("o_custkey").agg(
        arith.strict_least(total, F.lit(1000000)).cast("double").alias("capped"),
        arith.strict_greatest(total - 2000000, F.lit(0)).cast("double").alias("above"),
    )


@query("d21_array_size_test", "SELECT o_custkey, len(list(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) FILTER (o_orderstatus = 'F')) > 2 AS many FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0")
def _(t):
    won = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return t.orders.groupBy("o_custkey").agg(F.collect_set(won).alias("p")).where(F.size("p") > 0).select(
        "o_custkey", (F.size("p") > 2).alias("many")
    )


@query("d22_ranked_category_max", """
SELECT o_custkey, CASE max(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 WHEN 'P' THEN 1 END) WHEN 3 THEN 'F' WHEN 2 THEN 'O' WHEN 1 THEN 'P' END AS best FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(aggregate.ranked_label_max({"F": 3, "O": 2, "P": 1}, "o_orderstatus").alias("best"))


@query("d23_milestones", """
WITH d AS (SELECT l_suppkey, l_shipdate::DATE AS day, sum(l_quantity::BIGINT) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey ORDER BY day) AS total FROM d)
SELECT l_suppkey, min(day) FILTER (total > 100) AS passed_100, min(day) FILTER (total > 1000) AS passed_1000, min(day) FILTER (total > 10000) AS passed_10000 FROM r GROUP BY 1""")
def _(t):
    daily = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("n"))
    r = daily.withColumn("total", F.sum("n").over(windows.running(["l_suppkey"], "day")))
    return r.groupBy("l_suppkey").agg(*[F.min(F.when(F.col("total") > m, F.col("day"))).alias(f"passed_{m}") for m in (100, 1000, 10000)])


@query("d24_first_last_attribute", """
SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority FROM orders GROUP BY 1""")
def _(t):
    at = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", at).alias("first_priority"), F.max_by("o_orderpriority", at).alias("last_priority")
    )


@query("d25_stage_timestamps", """
SELECT o_custkey, max(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS qualified_at, max(o_orderdate) FILTER (o_orderpriority = '2-HIGH') AS proposed_at, max(o_orderdate) FILTER (o_orderstatus = 'F') AS won_at FROM orders GROUP BY 1""")
def _(t):
    at = lambda test, name: F.max(F.when(test, F.col("o_orderdate"))).alias(name)
    return t.orders.groupBy("o_custkey").agg(
        at(F.col("o_orderpriority") == "1-URGENT", "qualified_at"), at(F.col("o_orderpriority") == "2-HIGH", "proposed_at"),
        at(F.col("o_orderstatus") == "F", "won_at"),
    )


# ---------------------------------------------------------------- windows


@query("e01_latest_row", TRACKS + """SELECT server_id, id, event FROM tracks QUALIFY row_number() OVER (PARTITION BY server_id ORDER BY "timestamp" DESC, event_id DESC) = 1""")
def _(t):
    return windows.latest(s.tracks(t), ["server_id"], "timestamp", "event_id").select("server_id", "id", "event")


@query("e02_earliest_row", TRACKS + """SELECT user_id, id FROM tracks QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) = 1""")
def _(t):
    return windows.earliest(s.tracks(t), ["user_id"], "timestamp", "event_id").select("user_id", "id")


@query("e03_any_row", "SELECT o_custkey, count(*) > 0 AS found FROM orders GROUP BY 1")
def _(t):
    return t.orders.dropDuplicates(["o_custkey"]).select("o_custkey", F.col("o_orderkey").isNotNull().alias("found"))


@query("e04_rownum_subquery", TRACKS + """
SELECT user_id, k FROM (SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY k DESC, event_id) AS rownum FROM tracks) WHERE rownum = 1""")
def _(t):
    ranked = windows.top_k(s.tracks(t), ["user_id"], [F.desc("k"), F.asc("event_id")], 1, rank="rownum")
    return ranked.select("user_id", "k")


@query("e05_latest_flag", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_latest FROM orders")
def _(t):
    return windows.latest_flag(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "is_latest")


@query("e06_manual_precedence", """
WITH x AS (SELECT *, o_orderpriority = '1-URGENT' AS manual FROM orders)
SELECT o_custkey, o_orderkey FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY manual DESC, o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t):
    x = t.orders.withColumn("manual", F.col("o_orderpriority") == "1-URGENT")
    return windows.latest(x, ["o_custkey"], "manual", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@query("e07_dense_rank", "SELECT o_orderkey, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS INTEGER) AS transaction_no FROM orders")
def _(t):
    # Ranks are taken over one row per customer and day, then joined back to the orders.
    days = t.orders.select("o_custkey", "o_orderdate").distinct()
    ranked = days.withColumn("transaction_no", F.row_number().over(windows.window(["o_custkey"], "o_orderdate")))
    return t.orders.join(ranked, ["o_custkey", "o_orderdate"]).select("o_orderkey", "transaction_no")


@query("e08_rank_in_year", """
SELECT o_orderkey, CAST(rank() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate) AS BIGINT) AS n FROM orders""")
def _(t):
    year = F.year("o_orderdate")
    days = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("same"))
    before = F.sum("same").over(windows.window(["o_custkey", year], "o_orderdate").rowsBetween(windows.FIRST, -1))
    ranked = days.withColumn("n", F.coalesce(before, F.lit(0)) + 1).drop("same")
    return t.orders.join(ranked, ["o_custkey", "o_orderdate"]).select("o_orderkey", "n")


@query("e09_lag_lead", TRACKS + """
SELECT id, lag(event) OVER w AS previous_event, lead(event, 1, 'none') OVER w AS next_event FROM tracks WINDOW w AS (PARTITION BY server_id ORDER BY "timestamp", event_id)""")
def _(t):
    out = windows.chunked_scan(
        s.tracks(t), ["server_id"], F.to_date("timestamp"), ["timestamp", "event_id"],
        lags={"previous_event": "event"}, leads={"next_event": "event"},
    )
    return out.select("id", "previous_event", F.coalesce("next_event", F.lit("none")).alias("next_event"))


@query("e10_first_last_value", TRACKS + """
SELECT id, first_value(event) OVER w AS first_event, last_value(event) OVER w AS last_event FROM tracks
WINDOW w AS (PARTITION BY server_id ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(t):
    at = F.struct("timestamp", "event_id")
    return windows.group_stats(
        s.tracks(t), ["server_id"], first_event=F.min_by("event", at), last_event=F.max_by("event", at)
    ).select("id", "first_event", "last_event")


@query("e11_forward_fill", TRACKS + """
SELECT id, last_value(CASE WHEN event = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY server_id ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_price FROM tracks""")
def _(t):
    rows = s.tracks(t).withColumn("price", F.when(F.col("event") == "purchase", F.col("value")))
    return windows.chunked_scan(
        rows, ["server_id"], F.to_date("timestamp"), ["timestamp", "event_id"], fills={"last_price": "price"}
    ).select("id", "last_price")


DAILY = TRACKS + """, d AS (SELECT server_id, "timestamp"::DATE AS day, count(*) AS n, nullif(count(*) FILTER (k < 5), 0) AS low FROM tracks GROUP BY ALL)"""


def _daily(t):
    return s.tracks(t).groupBy("server_id", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.nullif(F.count_if(F.col("k") < 5), F.lit(0)).alias("low")
    )


@query("e12_carry_forward_limited", DAILY + """
SELECT server_id, day, first_value(low IGNORE NULLS) OVER (PARTITION BY server_id ORDER BY day DESC ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS low FROM d""")
def _(t):
    w = windows.window(["server_id"], F.desc("day")).rowsBetween(0, 2)
    return _daily(t).select("server_id", "day", F.first("low", ignorenulls=True).over(w).alias("low"))


@query("e13_first_non_null", DAILY + """
SELECT server_id, day, first_value(low IGNORE NULLS) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_low FROM d""")
def _(t):
    return _daily(t).select(
        "server_id", "day", F.first("low", ignorenulls=True).over(windows.whole(["server_id"], "day")).alias("first_low")
    )


@query("e14_rolling_max", DAILY + """
SELECT server_id, day, max(n) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS max_7, max(n) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS max_30 FROM d""")
def _(t):
    return _daily(t).select(
        "server_id", "day", *[F.max("n").over(windows.trailing(["server_id"], k, "day")).alias(f"max_{k}") for k in (7, 30)]
    )


@query("e15_rolling_sum", DAILY + """
SELECT server_id, day, CAST(sum(n) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM d""")
def _(t):
    return _daily(t).select("server_id", "day", F.sum("n").over(windows.trailing(["server_id"], 11, "day")).alias("total"))


@query("e16_prior_window", DAILY + """
SELECT server_id, day, CAST(sum(n) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS BIGINT) AS before FROM d""")
def _(t):
    w = windows.window(["server_id"], "day").rowsBetween(-7, -1)
    return _daily(t).select("server_id", "day", F.sum("n").over(w).alias("before"))


@query("e17_offset_frame", DAILY + """
SELECT server_id, day, CAST(sum(n) OVER (PARTITION BY server_id ORDER BY day ROWS BETWEEN 8 PRECEDING AND 8 PRECEDING) AS BIGINT) AS eight_ago FROM d""")
def _(t):
    return _daily(t).select("server_id", "day", F.lag("n", 8).over(windows.window(["server_id"], "day")).alias("eight_ago"))


@query("e18_running_total", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS total FROM orders""")
def _(t):
    # Rows of one customer and day share the total, so the scan runs over days.
    days = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.sum(arith.money("o_totalprice")).alias("d"))
    run = days.withColumn("total", F.sum("d").over(windows.running(["o_custkey"], "o_orderdate")).cast("double")).drop("d")
    return t.orders.join(run, ["o_custkey", "o_orderdate"]).select("o_orderkey", "total")


@query("e19_running_before", """
SELECT o_orderkey, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before FROM orders""")
def _(t):
    price = arith.money("o_totalprice")
    run = windows.chunked_scan(t.orders, ["o_custkey"], F.year("o_orderdate"), ["o_orderdate", "o_orderkey"], sums={"total": price})
    return run.select("o_orderkey", (F.col("total") - price).cast("double").alias("before"))


@query("e20_global_running_total", """
SELECT day, CAST(sum(v) OVER (ORDER BY day) AS DOUBLE) AS total FROM (SELECT o_orderdate::DATE AS day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1)""")
def _(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(arith.money("o_totalprice")).alias("v"))
    out = windows.running_total_overall(days, "day", F.col("v"), "total", F.year("day"))
    return out.select("day", F.col("total").cast("double").alias("total"))


@query("e21_partition_total", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS account_total FROM orders""")
def _(t):
    return windows.group_stats(t.orders, ["o_custkey"], account_total=F.sum(arith.money("o_totalprice")).cast("double")).select(
        "o_orderkey", "account_total"
    )


@query("e22_distinct_over_partition", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(DISTINCT l_returnflag) OVER (PARTITION BY l_suppkey) AS flags FROM lineitem")
def _(t):
    return windows.group_stats(t.lineitem, ["l_suppkey"], flags=F.countDistinct("l_returnflag")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flags"
    )


@query("e23_distinct_array_over_partition", """
SELECT o_orderkey, x.p AS priorities FROM orders JOIN (SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS p FROM orders GROUP BY 1) x USING (o_custkey)""")
def _(t):
    return windows.group_stats(t.orders, ["o_custkey"], priorities=aggregate.joined_set("o_orderpriority")).select("o_orderkey", "priorities")


@query("e24_outlier_flag", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT AS q FROM lineitem),
m AS (SELECT l_suppkey, count(*) AS n, sum(q)::DOUBLE AS sq, sum(q * q)::DOUBLE AS sqq FROM x GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(q * n - sq) * abs(q * n - sq) * (n - 1) <= (n * sqq - sq * sq) * n AS within_one_sigma FROM x JOIN m USING (l_suppkey)""")
def _(t):
    x = t.lineitem.withColumn("q", F.col("l_quantity").cast("bigint"))
    m = windows.group_stats(
        x, ["l_suppkey"], n=F.count("*"), sq=F.sum("q").cast("double"), sqq=F.sum(F.col("q") * F.col("q")).cast("double")
    )
    # |q - mean| <= stddev, squared and without divisions so that both engines agree to the last bit.
    gap = F.abs(F.col("q") * F.col("n") - F.col("sq"))
    within = gap * gap * (F.col("n") - 1) <= (F.col("n") * F.col("sqq") - F.col("sq") * F.col("sq")) * F.col("n")
    return m.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", within.alias("within_one_sigma"))


@query("e25_cumulative_conditional", DAILY + """
SELECT server_id, day, count(CASE WHEN low > 0 THEN 1 END) OVER w AS low_days, min(CASE WHEN low > 0 THEN day END) OVER w AS first_low, max(CASE WHEN low > 0 THEN day END) OVER w AS last_low
FROM d WINDOW w AS (PARTITION BY server_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(t):
    w = windows.running(["server_id"], "day")
    low_day = F.when(F.col("low") > 0, F.col("day"))
    return _daily(t).select(
        "server_id", "day", F.count(low_day).over(w).alias("low_days"), F.min(low_day).over(w).alias("first_low"), F.max(low_day).over(w).alias("last_low")
    )


@query("e26_sibling_default", """
WITH x AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS v FROM orders)
SELECT o_orderkey, coalesce(v, max(v) OVER (PARTITION BY o_custkey)) AS v FROM x""")
def _(t):
    x = t.orders.withColumn("v", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))
    return windows.group_stats(x, ["o_custkey"], sibling=F.max("v")).select("o_orderkey", F.coalesce("v", "sibling").alias("v"))


@query("e27_sequence_number", TRACKS + """
SELECT id, n FROM (SELECT id, row_number() OVER (PARTITION BY server_id ORDER BY "timestamp", event_id) AS n FROM tracks)""")
def _(t):
    return windows.chunked_scan(
        s.tracks(t), ["server_id"], F.to_date("timestamp"), ["timestamp", "event_id"], row_number="n"
    ).select("id", "n")


@query("e28_gap_seconds", TRACKS + """
SELECT id, date_diff('second', lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id), "timestamp") AS gap FROM tracks""")
def _(t):
    seen = windows.chunked_scan(
        s.tracks(t), ["user_id"], F.to_date("timestamp"), ["timestamp", "event_id"], lags={"before": "timestamp"}
    )
    return seen.select("id", dates.seconds_crossed("before", "timestamp").alias("gap"))


@query("e29_identity_fill", """
WITH x AS (SELECT o_orderkey, o_custkey, o_orderkey % 50 AS contact, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS own FROM orders),
a AS (SELECT o_custkey, max(own) AS v FROM x GROUP BY 1), b AS (SELECT contact, max(own) AS v FROM x GROUP BY 1)
SELECT o_orderkey, coalesce(own, a.v, b.v) AS identity FROM x LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (contact)""")
def _(t):
    x = t.orders.select(
        "o_orderkey", "o_custkey", (F.col("o_orderkey") % 50).alias("contact"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("own"),
    )
    by_account = windows.group_stats(x, ["o_custkey"], account_value=F.max("own"))
    both = windows.group_stats(by_account, ["contact"], x, contact_value=F.max("own"))
    return both.select("o_orderkey", F.coalesce("own", "account_value", "contact_value").alias("identity"))


@query("e30_retirement_date", """
WITH x AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS starts FROM orders)
SELECT o_custkey, starts, coalesce(lead(starts, 4) OVER w - 1, lead(starts, 3) OVER w - 1, lead(starts, 2) OVER w - 1, lead(starts, 1) OVER w - 1, starts + 365)::DATE AS retired_on
FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY starts)""")
def _(t):
    x = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("starts")).distinct()
    w = windows.window(["o_custkey"], "starts")
    ahead = [F.date_sub(F.lead("starts", n).over(w), 1) for n in (4, 3, 2, 1)]
    return x.withColumn("retired_on", F.coalesce(*ahead, F.date_add("starts", 365)))


@query("e31_most_frequent", """
SELECT o_custkey, o_orderpriority, n AS votes FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority DESC) = 1""")
def _(t):
    return aggregate.most_frequent(t.orders, ["o_custkey"], "o_orderpriority")


@query("e32_clip_periods", """
WITH x AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS starts, o_orderdate::DATE + 365 AS ends FROM orders)
SELECT o_custkey, starts, CASE WHEN lead(starts) OVER w <= ends THEN lead(starts) OVER w - 1 ELSE ends END AS ends FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY starts)""")
def _(t):
    x = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("starts")).distinct().withColumn("ends", F.date_add("starts", 365))
    following = F.lead("starts").over(windows.window(["o_custkey"], "starts"))
    return x.withColumn("ends", F.when(following <= F.col("ends"), F.date_sub(following, 1)).otherwise(F.col("ends")))


@query("e33_mixed_group", """
SELECT o_orderkey, count(*) FILTER (o_orderstatus = 'F') OVER w BETWEEN 1 AND count(*) OVER w - 1 AS mixed FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def _(t):
    g = windows.group_stats(t.orders, ["o_custkey"], won=F.count_if(F.col("o_orderstatus") == "F"), n=F.count("*"))
    return g.select("o_orderkey", F.col("won").between(1, F.col("n") - 1).alias("mixed"))
