"""Data checks: failing rows per rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from . import standins as s
from .registry import query

TRACKS = s.with_("tracks")


@query("k01_not_null", TRACKS + "SELECT id FROM tracks WHERE context_user_agent IS NULL")
def _(t):
    return quality.not_null(s.tracks(t), "context_user_agent").select("id")


@query("k02_unique", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return quality.unique(t.lineitem, "l_orderkey")


@query("k03_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return quality.unique(t.lineitem, "l_orderkey", "l_linenumber")


@query("k04_relationships", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return quality.relationships(t.documents, "doc_id", t.labels, "doc_id").select("doc_id")


@query("k05_accepted_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def _(t):
    return quality.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey", "o_orderpriority")


@query("k06_accepted_range", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def _(t):
    return quality.accepted_range(t.customer, "c_acctbal", 0, 9000).select("c_custkey")


@query("k07_expression_is_true", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_extendedprice >= 1000 AND l_discount <= 0.09)")
def _(t):
    return quality.expression_is_true(t.lineitem, "l_extendedprice >= 1000 AND l_discount <= 0.09").select("l_orderkey", "l_linenumber", "l_partkey")


@query("k08_not_empty_string", "SELECT page_id FROM pages WHERE split_part(url, '?', 2) = ''")
def _(t):
    parts = t.pages.withColumn("query", F.split_part("url", F.lit("?"), F.lit(2)))
    return quality.not_empty_string(parts, "query").select("page_id")


@query("k09_sequential_values", """
WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events) SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next_value FROM d QUALIFY next_value - day <> 1""")
def _(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    return quality.sequential_values(days, ["user_id"], "day")


@query("k10_severity", "SELECT count(*) AS failures, CASE WHEN count(*) > 100 THEN 'error' WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END AS status FROM customer WHERE c_acctbal < -900")
def _(t):
    return quality.severity(t.customer.where(F.col("c_acctbal") < -900), warn_if=0, error_if=100)


@query("k11_overlap", TRACKS + """
SELECT count(*) AS delta_rows, count(*) FILTER (received_at < TIMESTAMP '2024-01-20') AS shared_rows FROM tracks WHERE received_at >= TIMESTAMP '2024-01-18'""")
def _(t):
    rows = s.tracks(t)
    base = rows.where(F.col("received_at") < s.ts("2024-01-20 00:00:00"))
    return quality.overlap(rows.where(F.col("received_at") >= s.ts("2024-01-18 00:00:00")), base, "id")


@query("k12_one_to_one", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def _(t):
    return quality.one_to_one(t.lineitem, "l_orderkey", "l_suppkey")


@query("k13_plan_coverage", """
WITH a AS (SELECT DISTINCT event_type AS event_name, nullif(CAST(props ->> '$.k' AS INTEGER) % 6, 0) AS event_action FROM events),
p AS (SELECT DISTINCT event_type AS event_name, nullif(CAST(props ->> '$.k' AS INTEGER) % 4, 0) + CASE WHEN event_type = 'view' THEN 5 ELSE 0 END AS event_action FROM events)
SELECT *, 'plan' AS missing_from FROM (SELECT * FROM a EXCEPT SELECT * FROM p) UNION ALL SELECT *, 'data' FROM (SELECT * FROM p EXCEPT SELECT * FROM a)""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = t.events.withColumnRenamed("event_type", "event_name")
    actual = rows.withColumn("event_action", F.nullif(k % 6, F.lit(0)))
    plan = rows.withColumn("event_action", F.nullif(k % 4, F.lit(0)) + F.when(F.col("event_name") == "view", 5).otherwise(0))
    return quality.coverage_gap(actual, plan, ["event_name", "event_action"])


@query("k14_survey_rules", """
WITH a AS (SELECT conv_id, turn, role AS question, text AS answer FROM conversations)
SELECT conv_id, turn, CASE WHEN question NOT IN ('user', 'assistant') THEN 'unknown question' ELSE 'empty answer' END AS reason FROM a WHERE question NOT IN ('user', 'assistant') OR trim(answer) = ''""")
def _(t):
    from ..sources.packets import answer_rejects

    answers = t.conversations.withColumnsRenamed({"role": "question", "text": "answer"})
    return answer_rejects(answers, ["user", "assistant"]).select("conv_id", "turn", "reason")


@query("k15_new_event_names", """
WITH e AS (SELECT event_type || '_' || user_id AS name, ts FROM events) SELECT name, min(ts) AS first_seen FROM e GROUP BY 1 HAVING min(ts) >= TIMESTAMP '2024-01-08'""")
def _(t):
    names = t.events.select(F.concat_ws("_", "event_type", "user_id").alias("name"), "ts")
    return quality.new_names(names, "name", "ts", s.ts("2024-01-08 00:00:00"))


@query("k_check_suite", """
SELECT 'not_null' AS rule, count(*) FILTER (c_name IS NULL) AS failures FROM customer UNION ALL SELECT 'range', count(*) FILTER (c_acctbal < 0) FROM customer
UNION ALL SELECT 'unique', 0 UNION ALL SELECT 'orphans', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def _(t):
    return quality.check(t.customer, {
        "not_null": quality.not_null(t.customer, "c_name"),
        "range": quality.accepted_range(t.customer, "c_acctbal", low=0),
        "unique": quality.unique(t.customer, "c_custkey"),
        "orphans": quality.relationships(t.customer, "c_custkey", t.orders, "o_custkey"),
    })
