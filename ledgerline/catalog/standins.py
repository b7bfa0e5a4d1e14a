"""Telemetry, CRM and log shapes derived from the driver tables, with the same shapes as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .registry import Tables

AS_OF = "2024-01-31"

# One user agent text per remainder of the event's k.
AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/110.0.5481 Electron/23.2.0 Desktop/5.3.1 Safari/537.36",
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/118.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.1 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_2 like Mac OS X) AppleWebKit/605.1.15 Mobile/15E148",
]

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def define(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql.strip(), needs)


def with_(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named shapes and what they need."""
    done: list[str] = []

    def add(n: str) -> None:
        for need in CTES[n][1]:
            add(need)
        if n not in done:
            done.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in done)


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def pick(index: Column, values: list) -> Column:
    """Value at ``index``, NULL past the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def pick_sql(index: str, values: list) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


define("tracks", f"""
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp", ts + to_days(CAST(event_id % 3 AS INTEGER)) AS received_at,
       event_type AS event, 'u' || user_id AS user_id, 's' || (user_id % 20) AS server_id,
       CAST(props ->> '$.k' AS INTEGER) AS k, value, event_id,
       {pick_sql("CAST(props ->> '$.k' AS INTEGER) % 6", AGENTS)} AS context_user_agent
FROM events""")


def tracks(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        (F.col("ts") + F.make_dt_interval((F.col("event_id") % 3).cast("int"))).alias("received_at"),
        F.col("event_type").alias("event"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
        F.concat(F.lit("s"), F.col("user_id") % 20).alias("server_id"),
        k.alias("k"),
        "value",
        "event_id",
        pick(k % 6, AGENTS).alias("context_user_agent"),
    )


# Opportunities and contract lines from orders and lineitem.
define("deals", """
SELECT 'o' || o_orderkey AS opportunity_id, 'a' || o_custkey AS account_id, o_orderkey, o_custkey,
       CAST(o_orderdate AS DATE) AS close_date, o_orderstatus = 'F' AS is_won, o_orderstatus <> 'O' AS is_closed,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'New Subscription' ELSE 'Renewal' END AS type,
       o_orderpriority AS stage, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
FROM orders""")


def deals(t: Tables) -> DataFrame:
    return t.orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("opportunity_id"),
        F.concat(F.lit("a"), "o_custkey").alias("account_id"),
        "o_orderkey", "o_custkey",
        F.col("o_orderdate").cast("date").alias("close_date"),
        (F.col("o_orderstatus") == "F").alias("is_won"),
        (F.col("o_orderstatus") != "O").alias("is_closed"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "New Subscription").otherwise("Renewal").alias("type"),
        F.col("o_orderpriority").alias("stage"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


define("lines", """
SELECT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id, 'o' || l_orderkey AS opportunity_id,
       CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) + 364 AS end_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total_price, CAST(l_quantity AS INTEGER) AS quantity,
       CASE l_returnflag WHEN 'A' THEN 'Recurring' WHEN 'N' THEN 'Recurring' ELSE 'One-time' END AS product_type
FROM lineitem""")


def lines(t: Tables) -> DataFrame:
    start = F.col("l_shipdate").cast("date")
    return t.lineitem.select(
        F.concat(F.lit("l"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("line_id"),
        F.concat(F.lit("o"), "l_orderkey").alias("opportunity_id"),
        start.alias("start_date"),
        F.date_add(start, 364).alias("end_date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_returnflag").isin("A", "N"), "Recurring").otherwise("One-time").alias("product_type"),
    )


# Access log from the pages: address, URI, size and time derived from the page id.
define("access_log", """
SELECT page_id, url, regexp_replace(url, '^https?://[^/]+', '') AS uri, CAST(length(html) AS INTEGER) AS bytes_sent,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id * 37 % 43200 AS INTEGER)) AS log_at,
       '10.' || (page_id % 7) || '.' || (page_id % 250) || '.' || (page_id * 13 % 251) AS ip,
       CASE page_id % 4 WHEN 0 THEN 404 WHEN 3 THEN 304 ELSE 200 END AS status,
       """ + pick_sql("page_id % 6", AGENTS) + """ AS user_agent
FROM pages""")


def access_log(t: Tables) -> DataFrame:
    p = F.col("page_id")
    return t.pages.select(
        p,
        "url",
        F.regexp_replace("url", "^https?://[^/]+", "").alias("uri"),
        F.length("html").alias("bytes_sent"),
        (ts("2024-01-01 00:00:00") + F.make_dt_interval(mins=(p * 37 % 43200).cast("int"))).alias("log_at"),
        F.concat(F.lit("10."), p % 7, F.lit("."), p % 250, F.lit("."), p * 13 % 251).alias("ip"),
        F.when(p % 4 == 0, 404).when(p % 4 == 3, 304).otherwise(200).alias("status"),
        pick((p % 6).cast("int"), AGENTS).alias("user_agent"),
    )
