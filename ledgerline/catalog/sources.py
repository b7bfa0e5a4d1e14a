"""Sources, sinks and incremental loads."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..functions.text import surrogate_key
from ..operators import merge, tables
from ..operators.aggregate import spread
from ..session import scratch_path
from ..sources import files, packets
from . import standins as s
from .registry import mart, query

TRACKS = s.with_("tracks")


def kept(t, rows, by, mark=None):
    """A table that earlier loads have written, in parts by ``by``."""
    table = tables.PartTable(t.spark, scratch_path(t.spark, "table"), by, mark)
    table.merge(rows, lambda new, _: new)
    return table


@query("a01_scan_table", "SELECT * FROM orders")
def _(t):
    return files.scan(t.spark, t.folder, "orders")


@query("a02_load_csv", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def _(t):
    path = scratch_path(t.spark, "csv")
    t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").write.csv(path, header=True, quoteAll=True)
    return files.load_csv(t.spark, path, "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double")


@query("a03_load_files", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal >= 0")
def _(t):
    path = scratch_path(t.spark, "files")
    key = F.when(F.col("s_acctbal") < 0, "no number").otherwise(F.col("s_suppkey").cast("string"))
    t.supplier.select(key, "s_name", "s_acctbal").write.csv(f"{path}/supplier")
    t.nation.write.csv(f"{path}/nation")
    return files.load_files(t.spark, path, r"/supplier/part-.*\.csv$", "s_suppkey bigint, s_name string, s_acctbal double")


@query("a04_log_file_pattern", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'")
def _(t):
    path = scratch_path(t.spark, "logs")
    t.events.select("event_id", "user_id", F.to_date("ts").alias("day")).write.partitionBy("day").csv(f"{path}/eu")
    pattern = files.log_file_pattern("/eu/", date(2024, 1, 5))
    return files.load_files(t.spark, path, pattern, "event_id bigint, user_id bigint")


@query("a05_load_incremental_by_date", """
SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-19' AND CAST(ts AS DATE) < DATE '2024-01-30'""")
def _(t):
    path = scratch_path(t.spark, "dated")
    t.events.select("event_id", "ts", F.to_date("ts").alias("day")).write.partitionBy("day").parquet(path)
    loaded = t.events.where(F.col("ts") < s.ts("2024-01-20 00:00:00"))
    return files.load_incremental_by_date(
        t.spark, path, loaded, "ts", date(2024, 1, 30), lambda p: t.spark.read.parquet(*p), layout="day=%Y-%m-%d"
    )


@query("a06_daterange", """
SELECT o_orderpriority, CAST(d AS DATE) AS day FROM (SELECT o_orderpriority, unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
FROM orders GROUP BY 1)""")
def _(t):
    day = F.to_date("o_orderdate")
    spans = t.orders.groupBy("o_orderpriority").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return spans.select(
        "o_orderpriority", F.explode(F.expr("sequence(a, date_sub(b, 1), interval 1 day)")).alias("day")
    )


@query("a08_seed", """
SELECT o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'normal' END AS lane, count(*) AS n
FROM orders GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "seed")
    lane = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "fast").otherwise("normal")
    t.orders.select("o_orderpriority", lane.alias("lane")).distinct().write.csv(path, header=True)
    lanes = files.seed(t.spark, path, "o_orderpriority string, lane string")
    return t.orders.join(lanes, "o_orderpriority").groupBy("o_orderpriority", "lane").agg(F.count("*").alias("n"))


@query("a09_materialisation", """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def _(t):
    t.customer.createOrReplaceTempView("stg_customer")
    joined = t.spark.sql("SELECT c_custkey, c_nationkey FROM stg_customer").join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    path = scratch_path(t.spark, "mart")
    joined.groupBy("n_name").agg(F.count("*").alias("customers")).write.parquet(path)
    return t.spark.read.parquet(path)


@query("a10_incremental_append", TRACKS + """
SELECT id, received_at FROM tracks n WHERE NOT EXISTS (SELECT 1 FROM tracks o WHERE o.id = n.id AND o.received_at < TIMESTAMP '2024-01-20')""")
def _(t):
    rows = s.tracks(t).select("id", "received_at")
    loaded = rows.where(F.col("received_at") < s.ts("2024-01-20 00:00:00"))
    table = kept(t, loaded.withColumn("day", F.to_date("received_at")), "day", "received_at")
    return table.append(rows.withColumn("day", F.to_date("received_at")), ["id"]).drop("day")


USER_DAYS = """
, user_days AS (SELECT md5(concat_ws('-', CAST(CAST("timestamp" AS DATE) AS VARCHAR), server_id, user_id)) AS daily_user_id,
    CAST("timestamp" AS DATE) AS activity_date, server_id, user_id, CAST(received_at AS DATE) AS received_on, count(*) AS n
  FROM tracks GROUP BY ALL),
old AS (SELECT daily_user_id, activity_date, server_id, user_id, max(received_on) AS received_at_date, CAST(sum(n) AS BIGINT) AS n
  FROM user_days WHERE received_on <= DATE '2024-01-15' GROUP BY ALL),
new AS (SELECT daily_user_id, activity_date, server_id, user_id, max(received_on) AS received_at_date, CAST(sum(n) AS BIGINT) AS n
  FROM user_days WHERE received_on >= DATE '2024-01-14' GROUP BY ALL)
"""


def _user_days(t):
    daily = s.tracks(t).groupBy(
        F.to_date("timestamp").alias("activity_date"), "server_id", "user_id", F.to_date("received_at").alias("received_on")
    ).agg(F.count("*").alias("n"))

    def part(rows):
        return rows.groupBy("activity_date", "server_id", "user_id").agg(
            F.max("received_on").alias("received_at_date"), F.sum("n").alias("n")
        ).withColumn("daily_user_id", surrogate_key("activity_date", "server_id", "user_id"))

    return part(daily.where(F.col("received_on") <= s.day("2024-01-15"))), part(daily.where(F.col("received_on") >= s.day("2024-01-14")))


@query("a11_incremental_merge", TRACKS + USER_DAYS + """
SELECT coalesce(o.daily_user_id, n.daily_user_id) AS daily_user_id, coalesce(o.activity_date, n.activity_date) AS activity_date,
  coalesce(o.server_id, n.server_id) AS server_id, coalesce(o.user_id, n.user_id) AS user_id,
  coalesce(n.received_at_date, o.received_at_date) AS received_at_date, coalesce(o.n, n.n) AS n
FROM old o FULL JOIN new n ON o.daily_user_id = n.daily_user_id""")
def _(t):
    old, new = _user_days(t)
    table = kept(t, old, "activity_date")
    table.merge(new, lambda rows, there: merge.incremental_merge(rows, there, ["daily_user_id"], ["received_at_date"]))
    return table.read().drop(tables.PART)


@query("a12_incremental_delete_insert", TRACKS + USER_DAYS + """
SELECT * FROM old WHERE activity_date NOT IN (SELECT activity_date FROM new) UNION ALL SELECT * FROM new""")
def _(t):
    old, new = _user_days(t)
    table = kept(t, old, "activity_date")
    table.merge(new, lambda rows, there: merge.delete_insert(rows, there, ["activity_date"]))
    return table.read().drop(tables.PART)


@query("a13_high_water_mark", TRACKS + """
SELECT id, received_at FROM tracks WHERE received_at >= (SELECT max("timestamp") FROM tracks WHERE event = 'purchase')""")
def _(t):
    rows = s.tracks(t)
    bought = rows.where(F.col("event") == "purchase").select(F.col("timestamp").alias("received_at"))
    return merge.since_mark(rows.select("id", "received_at"), bought, "received_at")


@query("a14_late_lookback", TRACKS + """
SELECT id, "timestamp" FROM tracks WHERE "timestamp" >= (SELECT max("timestamp") FROM tracks WHERE event = 'signup') - INTERVAL 2 DAY""")
def _(t):
    rows = s.tracks(t).select("id", "timestamp", "event")
    seen = rows.where(F.col("event") == "signup")
    return merge.since_mark(rows, seen, "timestamp", timedelta(days=2)).select("id", "timestamp")


@query("a15_lookback_hours", TRACKS + """
SELECT id, "timestamp" FROM tracks WHERE "timestamp" > (SELECT max("timestamp") FROM tracks WHERE event = 'error') - INTERVAL 12 HOUR""")
def _(t):
    rows = s.tracks(t).select("id", "timestamp", "event")
    seen = rows.where(F.col("event") == "error")
    return merge.since_mark(rows, seen, "timestamp", timedelta(hours=12), inclusive=False).select("id", "timestamp")


SOURCE_TARGET = """
, target AS (SELECT event, received_at FROM tracks WHERE (event = 'click' AND received_at < TIMESTAMP '2024-01-25')
   OR (event IN ('signup', 'error', 'purchase') AND received_at < TIMESTAMP '2024-01-20')),
marks AS (SELECT event, max(received_at) AS m FROM target GROUP BY event)
"""


def _loaded(rows):
    click = (F.col("event") == "click") & (F.col("received_at") < s.ts("2024-01-25 00:00:00"))
    rest = F.col("event").isin("signup", "error", "purchase") & (F.col("received_at") < s.ts("2024-01-20 00:00:00"))
    return rows.where(click | rest)


@query("a16_per_source_water_mark", TRACKS + SOURCE_TARGET + """
SELECT id, t.event, received_at FROM tracks t LEFT JOIN marks ON t.event = marks.event WHERE m IS NULL OR received_at > m""")
def _(t):
    rows = s.tracks(t).select("id", "event", "received_at")
    return merge.per_source_marks(rows, _loaded(rows), "event", "received_at")


@query("a17_min_over_sources_mark", TRACKS + SOURCE_TARGET + """
SELECT id, event, received_at FROM tracks WHERE received_at >= (SELECT min(m) FROM marks) - INTERVAL 2 DAY""")
def _(t):
    rows = s.tracks(t).select("id", "event", "received_at")
    mark = merge.slowest_source_mark(_loaded(rows), "event", "received_at")
    return rows.where(F.col("received_at") >= F.lit(mark - timedelta(days=2)))


BASE_DELTA = """
, base AS (SELECT id, event, received_at FROM tracks WHERE received_at < TIMESTAMP '2024-01-20'),
delta AS (SELECT id, event, received_at, k FROM tracks WHERE received_at >= TIMESTAMP '2024-01-18')
"""


def _base_delta(t):
    rows = s.tracks(t)
    base = rows.where(F.col("received_at") < s.ts("2024-01-20 00:00:00")).select("id", "event", "received_at")
    delta = rows.where(F.col("received_at") >= s.ts("2024-01-18 00:00:00")).select("id", "event", "received_at", "k")
    return base, delta


@query("a18_merge_delta_into_base", TRACKS + BASE_DELTA + """
SELECT id, event, received_at, NULL::INTEGER AS k FROM base UNION ALL SELECT * FROM delta WHERE id NOT IN (SELECT id FROM base)""")
def _(t):
    return merge.merged_base(*_base_delta(t))


@query("a19_schema_evolve", TRACKS + BASE_DELTA + "SELECT *, NULL::INTEGER AS k FROM base")
def _(t):
    return merge.schema_evolve(*_base_delta(t))


@query("a20_read_base_plus_delta", TRACKS + BASE_DELTA + """
SELECT id, received_at, NULL::INTEGER AS k FROM base WHERE id NOT IN (SELECT id FROM delta) UNION ALL SELECT id, received_at, k FROM delta""")
def _(t):
    return merge.read_base_plus_delta(*_base_delta(t), exclude=["event"])


@query("a21_build_delta", TRACKS + BASE_DELTA + """
, source AS (SELECT id, event, received_at FROM tracks UNION ALL SELECT id, event, received_at + INTERVAL 10 DAY FROM tracks WHERE event = 'error'),
mark AS (SELECT max(m) - INTERVAL 2 DAY AS since FROM (SELECT max(received_at) AS m FROM base UNION ALL SELECT max(received_at) FROM delta WHERE received_at < TIMESTAMP '2024-01-21'))
SELECT id, event, received_at FROM source, mark WHERE received_at >= since AND id NOT IN (SELECT id FROM base WHERE received_at >= since)""")
def _(t):
    base, delta = _base_delta(t)
    rows = s.tracks(t).select("id", "event", "received_at")
    again = rows.where(F.col("event") == "error").withColumn("received_at", F.col("received_at") + F.expr("interval 10 days"))
    return merge.build_delta(rows.unionByName(again), base, delta=delta.where(F.col("received_at") < s.ts("2024-01-21 00:00:00")))


@query("a22_upsert_by_source", TRACKS + """
, old AS (SELECT server_id, event AS source, count(*) AS n FROM tracks WHERE "timestamp" < TIMESTAMP '2024-01-20' GROUP BY ALL),
new AS (SELECT server_id, event AS source, count(*) AS n FROM tracks WHERE event IN ('click', 'view') GROUP BY ALL)
SELECT * FROM old WHERE (server_id, source) NOT IN (SELECT (server_id, source) FROM new) UNION ALL SELECT * FROM new""")
def _(t):
    rows = s.tracks(t).withColumnRenamed("event", "source")
    old = rows.where(F.col("timestamp") < s.ts("2024-01-20 00:00:00")).groupBy("server_id", "source").agg(F.count("*").alias("n"))
    new = rows.where(F.col("source").isin("click", "view")).groupBy("server_id", "source").agg(F.count("*").alias("n"))
    table = kept(t, old, "source")
    table.merge(new, lambda rows, there: merge.delete_insert(rows, there, ["server_id", "source"]))
    return table.read().drop(tables.PART)


@query("a23_daily_snapshot", """
SELECT c_custkey, c_acctbal, DATE '2024-01-30' AS snapshot_date FROM customer
UNION ALL SELECT c_custkey, c_acctbal, DATE '2024-01-31' FROM customer""")
def _(t):
    table, history = t.customer.select("c_custkey", "c_acctbal"), tables.PartTable(t.spark, scratch_path(t.spark, "snapshots"), "snapshot_date")
    for day in ("2024-01-30", "2024-01-31", "2024-01-31"):
        history.snapshot(table, day)
    return history.read().drop(tables.PART)


@query("a24_update_from", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN n_name ELSE c_name END AS c_name
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    source = t.customer.where(F.col("c_mktsegment") == "BUILDING").join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_mktsegment", F.col("n_name").alias("c_name"))
    table = kept(t, t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_mktsegment")
    table.merge(source, lambda rows, there: merge.update_from(there, rows, ["c_custkey"], ["c_name"]))
    return table.read().select("c_custkey", "c_name")


@query("a25_delete_using", """
SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS
  (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal * 50 < o.o_totalprice)""")
def _(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    table = tables.HashTable(t.spark, scratch_path(t.spark, "orders"), ["c_custkey"], 20_000, mark="o_totalprice")
    table.merge(orders, lambda rows, there: rows)
    # no order costs more than the manifest says, so customers above that balance delete nothing
    dearest = max((f["high"] for files in table.manifest().parts.values() for f in files if f["high"] is not None), default=0)
    poor = t.customer.where(F.col("c_acctbal") * 50 < dearest).select("c_custkey", "c_acctbal")
    table.merge(poor, lambda rows, there: merge.delete_using(there, rows, ["c_custkey"], lambda o, c: c("c_acctbal") * 50 < o("o_totalprice")))
    return table.read().select("o_orderkey", "o_totalprice")


@query("a26_sync_diff", """
WITH cur AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal AS balance FROM customer),
want AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE nullif(c_mktsegment, 'BUILDING') END AS segment, abs(c_acctbal) AS balance FROM customer)
SELECT want.* FROM want JOIN cur USING (c_custkey)
WHERE want.segment IS DISTINCT FROM cur.segment OR want.balance IS DISTINCT FROM cur.balance""")
def _(t):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    current = t.customer.select("c_custkey", segment.alias("segment"), F.col("c_acctbal").alias("balance"))
    desired = t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, segment).alias("segment"), F.abs("c_acctbal").alias("balance")
    )
    return merge.sync_diff(desired, current, ["c_custkey"], ["segment", "balance"])


@query("a27_clustered_write", "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def _(t):
    path = scratch_path(t.spark, "clustered")
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    files.write_clustered(rows, path, "day", ["user_id"])
    return t.spark.read.parquet(path)


@query("a28_discover_event_tables", """
SELECT 'customer' AS name, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def _(t):
    names = files.discover_tables(t.spark, t.folder, "customer|nation|orders|lineitem|region", min_rows=100, exclude=["region"])
    tables = {n: files.scan(t.spark, t.folder, n) for n in names}
    return merge.union_relations(tables, source_column="name").groupBy("name").agg(F.count("*").alias("n_rows"))


@query("a29_union_relations", """
SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS VARCHAR) AS place, c_mktsegment AS segment, NULL::DOUBLE AS balance, 'customer' AS relation FROM customer
UNION ALL SELECT s_suppkey, s_name, 'N' || s_nationkey, NULL, s_acctbal, 'supplier' FROM supplier""")
def _(t):
    customers = t.customer.selectExpr("c_custkey AS key", "c_name AS name", "c_nationkey AS place", "c_mktsegment AS segment", "c_acctbal")
    suppliers = t.supplier.selectExpr("s_suppkey AS key", "s_name AS name", "concat('N', s_nationkey) AS place", "s_acctbal AS balance")
    return merge.union_relations(
        {"customer": customers, "supplier": suppliers}, exclude=["c_acctbal"], source_column="relation"
    )


@query("a32_resume_from_checkpoint", """
SELECT event_id, CAST(ts AS DATE) AS ingestion_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-25'""")
def _(t):
    path = scratch_path(t.spark, "landed")
    rows = t.events.select("event_id", F.to_date("ts").alias("ingestion_date"))
    rows.withColumn("day", F.col("ingestion_date")).write.partitionBy("day").parquet(path)
    done = rows.where(F.col("ingestion_date") <= s.day("2024-01-25"))
    return files.load_incremental_by_date(
        t.spark, path, done, "ingestion_date", date(2024, 1, 31), lambda p: t.spark.read.parquet(*p), layout="day=%Y-%m-%d"
    )


PLUGIN = "survey.plugin"


def _zip(files_of_row):
    """Packets as (path, zip bytes), one per row of the batch; ``flaw`` cuts the archive short or pads it with incompressible bytes."""

    def build(batches):
        import io
        import random
        import zipfile

        import pandas as pd

        padding = random.Random(0).randbytes(LARGE)
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as packet:
                    for name, content in files_of_row(row).items():
                        packet.writestr(name, content)
                    if row["flaw"] == "large":
                        packet.writestr("padding.bin", padding)
                content = buffer.getvalue()
                out.append((f"{row['day']}/{row['id']}.zip", content[: len(content) // 2] if row["flaw"] == "cut" else content))
            yield pd.DataFrame(out, columns=["path", "content"])

    return build


# Packets of the stand-ins are far below this size, padded ones above it.
LARGE = 100_000
LAST_DAY = date(2024, 8, 10)


def _landed(rows, files_of_row):
    """The folder that Spark tasks have landed the packets of ``rows`` (id, day, flaw, …) in."""
    root = scratch_path(rows.sparkSession, "packets")
    rows = spread(rows, packets.PACKETS_PER_TASK, "id")
    packets.write_packets(rows.mapInPandas(_zip(files_of_row), "path string, content binary"), root)
    return root


def _metadata(row) -> str:
    return (
        f"version: 1\ntype: plugin-packet\ngenerated_at: 1721728796871\nserver_version: 9.1.0\nserver_id: '{str(row['id']).zfill(26)}'\n"
        f"extras:\n  plugin_id: {PLUGIN}\n  plugin_version: 1.0.1\n"
    )


def _survey_files(row):
    import csv
    import io
    import json

    answers = io.StringIO(newline="")
    lines = csv.writer(answers)
    lines.writerow(["User ID", "Submitted At", "How likely?", "Why?"])
    lines.writerow([f"u{row['id']}", "23 July 2024", row["score"], row["text"]])
    survey = {
        "id": str(row["id"]).zfill(26), "detractor_count": 0, "passive_count": 0, "promoter_count": 1, "receipt_count": 1,
        "response_count": 1, "start_time": "1 August 2024" if row["late"] else "1 July 2024", "duration": "30",
        "questions": [{"id": "q1", "text": "How likely?", "type": "linear_scale"}, {"id": "q2", "text": "Why?", "type": "text"}],
    }
    return {"metadata.yaml": _metadata(row), "survey_metadata.json": json.dumps(survey), "responses.csv": answers.getvalue()}


s.define("survey_packet", """
SELECT conv_id || '-' || turn AS id, turn % 11 AS score, text, role, '2024-08-0' || (1 + conv_id % 4) AS day, conv_id % 4 AS nr,
 CASE WHEN conv_id % 7 = 1 AND turn = 0 THEN 'cut' WHEN conv_id % 7 = 3 AND turn = 1 THEN 'large' ELSE 'none' END AS flaw FROM conversations""")


def _survey_root(t):
    flaw = F.when((F.col("conv_id") % 7 == 1) & (F.col("turn") == 0), "cut").when((F.col("conv_id") % 7 == 3) & (F.col("turn") == 1), "large").otherwise("none")
    rows = t.conversations.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), (F.col("turn") % 11).alias("score"), "text", (F.col("role") == "system").alias("late"),
        F.concat(F.lit("2024-08-0"), 1 + F.col("conv_id") % 4).alias("day"), flaw.alias("flaw"),
    )
    return _landed(rows, _survey_files)


def _surveys(found):
    return packets.ingest_survey_packets(found, PLUGIN, s.AS_OF)


@query("a30_ingest_survey_packets", s.with_("survey_packet") + """, p AS (SELECT * FROM survey_packet WHERE role <> 'system' AND flaw = 'none')
SELECT day || '/' || id || '.zip' AS source, day AS ingestion_date, 'u' || id AS user_id, DATE '2024-07-23' AS submitted_at, 'How likely?' AS question, score::VARCHAR AS answer, 'linear_scale' AS question_type FROM p
UNION ALL SELECT day || '/' || id || '.zip', day, 'u' || id, DATE '2024-07-23', 'Why?', text, 'text' FROM p""")
def _(t):
    accepted, _ = packets.resume_packets(t.spark, _survey_root(t), None, LAST_DAY, _surveys, LARGE)
    return accepted.select("source", "ingestion_date", "user_id", "submitted_at", "question", "answer", "question_type")


@query("a30_rejects", s.with_("survey_packet") + """
SELECT day || '/' || id || '.zip' AS source, CASE flaw WHEN 'large' THEN 'packet too large' WHEN 'cut' THEN 'unreadable packet: BadZipFile' ELSE 'answer before survey start' END AS reason
FROM survey_packet WHERE flaw <> 'none' OR role = 'system'""")
def _(t):
    return packets.resume_packets(t.spark, _survey_root(t), None, LAST_DAY, _surveys, LARGE)[-1]


@query("a30_resume", s.with_("survey_packet") + """
SELECT day || '/' || id || '.zip' AS source, day AS ingestion_date, count(*) AS packets FROM survey_packet WHERE role <> 'system' AND flaw = 'none' AND (nr = 3 OR nr = 2 AND conv_id_even = 0) GROUP BY ALL""".replace("conv_id_even", "(split_part(id, '-', 1)::BIGINT // 4) % 2"))
def _(t):
    """The target holds two days and half of the third; the next run opens the third and fourth day only."""
    root = _survey_root(t)
    accepted, _ = packets.resume_packets(t.spark, root, None, date(2024, 8, 4), _surveys, LARGE)
    number = F.regexp_extract("source", r"/(\d+)-", 1).cast("long")
    held = mart(accepted.where((F.col("ingestion_date") < "2024-08-03") | (F.floor(number / 4) % 2 == 1)), "ingested")
    fresh, _ = packets.resume_packets(t.spark, root, held, LAST_DAY, _surveys, LARGE)
    return fresh.select("source", "ingestion_date").distinct().withColumn("packets", F.lit(1).cast("long"))


def _support_files(row):
    body = "".join(
        f"{k}: {v}\n"
        for k, v in {
            "server_os": "linux", "server_architecture": "amd64", "server_version": "8.1.9", "build_hash": "abc", "database_type": "postgres",
            "database_version": '"13.10"', "database_schema_version": '"113"', "license_to": row["c_name"], "license_supported_users": 100,
            "active_users": row["c_nationkey"], "total_channels": 1, "total_posts": 2, "total_teams": 1, "daily_active_users": 1,
            "monthly_active_users": 1, "websocket_connections": 0, "master_db_connections": 1, "read_db_connections": 0, "inactive_user_count": 0,
        }.items()
        if k != "build_hash" or not row["broken"]
    )
    job = f"- id: j{row['id']}\n  type: migrations\n  priority: 0\n  createat: 1723734966121\n  startat: 1723734980530\n  lastactivityat: 1723734981002\n  status: success\n  progress: 0\n  data:\n    step: last\n"
    files_in = {"support_packet.yaml": f"{body}ldap_sync_jobs: []\nmigration_jobs:\n{job}compliance_jobs:\n{job}"}
    if row["c_nationkey"] > 4:
        files_in["metadata.yaml"] = _metadata(row)
    return files_in


def _support(t):
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), "c_name", "c_nationkey", (F.col("c_acctbal") < 0).alias("broken"), F.concat(F.lit("2024-08-0"), 1 + F.col("c_custkey") % 3).alias("day"),
        F.when(F.col("c_custkey") % 29 == 0, "cut").when(F.col("c_custkey") % 29 == 1, "large").otherwise("none").alias("flaw"),
    )
    return packets.resume_packets(t.spark, _landed(rows, _support_files), None, LAST_DAY, lambda found: packets.ingest_support_packets(found, s.AS_OF), LARGE)


s.define("support_packet", """
SELECT *, '2024-08-0' || (1 + c_custkey % 3) || '/' || c_custkey || '.zip' AS source, CASE c_custkey % 29 WHEN 0 THEN 'cut' WHEN 1 THEN 'large' ELSE 'none' END AS flaw FROM customer""")


@query("a31_ingest_support_packets", s.with_("support_packet") + """
SELECT source, c_name AS license_to, c_nationkey AS active_users, CASE WHEN c_nationkey > 4 THEN lpad(c_custkey::VARCHAR, 26, '0') ELSE 'Unknown' END AS metadata_server_id
FROM support_packet WHERE c_acctbal >= 0 AND flaw = 'none'""")
def _(t):
    return _support(t)[0].select("source", "license_to", "active_users", "metadata_server_id")


@query("a31_ingest_support_jobs", s.with_("support_packet") + """
SELECT source, 'j' || c_custkey AS id, 'success' AS status, TIMESTAMP '2024-08-15 15:16:06.121' AS createat, '{"step":"last"}' AS data FROM support_packet, range(2) WHERE c_acctbal >= 0 AND flaw = 'none'""")
def _(t):
    return _support(t)[1].select("source", "id", "status", "createat", "data")


@query("a31_rejects", s.with_("support_packet") + """
SELECT source, CASE flaw WHEN 'large' THEN 'packet too large' WHEN 'cut' THEN 'unreadable packet: BadZipFile' ELSE 'missing fields' END AS reason FROM support_packet WHERE flaw <> 'none' OR c_acctbal < 0""")
def _(t):
    return _support(t)[2]
