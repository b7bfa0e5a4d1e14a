"""Streams over the files of the given tables, compared with their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import jobs
from .registry import query



def event_stream(t):
    return jobs.file_stream(t.spark, t.folder, t.events.schema, "events.parquet")


def daily_files(t, copies: int = 1):
    """Events landed as dated folders, one file per day, so that a stream takes several batches."""
    path = scratch_path(t.spark, "landing")
    day = t.events.withColumn("day", F.to_date("ts"))
    for _ in range(copies):
        day.write.mode("append").partitionBy("day").parquet(path)
    return path


@query("l01_stream_dedupe", "SELECT event_id, user_id, ts FROM events")
def _(t):
    # Every event lands twice.
    stream = jobs.file_stream(t.spark, daily_files(t, 2), t.events.schema)
    return jobs.drain(jobs.dedupe(stream, ["event_id"], "ts", "40 days").select("event_id", "user_id", "ts"), "dedupe")


@query("l02_tumbling_hourly", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    return jobs.drain(jobs.tumbling_counts(event_stream(t), "ts", ["event_type"], "1 hour"), "hourly", ["window_start", "event_type"])


@query("l03_tumbling_daily", "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    unique = jobs.dedupe(jobs.file_stream(t.spark, daily_files(t, 2), t.events.schema), ["event_id"], "ts", "40 days")
    root, state = scratch_path(t.spark, "daily"), scratch_path(t.spark, "daily-state")
    key = ["window_start", "event_type"]
    add = jobs.add_counts(key, ["n"])
    ones = unique.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type", F.lit(1).cast("long").alias("n"))
    jobs.upsert_touched(ones, root, key, state, add, mode="append").awaitTermination()
    return jobs.kept(t.spark, root, key, ones.schema)


@query("l04_sliding_active_users", """
WITH a AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events)
SELECT g + INTERVAL 1 DAY AS window_end, count(DISTINCT user_id) AS users FROM (SELECT user_id, unnest(generate_series(day::TIMESTAMP, day + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS g FROM a) GROUP BY ALL""")
def _(t):
    members = jobs.sliding_members(event_stream(t), "ts", [], "user_id", "7 days", "1 day")
    return jobs.drain(members, "sliding", ["window_end", "user_id"]).groupBy("window_end").agg(F.count("*").alias("users"))


@query("l05_keyed_upsert", """
SELECT user_id, max(ts) AS last_seen, arg_max(event_type, (ts, event_id)) AS last_event FROM events GROUP BY 1""")
def _(t):
    stream = jobs.file_stream(t.spark, daily_files(t), t.events.schema, files_per_batch=10)
    root, state = scratch_path(t.spark, "upsert"), scratch_path(t.spark, "upsert-state")

    def combine(batch, old):
        newest = batch.unionByName(old).groupBy("user_id").agg(F.max_by(F.struct("ts", "event_id", "event_type"), F.struct("ts", "event_id")).alias("top"))
        return newest.select("user_id", "top.*")

    rows = stream.select("user_id", "ts", "event_id", "event_type")
    jobs.upsert_touched(rows, root, ["user_id"], state, combine, mode="append").awaitTermination()
    final = jobs.kept(t.spark, root, ["user_id"], rows.schema)
    return final.select("user_id", F.col("ts").alias("last_seen"), F.col("event_type").alias("last_event"))


@query("l06_replay_recent", "SELECT ts::DATE AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    # The stream says which days changed; those days are rebuilt from the landed rows.
    path = daily_files(t)
    stream = jobs.file_stream(t.spark, path, t.events.schema, files_per_batch=10)
    root, state = scratch_path(t.spark, "replay"), scratch_path(t.spark, "replay-state")

    def combine(batch, old):
        # The days are literals on the landing folder's partition column: other days' files are not opened.
        touched = [r["day"] for r in batch.select("day").distinct().collect()]
        landed = t.spark.read.schema(t.events.schema.add("day", "date")).parquet(path).where(F.col("day").isin(touched))
        rows = landed.groupBy("day").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))
        return old.join(rows.select("day"), "day", "left_anti").unionByName(rows)

    days = stream.select(F.to_date("ts").alias("day"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("users"))
    jobs.upsert_touched(days, root, ["day"], state, combine, mode="append").awaitTermination()
    return jobs.kept(t.spark, root, ["day"], days.schema)


@query("l07_first_last_seen", "SELECT event_type, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return jobs.drain(jobs.first_last_seen(event_stream(t), ["event_type"], "ts"), "seen", ["event_type"])


@query("l08_stream_static_join", "SELECT event_id, n_name FROM events LEFT JOIN nation ON user_id % 30 = n_nationkey")
def _(t):
    stream = event_stream(t).withColumn("n_nationkey", (F.col("user_id") % 30).cast("int"))
    return jobs.drain(jobs.enrich(stream, t.nation, ["n_nationkey"]).select("event_id", "n_name"), "enriched")


@query("l09_file_arrival", "SELECT event_id, ts::DATE AS day FROM events")
def _(t):
    stream = jobs.file_stream(t.spark, daily_files(t), t.events.schema, files_per_batch=7)
    return jobs.drain(stream.select("event_id", F.to_date("ts").alias("day")), "arrived")
