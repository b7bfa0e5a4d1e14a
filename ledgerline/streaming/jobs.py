"""Structured Streaming forms of the incremental batch loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import tables
from ..session import scratch_path


def file_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive; dated sub-folders are followed."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def dedupe(events: DataFrame, key: Sequence[str], ts: str, lateness: str = "2 days") -> DataFrame:
    """First copy of each key; state is dropped once the watermark has passed."""
    marked = events.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", lateness)
    return marked.dropDuplicatesWithinWatermark(list(key)).drop("_event_time")


def tumbling_counts(events: DataFrame, ts: str, by: Sequence[str], width: str, lateness: str = "2 days",
                    aggs: Sequence[Column] = ()) -> DataFrame:
    """Counts per window; a window's state is dropped once the watermark has passed it."""
    marked = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    grouped = marked.groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"), *aggs)
    return grouped.select(F.col("window.start").alias("window_start"), *by, "n", *[c for c in grouped.columns if c not in ("window", "n", *by)])


def sliding_members(events: DataFrame, ts: str, by: Sequence[str], member: str, span: str, step: str, lateness: str = "2 days") -> DataFrame:
    """Members seen per sliding window, one row per member and window.

    The exact distinct count is a plain count of these rows in the sink; the state holds one row per
    member and window and is dropped by the watermark.
    """
    marked = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return marked.groupBy(F.window(ts, span, step), *by, member).agg(F.count("*").alias("events")).select(
        F.col("window.end").alias("window_end"), *by, member, "events"
    )


def first_last_seen(events: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    return events.groupBy(*key).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("n"))


def enrich(events: DataFrame, dimension: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stream joined with a static dimension; Catalyst broadcasts it if it is small enough."""
    return events.join(dimension, list(key), "left")


def upsert_touched(stream: DataFrame, root: str, key: Sequence[str], checkpoint: str, combine: tables.Combine | None = None, part_rows: int = tables.PART_ROWS, mode: str = "update") -> StreamingQuery:
    """Keyed table of which a batch reads and writes only the parts of its keys; parts that outgrow ``part_rows`` are split.

    ``combine(rows, old)`` gives the new rows of these parts; by default a row of the batch replaces the row of its key. A batch
    is committed once: when the stream repeats it, the table already names its number and stays as it is.
    """
    table = tables.HashTable(stream.sparkSession, root, key, part_rows)

    def replace(rows: DataFrame, old: DataFrame) -> DataFrame:
        return old.join(rows.select(F.struct(*key).alias("_key")), F.struct(*[old[k] for k in key]) == F.col("_key"), "left_anti").unionByName(rows)

    def write(batch: DataFrame, batch_id: int) -> None:
        if table.merge(batch, combine or replace, batch_id):
            table.vacuum()

    return stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept(spark: SparkSession, root: str, key: Sequence[str], schema) -> DataFrame:
    """The rows of a table kept by :func:`upsert_touched`."""
    rows = tables.HashTable(spark, root, key).read()
    return spark.createDataFrame([], schema) if rows is None else rows.drop(tables.PART)


def add_counts(key: Sequence[str], measures: Sequence[str]) -> tables.Combine:
    """``combine`` that adds the batch's counts to the table's."""
    return lambda rows, old: old.unionByName(rows).groupBy(*key).agg(*[F.sum(m).alias(m) for m in measures])


def drain(stream: DataFrame, label: str, key: Sequence[str] | None = None) -> DataFrame:
    """Run a stream over what is there now and return its result table.

    Without ``key`` rows are appended. With ``key`` each batch's changed rows replace those of their keys, also while the
    watermark has not passed them.
    """
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, label + "-state")
    if key is None:
        stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format(
            "parquet"
        ).option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    upsert_touched(stream, out, key, checkpoint).awaitTermination()
    return kept(spark, out, key, stream.schema).select(*stream.columns)
