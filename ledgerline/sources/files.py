"""File loads, seeds, dated prefixes, table discovery and clustered writes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Typed CSV with a header line and double-quoted fields; nothing is inferred."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')


seed = load_csv


def load_files(spark: SparkSession, path: str, name_regex: str, schema: StructType | str, fmt: str = "csv", **options) -> DataFrame:
    """Rows of the files whose name matches; rows that do not fit the schema are skipped.

    Names are matched on the driver's listing, so other files are never opened.
    """
    wanted = [f for f in list_files(spark, path) if re.search(name_regex, f)]
    if not wanted:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).options(mode="DROPMALFORMED", **options).format(fmt).load(wanted)
    # A pruned column is not parsed and cannot reject its row. This test always holds but needs every
    # column, so a count skips the same rows as a full read.
    return df.where(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns]) >= "")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Files under a folder of any file system Spark knows, from the listing only."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found, entries = [], fs.listFiles(root, True)
    while entries.hasNext():
        found.append(entries.next().getPath().toString())
    return sorted(found)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a folder, whatever number of files they hold."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())


def log_file_pattern(location: str, day: date) -> str:
    """Pattern of one day's access-log files."""
    return rf".*{re.escape(location)}.*{day:%Y-%m-%d}.*"


def date_range(first: date, end: date) -> Iterable[date]:
    """Days from ``first`` up to but without ``end``."""
    return (first + timedelta(days=n) for n in range(max((end - first).days, 0)))


def date_prefixes(prefix: str, first: date, end: date, layout: str = "%Y/%m/%d") -> list[str]:
    return [re.sub(r"(?<!:)/{2,}", "/", f"{prefix}/{d:{layout}}") for d in date_range(first, end)]


def load_incremental_by_date(spark: SparkSession, prefix: str, target: DataFrame | None, ts: str, today: date,
                             reader, layout: str = "%Y/%m/%d") -> DataFrame | None:
    """Load the dated folders from the target's latest day up to today (exclusive).

    An empty target loads everything under the prefix. ``reader(paths)`` reads a list of folders.
    """
    mark = None if target is None else target.agg(F.max(ts)).first()[0]
    if mark is None:
        return reader([prefix])
    first = mark if type(mark) is date else mark.date()
    folders = [p for p in date_prefixes(prefix, first, today, layout) if list_files(spark, p)]
    return reader(folders) if folders else None


def write_clustered(df: DataFrame, path: str, partition: str, cluster: Sequence[str], mode: str = "overwrite",
                    files: int | None = None) -> None:
    """One folder per partition value, rows sorted inside so that row-group statistics prune.

    Range partitioning on (partition, cluster columns) samples the data, so a partition value that
    holds a third of the rows is spread over many tasks.
    """
    keys = [partition, *cluster]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode(mode).partitionBy(partition).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Name, row count and bytes of every parquet table under a folder, from footers and listing."""
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    def footers(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for path in batch["path"]:
                file_system, inner = pafs.FileSystem.from_uri(path)
                with file_system.open_input_file(inner) as handle:
                    rows.append(pq.ParquetFile(handle).metadata.num_rows)
            yield pd.DataFrame({"path": batch["path"], "n_rows": rows, "bytes": batch["bytes"]})

    # Footers only: the listing gives path and size, one task reads the footers of its share.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true"
    ).load(folder).select("path", F.col("length").alias("bytes"))
    read = listing.repartition(F.col("path")).mapInPandas(footers, "path string, n_rows bigint, bytes bigint")
    name = F.regexp_extract("path", r"([^/]+?)\.parquet(?:/[^/]*)?$", 1)
    return read.groupBy(name.alias("name")).agg(F.sum("n_rows").alias("n_rows"), F.sum("bytes").alias("bytes"))


def discover_tables(spark: SparkSession, folder: str, like: str = ".*", min_rows: int = 0,
                    exclude: Sequence[str] = ()) -> list[str]:
    """Names of the tables that match, are not excluded and hold at least ``min_rows`` rows."""
    stats = table_stats(spark, folder)
    kept = stats.where(F.col("name").rlike(f"^(?:{like})$") & (F.col("n_rows") >= min_rows))
    if exclude:
        kept = kept.where(~F.col("name").isin(list(exclude)))
    return sorted(r["name"] for r in kept.select("name").collect())
