"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space that separates words, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Rows of one Arrow batch: whole texts cross to Python, so few at a time keep a worker's memory small.
BATCH_ROWS = 500


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches hold at most ``rows`` rows; the default of 10,000 long texts would not fit a worker."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: str | Column) -> Column:
    """Rows that no label is learnt from: every fifth by the CRC of the id's digits."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """``id, y, text, h`` of at most ``rows`` labelled documents that are not held out, the first ones in a seeded order.

    Only ids and labels are ordered; the chosen ids (16 bytes each) are broadcast, so texts are not shuffled.
    """
    known = labels.where(~held_out(id_col) & F.col(label).isNotNull()).groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.select(F.col(id_col).alias("id"), "y", F.xxhash64(F.lit(seed), id_col).alias("h")).orderBy("h", "id").limit(rows)
    return docs.select(docs[id_col].alias("id"), whole_text(docs[text_col]).alias("text")).join(F.broadcast(chosen), "id")
