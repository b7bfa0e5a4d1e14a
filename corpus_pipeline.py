"""A training corpus in five stages, each written as Parquet and read again as the documents of the next.

Rejected documents leave at ``toxicity``, all but one of each group of near-duplicates at ``simhash``; ``secrets`` replaces secrets in
the texts that stay; ``mixing`` repeats or leaves out documents so that sources meet their weights; ``bpe`` encodes the mix
and checks it by decoding.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import toxicity as tox
from ledgerline.llm.bpe import bpe_round_trip
from ledgerline.llm.common import small_batches, table, whole_text
from ledgerline.llm.mixing import mixed_rows
from ledgerline.llm.secret_scan import redact
from ledgerline.llm.simhash import keep_one_per_group
from ledgerline.session import materialize

TOXIC_FROM = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model is learnt from the labelled rows of ``sf_dir``."""
    small_batches(spark)
    model = tox.fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.withColumn("_score", tox.toxicity_score(whole_text("text"), model)).where(F.col("_score") < TOXIC_FROM).select(*docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (4-word shingles, at most 4 differing bits)."""
    return keep_one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` set anew."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: id, ``n_tokens``, packed ``ids`` and the SHA-256 of the decoded text."""
    coded = bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("secrets", secrets), ("mixing", mixing), ("bpe", bpe)]

#: No SQL expresses a trained classifier or BPE merging; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
