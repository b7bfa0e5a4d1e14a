"""Every operator takes NULL, empty and very long texts, repeated rows, clashing column names and empty tables."""

import public_tokenizers
import pytest
from helpers import ODD, nothing, odd
from pyspark.sql import functions as F

from ledgerline.llm import fingerprints, mixing, quality, secret_scan, simhash, token_counts, toxicity
from ledgerline.llm.bpe import bpe_round_trip


def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 0, 1), (9, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


PER_ROW = {
    "fingerprints": lambda s, d: fingerprints.fingerprint_versions(d),
    "secrets": lambda s, d: secret_scan.scan_secrets(d),
    "redact": lambda s, d: secret_scan.redact(d),
    "simhash": lambda s, d: simhash.simhash_near_duplicates(d),
    "quality": lambda s, d: quality.score_documents(d, labels(s)),
    "toxicity": lambda s, d: toxicity.score_documents(d, labels(s)),
    "bpe": lambda s, d: bpe_round_trip(d, public_tokenizers.path("word_bpe_49k.json")),
    "mixing": lambda s, d: mixing.mix_documents(d),
    "tokens": lambda s, d: token_counts.count_tokens(d, public_tokenizers.path("piece_bpe_32k.model")),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_per_row(spark, name):
    got = PER_ROW[name](spark, odd(spark)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, *_ in ODD)


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, nothing(spark)).collect() == []


def test_stages_keep_columns(spark):
    docs = odd(spark)
    assert simhash.keep_one_per_group(docs).columns == mixing.mixed_rows(docs).columns == docs.columns
    assert simhash.keep_one_per_group(nothing(spark)).count() == mixing.mixed_rows(nothing(spark)).count() == 0


def test_defined_values(spark):
    docs = odd(spark)
    prints = {r["doc_id"]: r for r in simhash.simhash_near_duplicates(docs).collect()}
    assert prints[1]["fingerprint"] == prints[2]["fingerprint"] == prints[3]["fingerprint"] == "0" * 16
    assert {prints[i]["component_id"] for i in (1, 2, 3)} == {1} and prints[7]["component_id"] == 6
    coded = {r["doc_id"]: r for r in bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert [coded[i]["n_tokens"] for i in (1, 2, 3)] == [0, 0, 0] and coded[1]["decoded"] == ""
    scores = quality.score_documents(docs, labels(spark)).where(F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1))
    assert scores.count() == 0
    alike = {r["doc_id"]: r for r in fingerprints.fingerprint_versions(docs).collect()}
    assert alike[6]["fingerprint"] == alike[7]["fingerprint"] and alike[7]["near_next"] == 1.0
