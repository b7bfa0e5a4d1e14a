"""Stages on a small corpus, each against what its contract keeps."""

import corpus_pipeline
from pyspark.sql import functions as F

from ledgerline.llm import mixing, secret_scan, simhash

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    outs = []
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, FOLDER).cache()
        outs.append(now)
        assert now.count() and (name == "bpe" or now.columns == docs.columns)
    clean, single, redacted, mixed, coded = outs
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = labels.join(clean, "doc_id", "left_semi").groupBy("toxic").count().collect()
    total = {r["toxic"]: r["count"] for r in labels.join(docs, "doc_id", "left_semi").groupBy("toxic").count().collect()}
    left = {r["toxic"]: r["count"] for r in kept}
    assert left[0] >= 0.98 * total[0] and left.get(1, 0) <= 0.5 * total[1]

    groups = simhash.simhash_near_duplicates(clean)
    want = {r["component_id"] for r in groups.collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    assert redacted.count() == single.count()
    again = secret_scan.scan_secrets(redacted)
    assert again.where(F.size(F.filter("spans", lambda s: s["kind"] < 3)) > 0).count() == 0
    changed = single.join(redacted.select("doc_id", F.col("text").alias("t")), "doc_id").where("text <> t")
    assert 0 < changed.count() and changed.where(~F.col("t").contains("[SECRET]")).count() == 0

    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_documents(redacted).collect() if r["size"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in taken.items() if n}
    assert coded.count() == mixed.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 50
