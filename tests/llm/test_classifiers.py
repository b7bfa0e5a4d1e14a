"""Held-out accuracy of both classifiers, and what the counterfactual penalty changes."""

import random
import zlib

from helpers import documents, prose
from pyspark.sql import functions as F

from ledgerline.llm import toxicity
from ledgerline.llm.common import held_out
from ledgerline.llm.queries import QUERIES


def test_held_out_rows(spark):
    ids = [1, 5, 42, 10**12, -3]
    got = {r["doc_id"]: r["h"] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, label, least in (("op5_quality", "quality", 0.9), ("op6_toxicity", "toxic", 0.9)):
        scored = QUERIES[name](spark, folder)
        assert scored.count() == 1000 and scored.where("score < 0 or score > 1 or score is null").count() == 0
        right = scored.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
        assert right >= least


def biased(n=600):
    """Insults decide, but a group is mentioned more often beside insults."""
    rnd = random.Random(6)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = prose(i, 30).split(" ") + (["vilefool"] if toxic and rnd.random() < 0.6 else [])
        if rnd.random() < (0.7 if toxic else 0.05):
            words.append("muslims")
        rnd.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_counterfactual_penalty(spark):
    rows = biased()
    docs = documents(spark, [(i, t, "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    free = toxicity.fit_toxicity(docs, labels, counterfactual=0.0)
    fair = toxicity.fit_toxicity(docs, labels, counterfactual=100.0)
    neutral = spark.createDataFrame([(f"we met some muslims near the {prose(9000 + i, 8)}",) for i in range(50)], "text string")
    mean = lambda m: neutral.agg(F.avg(toxicity.toxicity_score(F.col("text"), m))).first()[0]
    assert mean(fair) < mean(free) / 2
    gap = lambda m: abs(m.weights["muslims"] - m.weights[toxicity.SWAPS["muslims"][0]])
    assert gap(fair) < gap(free) / 4
    assert fair.weights["vilefool"] > 0.5


def test_neutral_mentions_at_the_default(spark):
    """Neither the group of the labelled rows nor one that they lack is rejected for being mentioned."""
    rows = biased()
    docs = documents(spark, [(i, t, "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    terms = ["", "muslims", *toxicity.SWAPS["muslims"], "hindus", "women", "frauen", "vilefool"]
    texts = spark.createDataFrame([(t, f"{t} {around}") for t in terms for around in ("", "near the " + prose(9000, 8))], "term string, text string")
    scores = {(r["term"], r["text"]): r["s"] for r in texts.select("term", "text", toxicity.toxicity_score(F.col("text"), model).alias("s")).collect()}
    for (term, text), score in scores.items():
        plain = scores["", text[len(term) :] if text != f"{term} " else " "]
        assert score > 0.5 if term == "vilefool" else abs(score - plain) < 0.1 and score < 0.5, scores


def test_toxic_passage_of_a_long_text(spark):
    """A held-out toxic text is found among clean ones of many times its length, and clean joins stay clean."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    rows = docs.join(labels, "doc_id").where(held_out("doc_id") & F.col("toxic").isNotNull()).select("doc_id", "text", "toxic").orderBy("doc_id").collect()
    clean, toxic = ([r["text"] for r in rows if r["toxic"] == n and r["text"]] for n in (0, 1))
    rnd = random.Random(3)
    joins = [(n, kind) for n in (0, 20, 100) for kind in (0, 1) for _ in range(60)]
    made = [(n, kind, "\n".join([*(rnd.choice(clean) for _ in range(n // 2 + (n == 0 and not kind))), *([rnd.choice(toxic)] if kind else []), *(rnd.choice(clean) for _ in range(n // 2))])) for n, kind in joins]
    scored = spark.createDataFrame(made, "n int, kind int, text string").repartition(4).select("n", "kind", (toxicity.toxicity_score(F.col("text"), model) >= 0.5).cast("int").alias("p"))
    share = {(r["n"], r["kind"]): r["p"] for r in scored.groupBy("n", "kind").agg(F.avg("p").alias("p")).collect()}
    assert all(share[n, 1] >= share[0, 1] - 0.25 and share[n, 0] <= 0.05 for n in (20, 100)), sorted(share.items())
