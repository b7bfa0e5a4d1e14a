"""Edited versions, likeness and recovered digests against brute force."""

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from helpers import LONG, documents, prose
from pyspark.sql import functions as F

from ledgerline.llm import fingerprints
from ledgerline.llm.queries import QUERIES


def paragraphs(text):
    seed, marked = 42, []
    for i, word in enumerate(words := text.split(" ")):
        seed = xxhash.xxh64_intdigest(words[i - 1].encode(), seed=42) if i else 42
        ends = xxhash.xxh64_intdigest(word.encode(), seed=seed) % (1 << fingerprints.CUT_BITS) == 0
        marked.append(word + "\n" if ends else word)
    return Counter(re.findall(rf"\A(?:[^\n ]{{1,{fingerprints.HEAD}}} ?){{1,4}}|[^\n]{{1,{fingerprints.PIECE}}}", " ".join(marked)))


def alike(a, b):
    x, y = paragraphs(a), paragraphs(b)
    every = sum((x | y).values())
    return sum((x & y).values()) / every if every else 1.0


def check(rows, texts):
    """``texts``: (id, text) in descending order of id."""
    got = {r["doc_id"]: r for r in rows}
    for i, (d, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(alike(text, edited)) and r["near_next"] == pytest.approx(alike(text, following))


def test_query(spark, folder):
    texts = sorted(((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()), reverse=True)
    rows = QUERIES["op10_document_fingerprints"](spark, folder).collect()
    check(rows, texts)
    prints = {}
    for r in rows:
        prints.setdefault(dict(texts)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_large_differences_and_repeats(spark):
    many = "\n".join(prose(i, 6) for i in range(400))
    rows = [(1, many), (2, many.replace("an", "AN", 30)), (3, "same\n" * 500), (4, "same\n" * 499), (5, LONG), (6, LONG[:-3000] + prose(3, 400)), (7, ""), (8, "😀é\n" * 50)]
    frame = documents(spark, [(i, t, "a") for i, t in rows])
    check(fingerprints.fingerprint_versions(frame).collect(), rows[::-1])
    single = documents(spark, [(1, "a b c\nd", "a")])
    check(fingerprints.fingerprint_versions(single).collect(), [(1, "a b c\nd")])


def test_peeling_recovers_digests(spark):
    frame = spark.sql("select transform(sequence(1, 40), x -> xxhash64(x)) as a, transform(sequence(11, 44), x -> xxhash64(x)) as b")
    cells = [fingerprints.sketch(F.col(c), 64) for c in "ab"]
    peeled = frame.select(fingerprints.peel(fingerprints.subtract(*cells), 64).alias("p"), F.sort_array(F.concat(F.array_except("a", "b"), F.array_except("b", "a"))).alias("want")).first()
    assert peeled["p"]["done"] and sorted(peeled["p"]["found"]) == list(peeled["want"])
    small = frame.select(fingerprints.difference(F.col("a"), F.col("b"), fingerprints.subtract(*[fingerprints.sketch(F.col(c), 4) for c in "ab"])).alias("d")).first()
    assert sorted(small["d"]) == list(peeled["want"])


@pytest.mark.parametrize("change", [lambda t: "x" + t, lambda t: t[: len(t) // 2] + "x" + t[len(t) // 2 :], lambda t: "one more " + t, lambda t: t + "x"])
def test_small_changes_leave_the_rest_alike(spark, change):
    text = prose(11, 1500)
    rows = [(1, change(text)), (2, text)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_versions(documents(spark, [(i, t, "a") for i, t in rows])).collect()}
    assert got[2]["near_next"] == pytest.approx(alike(text, change(text))) and got[2]["near_next"] > 0.9


def test_a_long_word_is_cut_by_length(spark):
    rows = [(1, "ab" * 30_000), (2, "ab" * 30_000 + " end"), (3, " " * 5000), (4, " ")]
    check(fingerprints.fingerprint_versions(documents(spark, [(i, t, "a") for i, t in rows])).collect(), rows[::-1])
