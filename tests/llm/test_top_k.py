"""Exact top-k against sorted integer products, with ties, copies and odd vectors."""

import math

import numpy as np
import pytest

from ledgerline.llm import top_k
from ledgerline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string"


def brute(rows, asks, k=10):
    sound = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in sound:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in sound if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def answers(spark, rows, condition, k=10):
    return sorted(tuple(r) for r in top_k.top_inner_products(frame(spark, rows), condition, k).collect())


def test_odd_vectors_ties_and_copies(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.integers(-3, 4, 6) / 4]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(30)] + [(500, None), (501, []), (502, [0.0] * 6), (503, [float("nan")] * 6), (504, [None] * 6), (505, [1.0, 2.0]), (510, [3.0, 4.0]), (None, [9.0] * 6)]
    rows += [(600, [1e5, -1e5, 0.25, 0.0, 1e-9, -1e-9]), (610, [-1e5, 1e5, 3.0, 1.0, 2.0, 1.0])]
    from pyspark.sql import functions as F

    assert answers(spark, rows, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)
    # a repeated query row answers once per row, a repeated candidate is one candidate per row
    twice = rows[:20] + [rows[0]] + [rows[5]] * 3
    assert answers(spark, twice, F.col("vec_id") == 0) == brute(twice, lambda i: i == 0)
    assert answers(spark, rows[:3], F.lit(True)) == brute(rows[:3], lambda i: True)
    assert answers(spark, [], F.lit(True)) == []


def test_many_blocks_and_parts(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 70), ("QUERY_ROWS", 5), ("QUERIES_A_TASK", 10)):
        monkeypatch.setattr(top_k, name, value)
    from pyspark.sql import functions as F

    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=24) * 10.0 ** rnd.integers(-3, 3)]) for i in range(900)]
    assert answers(spark, rows, F.col("vec_id") % 20 == 0, 7) == brute(rows, lambda i: i % 20 == 0, 7)


@pytest.mark.parametrize("scale", [1, 40, 3_000, 2_000_000])
def test_slices_narrow_the_rows_and_lose_none(scale):
    rnd = np.random.default_rng(scale)
    values = rnd.integers(-scale, scale + 1, (2_000, 16))
    slices, cut = top_k.build(values)
    query = rnd.integers(-scale, scale + 1, 16)
    total = top_k.scores(slices, query)
    offset = (values - values.min(axis=0)) >> cut
    want = np.where(query < 0, 2**top_k.SLICES - 1 - offset, offset) @ np.abs(query)
    got = sum((np.unpackbits(t.view(np.uint8), bitorder="little")[:2_000].astype(object) << i for i, t in enumerate(total) if t is not None), np.zeros(2_000, object))
    assert (got == want).all()
    rows = top_k.bitmap(np.ones(2_000, bool))
    assert top_k.kth(total, rows, 10) == np.sort(want)[-10]
    assert (top_k.members(top_k.at_least(total, rows, int(np.sort(want)[-10]))) == np.flatnonzero(want >= np.sort(want)[-10])).all()


def test_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op12_exact_top_k"](spark, folder).collect()) == brute(rows, lambda i: i % 100 == 0)
