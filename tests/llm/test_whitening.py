"""Whitened components against a dense eigendecomposition, with awkward spectra and odd vectors."""

import math

import numpy as np
import pytest

from ledgerline.llm import whitening
from ledgerline.llm.queries import QUERIES
from ledgerline.session import materialize

SCHEMA = "vec_id long, embedding array<double>, label int, n string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def dense(rows):
    """Ids, whole vectors, eigenvalues and eigenvectors by falling eigenvalue."""
    kept = [(i, [math.floor(1024 * x) + 100_000 for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([v for _, v in kept], np.int64)
    centred = (len(x) * x - x.sum(axis=0)) / len(x)
    e, u = np.linalg.eigh(centred.T @ centred / len(x))
    return [i for i, _ in kept], x, centred, e[::-1], u[:, ::-1]


def compare(got, rows, count=8, tol=1e-8):
    ids, x, centred, e, u = dense(rows)
    count = min(count, x.shape[1])
    n = len(x)
    assert len(got) == n * count and {r["n"] for r in got} == {n}
    want = centred @ u[:, :count] / np.sqrt(e[:count])
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    for c, part in by.items():
        part = sorted(part, key=lambda r: (r["vec_id"], r["whitened"]))
        order = np.argsort(ids, kind="stable")
        have, there = np.array([r["whitened"] for r in part]), want[order, c - 1]
        assert min(np.abs(have - there).max(), np.abs(have + there).max()) < tol
        assert [r["deviation"] for r in part] == deviation[order].tolist()
        assert abs(part[0]["explained"] - e[c - 1] / e.sum()) < 1e-9
    assert got[0]["identity_error"] < 1e-9 and got[0]["residual"] <= 1e-11 * e[0]


@pytest.mark.parametrize("dim", [3, 20])
def test_against_a_dense_solver(spark, dim):
    rnd = np.random.default_rng(dim)
    x = rnd.normal(size=(400, dim)) * np.linspace(2, 0.5, dim)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    compare(whitening.whitened(frame(spark, rows)).collect(), rows)


def listed(spark, x):
    rows = spark.createDataFrame([([int(c) for c in v],) for v in x], "x array<long>")
    return whitening.Rows(materialize(rows.coalesce(2)), len(x), x.sum(axis=0))


def test_filter_alone_and_widened(spark):
    """A narrow block on a nearly flat spectrum converges by filtering; one on equal eigenvalues is widened."""
    rnd = np.random.default_rng(5)
    x = np.floor(1024 * rnd.normal(size=(3000, 40)) * np.linspace(1.1, 1.0, 40)).astype(np.int64)
    rows = listed(spark, x)
    e = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    found = whitening.leading(rows, 3, guards=9)
    assert found.residual <= 1e-11 * e[0] and np.allclose(found.values, e[:3], rtol=1e-12) and found.passes > 8
    same = np.concatenate([np.eye(30, dtype=np.int64), -np.eye(30, dtype=np.int64)]) * 1000
    rows = listed(spark, same)
    found = whitening.leading(rows, 3, guards=2)
    assert np.allclose(found.values, 1000**2 / 30) and found.residual < 1e-6


def test_odd_vectors(spark):
    rnd = np.random.default_rng(3)
    rows = [(i % 50, [float(c) for c in v]) for i, v in enumerate(rnd.normal(size=(120, 9)))]
    odd = [(900, None), (901, []), (902, [float("nan")] * 9), (903, [None] * 9), (904, [float("inf")] * 9), (905, [1.0, 2.0])]
    got = whitening.whitened(frame(spark, rows + odd)).collect()
    distinct = {r["vec_id"] for r in got}
    assert distinct == set(range(50)) and len(got) == 120 * 8
    _, x, centred, e, u = dense(rows)
    assert sorted(round(abs(r["whitened"]), 6) for r in got if r["component"] == 1) == sorted(round(abs(w), 6) for w in centred @ u[:, 0] / np.sqrt(e[0]))


def test_rows_without_variance_and_no_rows(spark):
    one = whitening.whitened(frame(spark, [(1, [0.5, 1.5])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(one, key=lambda r: r["component"])] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    got = whitening.whitened(frame(spark, line)).collect()
    assert {r["component"]: r["whitened"] is None for r in got} == {1: False, 2: True, 3: True}
    assert got[0]["identity_error"] < 1e-9
    assert whitening.whitened(frame(spark, [])).collect() == [] == whitening.whitened(frame(spark, [(1, None)])).collect()


def test_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    compare(QUERIES["op11_embedding_whitening"](spark, folder).collect(), rows)
