"""Links and components against brute force, copies, odd vectors, and blocks of hot cells."""

import numpy as np

from ledgerline.llm import embedding_dedup
from ledgerline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, least=0.9):
    """Link counts per row, and components by smallest id, for (id, vector) rows."""
    sound = [v is not None and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    unit = [np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64)) if s else None for (_, v), s in zip(rows, sound, strict=True)]
    near = [[j for j, b in enumerate(unit) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= least] for i, a in enumerate(unit)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min([label[i], *(label[j] for j in js)])
            for k in [i, *js]:
                changed |= label[k] != low
                label[k] = min(label[k], low)
    return [len(j) for j in near], [min(rows[k][0] for k in range(len(rows)) if label[k] == x) for x in label]


def test_odd_vectors_and_copies(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(30, 16)).astype("f4")
    rows = [(i, list(map(float, base[i % 30] + 0.15 * rnd.normal(size=16).astype("f4")))) for i in range(150)]
    rows += [(200 + i, list(map(float, base[0]))) for i in range(40)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (304, [1.0, 2.0]), (305, [2.0, 4.0]), (306, []), (307, [float("inf")] * 16), (200, list(map(float, base[0])))]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    counts, components = brute(rows)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link_embeddings(frame).collect())
    assert got == sorted((i, n, c, i == c) for (i, _), n, c in zip(rows, counts, components, strict=True))
    assert embedding_dedup.link_embeddings(frame.limit(0)).collect() == []
    assert [tuple(r) for r in embedding_dedup.link_embeddings(frame.where("vec_id = 301")).collect()] == [(301, 0, 301, True)]


def test_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(60, 24))
    rows = [(i, list(map(float, base[min(i % 90, 59)] + 0.2 * rnd.normal(size=24)))) for i in range(600)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    counts, components = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_embeddings(frame).collect()}
    found, there = sum(n for n, _ in got.values()), sum(counts)
    assert there > 500 and found >= 0.99 * there
    exact = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_embeddings(frame, reach=float("inf")).collect()}
    assert exact == {i: (n, c) for (i, _), n, c in zip(rows, counts, components, strict=True)}


def test_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    counts, components = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op1_embedding_near_duplicates"](spark, folder).collect()}
    assert got == {i: (n, c) for (i, _), n, c in zip(rows, counts, components, strict=True)}


def test_no_link_is_lost_in_few_of_many_dimensions(spark, monkeypatch):
    """Vectors of 384 dimensions on a subspace of 4: steps between partners are no random directions."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 40)
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(800, 4)) @ np.linalg.qr(rnd.normal(size=(384, 4)))[0].T
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, n_links string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    counts = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.link_embeddings(frame).collect()}
    assert counts.sum() > 5000 and sum(got.values()) == counts.sum() and got == dict(enumerate(counts))


def test_isotropic_vectors_with_copies(spark, monkeypatch):
    """5,000 vectors of 64 even dimensions: many guests in every cell, few of them near a home vector."""
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(5000, 64)).astype("f4")
    x[4000:] = x[rnd.integers(0, 400, 1000)] + 0.05 * rnd.normal(size=(1000, 64))
    x[3990:4000] = x[0]
    rows = [(i, list(map(float, v)), 0, "x") for i, v in enumerate(x)]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: n for i, (n, _) in got.items()} == dict(enumerate((near.sum(axis=1) - 1).tolist()))
    assert all(got[j][1] == got[i][1] for i, j in zip(*np.nonzero(near), strict=True))
    # few blocks of a home cell and a hot group in one cell
    monkeypatch.setattr(embedding_dedup, "BLOCK", 300)
    again = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.link_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert again == got


def test_codes_bound_the_cosine():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(200, 30)) ** 3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code, step, error = embedding_dedup.codes(x)
    low = code.astype(float) * step[:, None]
    assert (np.linalg.norm(x - low, axis=1) <= error).all()
    assert (np.abs(x @ x.T - low @ low.T) <= error[:, None] * (1 + error) + (1 + 2 * error[:, None]) * error).all()
