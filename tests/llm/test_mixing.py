"""Targets and flows against brute force, selection near its targets."""

import random
from collections import defaultdict

import pytest
from helpers import documents, prose
from pyspark.sql import functions as F

from ledgerline.llm import mixing
from ledgerline.llm.queries import QUERIES


def brute_targets(sizes, total):
    """Raise the common unit step by step: a source takes weight times unit, at most three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(weight[s] * mid, 3 * sizes[s]) for s in names) < total else (low, mid)
    return {s: min(weight[s] * high, 3 * sizes[s]) for s in names}


def test_targets():
    rnd = random.Random(1)
    for _ in range(50):
        sizes = {s: rnd.choice([0, 3, 50, 4000]) for s in ["é", "z", "a", "B", None]}
        total = sum(sizes.values())
        got, want = mixing.targets(sizes, mixing.WEIGHTS, total), brute_targets(sizes, total)
        assert all(got[s] == pytest.approx(want[s], abs=1e-3) for s in sizes)


def test_flow_is_cheapest():
    """Two sources share documents; first uses go before repeats, and all quotas that can be met are met."""
    capacity = {'["a"]': 10, '["b"]': 10, '["a","b"]': 10}
    members = {'["a"]': ["a"], '["b"]': ["b"], '["a","b"]': ["a", "b"]}
    flow = mixing.min_cost_flow(capacity, members, {"a": 20, "b": 10})
    assert sum(n for (_, s), n in flow.items() if s == "a") == 20 and sum(n for (_, s), n in flow.items() if s == "b") == 10
    used = defaultdict(int)
    for (p, _), n in flow.items():
        used[p] += n
    assert used == {'["a"]': 10, '["b"]': 10, '["a","b"]': 10}
    far = mixing.min_cost_flow(capacity, members, {"a": 100, "b": 0})
    assert sum(far.values()) == 60


def test_overlapping_sources(spark):
    rows = [(i, prose(i, 20 + i % 30), ["a", "b", "c"][i % 3]) for i in range(300)]
    docs = documents(spark, rows)
    memberships = F.when(F.col("doc_id") % 2 == 0, F.array("source", F.lit("web"))).otherwise(F.array("source"))
    items = mixing.mixing_items(docs, memberships).select(F.col("_size").alias("size"), F.col("_pattern").alias("pattern"), F.col("_h").alias("h")).cache()
    plan, shares, flow = mixing.mixing_plan(items)
    taken = {r["pattern"]: r["n"] for r in mixing.with_copies(items, plan).groupBy("pattern").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()}
    for p, n in taken.items():
        assert abs(n - sum(v for (q, _), v in flow.items() if q == p)) <= 25
    for r in shares.collect():
        assert sum(v for (_, s), v in flow.items() if s == r["source"]) == pytest.approx(r["target"], abs=1)


@pytest.mark.parametrize("seed", [1, 2])
def test_gap_is_filled_until_nothing_fits(spark, seed):
    """Very long documents among short ones: what is missing in the end is less than any document left."""
    import random

    rnd = random.Random(seed)
    items = [(p, rnd.choice([1, 3, 40, 300, 9000]) + rnd.randrange(3), rnd.randrange(-(2**63), 2**63)) for p in ("x", "y", "z") for _ in range(400)]
    items += [items[0]] * 3
    frame = spark.createDataFrame(items, "pattern string, size long, h long")
    rest = {"x": 20_011, "y": 7_777, "z": 1}
    got = mixing.seeded_front(spark, frame, rest)
    for p, (fronts, fill) in got.items():
        units = {}
        for q, size, h in items:
            if q == p:
                units[h] = units.get(h, 0) + size
        one = {h: size for q, size, h in items if q == p}
        took = {h for h in units if any(a < h <= b and one[h] <= m for a, b, m in fronts)}
        gap = rest[p] - sum(units[h] for h in took)
        assert gap >= 0 and all(units[h] > gap for h in set(units) - took)
        nearest = min(abs(units[h] - gap) for h in set(units) - took)
        assert len(fill) == (gap > 0 and nearest < gap)


def test_query(spark, folder):
    rows = QUERIES["op8_mix_sources"](spark, folder).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = {d: len([w for w in (r["text"] or "").replace("\x0b", " ").split()]) for d, r in docs.items()}
    of = defaultdict(int)
    for d, r in docs.items():
        of[r["source"]] += sizes[d]
    want = brute_targets(of, sum(of.values()))
    taken = defaultdict(int)
    for r in rows:
        s = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (sizes[r["doc_id"]], of[s]) and r["target"] == pytest.approx(want[s], rel=1e-6) and r["taken"] in [k * r["size"] for k in range(4)]
        taken[s] += r["taken"]
    for s in of:
        assert abs(taken[s] - want[s]) <= max(sizes[d] for d, r in docs.items() if r["source"] == s) / 2
    again = QUERIES["op8_mix_sources"](spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    mixed = mixing.mixed_rows(spark.read.parquet(f"{folder}/documents.parquet")).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] * sizes[r["doc_id"]] for r in mixed if sizes[r["doc_id"]]} == {r["doc_id"]: r["taken"] for r in rows if r["taken"]}
