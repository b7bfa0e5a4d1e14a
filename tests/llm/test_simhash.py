"""Fingerprints and components against brute force; masks cover every pair within the radius."""

import itertools
import random

import xxhash
from helpers import documents, prose

from ledgerline.llm import simhash
from ledgerline.llm.components import connected_components
from ledgerline.llm.queries import QUERIES


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """``prints``: list of (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= radius and find(i) != find(j):
            root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(d)
    return {d: min(g) for g in groups.values() for d in g}


def test_masks_cover():
    masks = simhash.covering_masks(3)
    rnd = random.Random(2)
    for _ in range(2000):
        differing = sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 3)))
        assert any(not (m & differing) for m in masks)


def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = [(d, brute_print(t)) for d, t in texts.items()]
    groups, of = brute_components(prints, 4), dict(prints)
    for r in QUERIES["op4_simhash_near_duplicates"](spark, folder).collect():
        assert (int(r["fingerprint"], 16), r["component_id"]) == (of[r["doc_id"]], groups[r["doc_id"]])


def test_chains_and_hot_buckets(spark):
    """Near fingerprints in chains, in one bucket that is cut into many blocks."""
    rnd = random.Random(9)
    prints = []
    for centre in (rnd.getrandbits(64) for _ in range(6)):
        fp = centre
        for _ in range(60):
            fp ^= sum(1 << b for b in rnd.sample(range(8), rnd.randint(0, 5)))
            prints.append(fp)
    rows = [(i + 1, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(prints)]
    got = simhash.fingerprint_components(spark.createDataFrame(rows, "id long, fp long"), radius=4, block=16).collect()
    want = brute_components([(i + 1, fp) for i, fp in enumerate(prints)], 4)
    component = {r["fp"] % (1 << 64): r["component"] for r in got}
    assert {i + 1: component[fp] for i, fp in enumerate(prints)} == want


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rnd.randint(2000, 2300), rnd.randint(2000, 2300)) for _ in range(200)] + [(None, 5), (7, 7)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            root[find(a)] = find(b)
    assert set(got) == set(root)
    for a, b in itertools.islice(itertools.combinations(sorted(got), 2), 60_000):
        assert (got[a] == got[b]) == (find(a) == find(b))


def test_one_per_group_stays(spark):
    text = prose(4, 400)
    near = text.replace(text.split(" ")[100], "changed", 1)
    rows = [(3, text, "a"), (2, text, "b"), (9, near, "a"), (4, prose(5, 300), "a"), (4, prose(5, 300), "a")]
    kept = simhash.keep_one_per_group(documents(spark, rows)).collect()
    groups = brute_components([(d, brute_print(t)) for d, t, _ in rows], 4)
    assert sorted(r["doc_id"] for r in kept) == sorted(set(groups.values()))


def test_masked_rows_stay_off_the_driver(spark, monkeypatch):
    """Spark sizes the masked rows like the points, so a broadcast of them would be planned far above its threshold."""
    plans, write = {}, simhash.materialize

    def record(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label)

    monkeypatch.setattr(simhash, "materialize", record)
    found = simhash.fingerprint_components(spark.createDataFrame([(i, i // 2) for i in range(64)], "id long, fp long"))
    assert {r["component"] for r in found.collect()} == {0}
    assert "Generate" in plans["simhash-members"] and "BroadcastExchange" not in plans["simhash-members"]
