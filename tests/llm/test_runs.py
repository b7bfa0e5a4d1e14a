"""Periodic runs against a plain scan of every period, and the query against its contract."""

import hashlib
import random
import re
import zlib

from ledgerline.llm import runs
from ledgerline.llm.queries import QUERIES

from helpers import documents, nothing, odd


def plain(words):
    """Runs of one text by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def digest(doc_id, text):
    """The row of the query for one document, from the words of its contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain(words)
    kept = [True] * n
    for s, size, q in found:
        kept[s + q : s + size] = [False] * (size - q)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha("".join(f"{s},{z},{q}\n" for s, z, q in found)), sha(" ".join(w for w, k in zip(words, kept, strict=True) if k)))


def made(seed, size):
    rnd, out = random.Random(seed), []
    while len(out) < size:
        kind = rnd.random()
        if kind < 0.4:
            out += rnd.choices("abcdefgh", k=rnd.randint(1, 30))
        elif kind < 0.8:
            unit = rnd.choices("ab" if rnd.random() < 0.5 else "abcdefghijk", k=rnd.randint(1, 25))
            out += (unit * rnd.randint(2, 9))[: -rnd.randint(1, len(unit))]
        elif out:
            at = rnd.randrange(len(out))
            out += out[at : at + 40]
    return out


def test_runs_of_made_texts():
    texts = [made(s, size) for s in range(60) for size in (0, 20, 60, 200, 500)]
    texts += [["a"] * 3000, ["a", "b"] * 700 + ["a"] * 100, ["a"] * 23, ["a"] * 24, list("abcdefgh") * 3, list("abcdefgh") * 3 + ["a"], [str(i) for i in range(900)] * 3, list("aab" * 8 + "aac" * 8)]
    got = runs.runs_of([[w.encode() for w in t] for t in texts])
    assert got == [plain(t) for t in texts]
    assert sum(map(len, got)) > 100


def test_rules_are_used_once_and_cover_the_text():
    import numpy as np

    ids = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 4, 1, 2], np.int64)
    rounds, start = runs.grammar(ids, np.zeros(len(ids), np.int64))
    for rule, a, b, c in rounds:
        assert (a < b).all() and (b < c).all()
        for r in np.unique(rule):
            at = np.flatnonzero(rule == r)
            assert len({tuple(ids[a[i] : c[i]]) for i in at}) == 1
    assert len(start) < len(ids) and start[0] == 0


def test_equal_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(runs, "mixed", lambda x: (x % 2).astype("uint64"))
    texts = [made(s, 120) for s in range(20)]
    found = runs.runs_of([[w.encode() for w in t] for t in texts])
    for t, got in zip(texts, found, strict=True):
        assert all(t[s : s + n - q] == t[s + q : s + n] for s, n, q in got)


def test_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect() if r["doc_id"] != 4]
    got = [tuple(r) for r in runs.digests(odd(spark)).collect()]
    # the plain scan takes too long for the very long text, which has no run
    assert sorted((r for r in got if r[0] != 4), key=str) == sorted((digest(*r) for r in rows), key=str)
    assert [r[:3] for r in got if r[0] == 4] == [(4, 0, None)]
    assert runs.digests(nothing(spark)).collect() == []


def test_long_text_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(runs, "MOST_WORDS", 50)
    rows = [(i, " \t".join(made(i, 300)), "a") for i in range(40)] + [(1000, "ab cd " * 30_000, "a")]
    got = {r[0]: tuple(r) for r in runs.digests(documents(spark, rows)).collect()}
    assert got == {i: digest(i, t) for i, t, _ in rows[:-1]} | {1000: got[1000]}
    assert got[1000][1:6] == (1, 0, 60_000, 2, 30_000_000)


def test_query(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    short = [r for r in rows if len((r[1] or "").split()) < 1500]
    assert len(got) == len(rows) and len(short) > 150
    for i, text in short:
        assert got[i] == digest(i, text)
    assert sum(r[1] > 0 for r in got.values()) > 10
