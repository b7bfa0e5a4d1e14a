"""Periodic runs of words, found on a Re-Pair grammar of each text.

The word ids of a text are compressed by Re-Pair in rounds: a pair of neighbouring symbols that occurs twice or more becomes
a new symbol. A round replaces, at once for all texts of a batch, every occurrence of a pair that is more frequent than the pairs
that overlap it (so the most frequent pair of each text always goes), and rounds end when no pair occurs twice. Each symbol is
one rule; the symbols that remain are joined two by two, level by level, into one root per text. A run is inside the smallest node that
holds it and crosses the boundary between that node's two halves, so per rule only runs across its own boundary are computed, once, and the intervals are moved to
every place where the rule was used. Intervals of several nodes are merged: of those with the same period only the ones that no other contains stay.

Across a boundary ``b`` at least half of a run lies on one side. There the word window that starts (or ends) at ``b`` recurs one period
on; all periods of all boundaries of a level are tried as arrays, by prefix hashes of the word ids, and reach left and right is a binary
search on the same hashes. Every interval is then compared word by word, so a collision of hashes changes nothing.

Defined results: NULL and empty texts have no words, no runs and the hash of the empty string; a NULL id gives a NULL ``doc_id`` row; repeated rows
give repeated results; an empty table gives an empty table; other columns of the table are not read. Texts of any length are taken
whole: a batch is cut between texts only, after ``MOST_WORDS`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import small_batches, whole_text

#: Least length of a run in words, and least number of periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Texts are worked on together until they hold so many words.
MOST_WORDS = 150_000
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
#: Odd multiplier of the prefix hash.
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Word ids spread over 64 bits."""
    z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Words:
    """Word ids of several texts one after the other, with hashes of all windows."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids, n = ids, len(ids)
        self.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE))])
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(ids) * self.powers[:n])])

    def same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the hashes of the windows of ``size`` words at ``i`` and ``j >= i`` agree."""
        return (self.sums[i + size] - self.sums[i]) * self.powers[j - i] == self.sums[j + size] - self.sums[j]

    def ahead(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``j`` on agree, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            good = self.same(i, j, mid)
            low, high = np.where(open_ & good, mid, low), np.where(open_ & ~good, mid - 1, high)
        return low

    def behind(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``i`` and ``j`` agree, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            good = self.same(i - mid, j - mid, mid)
            low, high = np.where(open_ & good, mid, low), np.where(open_ & ~good, mid - 1, high)
        return low


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ragged lists of these lengths: the list of each entry, and its place in it."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def grammar(ids: np.ndarray, doc: np.ndarray) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
    """Re-Pair of each text.

    Returns per round ``(rule, start, boundary, stop)`` of every place where a rule was used, and the first words of
    the symbols that remain. Ids are made different between texts, so a pair of neighbours in two texts occurs once.
    """
    n = len(ids)
    span = np.int64(ids.max(initial=0) + 1)
    symbol = np.unique(doc * span + ids, return_inverse=True)[1].astype(np.int64)
    start, fresh = np.arange(n), symbol.max(initial=-1) + 1
    live = np.ones(max(n - 1, 0), bool)
    rounds = []
    while live.any():
        at = np.flatnonzero(live)
        pair, of, count = np.unique(symbol[at] * fresh + symbol[at + 1], return_inverse=True, return_counts=True)
        # rank of each pair: more frequent first, ties in a mixed order
        rank = np.zeros(len(symbol) + 1, np.int64)
        order = np.lexsort((mixed(pair), count))
        place = np.empty(len(pair), np.int64)
        place[order] = np.arange(1, len(pair) + 1)
        rank[at + 1] = np.where(count[of] > 1, place[of], 0)
        mine, left, right = rank[1:-1], rank[:-2], rank[2:]
        best = (mine > 0) & (mine >= left) & (mine >= right)
        # a run of one pair with itself (a a a ...): every second one
        chain = best & (mine == left)
        first = np.maximum.accumulate(np.where(best & ~chain, np.arange(len(best)), 0))
        best &= (np.arange(len(best)) - first) % 2 == 0
        chosen = np.flatnonzero(best)
        if not chosen.size:
            break
        stops = np.append(start[1:], n)
        names, rule = np.unique(mine[chosen], return_inverse=True)
        rounds.append((rule, start[chosen], start[chosen + 1], stops[chosen + 1]))
        symbol[chosen] = fresh + rule
        fresh += len(names)
        # a pair can repeat later only if it repeats now or holds a new symbol
        new, stays, keep = np.zeros(len(symbol), bool), np.append(mine > 0, False), np.ones(len(symbol), bool)
        new[chosen], keep[chosen + 1] = True, False
        symbol, start, new = symbol[keep], start[keep], new[keep]
        live = stays[keep][:-1] | new[:-1] | new[1:]
    return rounds, start


def across(words: Words, start: np.ndarray, mid: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(node, start, stop, period)`` of the runs across the boundary ``mid`` of each node, as long as they are inside it."""
    found = []
    for side in (1, -1):
        # at least half of the run, and so 1.5 periods of it, lies on this side
        room = stop - mid if side > 0 else mid - start
        most = np.minimum(2 * room // LEAST_PERIODS, (stop - start) // LEAST_PERIODS)
        most[room < LEAST_WORDS // 2] = 0
        node, q = spread(np.maximum(most, 0))
        if not node.size:
            continue
        q = q + 1
        here = mid[node]
        near = words.ids
        # the word beside the boundary first: it settles most periods
        good = near[here] == near[here + q] if side > 0 else near[here - 1] == near[here - 1 - q]
        node, q, here = node[good], q[good], here[good]
        size = np.maximum(LEAST_WORDS // 2, (LEAST_PERIODS * q + 1) // 2) - q
        fits = size + q <= room[node]
        node, q, here, size = node[fits], q[fits], here[fits], size[fits]
        low = here if side > 0 else here - q - size
        good = words.same(low, low + q, size)
        node, q, here = node[good], q[good], here[good]
        i = here if side > 0 else here - q
        begin = i - words.behind(i, i + q, i - start[node])
        end = i + q + words.ahead(i, i + q, stop[node] - i - q)
        long_ = end - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append((node[long_], begin[long_], end[long_], q[long_]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    node, begin, end, q = (np.concatenate(x) for x in zip(*found, strict=True))
    # multiples of a period cover the same words
    order = np.lexsort((q, end, begin, node))
    node, begin, end, q = node[order], begin[order], end[order], q[order]
    first = np.ones(len(node), bool)
    first[1:] = (node[1:] != node[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return node[first], begin[first], end[first], q[first]


def intervals(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(doc, start, stop, period)`` in order of the runs of several texts, positions counted over all of them."""
    n, doc = len(ids), np.repeat(np.arange(len(lengths)), lengths)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    words, parts = Words(ids), []
    rounds, start = grammar(ids, doc)
    for rule, a, b, c in rounds:
        once = np.unique(rule, return_index=True)[1]
        once = once[c[once] - a[once] >= LEAST_WORDS]
        node, begin, end, q = across(words, a[once], b[once], c[once])
        if node.size:
            # every place where the rule was used
            order = np.argsort(rule, kind="stable")
            want = rule[once[node]]
            lo, hi = np.searchsorted(rule[order], want), np.searchsorted(rule[order], want, side="right")
            of, nth = spread(hi - lo)
            shift = a[order[lo[of] + nth]] - a[once[node]][of]
            parts.append((begin[of] + shift, end[of] + shift, q[of]))
    ends = np.cumsum(lengths)
    while True:
        own = doc[start]
        begin_of = np.searchsorted(own, own)
        odd = (np.arange(len(start)) - begin_of) % 2 == 1
        if not odd.any():
            break
        right = np.flatnonzero(odd)
        after = np.append(start[1:], n)[right]
        a, b, c = start[right - 1], start[right], np.minimum(after, ends[own[right]])
        wide = c - a >= LEAST_WORDS
        _, begin, end, q = across(words, a[wide], b[wide], c[wide])
        parts.append((begin, end, q))
        start = start[~odd]
    begin, end, q = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    # word by word: a run may be shorter than its hashes said
    sound = [i for i, (s, e, p) in enumerate(zip(begin, end, q, strict=True)) if np.array_equal(ids[s : e - p], ids[s + p : e])]
    begin, end, q = begin[sound], end[sound], q[sound]
    own = doc[begin]
    order = np.lexsort((-end, begin, q, own))
    own, begin, end, q = own[order], begin[order], end[order], q[order]
    keep, group, reach = np.zeros(len(own), bool), None, 0
    for i, key in enumerate(zip(own, q, strict=True)):
        if key != group:
            group, reach = key, -1
        keep[i] = end[i] > reach
        reach = max(reach, end[i])
    own, begin, end, q = own[keep], begin[keep], end[keep], q[keep]
    order = np.lexsort((q, end, begin, own))
    own, begin, end, q = own[order], begin[order], end[order], q[order]
    first = np.ones(len(own), bool)
    first[1:] = (own[1:] != own[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return own[first], begin[first], end[first], q[first]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Per text the runs ``(start, length, period)`` by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    ids = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.cumsum(lengths) - lengths
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, s, e, q in zip(*(x.tolist() for x in intervals(ids, lengths)), strict=True):
        out[d].append((s - int(first[d]), e - s, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(w for w, k in zip(words, kept.tolist(), strict=True) if k)


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact number of periods; ties go to the smallest start, then period."""
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


def results(ids: list, texts: list[list[bytes]]) -> Iterator[dict]:
    for i, words, runs in zip(ids, texts, runs_of(texts), strict=True):
        top = best(runs)
        one = dict(zip(("start", "length", "period"), top or (None,) * 3, strict=True))
        yield {
            "doc_id": i, "n_words": len(words), "n_runs": len(runs), **one, "exponent_milli": 1000 * top[1] // top[2] if top else None,
            "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], "collapsed": collapsed(words, runs).decode(),
        }


def periodic_runs(docs: DataFrame, text: Column, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ``n_words``, ``n_runs``, the run with most periods, all ``runs``, and ``collapsed`` (the text without repeats)."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.cast("binary").alias("text")).mapInArrow(by_text, SCHEMA)


def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    numbers = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli"]
    schema = pa.schema([*((c, pa.int64()) for c in numbers), ("runs", pa.list_(run)), ("collapsed", pa.string())])
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = value.as_py().split() if value.is_valid else []
            if ids and held + len(words) > MOST_WORDS:
                yield pa.RecordBatch.from_pylist(list(results(ids, texts)), schema)
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(words)
            held += len(words)
        if ids:
            yield pa.RecordBatch.from_pylist(list(results(ids, texts)), schema)


def edited(text: Column, doc_id: Column) -> Column:
    """The text whose words from a seeded place on repeat a seeded period, for one in ten ids; else the text as it is.

    With ``h`` the CRC-32 of the decimal id and ``g = h div 10``: if ``h % 10 = 0``, word ``i >= a`` becomes word
    ``a + (i - a) % p`` with ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. Words are the parts between blanks and control
    characters 9 to 13; the edited text joins them by one space. A NULL id changes nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words).cast("long")
    a = g % F.greatest(n, F.lit(1))
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    # the tail is one period, repeated, cut to length
    head, period = F.slice(words, F.lit(1), a.cast("int")), F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (n - a).cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, tail), " ")).otherwise(text)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the digest columns of the runs of the edited text."""
    small_batches(docs.sparkSession)
    found = periodic_runs(docs, edited(whole_text(docs[text_col]), docs[id_col]), id_col)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    )
