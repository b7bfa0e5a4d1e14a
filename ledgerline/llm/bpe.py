"""BPE encoding and decoding by speculation: propose greedily, verify adjacent pairs, merge exactly only where that fails.

A word is cut by longest match into vocabulary tokens. A cut is the BPE result exactly when every two
neighbours are compatible: merging the symbols of both from scratch ends in just these two tokens. The
verdict on a pair does not depend on the word, so the pairs of a batch are checked together, as integer
arrays that walk down the merges of both tokens. Words with an incompatible pair are merged exactly.

Texts are cut at blanks by Arrow, and each distinct chunk of a batch is looked up once; the ids of all places
are gathered from there, and the decoded text is gathered from the ids.

Defined results: NULL counts as the empty text and gives no tokens; repeated rows give repeated rows; other
columns of the input are not read, so their names cannot clash; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import small_batches, whole_text

#: Chunks, and words, whose ids a worker remembers, and bytes of these ids; beyond either it keeps those of the last batch only.
KNOWN_WORDS, KNOWN_BYTES = 200_000, 32_000_000
# The letters and numbers among the lower-case characters up to U+00FF. The standard library's
# matcher knows no Unicode classes but is three times as fast on the texts that need none.
LATIN_LETTERS, LATIN_NUMBERS, BEYOND_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", re.compile("[^\x00-\xff]")
ALONE = 0xFFFF  # the low half of a pair code
NEVER, UNRANKED = 1 << 60, 1 << 30
SHORT_WORD, LONG_WORD = 64, 200
ROUND_WORDS = 20_000  # words merged in the same rounds; small enough for a processor's cache
START = 5  # letters that the longest match is bounded by


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = [chr(b) if b in set(plain) else "" for b in range(256)]
    for n, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + n)
    return out


def joined(parts: pa.LargeBinaryArray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    """The parts between two bounds joined to one value each; the data are not moved."""
    buffers, first = parts.buffers(), parts.offset
    at = np.frombuffer(buffers[1], np.int64)[first + bounds]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(at), buffers[2]])


def packed(tokens: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    """Values of so many tokens each, as little-endian unsigned 32-bit integers."""
    at = np.append(0, 4 * np.cumsum(lengths))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(tokens.astype("<u4"))])


class Known:
    """Packed ids by chunk or by word."""

    def __init__(self, learn: Callable[[list[str]], pa.LargeBinaryArray]):
        self.learn = learn
        self.row: dict[str, int] = {}
        self.packed = pa.array([], pa.large_binary())

    def rows(self, keys: list[str]) -> np.ndarray:
        """Where the keys lie in ``packed``; those not met before are learnt."""
        row = self.row
        if new := list(dict.fromkeys([k for k in keys if k not in row])):
            self.packed = pa.concat_arrays([self.packed, self.learn(new)])
            row.update(zip(new, range(len(row), len(self.packed)), strict=True))
        return np.fromiter(map(row.__getitem__, keys), np.int64, len(keys))

    def of(self, keys: list[str]) -> pa.LargeBinaryArray:
        """The packed ids of each key."""
        at = self.rows(keys)
        out = self.packed.take(pa.array(at))
        if len(self.row) > KNOWN_WORDS or self.packed.nbytes > KNOWN_BYTES:
            kept = dict(zip(keys, at.tolist(), strict=True))
            self.packed = self.packed.take(pa.array(kept.values(), pa.int64()))
            self.row = dict(zip(kept, range(len(kept)), strict=True))
        return out


class WordBpe:
    """Vocabulary, merges and verdicts of one tokenizer file (lower case, word-end suffix)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.merges: dict[int, int] = {}  # by pair code: rank and new token, packed
        self.halves: dict[int, tuple[int, int]] = {}
        self.made = np.zeros(max(self.token) + 1, np.int64)  # by token: one more than the rank of its merge; 0 for single symbols
        self.left, self.right = np.zeros_like(self.made), np.zeros_like(self.made)
        for rank, (a, b) in enumerate(model["merges"]):
            new, x, y = self.vocab[a + b], self.vocab[a], self.vocab[b]
            self.merges[x << 16 | y] = rank + 1 << 16 | new
            self.halves.setdefault(new, (x, y))
            self.made[new], self.left[new], self.right[new] = rank + 1, x, y
        # Walking down the merges needs one merge per token, after those of its halves; other files get no verdicts.
        halves = np.maximum(self.made[self.left], self.made[self.right])
        self.ordered = len(self.halves) == len(model["merges"]) and bool((halves < self.made)[self.made > 0].all())
        # Sorted pair codes and one more than their ranks; the code at the end is no pair and above all.
        self.pairs = np.array([*sorted(self.merges), NEVER], np.int64)
        self.ranks = np.array([*(self.merges[p] >> 16 for p in self.pairs[:-1].tolist()), UNRANKED], np.int64)
        self.by_rank = np.array([0, *(hit & ALONE for hit in self.merges.values())], np.int64)  # new tokens; in a file in order, ranks have no gaps
        self.by_letter, self.by_last_letter = np.zeros(512, np.int64), np.zeros(512, np.int64)
        for letter in byte_letters():
            self.by_letter[ord(letter)], self.by_last_letter[ord(letter)] = self.vocab[letter], self.vocab[letter + self.end]
        self.alone = np.full(len(self.made), -1, np.int8)  # by token: whether its symbols merge to it; -1: not tried
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(self.end)}
        self.last = {t.removesuffix(self.end): i for t, i in self.vocab.items() if t.endswith(self.end)}
        self.longest = max(map(len, self.vocab))
        self.reach: dict[str, int] = {}  # by the first letters: the longest token inside a word
        for t in self.inner:
            self.reach[t[:START]] = max(len(t), self.reach.get(t[:START], 0))
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # A line feed is a piece of its own: it stands between chunks that are cut together.
        self.piece = regex.compile(split["pattern"]["Regex"] + r"|\n")
        narrow = split["pattern"]["Regex"].replace(r"\p{L}", LATIN_LETTERS).replace(r"\p{N}", LATIN_NUMBERS).replace(r"\s", r"\t-\r \x85\xa0")
        self.latin = re.compile(narrow + r"|\n")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = dict(enumerate(byte_letters()))
        # Texts of the tokens, with a blank behind and, for the last token of a text, without.
        shown = [self.token.get(i, "") for i in range(len(self.made))]
        self.texts = pa.array([t + " " for t in shown] + shown, pa.large_string())
        self.words, self.chunks = Known(self.learn), Known(self.learn_chunks)

    def symbols(self, token: int) -> list[int]:
        """The single symbols that a token is merged from."""
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.halves:
                todo += reversed(self.halves[t])
            else:
                out.append(t)
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost among equals."""
        if len(ids) > LONG_WORD:
            return self.merge_long(ids)
        ids, get = list(ids), self.merges.get
        ranked = [get(a << 16 | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranked and (best := min(ranked)) < NEVER:
            i = ranked.index(best)
            new = best & ALONE
            ids[i : i + 2] = [new]
            del ranked[i]
            if i:
                ranked[i - 1] = get(ids[i - 1] << 16 | new, NEVER)
            if i < len(ranked):
                ranked[i] = get(new << 16 | ids[i + 1], NEVER)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for words whose length makes the plain search quadratic."""
        ids, n, get = list(ids), len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(hit, i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (hit := get(a << 16 | b))]
        heapq.heapify(heap)
        while heap:
            hit, i = heapq.heappop(heap)
            if ids[i] < 0 or (j := after[i]) >= n or get(ids[i] << 16 | ids[j]) != hit:
                continue
            ids[i], ids[j], after[i] = hit & ALONE, -1, after[j]
            if (k := after[i]) < n:
                before[k] = i
                if new := get(ids[i] << 16 | ids[k]):
                    heapq.heappush(heap, (new, i))
            if (k := before[i]) >= 0 and (new := get(ids[k] << 16 | ids[i])):
                heapq.heappush(heap, (new, k))
        return [x for x in ids if x >= 0]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the spelled word; single symbols always match."""
        out, i, n, longest = [], 0, len(word), self.longest
        inner, last, reach = self.inner.get, self.last.get, self.reach.get
        while n - i > longest or (hit := last(word[i:])) is None:
            j = min(n - 1, i + reach(word[i : i + START], START - 1))
            while (hit := inner(word[i:j])) is None:
                j -= 1
            out.append(hit)
            i = j
        out.append(hit)
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses from a left to a right token, where each is the merge of its own symbols.

        Going back in time, the token made last falls into its halves (the right one of two made at once), so all symbols
        that ever meet at the border are looked at. They merge if their rank comes before the merge that ends their meeting.
        """
        good = np.ones(len(a), bool)
        limit, where = np.full(len(a), UNRANKED), np.arange(len(a))
        while where.size:
            crossed = self.rank(a, b) < limit
            good[where[crossed]] = False
            made_a, made_b = self.made[a], self.made[b]
            more = ~crossed & ((made_a > 0) | (made_b > 0))
            of_a = made_a > made_b
            limit = np.where(of_a, made_a, made_b + 1)[more]
            a, b, where = np.where(of_a, self.right[a], a)[more], np.where(of_a, b, self.left[b])[more], where[more]
        return good

    def merge_all(self, numbers: np.ndarray, spelled: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Exact merging of many words at once: each round merges the first best pair of every word.

        Gives numbers of words, their tokens and how many each has. Long words, and files out of order, take one word at a time.
        """
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        first, last = self.inner.__getitem__, self.last.__getitem__
        by_length = np.argsort(lengths, kind="stable")
        short = int((lengths <= SHORT_WORD).sum()) if self.ordered else 0
        if len(others := by_length[short:]):
            merged = [self.merge([*map(first, spelled[k][:-1]), last(spelled[k][-1])]) for k in others.tolist()]
            sizes = np.fromiter(map(len, merged), np.int64, len(merged))
            yield numbers[others], np.fromiter(itertools.chain.from_iterable(merged), np.int64, int(sizes.sum())), sizes
        for at in range(0, short, ROUND_WORDS):
            chosen = by_length[at : min(at + ROUND_WORDS, short)]
            width, of = int(lengths[chosen].max()), numbers[chosen]
            symbols = np.full((len(chosen), width + 1), ALONE)
            inside = np.arange(width + 1) < lengths[chosen, None]
            letters = "".join([spelled[k] for k in chosen.tolist()])
            symbols[inside] = self.by_letter[np.frombuffer(letters.encode("utf-16-le"), "<u2")]
            symbols[np.arange(len(chosen)), lengths[chosen] - 1] = self.by_last_letter[np.fromiter((ord(spelled[k][-1]) for k in chosen.tolist()), np.int64, len(chosen))]
            ranks = self.rank(symbols[:, :-1], symbols[:, 1:])
            while len(of):
                best = ranks.argmin(axis=1)
                rank = ranks[np.arange(len(of)), best]
                over = rank == UNRANKED
                if over.any():
                    kept = symbols[over]
                    inside = kept != ALONE
                    yield of[over], kept[inside], inside.sum(axis=1)
                    symbols, ranks, best, of, rank = (x[~over] for x in (symbols, ranks, best, of, rank))
                if not len(of):
                    break
                rows = np.arange(len(of))
                symbols[rows, best] = self.by_rank[rank]
                keep = np.ones(symbols.shape, bool)
                keep[rows, best + 1] = False
                symbols = symbols[keep].reshape(len(of), -1)
                ranks = ranks[keep[:, 1:]].reshape(len(of), -1)
                here = np.minimum(best, ranks.shape[1] - 1)
                ranks[rows, here] = self.rank(symbols[rows, here], symbols[rows, here + 1])
                before = np.maximum(best - 1, 0)
                ranks[rows, before] = self.rank(symbols[rows, before], symbols[rows, before + 1])

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One more than the rank of each pair's merge, ``UNRANKED`` without one."""
        code = a << 16 | b
        at = np.searchsorted(self.pairs, code)
        return np.where(self.pairs[at] == code, self.ranks[at], UNRANKED)

    def learn(self, words: list[str]) -> pa.LargeBinaryArray:
        """Packed ids of distinct words, encoded all at once."""
        # No word holds a line feed, so the words are spelled as one text.
        spelled = "\n".join(words).encode().decode("latin-1").translate(self.letters).split(self.letters[10])
        cuts = [[self.special[w]] if w in self.special else self.propose(s) for w, s in zip(words, spelled, strict=True)]
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        flat = np.fromiter(itertools.chain.from_iterable(cuts), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        if self.ordered:
            for t in np.unique(flat[self.alone[flat] < 0]).tolist():
                self.alone[t] = self.merge(self.symbols(t)) == [t]
            good = self.alone[flat] == 1
            inner = np.ones(flat.size, bool)
            inner[ends - 1] = False  # the last token has no right neighbour
            inner = np.flatnonzero(inner)
            distinct, which = np.unique(flat[inner] << 16 | flat[inner + 1], return_inverse=True)
            good[inner] &= self.compatible(distinct >> 16, distinct & ALONE)[which]
            failing = np.flatnonzero(~np.logical_and.reduceat(good, ends - sizes))
        else:
            failing = np.array([k for k, w in enumerate(words) if w not in self.special], np.int64)
        fine = np.ones(len(words), bool)
        fine[failing] = False
        done = [packed(flat[np.repeat(fine, sizes)], sizes[fine])]
        order = [np.flatnonzero(fine)]
        for which, tokens, lengths in self.merge_all(failing, [spelled[k] for k in failing.tolist()]):
            order.append(which)
            done.append(packed(tokens, lengths))
        return pa.concat_arrays(done).take(pa.array(np.argsort(np.concatenate(order))))

    def pieces(self, text: str) -> list[str]:
        """Words and line feeds of a text in order; special tokens stay whole."""
        if text.isascii() and not self.cut.search(text):
            return self.latin.findall(text.lower())
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(part)
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            find = self.piece if BEYOND_LATIN.search(part) else self.latin
            out += find.findall(part)
        return out

    def learn_chunks(self, chunks: list[str]) -> pa.LargeBinaryArray:
        """Packed ids of distinct chunks: their words looked up, a line feed after each chunk marking its end."""
        kinds: list[list[int]] = [[], [], []]
        for k, c in enumerate(chunks):
            kinds[0 if c.isascii() else 2 if BEYOND_LATIN.search(c) else 1].append(k)
        parts = [p for kind in kinds if kind for p in self.pieces("".join([chunks[k] + "\n" for k in kind]))]
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, parts), bool, len(parts)))
        words = self.words.of([p for p in parts if p != "\n"])
        found = joined(words, np.append(0, ends - np.arange(len(ends))))
        return found.take(pa.array(np.argsort(np.concatenate(kinds).astype(np.int64))))

    def encode_texts(self, texts: pa.Array) -> tuple[pa.BinaryArray, pa.StringArray]:
        """Packed ids and decoded text of each text.

        No piece spans a blank or line feed and no normalisation reaches across one, so what stands between
        them is looked up as a whole; only chunks not met before are cut into pieces.
        """
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        # Chunks hold no blank: as one text they reach Python ten times as fast as one by one.
        chunks = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), pa.scalar(" ", pa.large_string()))
        known = self.chunks.of(chunks[0].as_py().split(" ")) if len(coded) else self.chunks.packed[:0]
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        packed = joined(known.take(coded.indices), np.append(0, np.cumsum(sizes, dtype=np.int64)))
        at = np.frombuffer(packed.buffers()[1], np.int64)
        ids = np.frombuffer(packed.buffers()[2], "<u4", int(at[-1]) // 4) if at[-1] else np.zeros(0, "<u4")
        bounds = at // 4
        tokens = ids.astype(np.int64)
        tokens[bounds[1:][np.diff(bounds) > 0] - 1] += len(self.made)
        shown = joined(self.texts.take(pa.array(tokens)).cast(pa.large_binary()), bounds)
        return packed.cast(pa.binary()), pa.LargeStringArray.from_buffers(len(shown), *shown.buffers()[1:]).cast(pa.string())

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """The same for a list."""
        return list(zip(*(x.to_pylist() for x in self.encode_texts(pa.array(texts, pa.large_string()))), strict=True))


_LOADED: dict[int, WordBpe] = {}


def loaded(spec: str) -> WordBpe:
    """The tokenizer of a file's text, once per worker."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(spec)
    return _LOADED[key]


#: Bytes of text encoded together; bounds what a worker holds besides its input batch.
STEP_BYTES = 1_000_000


def steps(batches: Iterable[pa.RecordBatch], size: int | None = None) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of the same rows in the same order, joined or cut to about that many bytes of text, one text at least."""
    held, left = [], size or STEP_BYTES
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            upto = min(int(np.searchsorted(ends, before + left)) + 1, batch.num_rows)
            held.append(batch.slice(at, upto - at))
            left -= int(ends[upto - 1]) - before
            at = upto
            if left <= 0:
                yield tuple(pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1))
                held, left = [], size or STEP_BYTES
    if held:
        yield tuple(pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1))


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit integers) and ``decoded``.

    ``tokenizer_path`` is read on the driver only; its text (1.7 MB for a vocabulary of 49 thousand) goes to the workers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    narrow = docs.select(docs[id_col].alias("_id"), whole_text(docs[text_col]).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for keys, texts in steps(batches):
            ids, decoded = bpe.encode_texts(texts)
            counts = pc.cast(pc.divide(pc.binary_length(ids), 4), pa.int64())
            yield pa.RecordBatch.from_arrays([keys, counts, ids, decoded], ["_id", "n_tokens", "ids", "decoded"])

    out = narrow.mapInArrow(run, f"_id {kind}, n_tokens long, ids binary, decoded string")
    return out.withColumnRenamed("_id", id_col)
