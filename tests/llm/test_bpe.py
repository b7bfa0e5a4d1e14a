"""BPE by speculation equals the tokenizers library, and exact merging agrees with its long-word form."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import bpe
from ledgerline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(texts):
    t = Tokenizer.from_file(PATH)
    out = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    return [(ids, t.decode(ids, skip_special_tokens=False)) for ids in out]


def ours(texts):
    with open(PATH, encoding="utf-8") as f:
        coder = bpe.WordBpe(f.read())
    return [(np.frombuffer(b, "<u4").tolist(), shown) for b, shown in coder.encode(texts)]


def test_words_and_odd_texts():
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzéñüßσΣİ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 24))) for _ in range(4000)]
    texts += ["", " ", "I'LL don't we're 'sx", "<|endoftext|>a<|startoftext|> <|endoftext", "</w> a</w>", "ΟΔΟΣ", "a\x1cb\x1d\x85c", "漢字 123 ½²", "é Å", "a" * 5000, "!?" * 400]
    assert ours(texts) == reference(texts)


def test_long_word_merging():
    with open(PATH, encoding="utf-8") as f:
        coder = bpe.WordBpe(f.read())
    rnd = random.Random(1)
    for _ in range(300):
        ids = [coder.vocab[rnd.choice("abcdeinorst")] for _ in range(rnd.randint(2, 60))]
        assert coder.merge(ids) == coder.merge_long(ids)


def test_query(spark, folder):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(texts, reference(list(texts.values())), strict=True))
    for r in QUERIES["op7_bpe_round_trip"](spark, folder).collect():
        ids, shown = want[r["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())


def coder_of(spec=None):
    if spec is None:
        with open(PATH, encoding="utf-8") as f:
            spec = f.read()
    return bpe.WordBpe(spec)


def test_pair_verdicts_equal_merging_from_scratch():
    coder, rnd = coder_of(), random.Random(3)
    inner, last = list(coder.inner.values()), list(coder.last.values())
    near = [p for p in coder.merges if rnd.random() < 0.2]  # pairs with a merge of their own
    pairs = [(rnd.choice(inner), rnd.choice(inner + last)) for _ in range(20_000)] + [(p >> 16, p & 0xFFFF) for p in near]
    pairs += [(coder.halves[a][0], b) for a, b in pairs if a in coder.halves]
    pairs += [(inner[k], inner[k]) for k in range(0, len(inner), 7)]
    a, b = np.array(pairs).T
    want = [coder.merge(coder.symbols(x) + coder.symbols(y)) == [x, y] for x, y in pairs]
    assert coder.ordered and 0 < sum(want) < len(want)
    assert coder.compatible(a, b).tolist() == want


def test_merging_in_rounds_equals_one_word_at_a_time(monkeypatch):
    monkeypatch.setattr(bpe, "ROUND_WORDS", 97)
    coder, rnd = coder_of(), random.Random(4)
    words = ["".join(rnd.choice("aaehinorst" if k % 2 else "aab") for _ in range(rnd.randint(1, 80))) for k in range(3000)]
    numbers = np.arange(len(words)) * 3
    got = {}
    for of, tokens, sizes in coder.merge_all(numbers, words):
        got.update(zip(of.tolist(), np.split(tokens, np.cumsum(sizes)[:-1]), strict=True))
    assert len(got) == len(words)
    for n, w in zip(numbers.tolist(), words, strict=True):
        assert got[n].tolist() == coder.merge([*map(coder.inner.__getitem__, w[:-1]), coder.last[w[-1]]])


def test_merges_out_of_order():
    import json

    with open(PATH, encoding="utf-8") as f:
        data = json.load(f)
    data["model"]["merges"] = data["model"]["merges"][::-1]
    spec, rnd = json.dumps(data), random.Random(6)
    texts = [" ".join("".join(rnd.choice("aehinorst") for _ in range(rnd.randint(1, 14))) for _ in range(9)) for _ in range(60)] + ["<|endoftext|> the", ""]
    coder, other = coder_of(spec), Tokenizer.from_str(spec)
    assert not coder.ordered
    assert [np.frombuffer(b, "<u4").tolist() for b, _ in coder.encode(texts)] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_not_merged_one_by_one(monkeypatch):
    calls, merge = [], bpe.WordBpe.merge
    monkeypatch.setattr(bpe.WordBpe, "merge", lambda self, ids: calls.append(1) or merge(self, ids))
    rnd = random.Random(8)
    words = list({"".join(rnd.choice(["th", "er", "on", "ing", "an", "re", "ha", "ou", "st"]) for _ in range(rnd.randint(2, 6))) for _ in range(20_000)})
    coder = coder_of()
    coder.encode([" ".join(words)])
    assert len(calls) < len(words) / 5  # once per token at most, neither per pair nor per word


def test_a_full_memory_keeps_the_last_batch(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    cut, pieces = [], bpe.WordBpe.pieces
    monkeypatch.setattr(bpe.WordBpe, "pieces", lambda self, text: cut.append(text) or pieces(self, text))
    coder, texts = coder_of(), [f"{a}{b} it's {a} <|endoftext|>{b}é" for a in "abcdefgh" for b in "stuvwx"]
    want = reference(texts)
    for again in range(3):
        got = coder.encode(texts)
        assert [(np.frombuffer(b, "<u4").tolist(), shown) for b, shown in got] == want
        assert bool(cut) == (again == 0)
        cut.clear()
    coder.encode(["other"])
    assert len(coder.chunks.row) == 1


def test_steps_keep_rows_and_bound_bytes():
    import pyarrow as pa

    rnd = random.Random(9)
    rows = [(k, "x" * rnd.choice([0, 1, 5, 40, 300])) for k in range(500)]
    batches, at = [], 0
    while at < len(rows):
        n = rnd.choice([1, 3, 70])
        part = rows[at : at + n]
        batches.append(pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part])], ["_id", "_text"]))
        at += n
    out = [list(zip(k.to_pylist(), t.to_pylist(), strict=True)) for k, t in bpe.steps([batches[0].slice(0, 0), *batches], 200)]
    assert [r for step in out for r in step] == rows
    assert all(sum(len(t) for _, t in step[:-1]) < 200 for step in out) and all(sum(len(t) for _, t in step) >= 200 for step in out[:-1])
