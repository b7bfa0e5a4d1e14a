"""Counts equal the lengths of a unigram tokenizer with the same pieces, and ties fall alike."""

import random

import public_tokenizers
from tokenizers import Tokenizer, models

from ledgerline.llm import token_counts
from ledgerline.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(pieces):
    vocabulary = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + pieces
    tokenizer = Tokenizer(models.Unigram(vocabulary, 0, True))
    return lambda text: len(tokenizer.encode((" " + text).replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


def test_ties_and_unknown_characters():
    rnd = random.Random(2)
    for seed in range(20):
        rnd = random.Random(seed)
        pieces = {"".join(rnd.choice("ab▁é") for _ in range(rnd.randint(1, 4))): float(-rnd.randint(1, 3)) for _ in range(14)}
        counter, count = token_counts.UnigramCounter(list(pieces.items())), reference(list(pieces.items()))
        for _ in range(200):
            text = "".join(rnd.choice("ab é漢\n") for _ in range(rnd.randint(1, 14)))
            assert counter.count(" " + text) == count(text), (pieces, text)


def test_query(spark, folder):
    with open(PATH, "rb") as f:
        count = reference(token_counts.pieces_of_model(f.read()))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op9_token_counts"](spark, folder).collect():
        assert r["n_tokens"] == count(texts[r["doc_id"]])
