"""Token counts of a unigram tokenizer without building tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each position, and a Viterbi pass over the positions carries only
the best score and the number of pieces of the best path. Ties fall as in the tokenizer: a path replaces another only
with a strictly better score, and the pieces that end at a position are tried from the longest to the shortest, so the longest last
piece wins. A character that is no piece by itself costs ``lowest score - 10`` as unknown; neighbouring unknown characters are
one unknown token, which byte fallback writes as one token per UTF-8 byte.

Blanks are written as ``▁``, which only starts pieces (or fills runs), so no piece reaches across the start of a blank run: the
best path of a text is the join of the best paths of its words, and words seen before are looked up.

Defined results: NULL and empty texts have no tokens; repeated rows give repeated rows; columns other than id and text are
not read; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, whole_text

BLANK = "▁"
#: Words whose count a worker remembers; beyond this number it forgets all and starts again.
KNOWN_WORDS = 500_000
UNKNOWN_PENALTY = 10.0
#: Kinds of a piece in a vocabulary file that stand for text.
NORMAL = 1


def pieces_of_model(data: bytes) -> list[tuple[str, float]]:
    """Normal pieces and scores of a SentencePiece file, read from its wire format (field 1: pieces; in each, text, score and kind)."""
    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    def fields(at: int, end: int) -> Iterator[tuple[int, object]]:
        while at < end:
            key, at = number(at)
            kind = key & 7
            if kind == 0:
                value, at = number(at)
            elif kind == 2:
                size, at = number(at)
                value, at = (at, at + size), at + size
            else:
                size = 4 if kind == 5 else 8
                value, at = data[at : at + size], at + size
            yield key >> 3, value

    out = []
    for field, span in fields(0, len(data)):
        if field == 1:
            piece = dict(fields(*span))
            if piece.get(3, NORMAL) == NORMAL:
                a, b = piece[1]
                out.append((data[a:b].decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0))
    return out


class UnigramCounter:
    """Counts pieces of the best segmentation of words."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for text, score in pieces:
            self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        # a blank inside a piece would tie words together
        self.split = not any(BLANK in t.lstrip(BLANK) for t, _ in pieces)
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Number of tokens of a word: best score first, the path found first among equals."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for at, piece in self.automaton.iter(word):
            ends[at].append(piece)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        for at in range(n):
            top, tokens, single = None, 0, False
            for size, score in sorted(ends[at], reverse=True):
                start = at + 1 - size
                single |= size == 1
                if top is None or best[start] + score > top:
                    top, tokens = best[start] + score, count[start] + 1
            if not single and (top is None or best[at] + self.unknown > top):
                top, tokens = best[at] + self.unknown, count[at] + len(word[at].encode())
            best[at + 1], count[at + 1] = top, tokens
        return count[n]

    def count(self, text: str) -> int:
        """Tokens of a text whose blanks are written as they are in the vocabulary."""
        if not text:
            return 0
        text = text.replace(" ", BLANK)
        if not self.split:
            return self.word(text)
        known, total = self.known, 0
        for part in re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text):
            if (n := known.get(part)) is None:
                if len(known) > KNOWN_WORDS:
                    known.clear()
                n = known[part] = self.word(part)
            total += n
        return total


_LOADED: dict[int, UnigramCounter] = {}


def loaded(data: bytes) -> UnigramCounter:
    """The counter of a vocabulary file, once per worker."""
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = UnigramCounter(pieces_of_model(data))
    return _LOADED[key]


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``n_tokens`` under the unigram model of a vocabulary file, a blank put before the text.

    The file is read on the driver only (0.5 MB for a vocabulary of 32 thousand).
    """
    small_batches(docs.sparkSession)
    with open(vocabulary_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = loaded(data.value)
        for texts in batches:
            yield pd.Series([counter.count(" " + t if t else "") for t in texts], dtype="int64")

    return docs.select(docs[id_col].alias(id_col), run(whole_text(docs[text_col])).alias("n_tokens"))
