"""Quality classifier by compression: a text is good if a dictionary of good texts shortens it more than one of bad texts.

Two zstandard dictionaries are built from pieces of labelled texts, one per label. Every whole text is compressed
with each. The difference of the two sizes, once per byte of text and once per compressed byte, and the text's
rate under the good dictionary go through a logistic curve fitted on labelled texts that are in neither dictionary.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows and ``PIECES`` pieces per label (documented bounds, independent of the
corpus); scoring covers every text. Defined results: NULL is scored as the empty text; without rows of both labels the
score is the smoothed share of label 1; repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import held_out, labelled_sample, small_batches, whole_text

SAMPLE_ROWS = 16_000
PIECES, PIECE_CHARS = 4096, 2048
DICTIONARY_BYTES = 112_640
LEVEL = 3
FEATURES = 3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries by label and the calibration: weights of the scaled features and a constant."""

    dictionaries: tuple[bytes, bytes]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    constant: float


def compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **plain) if d else zstandard.ZstdCompressor(**plain) for d in dictionaries]


def sizes(text: Column, dictionaries: tuple[bytes, bytes]) -> Column:
    """Struct of the text's bytes, and its compressed bytes under the dictionary of either label."""

    @F.pandas_udf("raw long, bad long, good long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bad, good = compressors(dictionaries)
        for texts in batches:
            out = [(len(b), len(bad.compress(b)), len(good.compress(b))) for b in ((t or "").encode() for t in texts)]
            yield pd.DataFrame(out, columns=["raw", "bad", "good"], dtype="int64")

    return run(text)


def features(size: Column) -> list[Column]:
    more = size["bad"] - size["good"]
    return [more / (size["raw"] + 1), more / (size["bad"] + size["good"] + 1), F.log((size["good"] + 1) / (size["raw"] + 1))]


def pieces(sample: DataFrame, label: int) -> list[bytes]:
    """The first ``PIECES`` pieces in seeded order from the sampled texts of a label; every part of a text can be drawn."""
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE_CHARS).cast("int"))
    cut = sample.where((F.col("y") == label) & (F.length("text") > 0)).select("h", "text", F.explode(starts).alias("n"))
    cut = cut.select(F.xxhash64("h", "n").alias("o"), F.expr(f"substring(text, n * {PIECE_CHARS} + 1, {PIECE_CHARS})").alias("piece"))
    return [r["piece"].encode() for r in cut.orderBy("o", "piece").limit(PIECES).collect()]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights and constant by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + ridge / 2 * w @ w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        size = 1.0
        while loss(w + size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    small_batches(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, label, SAMPLE_ROWS, id_col, text_col), "quality-sample")
    half = F.pmod("h", F.lit(2)) == 0
    made = tuple(dictionary(pieces(sample.where(half), y)) for y in (0, 1))
    size = sample.where(~half).select("y", "id", sizes(F.col("text"), made).alias("s"))
    rows = size.select("y", *[f.alias(f"f{i}") for i, f in enumerate(features(F.col("s")))]).orderBy("id", "f0").collect()
    x, y = np.array([r[1:] for r in rows], float).reshape(-1, FEATURES), np.array([r["y"] for r in rows], float)
    if len(set(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return QualityModel(made, (0.0,) * FEATURES, (1.0,) * FEATURES, (0.0,) * FEATURES, float(np.log(share / (1 - share))))
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    w = logistic((x - centre) / scale, y)
    return QualityModel(made, tuple(centre.tolist()), tuple(scale.tolist()), tuple(w[:-1].tolist()), float(w[-1]))


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``score``, the chance of label 1."""
    small_batches(docs.sparkSession)
    narrow = docs.select(docs[id_col].alias(id_col), sizes(whole_text(docs[text_col]), model.dictionaries).alias("_s"))
    total = F.lit(model.constant)
    for f, c, s, w in zip(features(F.col("_s")), model.centre, model.scale, model.weights, strict=True):
        total = total + (f - c) / s * w
    return narrow.select(id_col, (1 / (1 + F.exp(-total))).alias("score"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = quality_scores(docs, fit_quality(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
