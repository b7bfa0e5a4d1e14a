"""Toxicity classifier that is held to the same score when an identity term is swapped for another.

A logistic model over the words of a text and the beginnings of its words (present or not), so that an unseen form of
an insult still counts; identity terms stand only for themselves. Features are chosen by how strongly their presence goes with the
label (likelihood-ratio statistic). Besides the labels' loss and a ridge, fitting pays for every change of the
linear score among a labelled text and its counterfactuals, in which an identity term is replaced by the next of its group or by a
neutral noun, both of its language, or left out. A text without the term is the anchor: a term and those it is swapped for are held to the
weight 0, so neither a neutral mention of a group raises the score by itself, nor does a swap pass the weight on to terms that no
labelled text has. At a strength of c the weight of a term ends at 1 / 2c at most, whatever the labels say.

A text of more than two blocks of ``BLOCK_WORDS`` words is also scored by windows of two neighbouring blocks over its whole length, and
the largest score counts, so a toxic passage is not outweighed by ordinary words around it. As the largest of many
windows is high by chance, it is lowered by what clean windows reach: their upper tail is taken as exponential and measured on a
fifth of the labelled rows under weights fitted on the others, such that a clean text of any length is about as seldom flagged as a clean short one
(a window is never held to less than a whole text is).

Fitting uses at most ``SAMPLE_ROWS`` labelled rows and ``WORDS`` features (documented bounds, independent of the corpus);
scoring covers every whole text. Defined results: NULL is scored as the empty text; without rows of both labels
the score is the smoothed share of label 1; repeated rows are scored alike; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import held_out, labelled_sample, small_batches, whole_text

SAMPLE_ROWS = 16_000
WORDS = 2048
#: Least likelihood-ratio statistic of a chosen word (chance of 1 in 1,000 for an unrelated one).
LEAST_G2 = 10.83
RIDGE, COUNTERFACTUAL = 1e-5, 1.0
STEPS, RATE = 400, 0.1
BLOCK_WORDS = 128
#: Every so many labelled rows one measures the windows; share of the clean windows that is their tail, and fewest in the tail.
TAIL_FOLD, TAIL_SHARE, TAIL_LEAST = 5, 0.1, 10
# Neutral nouns by language, and identity terms by group and language.
NEUTRAL = {"en": ["people", "persons"], "de": ["leute", "personen"], "fr": ["gens", "personnes"], "es": ["gente", "personas"]}
GROUPS = [
    {"en": ["women", "men", "girls", "boys"], "de": ["frauen", "männer"], "fr": ["femmes", "hommes"], "es": ["mujeres", "hombres"]},
    {"en": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"]},
    {"en": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"]},
    {"en": ["gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual", "homosexual"]},
    {"en": ["black", "white", "asian", "african", "european", "american", "mexican", "arab", "latino", "chinese", "indian"]},
    {"en": ["immigrants", "refugees", "foreigners", "natives", "migrants", "citizens"]},
    {"en": ["disabled", "deaf", "blind", "autistic", "elderly", "young"]},
]
PREFIXES = (4, 5, 7)
TOKEN = re.compile(r"[^\W\d_]+")


def swaps() -> dict[str, tuple[str, ...]]:
    """Counterfactual terms of each identity term: the next of its group, and a neutral noun, both of its language."""
    out = {}
    for group in GROUPS:
        for language, terms in group.items():
            for i, term in enumerate(terms):
                out[term] = (terms[(i + 1) % len(terms)], NEUTRAL[language][i % len(NEUTRAL[language])])
    return out


SWAPS = swaps()
TERMS = frozenset(SWAPS) | frozenset(noun for nouns in NEUTRAL.values() for noun in nouns)


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    constant: float = 0.0
    #: What the largest of n windows is lowered by: ``level + spread * ln(n)``.
    level: float = 0.0
    spread: float = 1.0


def token_features(tokens: list[str]) -> set[str]:
    """Distinct words, and the first letters of longer ones with a star."""
    found = set(tokens)
    longer = found - TERMS
    return found.union(*({w[:k] + "*" for w in longer if len(w) > k} for k in PREFIXES))


def text_features(text: str | None) -> set[str]:
    """Features of the lower-case words of a text."""
    return token_features(TOKEN.findall((text or "").lower()))


def linear_scores(text: str | None, weights: dict[str, float], constant: float) -> list[float]:
    """Linear score of the whole text, then of each window if it has more than two blocks."""
    tokens = TOKEN.findall((text or "").lower())
    blocks = [weights.keys() & token_features(tokens[at : at + BLOCK_WORDS]) for at in range(0, len(tokens), BLOCK_WORDS)]
    parts = [set().union(*blocks), *((a | b for a, b in zip(blocks, blocks[1:], strict=False)) if len(blocks) > 2 else ())]
    return [constant + sum(weights[w] for w in sorted(p)) for p in parts]


def largest(scores: list[float], model: ToxicityModel) -> float:
    """Linear score of a text from those of ``linear_scores``."""
    if len(scores) == 1:
        return scores[0]
    return max(scores[0], max(scores[1:]) - model.level - model.spread * float(np.log(len(scores) - 1)))


def words(text: Column) -> Column:
    """Features of a text as a sorted array."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted(text_features(t)) for t in texts])

    return run(text)


def chosen_words(sample: DataFrame) -> list[str]:
    """Words whose presence goes with the label, the strongest first."""
    total = sample.agg(F.count("*").alias("n"), F.sum("y").alias("n1")).first()
    n, n1 = float(total["n"] or 0), float(total["n1"] or 0)
    counts = sample.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").cast("double").alias("a"), F.count("*").cast("double").alias("c"))

    def term(seen: Column, row: Column, column: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)

    a, c, one, zero = F.col("a"), F.col("c"), F.lit(n1), F.lit(n - n1)
    rest = F.lit(n) - c
    g2 = 2 * (term(a, c, one) + term(c - a, c, zero) + term(one - a, rest, one) + term(zero - c + a, rest, zero))
    best = counts.where("c >= 3").withColumn("g2", g2).where(F.col("g2") >= LEAST_G2)
    return [r["word"] for r in best.orderBy(F.desc("g2"), "word").limit(WORDS).select("word").collect()]


def fit_weights(rows: list[tuple[int, list[str]]], vocabulary: list[str], counterfactual: float = COUNTERFACTUAL) -> ToxicityModel:
    """Full-batch Adam on label loss, ridge and counterfactual penalty (over mentions, or rows if these are fewer)."""
    y = np.array([r[0] for r in rows], float)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(set(y)) < 2:
        return ToxicityModel({}, start)
    of = {w: i for i, w in enumerate(vocabulary)}
    hits = [[of[w] for w in ws if w in of] for _, ws in rows]
    row = np.repeat(np.arange(len(rows)), [len(h) for h in hits])
    col = np.fromiter((i for h in hits for i in h), np.int64, len(row))
    mentions = [(a, [other for other in SWAPS[a] if other not in ws]) for _, ws in rows for a in ws if a in SWAPS]
    pairs = [pair for a, others in mentions for pair in [(a, None), *((a, other) for other in others), *((other, None) for other in others)]]
    held = max(1, min(len(mentions), len(rows)))
    left = np.array([of.get(a, -1) for a, _ in pairs], np.int64)
    right = np.array([of.get(b, -1) for _, b in pairs], np.int64)
    k = len(vocabulary)
    w, b = np.zeros(k + 1), start  # the last weight belongs to words that are not in the vocabulary, and stays 0
    m, v = np.zeros(k + 2), np.zeros(k + 2)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[col], len(rows)) + b
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        grad = np.append(np.bincount(col, off[row], k + 1) + 2 * RIDGE * w, off.sum())
        if len(pairs):
            change = 2 * counterfactual * (w[left] - w[right]) / held
            np.add.at(grad, np.where(left < 0, k, left), change)
            np.add.at(grad, np.where(right < 0, k, right), -change)
        grad[k] = 0
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w, b = w - move[: k + 1], b - move[k + 1]
    return ToxicityModel({t: float(x) for t, x in zip(vocabulary, w, strict=False)}, float(b))


def clean_tail(scores: list[list[float]]) -> tuple[float, float]:
    """``level`` and ``spread`` from the ``linear_scores`` of clean texts; without enough of them a window counts as one of n chances."""
    windows = np.sort(np.array([x for s in scores for x in (s[1:] or s)], float))
    most = int(len(windows) * TAIL_SHARE)
    if most < TAIL_LEAST:
        return 0.0, 1.0
    start = float(windows[-most - 1])
    spread = float((windows[-most:] - start).mean())
    flagged = (sum(s[0] >= 0 for s in scores) + 1) / (len(scores) + 1)
    return max(0.0, start + spread * float(np.log(TAIL_SHARE / flagged))), spread


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", counterfactual: float = COUNTERFACTUAL) -> ToxicityModel:
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, SAMPLE_ROWS, id_col, text_col)
    fold = F.pmod("h", F.lit(TAIL_FOLD)) == 0
    texts, sample = sample, materialize(sample.select("id", "y", fold.alias("fold"), words(F.col("text")).alias("words")), "toxicity-sample")
    vocabulary = [w for w in chosen_words(sample) if w not in TERMS] + sorted(TERMS)
    kept = F.array_intersect("words", F.array(*[F.lit(w) for w in vocabulary]))
    found = sample.select("y", "id", "fold", kept.alias("kept")).orderBy("id", "kept").collect()
    model = fit_weights([(r["y"], r["kept"]) for r in found], vocabulary, counterfactual)
    others = fit_weights([(r["y"], r["kept"]) for r in found if not r["fold"]], vocabulary, counterfactual)
    clean = texts.where(fold & (F.col("y") == 0)).select(parts_scores(F.col("text"), others).alias("x")).collect()
    level, spread = clean_tail([r["x"] for r in clean])
    return replace(model, level=level, spread=spread)


def parts_scores(text: Column, model: ToxicityModel) -> Column:
    """``linear_scores`` of a text."""
    weights, constant = dict(model.weights), model.constant

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([linear_scores(t, weights, constant) for t in texts])

    return run(text)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Chance of label 1 for a whole text, or for its most toxic window."""
    weights, constant = dict(model.weights), model.constant

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            total = [largest(linear_scores(t, weights, constant), model) for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(total, float), -500, 500))))

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit_toxicity(docs, labels)
    small_batches(docs.sparkSession)
    scored = docs.select("doc_id", toxicity_score(whole_text("text"), model).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
