"""First-match rules kept as data: folded into one expression, or found through an index of their words."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

# What may stand before and after a word, as regular expression class bodies.
BEFORE, AFTER = r" .;,:\n\t\-\"'/", r".;, /\n\t\-\"'?!"
PART = rf"[^{BEFORE}{AFTER}]+"
#: Groups of one rule: their hits are bits of a long.
MOST_GROUPS = 62


def first_match(rules: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    out = None
    for test, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)


def equals_all(conditions: dict[str, object]) -> Column:
    """All listed columns hold the listed values; a value of None is not compared."""
    out = F.lit(True)
    for column, value in conditions.items():
        if value is not None:
            out = out & (F.col(column) == F.lit(value))
    return out


@dataclass
class WordRule:
    """Every group needs one of its words or phrases, with optional bounds of score and length; no groups means bounds only."""

    value: str
    groups: list[list[str]] = field(default_factory=list)
    min_score: float | None = None
    max_score: float | None = None
    shorter_than: int | None = None
    longer_than: int | None = None


def expand(pattern: str) -> list[str]:
    """Plain words of alternatives such as ``fi(x|xes)|work(s|ing)?|sign on``, in lower case."""
    out = []
    for one in re.findall(r"(?:\([^()]*\)\??|[^|()])+", pattern):
        parts = [[p] if not p.startswith("(") else [*p.rstrip("?")[1:-1].split("|"), *([""] if p.endswith("?") else [])] for p in re.findall(r"\([^()]*\)\??|[^()]+", one)]
        out += ["".join(x).lower() for x in itertools.product(*parts)]
    return list(dict.fromkeys(w for w in out if w))


def load_word_rules(seed: DataFrame) -> list[WordRule]:
    """Ordered rules of a seed file with one row per rule and group: rule, grp, words, subcategory, min_score, max_score, shorter_than, longer_than.

    The list of rules is configuration; it is held by the driver like the text of a query.
    """
    rules: dict[int, WordRule] = {}
    for r in seed.orderBy("rule", "grp").collect():
        rule = rules.setdefault(r["rule"], WordRule(r["subcategory"], [], r["min_score"], r["max_score"], r["shorter_than"], r["longer_than"]))
        if r["words"]:
            rule.groups.append(expand(r["words"]))
    return list(rules.values())


def _bounds(score: Column, size: Column, low: Column, high: Column, shorter: Column, longer: Column) -> Column:
    holds = (low.isNull() | (score >= low)) & (high.isNull() | (score <= high)) & (shorter.isNull() | (size < shorter)) & (longer.isNull() | (size > longer))
    return F.coalesce(holds, F.lit(False))


def first_word_rule(rows: DataFrame, text: str, score: str, rules: Sequence[WordRule]) -> DataFrame:
    """``rows`` with ``position``, the place of the first rule that holds, or NULL.

    An index leads from each word (for a phrase: its first part) to the rules that use it. A text is cut into its different words
    once; only words of the index go on, so the cost follows the hits and not the number of rules, and phrases are searched for
    only in texts that hold their first part. The index is as large as the list of rules.
    """
    spark = rows.sparkSession
    if any(len(r.groups) > MOST_GROUPS for r in rules):
        raise ValueError(f"a rule has more than {MOST_GROUPS} groups")
    words, phrases = [], []
    for position, rule in enumerate(rules):
        for bit, group in enumerate(rule.groups):
            for w in group:
                if re.fullmatch(PART, w):
                    words.append((w, position, 1 << bit))
                else:
                    found = re.search(PART, w)
                    if not found:
                        raise ValueError(f"a rule needs words with more than separators: {w!r}")
                    phrases.append((found[0], position, 1 << bit, rf"(?:^|[{BEFORE}])\Q{w}\E(?:[{AFTER}]|$)"))
    number = lambda v: None if v is None else float(v)
    facts = [(p, (1 << len(r.groups)) - 1, number(r.min_score), number(r.max_score), r.shorter_than, r.longer_than) for p, r in enumerate(rules)]
    table = spark.createDataFrame(facts, "position int, need long, low double, high double, shorter int, longer int")
    kept = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "rule-rows")
    lowered, size = F.lower(text), F.length(text)
    sized = [F.col("_row"), F.col(score).cast("double").alias("_score"), size.alias("_size")]
    known = lambda column, listed: F.array_intersect(column, F.array(*map(F.lit, sorted(set(listed)))))
    whole = F.regexp_extract_all(lowered, F.lit(rf"(?:^|[{BEFORE}])({PART})(?=[{AFTER}]|$)"), F.lit(1))
    hits = []
    if words:
        index = spark.createDataFrame(words, "_word string, position int, bit long")
        hits.append(kept.select(*sized, F.explode(known(whole, [w for w, *_ in words])).alias("_word")).join(F.broadcast(index), "_word"))
    if phrases:
        index = spark.createDataFrame(phrases, "_word string, position int, bit long, pattern string")
        parts = F.regexp_extract_all(lowered, F.lit(f"({PART})"), F.lit(1))
        maybe = kept.select(*sized, lowered.alias("_text"), F.explode(known(parts, [w for w, *_ in phrases])).alias("_word"))
        hits.append(maybe.join(F.broadcast(index), "_word").where(F.expr("_text rlike pattern")).drop("_text", "pattern"))
    bounds = lambda: _bounds(F.col("_score"), F.col("_size"), *map(F.col, ("low", "high", "shorter", "longer")))
    plain = [p for p, r in enumerate(rules) if not r.groups]
    # rules without words are few conditions on the row itself
    simple = [F.when(_bounds(F.col(score).cast("double"), size, *(F.lit(v).cast("double") for v in facts[p][2:])), p) for p in plain]
    own = F.least(*simple, F.lit(None).cast("int"), F.lit(None).cast("int"))
    out = kept.withColumn("_own", own)
    if not hits:
        return out.withColumn("position", F.col("_own")).drop("_row", "_own")
    every = hits[0].select("_row", "_score", "_size", "position", "bit")
    for more in hits[1:]:
        every = every.unionByName(more.select(*every.columns))
    full = every.groupBy("_row", "position").agg(F.bit_or("bit").alias("has"), F.first("_score").alias("_score"), F.first("_size").alias("_size"))
    first = full.join(F.broadcast(table), "position").where((F.col("has") == F.col("need")) & bounds()).groupBy("_row").agg(F.min("position").alias("_found"))
    return out.join(first, "_row", "left").withColumn("position", F.least("_own", "_found")).drop("_row", "_own", "_found")
