"""User agents by a table of patterns: browser, operating system and device, the first pattern in the table's order wins."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("browser", "system", "device")
#: Stands for a version in a pattern: numbers between dots or underscores.
VERSION = r"(\d+(?:[._]\d+)*)"
#: Place of the family "Other", which every text has.
LAST = 2**31 - 1


@dataclass
class AgentPattern:
    """``word`` (small letters only) stands in every text that ``pattern`` finds; ``$1`` in a value is the pattern's group."""

    position: int
    kind: str
    word: str
    pattern: str
    family: str
    version: str | None = None
    brand: str | None = None
    model: str | None = None


def load_patterns(path: str) -> list[AgentPattern]:
    """Patterns of a seed file with the columns of :class:`AgentPattern`; configuration that the driver holds like a query's text."""
    with open(path, newline="") as lines:
        out = [AgentPattern(int(r["position"]), *(r[k] or None for k in ("kind", "word", "pattern", "family", "version", "brand", "model"))) for r in csv.DictReader(lines)]
    for p in out:
        if p.kind not in KINDS or not re.fullmatch("[a-z]+", p.word or "") or not p.pattern or not p.family:
            raise ValueError(f"pattern {p.position} needs a kind of {KINDS}, a word of small letters, a pattern and a family")
    return out


def _filled(value: str, group: Column) -> Column:
    return F.nullif(F.trim(F.replace(F.col(value), F.lit("$1"), F.coalesce(group, F.lit("")))), F.lit(""))


def parse_by_patterns(df: DataFrame, column: str, patterns: Sequence[AgentPattern]) -> DataFrame:
    """One row per distinct text of ``column``: families, version parts, brand and model.

    A text is cut into its words once, and only patterns whose word it holds are tried, so the cost follows the words of a text and
    not the length of the table. Trial and pick keep the partitioning of the distinct texts: there is one shuffle, of texts that
    were already made distinct per map task. NULL texts have no row; a text without any match, the empty one included, is "Other".
    """
    listed = [(p.position, p.kind, p.word, p.pattern.replace("<v>", VERSION) + "()", p.family, p.version, p.brand, p.model) for p in patterns]
    listed += [(LAST, kind, "", "()", "Other", None, None, None) for kind in KINDS]
    schema = "position int, kind string, _word string, pattern string, family string, version string, brand string, model string"
    # as large as the seed file
    table = F.broadcast(df.sparkSession.createDataFrame(listed, schema))
    texts = df.select(F.col(column).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    own = F.regexp_extract_all(F.lower("_text"), F.lit("([a-z]+)"), F.lit(1))
    known = F.array(*map(F.lit, sorted({p.word for p in patterns} | {""})))
    tried = texts.select("_text", F.explode(F.array_intersect(known, F.array_append(own, F.lit("")))).alias("_word"))
    found = tried.join(table, "_word").where(F.expr("_text rlike pattern"))
    group = F.nullif(F.expr("regexp_extract(_text, pattern, 1)"), F.lit(""))
    value = F.struct("position", _filled("family", group).alias("family"), F.coalesce("version", group).alias("version"), "brand", _filled("model", group).alias("model"))
    # positions differ within a kind, so the least struct is the first pattern
    first = found.groupBy("_text").agg(*(F.min(F.when(F.col("kind") == kind, value)).alias(kind) for kind in KINDS))
    part = lambda kind, n: F.try_element_at(F.split(f"{kind}.version", "[._]"), F.lit(n))
    return first.select(
        F.col("_text").alias(column),
        F.col("browser.family").alias("browser_family"),
        part("browser", 1).alias("browser_version_major"),
        part("browser", 2).alias("browser_version_minor"),
        part("browser", 3).alias("browser_version_patch"),
        F.col("system.family").alias("os_family"),
        part("system", 1).alias("os_version_major"),
        part("system", 2).alias("os_version_minor"),
        part("system", 3).alias("os_version_patch"),
        part("system", 4).alias("os_version_patch_minor"),
        F.col("device.family").alias("device_family"),
        F.col("device.brand").alias("device_brand"),
        F.col("device.model").alias("device_model"),
    )
