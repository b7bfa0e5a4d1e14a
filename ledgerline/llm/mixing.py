"""Mixing overlapping sources to target weights as a min-cost flow over membership patterns.

Documents are summed by membership pattern (the set of sources a document belongs to). Tokens flow from
the patterns to the quotas of the sources: a pattern offers its words once at cost 0 and again at cost 1, 2, …, so
repetition costs are convex and every first use goes before any second one. The flow of a pattern is turned into documents:
all of them are taken as often as the flow covers the whole pattern, and the rest is taken from the front
of a seeded order. That front is found on sums per hash bin, so only one bin of a pattern is ever sorted; what
is still missing is filled by further fronts of the documents that fit it, until none does, and at last by one document that is a little too long
if that comes nearer.

The driver holds one row per membership pattern; it grows with the number of source combinations, not with the documents.
Only tables made from these rows are broadcast, so no text is shuffled by its source.

Defined results: NULL text has size 0; a NULL source is a source of its own, last in order; rows that agree
in id, size and sources are drawn together; empty tables give an empty plan.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from ..session import materialize
from .common import WORD

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
#: Bins of the seeded order per pattern: a power of two.
BIN_BITS = 12


def word_count(text: Column) -> Column:
    """Words of the text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(id_: Column, size: Column, pattern: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), id_, size, pattern)


def pattern_key(sources: Column) -> Column:
    """Membership pattern as text: the distinct sources in order, NULL last."""
    return F.to_json(F.array_sort(F.array_distinct(sources)))


def targets(sizes: dict[str | None, int], weights: Sequence[float], total: int, repeats: int = REPEATS) -> dict[str | None, float]:
    """Share ``total`` by weight; a source stops at ``repeats`` times its size and the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    free, left = set(names), float(total)
    while free:
        unit = left / sum(weight[s] for s in names if s in free)
        full = [s for s in names if s in free and weight[s] * unit > repeats * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in free}
        for s in full:
            out[s] = float(repeats * sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def min_cost_flow(capacity: dict[str, int], members: dict[str, list[str | None]], quota: dict[str | None, int], repeats: int = REPEATS) -> dict[tuple[str, str | None], int]:
    """Words that each pattern gives to each source: as much of the quotas as can be met, at the least repetition cost."""
    nodes = {("in",): 0, ("out",): 1}
    node = lambda k: nodes.setdefault(k, len(nodes))
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    arcs: dict[int, list[int]] = defaultdict(list)

    def arc(a: int, b: int, most: int, price: int) -> int:
        for x, y, r, c in ((a, b, most, price), (b, a, 0, -price)):
            arcs[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    used = {}
    for p in sorted(capacity):
        for k in range(repeats):
            arc(0, node(("p", p)), capacity[p], k)
        for s in members[p]:
            used[p, s] = arc(node(("p", p)), node(("s", s)), repeats * capacity[p], 0)
    for s, most in quota.items():
        arc(node(("s", s)), 1, most, 0)
    while True:
        far, via, todo, waiting = {0: 0}, {}, deque([0]), {0}
        while todo:
            x = todo.popleft()
            waiting.discard(x)
            for e in arcs[x]:
                if room[e] and (d := far[x] + cost[e]) < far.get(to[e], 1 << 60):
                    far[to[e]], via[to[e]] = d, e
                    if to[e] not in waiting:
                        waiting.add(to[e])
                        todo.append(to[e])
        if 1 not in via:
            return {k: room[e + 1] for k, e in used.items()}
        path, x = [], 1
        while x:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


PLAN = "pattern string, base long, fronts array<struct<after:long,upto:long,most:long>>, fill array<long>"
#: Order keys are longs; nothing comes before the first.
FIRST, LAST = -(1 << 63), (1 << 63) - 1


def mixing_plan(items: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame, dict]:
    """Plan for ``items(pattern, size, h)``, which is read several times: write it down first.

    Returns the plan per pattern (how often all its documents are taken, and up to which order key once more), a
    table ``source, source_size, target``, and the flow by (pattern, source).
    """
    spark = items.sparkSession
    capacity = {r["pattern"]: int(r["n"]) for r in items.groupBy("pattern").agg(F.sum("size").alias("n")).collect()}
    members = {p: json.loads(p) for p in capacity}
    sizes: dict[str | None, int] = defaultdict(int)
    for p, n in capacity.items():
        for s in members[p]:
            sizes[s] += n
    target = targets(sizes, weights, round(share * sum(capacity.values())), repeats) if sizes else {}
    flow = min_cost_flow(capacity, members, {s: round(t) for s, t in target.items()}, repeats)
    given = {p: sum(flow[p, s] for s in members[p]) for p in capacity}
    base = {p: given[p] // n if n else 0 for p, n in capacity.items()}
    rest = {p: given[p] - base[p] * n for p, n in capacity.items()}
    fronts = seeded_front(spark, items, rest)
    plan = spark.createDataFrame([(p, base[p], *fronts.get(p, ([], []))) for p in sorted(capacity)], PLAN)
    shares = spark.createDataFrame([(s, sizes[s], target[s]) for s in sizes], "source string, source_size long, target double")
    return plan, shares, flow


def seeded_front(spark: SparkSession, items: DataFrame, rest: dict[str, int]) -> dict[str, tuple[list[tuple[int, int, int]], list[int]]]:
    """Per pattern the documents whose words add up to ``rest``, as fronts of the seeded order ``(after, upto, longest document)``, and keys that fill the gap.

    A front ends before the first document that does not fit what is left; the next one starts behind it and passes over
    everything longer than the gap, until no document fits. At last one document may be too long if that comes nearer.
    """
    units = items.groupBy("pattern", "h").agg(F.sum("size").alias("size"), F.max("size").alias("one"))
    units = materialize(units.where("size > 0").withColumn("bin", F.expr(f"shiftright(h, {64 - BIN_BITS})")), "mixing-units")
    gap = {p: n for p, n in rest.items() if n}
    after, most = dict.fromkeys(gap, FIRST), dict.fromkeys(gap, LAST)
    found: dict[str, tuple[list[tuple[int, int, int]], list[int]]] = {p: ([], []) for p in gap}
    while after:
        state = spark.createDataFrame([(p, gap[p], after[p], most[p]) for p in after], "pattern string, gap long, after long, most long")
        behind = {}
        for r in next_front(units.join(F.broadcast(state), "pattern").where("h > after and one <= most")).collect():
            p = r["pattern"]
            if r["upto"] is not None:
                found[p][0].append((after[p], r["upto"], most[p]))
                gap[p] -= r["taken"]
            # without a document that does not fit, the pattern is used up
            if r["blocker"] is not None and gap[p] > 0:
                behind[p], most[p] = r["blocker"], gap[p]
        after = behind
    short = [(p, n, *found[p]) for p, n in gap.items() if n > 0]
    if short:
        open_ = units.join(F.broadcast(spark.createDataFrame(short, "pattern string, gap long, fronts array<struct<after:long,upto:long,most:long>>, fill array<long>")), "pattern")
        open_ = open_.where(~taken_once(F.col("h"), F.col("one"), F.col("fronts"), F.col("fill")) & (F.col("size") < 2 * F.col("gap")))
        nearest = F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "h"))
        for r in open_.groupBy("pattern").agg(nearest.alias("x")).collect():
            found[r["pattern"]][1].append(r["x"]["h"])
    return found


def next_front(units: DataFrame) -> DataFrame:
    """Per pattern of ``units(pattern, h, bin, size, gap)``: the last key ``upto`` whose running sum stays within ``gap``, that sum ``taken``, and the key of the first unit that does not fit.

    Running sums go over hash bins first, so only one bin of a pattern is ever sorted.
    """
    per_bin = units.groupBy("pattern", "gap", "bin").agg(F.sum("size").alias("size"), F.max("h").alias("last"))
    upto = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = per_bin.withColumn("sum", F.sum("size").over(upto))
    fits = F.col("sum") <= F.col("gap")
    whole = summed.groupBy("pattern").agg(F.max(F.when(fits, F.struct("sum", "last"))).alias("full"), F.min(F.when(~fits, F.col("bin"))).alias("bin"))
    within = Window.partitionBy("pattern").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.col("full.sum"), F.lit(0))
    inside = units.join(F.broadcast(whole), ["pattern", "bin"]).withColumn("sum", before + F.sum("size").over(within))
    fits = F.col("sum") <= F.col("gap")
    ends = inside.groupBy("pattern").agg(F.max(F.when(fits, F.struct("sum", F.col("h").alias("last")))).alias("part"), F.min(F.when(~fits, F.col("h"))).alias("blocker"))
    end = F.coalesce("part", "full")
    return whole.join(ends, "pattern", "left").select("pattern", end["last"].alias("upto"), F.coalesce(end["sum"], F.lit(0)).alias("taken"), "blocker")


def taken_once(h: Column, size: Column, fronts: Column, fill: Column) -> Column:
    """Whether a document is taken once more than all of its pattern."""
    return F.exists(fronts, lambda f: (h > f["after"]) & (h <= f["upto"]) & (size <= f["most"])) | F.array_contains(fill, h)


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Column ``copies`` for ``rows(pattern, h, size, …)``: how often the mix takes each row."""
    again = taken_once(F.col("h"), F.col("size"), F.col("fronts"), F.col("fill"))
    return rows.join(F.broadcast(plan), "pattern").withColumn("copies", F.col("base") + F.when(again, 1).otherwise(0)).drop("base", "fronts", "fill")


def mixing_items(docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """The input's columns and ``_size``, ``_pattern``, ``_h``."""
    sized = docs.withColumns({"_size": word_count(docs[text_col]), "_pattern": pattern_key(sources)})
    return sized.withColumn("_h", order_key(F.col(id_col), F.col("_size"), F.col("_pattern"), seed))


def mix_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: Sequence[float] = WEIGHTS, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: id, size, the size and target of its source, and ``taken``, the words the mix takes from it."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).alias("_source"))
    items = mixing_items(narrow, F.array("_source"), "_id", "_text", seed)
    items = materialize(items.select(F.col("_id").alias("id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_pattern").alias("pattern"), F.col("_h").alias("h")), "mixing-items")
    plan, shares, _ = mixing_plan(items, weights)
    drawn = with_copies(items, plan)
    shares = F.broadcast(shares.withColumnRenamed("source", "_s"))
    return drawn.join(shares, drawn["source"].eqNullSafe(shares["_s"])).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_rows(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", weights: Sequence[float] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    sized = mixing_items(docs, F.array(F.col(source_col)), id_col, text_col, seed)
    items = materialize(sized.select(F.col("_size").alias("size"), F.col("_pattern").alias("pattern"), F.col("_h").alias("h")), "mixing-items")
    plan, _, _ = mixing_plan(items, weights)
    plan = plan.select(F.col("pattern").alias("_pattern"), *[F.col(c).alias(f"_{c}") for c in ("base", "fronts", "fill")])
    again = taken_once(F.col("_h"), F.col("_size"), F.col("_fronts"), F.col("_fill"))
    drawn = sized.join(F.broadcast(plan), "_pattern").withColumn("_copies", F.col("_base") + F.when(again, 1).otherwise(0))
    return drawn.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*docs.columns)
