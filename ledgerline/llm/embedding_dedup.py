"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside cells, one vector kept per group.

Equal vectors are one class with a weight, so copies cost one comparison. Classes are assigned to the nearest of
``k`` unit centres (fitted on a bounded sample). A class is also shown, as a guest, in every other cell whose gap (the cosine with
its own centre less that with the other) is at most half the longest chord of a link times the distance of the two centres. The two gaps of a
linked pair sum to at most its chord times that distance, so one side always sees the pair, whatever the vectors
and their dimension; ``reach`` is the share of that band that is visited, and below 1 links may be lost.
Guests first travel as codes of one byte per component with the exact length of their rounding error: the product of two codes and these lengths bound the cosine,
and only guests that can reach the limit with some home class of the cell stay (no link is lost). Then home classes are multiplied with home classes
and the guests that stayed, block by block, in double precision. Blocks are numbered by the home classes and by the guests of a cell, and home blocks meet once.
A pair that both cells see counts once for each side, in its own cell; a pair that one cell sees counts for both sides there. Blocks return link counts
and at most one link per class, never all pairs.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components link with nothing, nor do vectors of
different lengths; a NULL id never names a component while another id is in it; every row is a vector, so repeated rows are
linked copies; an empty table gives an empty table. ``kept`` is whether the id names its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import small_batches
from .components import connected_components

LEAST_COSINE = 0.9
#: Vectors of the sample that centres are fitted on (fewer if they are long: so many numbers in all), classes per cell aimed at, and most cells.
SAMPLE_ROWS, SAMPLE_NUMBERS, CELL_ROWS, MOST_CELLS = 20_000, 4_000_000, 2_000, 4_096
#: Rows that are held against all centres at once.
STEP = 500
ROUNDS = 10
#: Share of the band in which classes are shown as guests; all links are found from 1 on.
REACH = 1.0
#: Rows of one block of home classes (a task holds two blocks and their products), guest codes held against one, and most tasks of a shuffle.
BLOCK, GUESTS, TASKS = 2_048, 16_384, 20_000


def fit_centres(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means from evenly spaced rows; an emptied centre keeps its place."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[at : at + STEP] @ centres.T, axis=1) for at in range(0, len(x), STEP)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def visits(x: np.ndarray, centres: np.ndarray, least: float, reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each row, and all cells it is shown in."""
    near = x @ centres.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres[home] @ centres.T, 0))
    step = min(reach, 2.0) * math.sqrt(max(2 - 2 * least, 0.0)) / 2
    gap = near[np.arange(len(x)), home][:, None] - near
    shown = gap <= step * apart + 1e-9
    shown[np.arange(len(x)), home] = True
    return home, [np.flatnonzero(s) for s in shown]


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows as bytes, the size of one step, and the length of what rounding changed."""
    step = np.abs(x).max(axis=1) / 127
    code = np.rint(x / step[:, None]).astype(np.int8)
    return code, step, np.linalg.norm(x - code * step[:, None], axis=1) + 1e-12


def reachable(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Guests of a cell whose cosine with some home class of the block may be ``least`` or more."""
    home = rows["side"].to_numpy() == 0
    left, right = rows[home], rows[~home]
    if left.empty or right.empty:
        return pd.DataFrame({"cell": pd.Series(dtype="int32"), "cid": pd.Series(dtype="int64")})
    dim = len(left["code"].iloc[0])
    # whole numbers up to 127 * 127 * dim are exact in 32 bits up to 1,040 dimensions
    kind = np.float32 if dim <= 1_024 else np.float64
    read = lambda part: np.frombuffer(b"".join(part), np.int8).reshape(-1, dim).astype(kind)
    a, step, error = read(left["code"]), left["step"].to_numpy(), left["error"].to_numpy()
    stay = []
    for at in range(0, len(right), BLOCK):
        part = right.iloc[at : at + BLOCK]
        e = part["error"].to_numpy()
        most = (a @ read(part["code"]).T) * step[:, None] * part["step"].to_numpy() + error[:, None] * (1 + e) + (1 + 2 * error[:, None]) * e
        stay.append(part["cid"].to_numpy()[(most >= least - 1e-6).any(axis=0)])
    return pd.DataFrame({"cell": rows["cell"].iloc[0], "cid": np.concatenate(stay)}).astype({"cell": "int32"})


def joined(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least column linked (through any steps) with each row and each column of a block, as labels."""
    none = hit.shape[1]
    columns = np.arange(none)
    while True:
        rows = np.where(hit, columns[None, :], none).min(axis=1, initial=none)
        back = np.minimum(columns, np.where(hit, rows[:, None], none).min(axis=0, initial=none))
        if (back == columns).all():
            return rows, columns
        columns = back


def block_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Link counts and component links of one pair of blocks: home classes of block ``i`` against those, or the guests, of block ``j``."""
    cell, i, j = rows["cell"].iloc[0], rows["i"].iloc[0], rows["j"].iloc[0]
    left = rows[rows["side"] == 0]
    right = left if i == j else rows[rows["side"] == 1]
    empty = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})
    if left.empty or right.empty:
        return empty
    a, b = left["cid"].to_numpy(), right["cid"].to_numpy()
    hit = (unit(left["v"]) @ unit(right["v"]).T >= least) & (a[:, None] != b[None, :])
    some, other = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not some.size:
        return empty
    left, right, hit, a, b = left.iloc[some], right.iloc[other], hit[np.ix_(some, other)], a[some], b[other]
    counts = [pd.DataFrame({"a": a, "n": hit @ right["n"].to_numpy(np.int64)})]
    if i != j:
        # does the left row visit the guest's home? then that cell counts the pair for the guest
        homes, place = np.unique(right["home"].to_numpy(), return_inverse=True)
        seen = np.stack([np.isin(homes, c) for c in left["cells"]])
        seen[:, homes == cell] = False
        counts.append(pd.DataFrame({"a": b, "n": left["n"].to_numpy(np.int64) @ (hit & ~seen[:, place])}))
    of_left, of_right = joined(hit)
    links = pd.DataFrame({"a": np.concatenate([a, b]), "b": b[np.concatenate([of_left, of_right])], "n": 0})
    every = pd.concat([*(c[c["n"] > 0] for c in counts), links[links["a"] != links["b"]]])
    return every[["a", "b", "n"]].astype({"a": "int64", "b": "Int64", "n": "int64"})


def link_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE, reach: float = REACH) -> DataFrame:
    """Per row: id, ``n_links`` (other vectors linked directly), ``component_id`` and ``kept``."""
    small_batches(vectors.sparkSession, STEP)
    plain = vectors.schema[vector_col].dataType.elementType.simpleString()
    # components keep their type (a float is exact in four bytes); adding zero makes -0.0 and 0.0 one
    kind = "float" if plain == "float" else "double"
    v = F.transform(F.col("v"), lambda x: x.cast(kind) + F.lit(0.0).cast(kind))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("v")).withColumn("v", v)
    sound = F.coalesce(~F.exists("v", odd) & F.exists("v", lambda x: x != 0.0), F.lit(False))
    rows = rows.withColumn("key", F.when(sound, F.md5(F.to_json("v").cast("binary"))))
    classes = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.first("v").alias("v"))
    rows, classes = materialize(rows.select("id", "key"), "embedding-rows"), materialize(classes.withColumns({"cid": F.monotonically_increasing_id(), "dim": F.size("v")}), "embedding-classes")

    found, links = None, None
    for dim, n in sorted((r["dim"], r["count"]) for r in classes.groupBy("dim").count().collect()):
        same = classes.where(F.col("dim") == dim)
        counts, pairs = links_of_length(same, n, dim, least, reach)
        found = counts if found is None else found.unionByName(counts)
        links = pairs if links is None else links.unionByName(pairs)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    labels = connected_components(links).withColumnRenamed("node", "cid")
    direct = found.groupBy("cid").agg(F.sum("others").alias("others"))
    full = classes.select("key", "cid", "n", "id").join(direct, "cid", "left").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    smallest = full.groupBy("label").agg(F.min("id").alias("component_id"))
    full = full.join(smallest, "label").select("key", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "key").join(full, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def links_of_length(classes: DataFrame, n: int, dim: int, least: float, reach: float) -> tuple[DataFrame, DataFrame]:
    """``cid, others`` (weights of linked classes, to be summed) and links ``a, b`` among ``classes(cid, n, v)``."""
    spark = classes.sparkSession
    sample = classes.select("v", F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim))).select("v").collect()
    k = max(1, min(MOST_CELLS, n // CELL_ROWS, len(sample)))
    centres = spark.sparkContext.broadcast(fit_centres(unit(pd.Series([r["v"] for r in sample])), k))

    kind = dict(classes.dtypes)["v"]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                x = unit(part["v"])
                home, cells = visits(x, centres.value, least, reach)
                code, step, error = codes(x)
                yield part.assign(home=home.astype("int32"), cells=[c.astype("int32") for c in cells], code=[c.tobytes() for c in code], step=step, error=error)

    placed = classes.select("cid", "n", "v").mapInPandas(assign, f"cid long, n long, v {kind}, home int, cells array<int>, code binary, step double, error double")
    placed = materialize(placed, "embedding-cells")
    of = lambda most: F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / most)).cast("int")
    counted = lambda frame: frame.join(F.broadcast(frame.groupBy("cell").agg(F.count("*").alias("size"))), "cell")

    def dealt(homes: DataFrame, guests: DataFrame, most: int, among: bool) -> DataFrame:
        """Rows of each pair of blocks: ``i`` counts home blocks; ``j`` counts guest blocks, after the home blocks if these meet as well."""
        homes = counted(homes).withColumns({"block": of(BLOCK), "own": F.ceil(F.col("size") / BLOCK).cast("int")}).drop("size")
        guests = counted(guests).withColumns({"block": of(most), "blocks": F.ceil(F.col("size") / most).cast("int")}).drop("size")
        own = homes.groupBy("cell").agg(F.max("own").alias("own"))
        facing = guests.groupBy("cell").agg(F.max("blocks").alias("facing"))
        homes = homes.join(F.broadcast(facing), "cell", "left").fillna(0, ["facing"])
        first = F.col("block") if among else F.col("own")
        last = F.col("own") + F.col("facing") - 1
        left = homes.where(first <= last).withColumns({"i": F.col("block"), "j": F.explode(F.sequence(first, last)), "side": F.lit(0)})
        right = guests.join(F.broadcast(own), "cell").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("own") - 1)), "j": F.col("own") + F.col("block"), "side": F.lit(1)})
        both = left.drop("block", "own", "facing").unionByName(right.drop("block", "own", "blocks"))
        if among:
            later = homes.where("block > 0").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("block") - 1)), "j": F.col("block"), "side": F.lit(1)})
            both = both.unionByName(later.drop("block", "own", "facing"))
        tasks = own.join(facing, "cell", "left").agg(F.sum(F.col("own") * (F.coalesce("facing", F.lit(0)) + (F.col("own") if among else 0)))).first()[0]
        return both.repartition(max(1, min(int(tasks or 1), TASKS)), "cell", "i", "j")

    light = placed.select("cid", "home", "code", "step", "error")
    visiting = placed.select("cid", "home", "code", "step", "error", F.explode("cells").alias("cell")).where("cell <> home")
    near = dealt(light.withColumn("cell", F.col("home")), visiting, GUESTS, False).groupBy("cell", "i", "j").applyInPandas(lambda rows: reachable(rows, least), "cell int, cid long")
    near = materialize(near, "embedding-guests").distinct()
    whole = placed.select("cid", "n", "v", "home", "cells")
    paired = dealt(whole.withColumn("cell", F.col("home")), whole.join(near, "cid").select("cell", *whole.columns), BLOCK, True)
    pairs = paired.groupBy("cell", "i", "j").applyInPandas(lambda rows: block_links(rows, least), "a long, b long, n long")
    pairs = materialize(pairs, "embedding-pairs")
    return pairs.where("b is null").select(F.col("a").alias("cid"), F.col("n").alias("others")), pairs.where("b is not null").select("a", "b")
