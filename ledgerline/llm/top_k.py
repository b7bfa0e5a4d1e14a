"""Exact top-k inner products on a bit-sliced index.

The index holds the rows in blocks. Of each dimension a block keeps the ``SLICES`` top bits of the offset value, one bitmap per bit
(bit ``r`` for row ``r``), and beside them the exact values. A query adds, for every set bit of every component, the slices of that dimension at the
weight of the bit (the complemented slices where the component is negative), with carry-save adders on whole bitmaps; the result is the
quantised score of all rows as slices. From the most significant slice downward the rows are narrowed to the k-th greatest
quantised score. The bits that were cut off can move a score by at most a known width, so only rows within that width below the k-th can
belong to the answer; these boundary rows get their exact integer score, and ties go to the smaller id. Nothing is estimated: the answer is exact.

Blocks of queries are a bounded part of a task, as is one block of the index: a task holds one index block and at most ``QUERIES_A_TASK`` queries, and
returns at most k rows per query and block. The best k over all blocks are ranked per query, cut to k rows in every task before the shuffle.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite components take no part, nor do rows with a NULL id or with a value beyond
``2**28`` (its products would not fit a long); vectors of different lengths have no score; rows with the query's own id are its own rows and no candidates;
a repeated query row has its answer once per row, a repeated candidate row is one candidate per row; fewer than k candidates give fewer rows; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

#: Bits kept of each value, most rows of an index block, numbers in one, and queries in one row and in one task.
SLICES, BLOCK_ROWS, BLOCK_NUMBERS, QUERY_ROWS, QUERIES_A_TASK = 6, 16_384, 4_000_000, 64, 2_048
#: Values are whole numbers of this part of one.
SCALE = 1024
LARGEST = 2**28
WORD = 64


def bitmap(bits: np.ndarray) -> np.ndarray:
    """0/1 rows along the last axis, packed into 64-bit words."""
    pad = -bits.shape[-1] % WORD
    full = np.pad(bits.astype(np.uint8), [(0, 0)] * (bits.ndim - 1) + [(0, pad)])
    return np.packbits(full, axis=-1, bitorder="little").view(np.uint64)


def members(words: np.ndarray) -> np.ndarray:
    """Rows that are set in a bitmap."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def build(values: np.ndarray) -> tuple[np.ndarray, int]:
    """``(dimension, bit, words)`` slices of the offset values, and the number of low bits that were cut off."""
    offset = values - values.min(axis=0)
    cut = max(0, int(offset.max(initial=0)).bit_length() - SLICES)
    top = (offset >> cut).T
    return bitmap((top[:, None, :] >> np.arange(SLICES)[None, :, None]) & 1), cut


def add(stacks: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps by weight, as one bitmap per bit; each stack is ``(bitmaps, words)``."""
    out, weight = [], min(stacks, default=0)
    out += [None] * weight
    while stacks:
        here = stacks.pop(weight, None)
        x = np.concatenate(here) if here else ()
        while len(x) > 1:
            third = len(x) // 3
            if third:
                a, b, c, rest = x[:third], x[third : 2 * third], x[2 * third : 3 * third], x[3 * third :]
                both = a ^ b
                carry, x = (a & b) | (both & c), np.concatenate([both ^ c, rest])
            else:
                carry, x = (x[0] & x[1])[None], (x[0] ^ x[1])[None]
            stacks.setdefault(weight + 1, []).append(carry)
        out.append(x[0] if len(x) else None)
        weight += 1
    return out


def scores(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray | None]:
    """Quantised scores of all rows of a block as slices, least significant first (None: all zero), up to a constant."""
    size, stacks = np.abs(query), {}
    for bit in range(int(size.max(initial=0)).bit_length()):
        has = (size >> bit) & 1 == 1
        plus, minus = slices[has & (query > 0)], ~slices[has & (query < 0)]
        for j in range(SLICES):
            stacks.setdefault(bit + j, []).append(np.concatenate([plus[:, j], minus[:, j]]))
    return add(stacks)


def kth(total: list[np.ndarray | None], rows: np.ndarray, k: int) -> int:
    """The k-th greatest quantised score among ``rows`` (a bitmap with at least k rows), from the top slice downward."""
    value, sure, open_ = 0, 0, rows
    for i in range(len(total) - 1, -1, -1):
        if total[i] is None:
            continue
        high = open_ & total[i]
        count = int(np.bitwise_count(high).sum())
        if sure + count >= k:
            value, open_ = value | 1 << i, high
        else:
            sure, open_ = sure + count, open_ & ~total[i]
    return value


def at_least(total: list[np.ndarray | None], rows: np.ndarray, value: int) -> np.ndarray:
    """Those of ``rows`` whose quantised score is at least ``value``."""
    if value <= 0:
        return rows
    if value >> len(total):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for i in range(len(total) - 1, -1, -1):
        one = total[i] if total[i] is not None else np.zeros_like(rows)
        if value >> i & 1:
            equal = equal & one
        else:
            above, equal = above | (equal & one), equal & ~one
    return above | equal


def top_of_block(slices: np.ndarray, cut: int, values: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the k best rows of a block, best first."""
    rows = bitmap(ids != own)
    if len(ids) > k:
        total = scores(slices, query)
        if int(np.bitwise_count(rows).sum()) > k:
            # what the cut bits can add to a score, from the least to the most, in units of the quantised score
            width = int(np.abs(query).sum()) * ((1 << cut) - 1)
            rows = at_least(total, rows, kth(total, rows, k) - (width >> cut) - 1)
    at = members(rows)
    exact = values[at] @ query
    best = np.lexsort((ids[at], -exact))[:k]
    return ids[at][best], exact[best]


def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per index block: the rows of a task in its order, by vector length."""
    held: dict[int, list[pd.DataFrame]] = {}

    def block(dim: int) -> pd.DataFrame:
        rows = pd.concat(held.pop(dim))
        values = np.stack(list(rows["v"])).astype(np.int64)
        slices, cut = build(values)
        return pd.DataFrame({"dim": [dim], "n": [len(rows)], "cut": [cut], "slices": [slices.tobytes()], "vals": [values.astype(np.int32).tobytes()], "ids": [rows["id"].to_numpy(np.int64).tobytes()]})

    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // dim))
            for at in range(0, len(rows), most):
                part = rows.iloc[at : at + most]
                if sum(map(len, held.get(dim, []))) + len(part) > most:
                    yield block(dim)
                held.setdefault(dim, []).append(part)
    for dim in sorted(held):
        yield block(dim)


def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Query rows by vector length, at most ``QUERY_ROWS`` in one row."""
    for batch in batches:
        for dim, rows in batch.groupby("dim"):
            for at in range(0, len(rows), QUERY_ROWS):
                part = rows.iloc[at : at + QUERY_ROWS]
                values = np.stack(list(part["v"])).astype(np.int32)
                yield pd.DataFrame({"dim": [dim], "q_vals": [values.tobytes()], "q_rows": [part["row"].to_numpy(np.int64).tobytes()], "q_ids": [part["id"].to_numpy(np.int64).tobytes()]})


FOUND = "row long, query_id long, vec_id long, score long"


def answer(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for one in index.itertuples():
            slices = np.frombuffer(one.slices, np.uint64).reshape(one.dim, SLICES, -1)
            values = np.frombuffer(one.vals, np.int32).reshape(-1, one.dim).astype(np.int64)
            ids = np.frombuffer(one.ids, np.int64)
            for some in queries.itertuples():
                asking = np.frombuffer(some.q_vals, np.int32).reshape(-1, one.dim).astype(np.int64)
                for query, row, own in zip(asking, np.frombuffer(some.q_rows, np.int64), np.frombuffer(some.q_ids, np.int64), strict=True):
                    found, exact = top_of_block(slices, one.cut, values, ids, query, own, k)
                    out.append(pd.DataFrame({"row": row, "query_id": own, "vec_id": found, "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("row", "query_id", "vec_id", "score")})

    return run


def whole_numbers(vector: Column) -> Column:
    """``floor(1024 * x)`` of every component, or NULL where the vector takes no part."""
    scaled = F.transform(vector, lambda x: F.floor(F.when(F.abs(x.cast("double")) < LARGEST / SCALE, x.cast("double") * SCALE)).cast("int"))
    return F.when((F.size(vector) > 0) & ~F.exists(scaled, lambda x: x.isNull()), scaled)


def top_inner_products(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row where ``queries`` holds its ``k`` best rows: ``query_id``, ``rank``, ``vec_id`` and ``score``."""
    spark = vectors.sparkSession
    whole = vectors.select(vectors[id_col].cast("long").alias("id"), whole_numbers(vectors[vector_col]).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    whole = whole.where("v is not null and id is not null").withColumn("dim", F.size("v"))
    index = whole.select("id", "v", "dim").mapInPandas(indexed, "dim int, n long, cut int, slices binary, vals binary, ids binary")
    index = materialize(index.withColumn("block", F.monotonically_increasing_id()), "bit-slices")
    named = whole.where("asks").select("id", "v", "dim", F.monotonically_increasing_id().alias("row"))
    asking = materialize(named.mapInPandas(asked, "dim int, q_vals binary, q_rows binary, q_ids binary").withColumn("part", F.monotonically_increasing_id()), "queries")
    # a task is one index block and a bounded number of queries
    parts = max(1, -(-asking.count() * QUERY_ROWS // QUERIES_A_TASK))
    blocks = index.select(F.col("dim").alias("dim"), F.col("block").alias("block"))
    tasks = max(1, min(blocks.count() * parts, 20_000))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, "dim", "block", "part")
    right = asking.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)).cast("int")).join(blocks, "dim").repartition(tasks, "dim", "block", "part")
    key = ["dim", "block", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(answer(k), FOUND)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    best = materialize(found, "block-answers").withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
