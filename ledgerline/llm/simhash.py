"""SimHash near-duplicates through covering masks: no pair within the radius is missed, whatever its bits.

Bit ``i`` of a fingerprint gets the vector ``i mod 2^(r+1)`` over GF(2)^(r+1). Every non-zero vector ``v`` makes one mask:
the bits whose vector has an odd product with ``v``. The vectors of at most ``r`` differing bits span less than
the whole space, so some ``v`` is orthogonal to all of them and its mask leaves out every differing bit: the pair
agrees under that mask and meets in its table (Pagh's covering construction).

Links inside a bucket are found in two steps. Every member is first held against one leader of its bucket. What
is connected by then needs no further comparison, so only buckets that still hold more than one
component are compared in full, in blocks, and a block returns at most one link per component in it.

Defined results: NULL and texts without words have fingerprint zero, which is linked like any other; a NULL id
never names a component while another id is in it; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import materialize
from .common import small_batches
from .components import connected_components, labels_of_pairs

BITS = 64
#: Members of one block of a large bucket; a task holds two blocks.
BLOCK = 2048
#: Rows of a block that are held against the other block at once, pairs of blocks of one task, and most tasks of that comparison.
ROWS, TASK_PAIRS, TASKS = 256, 64, 20_000
STEP = 1 << 16  # shingles whose bits are counted at once


def text_fingerprint(text: str | None, words_per_shingle: int = 4, seed: int = 42) -> int:
    """Unsigned fingerprint of one text: bit set if set in over half the shingle hashes."""
    words = (text or "").encode().lower().split()  # of bytes, both are limited to ASCII
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for at in range(0, n, STEP):
        part = words[at : at + STEP + k - 1]
        hashes = np.array([digest(s, seed) for s in map(join, zip(*(part[i:] for i in range(k)), strict=False))], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words_per_shingle: int = 4, seed: int = 42) -> Column:
    """Fingerprint as a long with the same 64 bits."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((text_fingerprint(t, words_per_shingle, seed) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return run(text)


def covering_masks(radius: int) -> list[int]:
    """One signed 64-bit mask per non-zero vector."""
    size = 1 << (radius + 1)
    masks = [sum(1 << i for i in range(BITS) if ((i % size) & v).bit_count() % 2) for v in range(1, size)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def block_links(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Links between the components of one pair of blocks: enough to connect all that are within the radius."""
    i, j = rows["i"].iloc[0], rows["j"].iloc[0]
    left, right = rows[rows["block"] == i], rows[rows["block"] == j]
    names, of = np.unique(np.concatenate([left["label"], right["label"]]), return_inverse=True)
    a, b = of[: len(left)], of[len(left) :]
    x, y = left["fp"].to_numpy().view(np.uint64), right["fp"].to_numpy().view(np.uint64)
    near = []
    for at in range(0, len(x), ROWS):
        r, c = np.nonzero(np.bitwise_count(x[at : at + ROWS, None] ^ y) <= radius)
        pairs = a[at + r] * names.size + b[c]
        near.append(np.unique(pairs[a[at + r] != b[c]]))
    pairs = np.unique(np.concatenate(near)) if near else np.zeros(0, np.int64)
    root = labels_of_pairs(pairs // names.size, pairs % names.size, names.size)
    joined = np.flatnonzero(root != np.arange(names.size))
    return pd.DataFrame({"a": names[joined], "b": names[root[joined]]}).astype("int64")


def fingerprint_components(fps: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """``fp``, ``label`` (equal within a component) and ``component`` (its smallest id) for all distinct fingerprints of ``fps(id, fp)``."""
    points = materialize(fps.groupBy("fp").agg(F.min("id").alias("id")), "simhash-points")
    masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)])
    keyed = points.select("fp", F.posexplode(masks).alias("t", "mask")).select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("lead")).where("n > 1")
    # Spark sizes the masked rows like the points they come from, 31 times too low, and would send them to the driver for a broadcast
    members = materialize(keyed.hint("merge").join(shared, ["t", "key"]), "simhash-members")

    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("lead"))) <= radius
    first = materialize(members.where(near & (F.col("fp") != F.col("lead"))).select(F.col("fp").alias("a"), F.col("lead").alias("b")).distinct(), "simhash-first")
    known = connected_components(first)
    named = members.join(known.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    mixed = named.groupBy("t", "key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("t", "key")
    left = named.join(mixed, ["t", "key"], "left_semi")

    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_x"))
    pairs = dealt.select("t", "key", "fp", "label", "block", F.least("block", "_x").alias("i"), F.greatest("block", "_x").alias("j"))
    # the blocks are small in bytes and long in work, so tasks follow the pairs of blocks, not the bytes
    work = dealt.groupBy("t", "key").agg(F.first("blocks").alias("blocks")).agg(F.sum(F.col("blocks") * (F.col("blocks") + 1) / 2)).first()[0]
    pairs = pairs.repartition(max(1, min(int(work or 1) // TASK_PAIRS + 1, TASKS)), "t", "key", "i", "j")
    more = pairs.groupBy("t", "key", "i", "j").applyInPandas(lambda rows: block_links(rows, radius), "a long, b long")

    links = materialize(more.distinct(), "simhash-more")
    final = connected_components(first.unionByName(links))
    named_points = points.join(final.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = named_points.groupBy("label").agg(F.min("id").alias("component"))
    return named_points.join(smallest, "label").select("fp", "label", "component")


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4, radius: int = 4) -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest id reachable by links."""
    small_batches(docs.sparkSession)
    prints = docs.select(docs[id_col].alias("id"), fingerprint(docs[text_col], words_per_shingle).alias("fp"))
    prints = materialize(prints, "simhash-prints")
    found = fingerprint_components(prints, radius)
    return prints.join(found, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with its smallest id (of several with that id, one fixed by its text)."""
    small_batches(docs.sparkSession)
    printed = materialize(docs.withColumn("_fp", fingerprint(F.col(text_col), words_per_shingle)), "simhash-documents")
    ids = printed.select(F.col(id_col).alias("id"), F.col("_fp").alias("fp"))
    found = fingerprint_components(ids, radius)
    first = ids.join(found, "fp").where(F.col("id").eqNullSafe(F.col("component"))).groupBy("label").agg(F.min(F.struct("id", "fp")).alias("r"))
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stay = first.select(key("r.id").alias("_key"), F.col("r.fp").alias("_fp"))
    kept = printed.withColumn("_key", key(id_col)).join(stay, ["_key", "_fp"])
    nth = F.row_number().over(Window.partitionBy("_key", "_fp").orderBy(F.xxhash64(text_col)))
    return kept.withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)
