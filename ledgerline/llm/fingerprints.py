"""Document fingerprints: invertible Bloom lookup sketches whose difference gives back the differing paragraphs.

A paragraph is a line, cut after words that the content picks: those whose hash, taken with the word in front, ends in
``CUT_BITS`` zeros (words lie between spaces). So an insertion changes the paragraphs it stands in and leaves the later ones alone.
Only a stretch without such a word is cut every ``PIECE`` characters. The first four words stand alone, so that short texts have more
than one paragraph. A digest also counts repeats, so the digests of a text are distinct. A sketch has three tables of cells. Every digest goes to one cell of each table, and a cell holds how many came,
the XOR of the digests and the XOR of their check hashes. Sketches of two versions subtract cell by cell, which
cancels what they share. Peeling then looks for cells that hold a single digest (its check hash fits), notes
the digest and takes it out of its other cells, until nothing is left.

The fingerprint is a small sketch of fixed size. When the difference of two fingerprints does not peel, the digests are dealt into
groups by their high bits, each with a sketch of its own, and groups that still fail are tried again with wider tables.

Only DataFrame functions are used, row by row, so nothing is gathered over documents. Defined results: NULL counts as
the empty text, whose sketch is empty; two empty texts are alike (1.0); rows that agree in id and text are one
document in the order of documents and give one result row each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import materialize
from .common import whole_text

#: One word in 2^CUT_BITS ends a paragraph; no paragraph is longer than PIECE characters, no word of the first one longer than HEAD.
CUT_BITS, PIECE, HEAD = 5, 2048, 32
#: Cells per table: of the fingerprint, and of the sketches of a group at each try.
FINGERPRINT_WIDTH = 4
TRIES = (8, 32, 256)
#: Digests of both versions in one group, on average at most.
GROUP = 16
ROUNDS = 10
TABLES = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def paragraph_digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text, sorted before repeats are numbered."""
    ends = lambda words: lambda w, i: F.xxhash64(F.get(words, i - 1), w).bitwiseAND(F.lit((1 << CUT_BITS) - 1).cast("long")) == 0
    marked = let(F.split(text, " "), lambda words: F.array_join(F.transform(words, lambda w, i: F.when(ends(words)(w, i), F.concat(w, F.lit("\n"))).otherwise(w)), " "))
    pieces = F.regexp_extract_all(marked, F.lit(rf"^(?:[^\n ]{{1,{HEAD}}} ?){{1,4}}|[^\n]{{1,{PIECE}}}"), F.lit(0))
    hashes = F.sort_array(F.transform(pieces, lambda p: F.xxhash64(p)))
    return let(hashes, lambda s: F.transform(s, lambda d, i: F.xxhash64(d, i - F.array_position(s, d))))


def place(digest: Column, t: int, width: int) -> Column:
    return F.shiftrightunsigned(digest, 24 + 11 * t).bitwiseAND(F.lit(width - 1).cast("long")).cast("int")


def cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), c.alias("c"))


def sketch(digests: Column, width: int) -> Column:
    """Cells of an array of digests: table after table."""
    empty = cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))

    def cells(items: Column, t: int) -> Column:
        def gather(j: Column) -> Column:
            add = lambda acc, x: F.when(x[f"p{t}"] == j, cell(acc["n"] + 1, acc["k"].bitwiseXOR(x["k"]), acc["c"].bitwiseXOR(x["c"]))).otherwise(acc)
            return F.aggregate(items, empty, add)

        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), gather)

    items = F.transform(digests, lambda d: F.struct(d.alias("k"), F.xxhash64(d).alias("c"), *[place(d, t, width).alias(f"p{t}") for t in range(TABLES)]))
    return let(items, lambda x: F.concat(*[cells(x, t) for t in range(TABLES)]))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["c"].bitwiseXOR(y["c"])))


def peel(cells: Column, width: int) -> Column:
    """Struct of ``found``, the digests recovered, and ``done``: whether nothing is left in the cells."""

    def pure(state: Column) -> Column:
        single = F.filter(state["cells"], lambda x: (F.abs(x["n"]) == 1) & (F.xxhash64(x["k"]) == x["c"]))
        return F.array_distinct(single)

    def take(x: Column, at: Column, hits: Column) -> Column:
        spot = lambda k: F.when(at < width, place(k, 0, width)).when(at < 2 * width, place(k, 1, width)).otherwise(place(k, 2, width))
        out = lambda acc, h: F.when(spot(h["k"]) == at % width, cell(acc["n"] - h["n"], acc["k"].bitwiseXOR(h["k"]), acc["c"].bitwiseXOR(h["c"]))).otherwise(acc)
        return F.aggregate(hits, x, out)

    def step(state: Column, _: Column) -> Column:
        def use(hits: Column) -> Column:
            rest = F.transform(state["cells"], lambda x, at: take(x, at, hits))
            more = F.struct(rest.alias("cells"), F.concat(state["found"], F.transform(hits, lambda h: h["k"])).alias("found"), F.lit(True).alias("open"))
            return F.when(F.size(hits) > 0, more).otherwise(F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("open")))

        return F.when(state["open"], let(pure(state), use)).otherwise(state)

    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"), F.lit(True).alias("open"))
    over = lambda s: F.struct(s["found"].alias("found"), (~F.exists(s["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["c"] != 0))).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, over)


def group_difference(a: Column, b: Column) -> Column:
    """Digests in one of two small sets only, by sketches of growing width; a set that beats the widest is compared directly."""

    def attempt(left: tuple[int, ...]) -> Column:
        if not left:
            return F.concat(F.array_except(a, b), F.array_except(b, a))
        width = left[0]
        return let(peel(subtract(sketch(a, width), sketch(b, width)), width), lambda r: F.when(r["done"], r["found"]).otherwise(attempt(left[1:])))

    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.concat(a, b)).otherwise(attempt(TRIES))


def dealt(digests: Column, bits: Column) -> Column:
    """``2^bits`` arrays of digests by their high bits: the bounds are sorted in among the digests, which are cut there."""
    shift = lambda x, n: F.call_function("shiftleft", x, n)
    one, low = F.lit(1).cast("long"), F.lit(-(1 << 63))
    bounds = let(bits, lambda n: F.transform(F.sequence(F.lit(0).cast("long"), shift(one, n) - 1), lambda g: shift(g, 64 - n).bitwiseXOR(low)))

    def cut(line: Column) -> Column:
        at = F.concat(F.transform(bounds, lambda x: F.array_position(line, x)), F.array(F.size(line).cast("long") + 1))
        return let(at, lambda p: F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: F.slice(line, (F.element_at(p, i) + 1).cast("int"), (F.element_at(p, i + 1) - F.element_at(p, i) - 1).cast("int"))))

    return let(F.sort_array(F.concat(digests, bounds)), cut)


def difference(a: Column, b: Column, small: Column) -> Column:
    """Digests in one of two arrays only. ``small`` is the difference of the fingerprints, which is tried first."""
    bits = F.least(F.greatest(F.lit(0), F.ceil(F.log2((F.size(a) + F.size(b) + 1) / F.lit(float(GROUP))))), F.lit(20)).cast("int")
    pairs = lambda n: F.zip_with(dealt(a, n), dealt(b, n), lambda x, y: F.struct(x.alias("a"), y.alias("b")))
    split = let(bits, pairs)
    larger = F.flatten(F.transform(split, lambda x: group_difference(x["a"], x["b"])))
    return let(peel(small, FINGERPRINT_WIDTH), lambda r: F.when(r["done"], r["found"]).otherwise(larger))


def likeness(n_a: Column, n_b: Column, n_different: Column) -> Column:
    """Shared paragraphs of all paragraphs of two texts."""
    shared = (n_a + n_b - n_different) / 2
    return F.when(n_a + n_b == 0, F.lit(1.0)).otherwise(shared / (shared + n_different))


def shown(cells: Column) -> Column:
    """Cells as text: count, digest and the low half of the check hash in hexadecimal digits."""
    part = lambda x: F.concat(F.hex(x["n"].cast("long")), F.lit("."), F.lpad(F.hex(x["k"]), 16, "0"), F.substring(F.lpad(F.hex(x["c"]), 16, "0"), 9, 8))
    return F.lower(F.array_join(F.transform(cells, part), "-"))


def following(keys: DataFrame) -> DataFrame:
    """``keys(id, k, …)`` with ``next_id`` and ``next_k``: the next in descending order of id (NULL last), then k; the first follows the last.

    Keys are dealt by range, the order is taken within each range, and only the first key of each range is
    gathered to join the ranges.
    """
    order = [F.col("id").desc_nulls_last(), F.col("k").asc()]
    dealt = materialize(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    within = Window.partitionBy("part").orderBy(*order)
    ranked = dealt.withColumns({"_nr": F.row_number().over(within), "_next": F.lead(F.struct("id", "k")).over(within)})
    firsts = sorted((r["part"], r["id"], r["k"]) for r in ranked.where("_nr = 1").select("part", "id", "k").collect())
    after = [(p, *firsts[(i + 1) % len(firsts)][1:]) for i, (p, _, _) in enumerate(firsts)]
    schema = f"part int, _id {keys.schema['id'].dataType.simpleString()}, _k bigint"
    jumps = keys.sparkSession.createDataFrame(after, schema)
    last = F.col("_next").isNull()
    out = ranked.join(jumps, "part").withColumns({"next_id": F.when(last, F.col("_id")).otherwise(F.col("_next.id")), "next_k": F.when(last, F.col("_k")).otherwise(F.col("_next.k"))})
    return out.drop("part", "_nr", "_next", "_id", "_k")


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n_chars``, ``edited`` (the last third replaced by the front of the next document), and the digests ``a`` of the text and ``b`` of the next text.

    Texts are shuffled by key once; the fronts that the previous document asks for are the only text sent besides.
    """
    text = whole_text(docs[text_col])
    keyed = docs.select(docs[id_col].alias("id"), text.alias("text")).withColumn("k", F.xxhash64("id", "text"))
    keys = materialize(keyed.groupBy("id", "k").agg(F.first(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("m")), "fingerprint-keys")
    asked = materialize(following(keys).select("next_id", "next_k", F.col("id").alias("of_id"), F.col("k").alias("of_k"), "n_chars", F.floor(F.col("n_chars") / 3).cast("int").alias("need")), "fingerprint-next")
    heads = keyed.join(asked, keyed["id"].eqNullSafe(asked["next_id"]) & (keyed["k"] == asked["next_k"])).select(
        "of_id", "of_k", "n_chars", "need", F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head"), paragraph_digests(F.col("text")).alias("b")
    )
    if not keys.where("m > 1").isEmpty():
        heads = heads.dropDuplicates(["of_id", "of_k"])
    joined = keyed.join(heads, keyed["id"].eqNullSafe(heads["of_id"]) & (keyed["k"] == heads["of_k"]))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("need")).cast("int")), F.col("head"))
    return joined.select("id", "n_chars", edited.alias("edited"), paragraph_digests(F.col("text")).alias("a"), "b")


def fingerprint_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_chars``, ``edited_sha256``, both fingerprints, the digests that differ between the versions
    (``changed``) and the likeness to the edited text and to the next document."""
    found = versions(docs, id_col, text_col)
    found = materialize(found.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a", "b", paragraph_digests(F.col("edited")).alias("e")), "fingerprint-digests")
    cells = found.select("*", *[sketch(F.col(c), FINGERPRINT_WIDTH).alias(f"{c}_cells") for c in "abe"])
    told = cells.select(
        "*", difference(F.col("a"), F.col("e"), subtract(F.col("a_cells"), F.col("e_cells"))).alias("changed"), F.size(difference(F.col("a"), F.col("b"), subtract(F.col("a_cells"), F.col("b_cells")))).alias("_other")
    )
    return told.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", shown(F.col("a_cells")).alias("fingerprint"), shown(F.col("e_cells")).alias("edited_fingerprint"), "changed",
        likeness(F.size("a"), F.size("e"), F.size("changed")).alias("near_edited"), likeness(F.size("a"), F.size("b"), F.col("_other")).alias("near_next"),
    )
