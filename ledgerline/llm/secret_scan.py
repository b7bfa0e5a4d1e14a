"""Secret scan: fixed patterns, and a randomness test battery for strings that no pattern names.

Patterns give spans of kind ``assign``, ``access`` and ``hex``. Besides, every run of at least ``MIN_TOKEN`` characters of
the base64 family is a candidate of kind ``random``, and so is every part of that length between its separators: between - and _
(base64), between / and + (base64url) and between all four, so a key is also tested without the path, prefix or words that
are glued to it. A run that mixes both pairs of separators has no encoding as a whole and is tested by its parts. The encoding is the smallest alphabet that holds all its
characters, and its symbols face three tests against an even, independent draw from that alphabet:

* chi-squared uniformity, which counts equal pairs of symbols;
* runs above and below the middle of the alphabet, and
* serial correlation of neighbouring symbols: all three must look like chance, which words, sequences and repeats do not.

The candidate is also held against ordinary text written in the same alphabet: a chain in which a symbol depends on the one
before it (letters and digits seldom alternate, letters have the frequencies of written text, digits repeat, count up and are
small). The likelihood of that text divided by the likelihood of an even draw bounds the chance that ordinary text looks this
even (Markov's inequality), whatever the length and the alphabet. Each symbol adds evidence, so a short string and a narrow
alphabet give less: decimal strings least, as nothing but the digits' order tells them from ordinary numbers.

That chance is turned into an adjusted value per encoding and length class (Benjamini and
Hochberg, on a histogram of log chances, so nothing but counts is gathered), and candidates at or under
the accepted false-discovery rate become spans; of accepted candidates of which one holds the other only the outer one does.

Only DataFrame functions are used. Positions are code points, ends exclusive. Defined results: NULL counts as the empty
text and has no spans; repeated rows give repeated rows; columns other than id and text are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import materialize
from .common import whole_text

# The patterns, in the order in which kinds are listed, and the least length of what must match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]
# Encodings from the narrowest to the widest alphabet, symbols in the order of their values.
ENCODINGS = {
    "decimal": "0123456789",
    "hex_lower": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36_lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36_upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
MIN_TOKEN = 20
#: Accepted share of ordinary strings among the spans of kind ``random``.
FALSE_DISCOVERIES = 0.01
#: Largest deviation, in standard errors, at which runs and serial correlation still look like chance.
CHANCE_Z = 3.0
# Fixed values of ordinary text: how often a kind of symbol follows another (lower case, upper case, digit, separator), letters of
# written text a to z in parts of 1,000, digits 0 to 9 of written numbers, and shares of a digit that repeats the last or counts up from it.
FOLLOWS = {"a": {"a": 0.90, "A": 0.04, "0": 0.02, "-": 0.04}, "A": {"a": 0.35, "A": 0.55, "0": 0.05, "-": 0.05}, "0": {"a": 0.06, "A": 0.06, "0": 0.78, "-": 0.10}, "-": {"a": 0.60, "A": 0.20, "0": 0.17, "-": 0.03}}
LETTERS = [80, 15, 30, 45, 140, 13, 18, 30, 75, 3, 6, 42, 26, 82, 65, 23, 4, 68, 70, 72, 35, 11, 12, 3, 14, 6]
DIGITS = [0.18, 0.16, 0.13, 0.10, 0.09, 0.08, 0.07, 0.07, 0.06, 0.06]
REPEATED, COUNTED = 0.30, 0.25
NEVER_CHANCE = 99.0
#: Least chance, in powers of ten, that is told apart.
LEAST_CHANCE = -300.0
SPANS = "array<struct<kind:int,start:int,stop:int,value:string>>"


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches; texts without a match are searched once only."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        stop = begin + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), stop.alias("stop"), x["value"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    both = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.when(text.rlike(pattern), F.aggregate(both, start, step)["out"]).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns. Runs that are too short to count need no match, so their length is put into the pattern."""
    value = F.regexp_extract
    assign = F.filter(matches(text, ASSIGN, 0), lambda s: F.length(value(s["value"], ASSIGN, 2)) >= LEAST["assign"])
    access = matches(text, PATTERNS["access"].replace("+", f"{{{LEAST['access'] - 4},}}"), 1)
    hexes = matches(text, PATTERNS["hex"].replace("+", f"{{{LEAST['hex']},}}"), 2)
    return F.concat(assign, access, hexes)


def candidates(text: Column) -> Column:
    """Runs of the base64 family."""
    return matches(text, rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}", 3)


def with_parts(run: Column) -> Column:
    """A run and its parts between separators, at their positions in the text."""

    def parts(symbols: str) -> Column:
        found = matches(run["value"], rf"[{symbols}]{{{MIN_TOKEN},}}", 3)
        return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), (run["start"] + s["start"]).alias("start"), (run["start"] + s["stop"]).alias("stop"), s["value"].alias("value")))

    whole = F.array(run)
    split = F.concat(whole, parts("A-Za-z0-9+/"), parts("A-Za-z0-9_-"), parts("A-Za-z0-9"))
    return F.when(run["value"].rlike("[+/_-]"), F.array_distinct(split)).otherwise(whole)


def outermost(spans: DataFrame) -> DataFrame:
    """``spans(_row, start, stop, …)`` without those that lie inside another of their row; no two are equal."""
    before = Window.partitionBy("_row").orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_reach", F.max("stop").over(before)).where("_reach is null or stop > _reach").drop("_reach")


def encoding(token: Column) -> Column:
    """Number of the narrowest alphabet with all characters of the token; NULL if none has."""
    out = F.lit(None).cast("int")
    for n, symbols in reversed(list(enumerate(ENCODINGS.values()))):
        out = F.when(token.rlike("^[" + symbols.replace("-", r"\-") + "]+$"), F.lit(n)).otherwise(out)
    return out


def pick(encoding_no: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), encoding_no + 1)


def occurrences(text: Column, part: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def ordinary(before: str, symbol: str) -> float:
    """Weight of ``symbol`` after ``before`` in ordinary text."""
    kinds = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "-" for c in (before, symbol)]
    follows = FOLLOWS[kinds[0]][kinds[1]]
    if kinds[1] in "aA":
        return follows * LETTERS[ord(symbol.lower()) - ord("a")] / sum(LETTERS)
    if kinds[1] == "-":
        return follows / 4  # + / - _
    if kinds[0] != "0":
        return follows * DIGITS[int(symbol)]
    step = (int(symbol) - int(before)) % 10
    return follows * ((1 - REPEATED - COUNTED) * DIGITS[int(symbol)] + REPEATED * (step == 0) + COUNTED * (step == 1))


def text_ratios() -> list[float]:
    """Log10 of ordinary text's chance of a symbol after another over an even draw's: encoding after encoding, row after row."""
    out = []
    for symbols in ENCODINGS.values():
        for before in symbols:
            row = [ordinary(before, s) for s in symbols]
            out += [math.log10(x * len(symbols) / sum(row)) for x in row]
    return out


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens(value, enc, …)`` with ``chi2_z``, ``runs_z`` and ``serial_z`` (against an even draw) and ``chance`` (of ordinary text)."""
    names = list(ENCODINGS.values())
    out = tokens.withColumns({"_abc": pick(F.col("enc"), names), "k": pick(F.col("enc"), [float(len(s)) for s in names]), "n": F.length("value").cast("double")})
    squares = F.aggregate(F.split("_abc", ""), F.lit(0.0), lambda acc, c: acc + F.pow(occurrences(F.col("value"), c), F.lit(2.0)))
    out = out.withColumn("_pairs", (squares - F.col("n")) / 2)
    out = out.withColumn("_at", F.transform(F.split("value", ""), lambda c: F.instr(F.col("_abc"), c)))
    sizes = [len(s) for s in names]
    first = pick(F.col("enc"), [sum(k * k for k in sizes[:i]) for i in range(len(sizes))])
    ratios = F.split(F.lit(",".join(f"{x:.4f}" for x in text_ratios())), ",").cast("array<double>")
    of_pairs = F.zip_with(F.slice("_at", 1, F.size("_at") - 1), F.slice("_at", 2, F.size("_at") - 1), lambda a, b: F.element_at(ratios, (first + (a - 1) * pick(F.col("enc"), sizes) + b).cast("int")))
    out = out.withColumn("_text", F.aggregate(of_pairs, F.lit(0.0), lambda acc, x: acc + x))
    out = out.withColumn("_x", F.transform("_at", lambda a: a - 0.5 - F.col("k") / 2))
    out = out.withColumn("_mean", F.aggregate("_x", F.lit(0.0), lambda acc, x: acc + x) / F.col("n"))
    out = out.withColumn("_side", F.array_join(F.transform("_x", lambda x: F.when(x > 0, "1").otherwise("0")), ""))
    out = out.withColumns({
        "_ones": occurrences(F.col("_side"), F.lit("1")),
        "_runs": occurrences(F.col("_side"), F.lit("01")) + occurrences(F.col("_side"), F.lit("10")) + 1,
        "_x": F.transform("_x", lambda x: x - F.col("_mean")),
    })
    out = out.withColumns({
        "_expected": 2 * F.col("_ones") * (F.col("n") - F.col("_ones")) / F.col("n") + 1,
        "_power": F.aggregate("_x", F.lit(0.0), lambda acc, x: acc + x * x),
        "_lag": F.aggregate(F.zip_with(F.slice("_x", 1, F.size("_x") - 1), F.slice("_x", 2, F.size("_x") - 1), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x),
    })
    out = out.withColumn("_spread", F.sqrt((F.col("_expected") - 1) * F.greatest(F.col("_expected") - 2, F.lit(0.0)) / (F.col("n") - 1)))
    return out.select(
        *tokens.columns,
        ((2 * F.col("k") * F.col("_pairs") / F.col("n") + F.col("k") - F.col("n") - (F.col("k") - 1)) / F.sqrt(2 * (F.col("k") - 1))).alias("chi2_z"),
        F.when(F.col("_spread") > 0, (F.col("_runs") - F.col("_expected")) / F.col("_spread")).otherwise(NEVER_CHANCE).alias("runs_z"),
        F.when(F.col("_power") > 0, (F.col("_lag") / F.col("_power") + 1 / F.col("n")) * F.sqrt("n")).otherwise(NEVER_CHANCE).alias("serial_z"),
        F.pow(F.lit(10.0), F.greatest(F.least(F.col("_text"), F.lit(0.0)), F.lit(LEAST_CHANCE))).alias("chance"),
    )


def discoveries(tested: DataFrame, accepted: float = FALSE_DISCOVERIES) -> DataFrame:
    """Rows of ``tested(enc, value, …)`` that pass: all three tests look like chance, ordinary text does not look like it.

    Only counts per encoding, length class (four per doubling) and tenth of log10 of the chance are gathered.
    """
    classed = tested.withColumns({"_class": F.floor(4 * F.log2(F.length("value") / F.lit(float(MIN_TOKEN)))), "_bin": F.least(F.floor(-10 * F.log10("chance")), F.lit(3000))})
    counts = classed.groupBy("enc", "_class", "_bin").agg(F.count("*").alias("_n"))
    group = Window.partitionBy("enc", "_class")
    counts = counts.withColumns({"_at_most": F.sum("_n").over(group.orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("_n").over(group)})
    limit = counts.where(F.pow(F.lit(10.0), -F.col("_bin") / 10.0) * F.col("_all") <= accepted * F.col("_at_most")).groupBy("enc", "_class").agg(F.min("_bin").alias("_least"))
    chance = (F.abs("chi2_z") <= CHANCE_Z) & (F.abs("runs_z") <= CHANCE_Z) & (F.abs("serial_z") <= CHANCE_Z)
    return classed.join(limit, ["enc", "_class"]).where(chance & (F.col("_bin") >= F.col("_least"))).drop("_class", "_bin", "_least")


def close_scan(searched: DataFrame) -> DataFrame:
    """``searched`` (with the arrays ``_base`` and ``_more``) with ``_spans``: (kind number, start, stop) by start, then kind.

    The rows are written down with a number each, so texts are searched once; only the spans' own values travel.
    """
    found = materialize(searched.withColumn("_row", F.monotonically_increasing_id()), "secret-spans")
    tokens = found.select("_row", F.explode("_more").alias("run")).select("_row", F.explode(with_parts(F.col("run"))).alias("s")).select("_row", "s.*").withColumn("enc", encoding(F.col("value"))).where("enc is not null")
    tested = materialize(battery(tokens), "secret-tests")
    random = outermost(discoveries(tested)).groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("_random"))
    plain = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    both = F.array_sort(F.concat(plain, F.coalesce("_random", F.array().cast("array<struct<start:int,kind:int,stop:int>>"))))
    return found.join(random, "_row", "left").withColumn("_spans", both).drop("_row", "_base", "_more", "_random")


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of all spans, joined with commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``spans``, an array of (kind number, start, stop); ``KINDS`` names the kinds."""
    text = whole_text(docs[text_col])
    narrow = docs.select(docs[id_col].alias("_id"), base_spans(text).alias("_base"), candidates(text).alias("_more"))
    return close_scan(narrow).select(F.col("_id").alias(id_col), F.col("_spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; overlapping spans become one. Rows and columns stay."""
    text = whole_text(docs[text_col])
    scanned = close_scan(docs.withColumns({"_base": base_spans(text), "_more": candidates(text)}))
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def join(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        merged = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))))
        return F.when((F.size(acc) > 0) & (s["start"] < F.try_element_at(acc, F.lit(-1))["stop"]), merged).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop")))))

    united = F.aggregate("_spans", empty, join)
    begins = F.concat(F.array(F.lit(0)), F.transform("_united", lambda s: s["stop"]))
    ends = F.concat(F.transform("_united", lambda s: s["start"]), F.array(F.length(F.col(text_col))))
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col(text_col), a + 1, b - a))
    out = scanned.withColumn("_united", united).withColumn(text_col, F.when(F.size("_united") > 0, F.array_join(kept, mark)).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.size("_united") > 0, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)
