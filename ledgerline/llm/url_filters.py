"""URL filters by a dated list: a capture is judged by the entries that were active when it was fetched.

List changes (``add`` or ``remove`` of a pattern at a time) become validity intervals: each change holds until the next
one of its pattern. A capture asks for every pattern that could cover it: its host, all parent
domains and all leading parts of its path. The as-of join is an equality on pattern and time bucket, and the interval bounds
are checked inside: an interval stands in the buckets it touches up to the last capture, so a pattern that changes often is
only met in the buckets at hand. The most specific active entry decides: path prefix before host before domain, the
longer pattern first.

Only DataFrame functions are used. Defined results: a NULL or unreadable URL, or a NULL time, is covered by nothing
(verdict ``none``); of changes at one time the removal comes first, then additions in order of action; repeated rows
give repeated rows; columns other than URL and time are passed on, and result columns replace columns of their names;
with an empty list every verdict is ``none``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import materialize

# Kinds of patterns from the widest to the most specific.
KINDS = ["domain", "host", "prefix"]
URL = r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#\s]*)(?::[0-9]*)?([^?#\s]*)"
BUCKET_DAYS = 32
RESULT = ["verdict", "rule", "since"]


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", ""), F.lit(""))


def path_parts(url: Column) -> Column:
    """Non-empty segments of the path."""
    return F.filter(F.split(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), "/"), lambda s: s != "")


def patterns_of(url: Column, depth: int) -> Column:
    """All (kind number, pattern) that cover a URL, path prefixes of at most ``depth`` segments."""
    host, parts = host_of(url), path_parts(url)
    labels = F.split(host, r"\.")
    as_key = lambda kind, p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: as_key(0, F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    steps = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(depth, 1))))).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(steps, lambda i: as_key(2, F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.when(host != "", F.concat(domains, F.array(as_key(1, host)), prefixes))


def validity(changes: DataFrame) -> DataFrame:
    """``kind, pattern, action, start, stop`` from ``changes(kind, pattern, action, op, at)``; ``stop`` is exclusive, NULL if open."""
    order = Window.partitionBy("kind", "pattern").orderBy("at", F.col("op").desc(), "action")
    held = changes.where("at is not null and pattern is not null").withColumn("stop", F.lead("at").over(order))
    return held.where("op = 'add' and (stop is null or stop > at)").select("kind", "pattern", "action", F.col("at").alias("start"), "stop")


def filter_urls(captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``verdict`` (``allow``, ``block`` or ``none``), ``rule`` (kind and pattern that decided) and ``since``."""
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    entries = materialize(validity(changes).withColumn("kind", number).where("kind >= 0"), "url-entries")
    asked = captures.select(F.col(url_col).alias("url"), F.col(time_col).alias("at")).where("url is not null and at is not null").distinct()
    bounds = asked.agg(F.min("at").alias("lo"), F.max("at").alias("hi")).first()
    deepest = entries.where(F.col("kind") == 2).agg(F.max(F.size(F.split("pattern", "/"))).alias("n")).first()["n"] or 1
    if bounds["hi"] is None:
        return with_verdict(captures, asked.select("url", "at", *[F.lit(None).cast("string").alias(c) for c in RESULT[:2]], F.col("at").alias("since")).limit(0), url_col, time_col)
    lo, hi = F.lit(bounds["lo"]), F.lit(bounds["hi"])
    bucket = lambda t: F.floor(F.datediff(t, lo) / BUCKET_DAYS).cast("int")
    span = entries.where((F.col("start") <= hi) & (F.col("stop").isNull() | (F.col("stop") > lo)))
    span = span.select("*", F.explode(F.sequence(bucket(F.greatest("start", lo)), bucket(F.least(F.coalesce("stop", hi), hi)))).alias("bucket"))
    wanted = asked.select("url", "at", bucket(F.col("at")).alias("bucket"), F.explode(patterns_of(F.col("url"), deepest - 1)).alias("p")).select("url", "at", "bucket", "p.*")
    hit = wanted.join(span, ["kind", "pattern", "bucket"]).where((F.col("start") <= F.col("at")) & (F.col("stop").isNull() | (F.col("at") < F.col("stop"))))
    best = hit.groupBy("url", "at").agg(F.max(F.struct("kind", F.length("pattern").alias("n"), "pattern", "action", "start")).alias("b"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    told = best.select("url", "at", F.col("b.action").alias("verdict"), F.concat(F.element_at(kinds, F.col("b.kind") + 1), F.lit(":"), "b.pattern").alias("rule"), F.col("b.start").alias("since"))
    return with_verdict(captures, told, url_col, time_col)


def with_verdict(captures: DataFrame, told: DataFrame, url_col: str, time_col: str) -> DataFrame:
    plain = captures.select(*[F.col(c) for c in captures.columns if c not in RESULT])
    told = told.select(F.col("url").alias("_url"), F.col("at").alias("_at"), *RESULT)
    joined = plain.join(told, (plain[url_col] == told["_url"]) & (plain[time_col] == told["_at"]), "left").drop("_url", "_at")
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit("none")))
