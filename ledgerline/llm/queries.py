"""One query per operator, over its whole table, and the SQL it is compared with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import quality, toxicity
from .bpe import bpe_round_trip
from .common import table
from .embedding_dedup import link_embeddings
from .fingerprints import fingerprint_versions
from .mixing import mix_documents
from .runs import digests
from .secret_scan import KINDS, listed, scan_secrets
from .simhash import simhash_near_duplicates
from .token_counts import count_tokens
from .top_k import top_inner_products
from .url_filters import filter_urls, host_of, path_parts
from .whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe_round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, folder, "documents"))


@query
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_documents(table(spark, folder, "documents"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = scan_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    of = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return scanned.select(
        "doc_id", *[of(n).alias(f"n_{k}") for n, k in enumerate(KINDS)], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query
def op10_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_versions(table(spark, folder, "documents")).drop("changed")


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A list for the pages at hand: changes of domains, hosts and path prefixes, dated by digits of the pattern's MD5."""
    seen = pages.select(host_of(F.col("url")).alias("host"), path_parts(F.col("url")).alias("parts")).where("host <> ''")
    domains = seen.select(F.regexp_replace("host", r"^(www|m|blog)\.", "").alias("pattern")).distinct()
    prefixes = seen.where(F.size("parts") > 0).select(F.concat("host", F.lit("/"), F.element_at("parts", 1)).alias("pattern")).distinct()
    number = F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), 1, 6), 16, 10).cast("int")

    def changes(patterns: DataFrame, kind: str, action: str, op: str, chosen: str, day: str) -> DataFrame:
        dated = patterns.withColumn("n", number).where(chosen).select(
            F.lit(kind).alias("kind"), "pattern", F.lit(action).alias("action"), F.lit(op).alias("op"), F.expr(f"timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval({day})").alias("at")
        )
        return dated

    hosts = seen.select(F.col("host").alias("pattern")).distinct()
    return (
        changes(domains, "domain", "block", "add", "n % 4 = 0", "n % 200")
        .unionByName(changes(domains, "domain", "block", "remove", "n % 8 = 0", "n % 200 + 45"))
        .unionByName(changes(domains, "domain", "block", "add", "n % 16 = 0", "n % 200 + 120"))
        .unionByName(changes(hosts, "host", "allow", "add", "n % 10 = 3", "n % 150"))
        .unionByName(changes(hosts, "host", "allow", "remove", "n % 10 = 3", "n % 150 + 90"))
        .unionByName(changes(prefixes, "prefix", "block", "add", "n % 6 = 1", "n % 250"))
    )


@query
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    fetched = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(cast(page_id % 360 as int), 12)")
    return filter_urls(pages.withColumn("fetched_at", fetched), dated_list(pages))


ORACLE["op2_url_filters"] = r"""
WITH raw AS (SELECT page_id, url, TIMESTAMP '2024-01-01 12:00:00' + to_days((page_id % 360)::INT) AS fetched_at,
    regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#\s]*)(?::[0-9]*)?([^?#\s]*)', ['h', 'p']) AS u FROM pages),
captures AS (SELECT page_id, url, fetched_at, regexp_replace(lower(u.h), '\.$', '') AS host, list_filter(string_split(u.p, '/'), lambda s: s <> '') AS parts FROM raw),
domains AS (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\.', '') AS pattern FROM captures WHERE host <> ''),
hosts AS (SELECT DISTINCT host AS pattern FROM captures WHERE host <> ''),
prefixes AS (SELECT DISTINCT host || '/' || parts[1] AS pattern FROM captures WHERE host <> '' AND len(parts) > 0),
numbered AS (SELECT kind, pattern, ('0x' || substr(md5(pattern), 1, 6))::INT AS n FROM (SELECT 0 AS kind, pattern FROM domains UNION ALL SELECT 1, pattern FROM hosts UNION ALL SELECT 2, pattern FROM prefixes)),
changes AS (
    SELECT kind, pattern, 'block' AS action, 'add' AS op, n % 200 AS d FROM numbered WHERE kind = 0 AND n % 4 = 0
    UNION ALL SELECT kind, pattern, 'block', 'remove', n % 200 + 45 FROM numbered WHERE kind = 0 AND n % 8 = 0
    UNION ALL SELECT kind, pattern, 'block', 'add', n % 200 + 120 FROM numbered WHERE kind = 0 AND n % 16 = 0
    UNION ALL SELECT kind, pattern, 'allow', 'add', n % 150 FROM numbered WHERE kind = 1 AND n % 10 = 3
    UNION ALL SELECT kind, pattern, 'allow', 'remove', n % 150 + 90 FROM numbered WHERE kind = 1 AND n % 10 = 3
    UNION ALL SELECT kind, pattern, 'block', 'add', n % 250 FROM numbered WHERE kind = 2 AND n % 6 = 1),
dated AS (SELECT kind, pattern, action, op, TIMESTAMP '2024-01-01 00:00:00' + to_days(d::INT) AS start FROM changes),
held AS (SELECT *, lead(start) OVER (PARTITION BY kind, pattern ORDER BY start, op DESC, action) AS stop FROM dated),
wanted AS (
    SELECT page_id, fetched_at, 0 AS kind, array_to_string(string_split(host, '.')[i:], '.') AS pattern FROM captures, unnest(range(1, len(string_split(host, '.')) + 1)) AS r(i) WHERE host <> ''
    UNION ALL SELECT page_id, fetched_at, 1, host FROM captures WHERE host <> ''
    UNION ALL SELECT page_id, fetched_at, 2, host || '/' || array_to_string(parts[1:i], '/') FROM captures, unnest(range(1, len(parts) + 1)) AS r(i) WHERE host <> ''),
hits AS (SELECT w.page_id, h.kind, h.pattern, h.action, h.start, row_number() OVER (PARTITION BY w.page_id ORDER BY h.kind DESC, length(h.pattern) DESC, h.pattern DESC) AS nr
    FROM wanted w JOIN held h ON w.kind = h.kind AND w.pattern = h.pattern AND h.op = 'add' AND h.start <= w.fetched_at AND (h.stop IS NULL OR w.fetched_at < h.stop))
SELECT c.page_id, c.url, c.fetched_at, coalesce(h.action, 'none') AS verdict, CASE h.kind WHEN 0 THEN 'domain:' WHEN 1 THEN 'host:' WHEN 2 THEN 'prefix:' END || h.pattern AS rule, h.start AS since
FROM captures c LEFT JOIN hits h ON c.page_id = h.page_id AND h.nr = 1
"""


@query
def op1_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(table(spark, folder, "embeddings"))


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"))


@query
def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op12_exact_top_k"] = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x::DOUBLE), false)))),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
