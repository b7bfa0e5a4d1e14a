"""Verdicts on hand-made lists, and the query against its SQL."""

import datetime as dt

import duckdb

from ledgerline.llm.queries import ORACLE, QUERIES
from ledgerline.llm.url_filters import filter_urls


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


CHANGES = [
    ("domain", "example.com", "block", "add", day(0)), ("domain", "example.com", "block", "remove", day(100)), ("domain", "example.com", "block", "add", day(200)),
    ("host", "good.example.com", "allow", "add", day(50)), ("prefix", "good.example.com/bad", "block", "add", day(60)), ("domain", "late.org", "block", "add", day(300)),
    ("domain", "flip.org", "block", "remove", day(10)), ("domain", "flip.org", "block", "add", day(10)), ("other", "x.org", "block", "add", day(0)), ("host", None, "block", "add", day(0)),
]


def test_verdicts(spark):
    cases = [
        ("http://a.b.example.com/x", 5, "block"), ("https://EXAMPLE.com.:8080/", 99, "block"), ("https://example.com", 100, "none"), ("https://example.com", 200, "block"), ("http://notexample.com", 5, "none"),
        ("http://good.example.com/", 49, "block"), ("http://u:p@good.example.com/", 50, "allow"), ("http://good.example.com/bad/page?q=1", 60, "block"), ("http://good.example.com/badly", 60, "allow"),
        ("http://late.org", 299, "none"), ("http://flip.org#f", 10, "block"), ("not a url", 5, "none"), (None, 5, "none"), ("http://example.com", None, "none"), ("", 1, "none"), ("http://x.org", 3, "none"),
        ("http://example.com/" + "a/" * 20_000, 5, "block"),
    ]
    rows = [(i, u, day(n) if n is not None else None, v, "old") for i, (u, n, v) in enumerate(cases + cases[:2])]
    captures = spark.createDataFrame(rows, "id long, url string, fetched_at timestamp_ntz, want string, verdict string")
    changes = spark.createDataFrame(CHANGES, "kind string, pattern string, action string, op string, at timestamp_ntz")
    got = filter_urls(captures, changes).collect()
    assert len(got) == len(rows) and [r for r in got if r["verdict"] != r["want"]] == []
    assert {r["rule"] for r in got if r["id"] == 7} == {"prefix:good.example.com/bad"}
    assert {r["verdict"] for r in filter_urls(captures, changes.limit(0)).collect()} == {"none"}
    assert filter_urls(captures.limit(0), changes).collect() == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{folder}/pages.parquet'")
    rel = con.sql(ORACLE["op2_url_filters"])
    df = QUERIES["op2_url_filters"](spark, folder).select(*rel.columns)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, rel.fetchall()))
