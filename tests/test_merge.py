"""Incremental loads: replays, late batches, schema drift and empty deltas."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators import merge
from ledgerline.sources import files


@pytest.fixture
def base(spark):
    data = [("1", "a", "_", 1, datetime(2024, 1, 1)), ("2", "b", None, 2, datetime(2024, 1, 9)), ("3", "c", "_", 3, datetime(2024, 1, 20))]
    return spark.createDataFrame(data, "id string, column_a string, `_` string, after int, received_at timestamp_ntz")


def test_merge_inserts_only_unknown_ids_and_keeps_matches(spark, base):
    delta = spark.createDataFrame([("3", "changed", "_", 9, datetime(2024, 1, 21)), ("4", "new", None, 4, datetime(2024, 1, 22))], base.schema)
    out = merge.merged_base(base, delta)
    assert {r["id"]: r["column_a"] for r in out.collect()} == {"1": "a", "2": "b", "3": "c", "4": "new"}
    assert rows(merge.merged_base(out, delta)) == rows(out)  # replay


def test_merge_prunes_the_searched_base(spark, base):
    delta = spark.createDataFrame([("1", "again", "_", 9, datetime(2024, 1, 21))], base.schema)
    fresh, rest = merge.merge_delta_into_base(base, delta)
    # The match lies more than seven days before the delta, so it is not searched.
    assert [r["id"] for r in fresh.collect()] == ["1"]
    assert rest.count() == 0


def test_schema_drift_adds_columns_in_order(spark, base):
    delta = spark.createDataFrame([("4", 7, "x", datetime(2024, 1, 22))], "id string, zz int, extra string, received_at timestamp_ntz")
    out = merge.merged_base(base, delta)
    assert out.columns == ["id", "column_a", "_", "after", "received_at", "extra", "zz"]
    assert out.where("id = '4'").first()["zz"] == 7


def test_empty_delta_is_a_no_op(spark, base):
    assert rows(merge.merged_base(base, base.limit(0))) == rows(base)


def test_incremental_merge_updates_listed_columns_only(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, x string, y int")
    new = spark.createDataFrame([(2, "B", None), (3, "c", 30)], "id int, x string, y int")
    assert rows(merge.incremental_merge(new, old, ["id"], ["y"])) == [(1, "a", 10), (2, "b", None), (3, "c", 30)]
    once = merge.incremental_merge(new, old, ["id"])
    assert rows(once) == [(1, "a", 10), (2, "B", None), (3, "c", 30)]
    assert rows(merge.incremental_merge(new, once, ["id"])) == rows(once)


def test_delete_insert_replaces_whole_keys(spark):
    old = spark.createDataFrame([("s", 1), ("s", 2), ("t", 3)], "k string, v int")
    new = spark.createDataFrame([("s", 9)], "k string, v int")
    assert rows(merge.delete_insert(new, old, ["k"])) == [("s", 9), ("t", 3)]


def test_sync_diff_is_null_safe(spark):
    cur = spark.createDataFrame([(1, None, 1), (2, "x", None), (3, "y", 3)], "id int, a string, b int")
    want = spark.createDataFrame([(1, None, 1), (2, None, None), (3, "y", 4), (4, "new", 1)], "id int, a string, b int")
    assert [r["id"] for r in merge.sync_diff(want, cur, ["id"], ["a", "b"]).orderBy("id").collect()] == [2, 3]


def test_union_relations_widens_and_tags(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([("2", 2.5)], "k string, only_b double")
    out = merge.union_relations({"a": a, "b": b}, source_column="src")
    assert dict(out.dtypes) == {"k": "string", "only_a": "string", "only_b": "double", "src": "string"}
    assert rows(out) == [("1", "x", None, "a"), ("2", None, 2.5, "b")]


def test_marks_reach_the_scan(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    clicks = events.where(F.col("event_type") == "click")
    plan = merge.since_mark(events.select("event_id", "ts"), clicks, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("first,end,n", [(date(2024, 1, 1), date(2024, 1, 3), 2), (date(2024, 1, 3), date(2024, 1, 3), 0), (date(2024, 1, 4), date(2024, 1, 3), 0)])
def test_date_range(first, end, n):
    assert len(list(files.date_range(first, end))) == n


def test_prefixes_collapse_slashes():
    assert files.date_prefixes("s3://b//logs/", date(2024, 2, 1), date(2024, 2, 2)) == ["s3://b/logs/2024/02/01"]


def test_incremental_by_date(spark, tmp_path):
    for d in (1, 2, 3):
        spark.range(d).withColumn("ts", F.lit(f"2024-01-0{d}").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/2024/01/0{d}")
    read = lambda paths: spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    assert files.load_incremental_by_date(spark, str(tmp_path), None, "ts", date(2024, 1, 9), read).count() == 6
    target = read([str(tmp_path)]).where("ts < '2024-01-03'")
    assert files.load_incremental_by_date(spark, str(tmp_path), target, "ts", date(2024, 1, 9), read).count() == 5
    assert files.load_incremental_by_date(spark, str(tmp_path), target, "ts", date(2024, 1, 2), read) is None


def test_bad_rows_are_skipped_for_counts_too(spark, tmp_path):
    spark.createDataFrame([("1,a",), ("x,b",), ("3,c",)], "v string").coalesce(1).write.text(f"{tmp_path}/in")
    df = files.load_files(spark, f"{tmp_path}/in", r"part-.*\.txt$", "n int, s string")
    assert df.count() == 2 and rows(df) == [(1, "a"), (3, "c")]


def test_clustered_write_overwrites_touched_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows_in = lambda d, n: spark.range(n).withColumn("day", F.lit(d))
    files.write_clustered(rows_in("a", 3).unionByName(rows_in("b", 4)), path, "day", ["id"])
    files.write_clustered(rows_in("b", 1), path, "day", ["id"])
    assert {r["day"]: r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()} == {"a": 3, "b": 1}


def _arrivals(spark, rows):
    import datetime as dt

    return spark.createDataFrame([(i, dt.datetime(2024, 1, d)) for i, d in rows], "id string, received_at timestamp_ntz")


def test_delta_searches_only_the_pruned_slice_of_the_base(spark):
    base = _arrivals(spark, [("old", 1), ("x", 20)])
    source = _arrivals(spark, [("old", 20), ("x", 20), ("new", 21), ("stale", 17)])
    assert sorted(r["id"] for r in merge.build_delta(source, base).collect()) == ["new", "old"]
    # The delta's own mark moves the slice on: x is searched in the base from the 20th only.
    delta = _arrivals(spark, [("new", 23)])
    assert sorted(r["id"] for r in merge.build_delta(source, base, delta=delta).collect()) == ["new"]
    assert merge.build_delta(source, base.limit(0)).count() == 4


def test_base_plus_delta_leaves_out_columns(spark):
    base = _arrivals(spark, [("a", 1), ("b", 2)])
    out = merge.read_base_plus_delta(base, _arrivals(spark, [("b", 5)]), exclude=["received_at"])
    assert out.columns == ["id"] and sorted(r["id"] for r in out.collect()) == ["a", "b"]


def test_late_page_views_stay_out(spark):
    from ledgerline.plans import web

    pages = _arrivals(spark, [("late", 5), ("next", 21)]).selectExpr("id", "'/cloud/signup' AS path", "received_at")
    loaded = _arrivals(spark, [("seen", 20)])
    assert [r["id"] for r in web.signup_funnel_events(pages, loaded).collect()] == ["next"]
    assert web.signup_funnel_events(pages, loaded.limit(0)).count() == 2


def test_rows_after_the_merge_stay_in_the_delta(spark):
    base, delta = _arrivals(spark, [("a", 20)]), _arrivals(spark, [("a", 20), ("b", 21)])
    later = _arrivals(spark, [("a", 20), ("b", 21), ("c", 22)])
    fresh, rest = merge.merge_delta_into_base(base, delta, later=later)
    assert [r["id"] for r in fresh.collect()] == ["b"] and [r["id"] for r in rest.collect()] == ["c"]


def test_merges_touch_only_the_partitions_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "state")
    state = spark.createDataFrame([(k, d, 1) for d in range(5) for k in range(3)], "key int, day int, n int")
    merge.write_partitions(state, path, "day")
    target = spark.read.parquet(path).select("key", "day", "n")
    batch = spark.createDataFrame([(1, 2, 9), (7, 3, 9)], "key int, day int, n int")
    merged = merge.incremental_merge(batch, target, ["key", "day"], partition="day")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day" in plan
    assert {r["day"] for r in merged.collect()} == {2, 3}
    from ledgerline.session import materialize

    merge.write_partitions(materialize(merged, "merged"), path, "day")
    after = {(r["key"], r["day"]): r["n"] for r in spark.read.parquet(path).collect()}
    assert len(after) == 16 and after[1, 2] == 9 and after[7, 3] == 9 and after[0, 2] == 1
    target = spark.read.parquet(path).select("key", "day", "n").where("n = 1")
    assert merge.incremental_append(batch, target, ["key", "day"], partition="day").count() == 2
    replaced = merge.delete_insert(batch, target, ["key", "day"], partition="day")
    assert replaced.count() == 7 and {r["day"] for r in replaced.collect()} == {2, 3}
