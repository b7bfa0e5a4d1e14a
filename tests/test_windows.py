"""Chunked and sweep operators against plain windows and brute force, with one hot key."""

import random
from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import Window, functions as F

from ledgerline.operators import joins, windows


def hot_rows(spark, n=600, seed=3):
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        data.append((i, key, start + timedelta(hours=rnd.randrange(24 * 20)), rnd.choice([None, 1, 2, 3]), f"e{rnd.randrange(5)}"))
    return spark.createDataFrame(data, "id bigint, k string, ts timestamp_ntz, v int, e string")


def test_chunked_scan_equals_plain_windows(spark):
    df = hot_rows(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select(
        "id", F.row_number().over(w).cast("bigint").alias("n"), F.sum("v").over(upto).alias("s"), F.last("v", True).over(upto).alias("f"), F.lag("e").over(w).alias("lg"), F.lead("v").over(w).alias("ld"),
    )
    got = windows.chunked_scan(
        df, ["k"], F.to_date("ts"), ["ts", "id"], row_number="n", sums={"s": F.col("v")}, fills={"f": "v"}, lags={"lg": "e"}, leads={"ld": "v"}
    ).select("id", "n", "s", "f", "lg", "ld")
    assert rows(got) == rows(plain)


def test_next_value_and_leads_by_rank(spark):
    df = hot_rows(spark).withColumn("d", F.to_date("ts"))
    w = Window.partitionBy("k").orderBy("d", "id")
    plain = df.select("id", F.lead("d").over(w).alias("x"))
    assert rows(windows.next_value(df, ["k"], "d", ["id"], "x").select("id", "x")) == rows(plain)
    plain = df.select("id", F.lead("d", 1).over(w).alias("a"), F.lead("d", 3).over(w).alias("b"))
    got = windows.leads_by_rank(df, ["k"], F.trunc("d", "week"), ["d", "id"], "d", [1, 3]).select("id", "_lead_1", "_lead_3")
    assert rows(got) == rows(plain)


def test_latest_flag_and_top_k(spark):
    df = hot_rows(spark).where(F.col("k").isNotNull())
    w = Window.partitionBy("k").orderBy(F.desc("ts"), F.desc("id"))
    assert rows(windows.latest_flag(df, ["k"], ["ts", "id"]).select("id", "is_latest")) == rows(df.select("id", F.row_number().over(w) == 1))
    assert rows(windows.top_k(df, ["k"], [F.desc("ts"), F.desc("id")], 3).select("id")) == rows(df.withColumn("n", F.row_number().over(w)).where("n <= 3").select("id"))


def test_first_k_is_trimmed_before_the_shuffle(spark):
    df = hot_rows(spark)
    plan = windows.top_k(df, ["k"], [F.desc("ts"), F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_trailing_distinct_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("xy"), rnd.randrange(12), date(2024, 1, 1) + timedelta(days=rnd.randrange(25))) for _ in range(120)]
    df = spark.createDataFrame(data, "s string, u int, d date")
    got = {(r["s"], r["d"]): r["n"] for r in joins.trailing_distinct(df, ["s"], "u", "d", 7, "n").collect() if r["n"]}
    want = {}
    for s in "xy":
        for i in range(40):
            day = date(2024, 1, 1) + timedelta(days=i)
            n = len({u for a, u, d in data if a == s and day - timedelta(days=6) <= d <= day})
            if n:
                want[(s, day)] = n
    assert got == want


def test_interval_sums_against_brute_force(spark):
    rnd = random.Random(7)
    data = []
    for _ in range(60):
        a = date(2024, 1, 1) + timedelta(days=rnd.randrange(60))
        data.append((rnd.choice("xy"), a, a + timedelta(days=rnd.randrange(20)), rnd.randrange(-5, 9)))
    df = spark.createDataFrame(data, "k string, a date, b date, v int")
    steps = joins.dense_days(joins.interval_sums(df, ["k"], "a", "b", ["v"]), "from_day", "to_day", "d")
    got = {(r["k"], r["d"]): (r["v"], r["_open"]) for r in steps.collect()}
    want = {}
    for k, a, b, v in data:
        for i in range((b - a).days + 1):
            x = want.get((k, a + timedelta(days=i)), (0, 0))
            want[(k, a + timedelta(days=i))] = (x[0] + v, x[1] + 1)
    assert got == want


def test_last_before_is_strict(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    events = spark.createDataFrame([(1, "u", at(5)), (2, "u", at(9)), (3, "v", at(5)), (4, "u", at(3))], "id int, k string, t timestamp_ntz")
    history = spark.createDataFrame([("u", at(3), "a"), ("u", at(5), "b"), ("u", at(8), "c")], "k string, h timestamp_ntz, c string")
    got = {r["id"]: r["c"] for r in joins.last_before(events, history, ["k"], "t", "h", ["c"], tie="id").collect()}
    assert got == {1: "a", 2: "c", 3: None, 4: None}


def test_range_bucket_join_spans_buckets(spark):
    ranges = spark.createDataFrame([(0, 99, "a"), (100, 1000, "b"), (2000, 2000, "c")], "lo bigint, hi bigint, n string")
    points = spark.createDataFrame([(0,), (99,), (100,), (555,), (1000,), (1001,), (2000,), (None,)], "p bigint")
    got = {r["p"]: r["n"] for r in joins.range_bucket_join(points, ranges, "p", "lo", "hi", 64).collect()}
    assert got == {0: "a", 99: "a", 100: "b", 555: "b", 1000: "b", 1001: None, 2000: "c", None: None}


def test_no_cross_join_or_nested_loop_in_rewrites(spark):
    ranges = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 9), 1)], "a date, b date, n int")
    points = hot_rows(spark)
    plan = joins.contain_join(points, ranges, "ts", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hierarchy_of_a_long_chain_and_its_limits(spark):
    import pytest

    chain = [(i, i - 1 if i else None, f"n{i}") for i in range(37)] + [(100, 99, "orphan"), (200, 5, "side")]
    df = spark.createDataFrame(chain, "id int, parent int, name string")
    got = {r["id"]: r for r in joins.hierarchy_paths(df, "/").collect()}
    assert set(got) == {*range(37), 200}
    assert got[36]["level"] == 36 and got[36]["root_id"] == 0 and got[36]["path"] == "/".join(f"n{i}" for i in range(37))
    assert got[200]["path"] == "n0/n1/n2/n3/n4/n5/side" and got[0]["level"] == 0
    with pytest.raises(ValueError):
        joins.hierarchy_paths(spark.createDataFrame([(1, 2, "a"), (2, 1, "b")], "id int, parent int, name string"))


def test_product_and_prefix_join(spark):
    left = spark.createDataFrame([(i,) for i in range(7)], "a int")
    right = spark.createDataFrame([("x",), ("y",), (None,)], "b string")
    assert sorted(map(str, joins.product(left, right).collect())) == sorted(map(str, left.crossJoin(right).collect()))
    full = spark.createDataFrame([("k", "12-34"), ("k", "9"), ("j", "12-34"), ("k", None)], "key string, full string")
    some = spark.createDataFrame([("k", "12"), ("k", ""), ("k", "12-34"), ("k", "123"), ("j", None)], "key string, part string")
    got = sorted((r["key"], r["full"], r["part"]) for r in joins.prefix_join(full, some, "full", "part", ["key"]).collect())
    assert got == [("k", "12-34", ""), ("k", "12-34", "12"), ("k", "12-34", "12-34"), ("k", "9", "")]


def test_max_from_here_in_chunks(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import windows

    rows = [("a" if i % 3 else None, i, (i * 7) % 11 if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, at int, v int")
    got = {(r["g"], r["at"]): r["m"] for r in windows.max_from_here(df, ["g"], F.floor(F.col("at") / 5), "at", "v", "m").collect()}
    for g, at, _ in rows:
        later = [v for h, t, v in rows if h == g and t >= at and v is not None]
        assert got[g, at] == (max(later) if later else None)


def test_leads_cross_the_blocks_of_ranks(spark, monkeypatch):
    """Every row once, and the same leads as one window over the key, where blocks are smaller than a key and a key may be NULL."""
    from pyspark.sql import Window

    monkeypatch.setattr(windows, "RANKS", 4)
    df = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 7 % 31).cast("int")).alias("d"))
    got = windows.leads_by_rank(df, ["k"], F.trunc("d", "week"), ["d", "id"], "d", [1, 4]).select("id", "_lead_1", "_lead_4")
    w = Window.partitionBy("k").orderBy("d", "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.select("id", F.lead("d", 1).over(w), F.lead("d", 4).over(w)).collect()))
