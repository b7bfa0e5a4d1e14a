"""Part tables: files that a merge touches, atomic commits, repeated batches and growing hashed parts."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators import merge, tables
from ledgerline.streaming import jobs


def files_of(table):
    return {f["path"] for files in table.manifest().parts.values() for f in files}


def counted(spark, pairs):
    return spark.createDataFrame(pairs, "k long, n long")


def test_a_small_batch_changes_few_parts_of_a_large_keyed_table(spark, tmp_path):
    table = tables.HashTable(spark, f"{tmp_path}/t", ["k"], part_rows=25)
    add = jobs.add_counts(["k"], ["n"])
    table.merge(spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n")), add)
    before = files_of(table)
    assert len(before) > 300 and max(f["rows"] for files in table.manifest().parts.values() for f in files) < 100
    touched = table.merge(counted(spark, [(k, 5) for k in range(0, 10_000, 1000)]), add)
    after = files_of(table)
    assert len(touched) <= 10 and len(before - after) < 0.05 * len(before)
    got = table.read()
    assert len(table.read(touched).inputFiles()) < 0.05 * len(got.inputFiles())
    assert got.count() == 10_000 and {r["k"] for r in got.where("n = 6").collect()} == set(range(0, 10_000, 1000))


def test_parts_split_as_keys_arrive_and_cover_every_hash(spark, tmp_path):
    table = tables.HashTable(spark, f"{tmp_path}/t", ["k"], part_rows=4)
    add, want = jobs.add_counts(["k"], ["n"]), {}
    for batch in range(4):
        keys = [(k * (batch + 1)) % 97 for k in range(30)]
        for k in keys:
            want[k] = want.get(k, 0) + 1
        table.merge(counted(spark, [(k, 1) for k in keys]), add, batch)
        # a repeated batch is not applied again
        assert table.merge(counted(spark, [(k, 1) for k in keys]), add, batch) == []
    assert {r["k"]: r["n"] for r in table.read().collect()} == want
    names = sorted(table.manifest().parts)
    assert sum(2.0 ** (1 - len(p)) for p in names) == 1 and not any(a != b and b.startswith(a) for a in names for b in names)
    table.vacuum(1)
    assert {r["k"]: r["n"] for r in table.read().collect()} == want


def test_a_failed_merge_leaves_the_table_as_it_was(spark, tmp_path):
    table = tables.PartTable(spark, f"{tmp_path}/t", "k")
    table.merge(counted(spark, [(1, 1), (2, 2), (None, 3)]), lambda new, old: new)
    before = rows(table.read().drop(tables.PART))
    with pytest.raises(Exception, match="broken"):
        table.merge(counted(spark, [(1, 9)]), lambda new, old: new.where(F.raise_error(F.lit("broken")).isNull()))
    assert rows(table.read().drop(tables.PART)) == before
    # of two writers that start from one version the second fails
    at = table.manifest()
    table.commit(table.placed(counted(spark, [(1, 5)]), at), ["1"], at)
    with pytest.raises(Exception, match="exist"):
        table.commit(table.placed(counted(spark, [(1, 6)]), at), ["1"], at)
    assert rows(table.read().drop(tables.PART)) == rows(counted(spark, [(1, 5), (2, 2), (None, 3)]))
    assert table.manifest().version == 2


def test_merges_open_only_the_parts_of_the_batch(spark, tmp_path):
    table = tables.PartTable(spark, f"{tmp_path}/t", "day", mark="at")
    make = lambda pairs: spark.createDataFrame(pairs, "id long, day string, at long")
    table.merge(make([(i, f"2024-01-{1 + i % 20:02}", i) for i in range(200)]), lambda new, old: new)
    seen = []

    def combine(new, old):
        seen.extend(old.inputFiles())
        return merge.incremental_merge(new, old, ["id"])

    assert table.merge(make([(3, "2024-01-04", 1000), (900, "2024-01-30", 7)]), combine) == ["2024-01-04", "2024-01-30"]
    assert len(seen) == 1 and "2024-01-04" in seen[0]
    assert table.read().count() == 201 and table.read().where("id = 3").first()["at"] == 1000
    assert table.meeting(1000, 2000) == ["2024-01-04"] and set(table.meeting(0, 0)) == {"2024-01-01"}
    added = table.append(make([(3, "2024-01-04", 5), (901, "2024-01-04", 5)]), ["id"])
    assert [r["id"] for r in added.collect()] == [901] and table.read().count() == 202


def test_snapshots_add_one_day_and_refuse_a_full_refresh(spark, tmp_path):
    table = tables.PartTable(spark, f"{tmp_path}/t", "day")
    data = counted(spark, [(1, 1), (2, 2)])
    table.snapshot(data, "2024-01-01")
    first = files_of(table)
    table.snapshot(data, "2024-01-02")
    assert first < files_of(table)
    table.snapshot(data.limit(1), "2024-01-02")
    assert sorted(str(r["day"]) for r in table.read().collect()) == ["2024-01-01", "2024-01-01", "2024-01-02"]
    with pytest.raises(ValueError, match="full refresh"):
        table.snapshot(data, "2024-01-03", full_refresh=True)
