"""Tables that change by commits: versions, buckets, loads that stop, and what is removed."""

import os
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import snapshots
from starloom.operators.snapshots import (
    CommitConflict, commit_of, lookup, merge_snapshot, read_snapshot, rebucket, replace_snapshot, unknown_keys, vacuum,
    versions,
)

SCHEMA = "k bigint, v string, o int"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def files_of(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet")}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_old_versions_stay_readable(spark, path):
    assert read_snapshot(spark, path) is None
    one = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    replace_snapshot(one, path)
    old = read_snapshot(spark, path)
    # a load may read the table that it replaces
    replace_snapshot(old.withColumn("v", F.upper("v")), path)
    assert rows_of(old) == [(1, "a", 1), (2, "b", 1)]
    assert rows_of(read_snapshot(spark, path)) == [(1, "A", 1), (2, "B", 1)]
    assert rows_of(read_snapshot(spark, path, 1)) == rows_of(old)
    replace_snapshot(one.limit(0), path)
    assert rows_of(read_snapshot(spark, path)) == [] and versions(spark, path) == [1, 2, 3]
    assert len(vacuum(spark, path, keep=2)) == 2
    assert versions(spark, path) == [2, 3] and rows_of(read_snapshot(spark, path, 2)) == [(1, "A", 1), (2, "B", 1)]


@pytest.mark.parametrize("step", ["before the draft", "after the draft", "after the commit"])
@pytest.mark.parametrize("load", [replace_snapshot, lambda df, p: merge_snapshot(df, p, ["k"], ["o"], buckets=4)])
def test_a_load_that_stops_leaves_one_version_whole(spark, path, monkeypatch, step, load):
    one = spark.createDataFrame([(k, "a", 1) for k in range(20)], SCHEMA)
    two = spark.createDataFrame([(k, "b", 2) for k in range(20)], SCHEMA)
    load(one, path)
    before = rows_of(read_snapshot(spark, path))

    class Stopped(Exception):
        pass

    def stop(*_):
        raise Stopped

    real = snapshots._publish
    with monkeypatch.context() as patch:
        if step == "before the draft":
            patch.setattr(snapshots, "_draft", stop)
        elif step == "after the draft":
            patch.setattr(snapshots, "_publish", stop)
        else:
            patch.setattr(snapshots, "_publish", lambda *a: (real(*a), stop()))
        with pytest.raises(Stopped):
            load(two, path)
    left = rows_of(read_snapshot(spark, path))
    after = sorted((r[0], *x) for r in before for x in [("b",) if len(r) == 2 else ("b", 2)])
    assert left == (after if step == "after the commit" else before)
    load(two, path)
    assert rows_of(read_snapshot(spark, path)) == after
    vacuum(spark, path)
    assert rows_of(read_snapshot(spark, path)) == after
    assert not [n for n in os.listdir(f"{path}/_commits") if n.startswith(".draft")]


def test_the_second_of_two_loads_fails(spark, path, monkeypatch):
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    replace_snapshot(df, path)
    draft = snapshots._draft

    def interrupted(session, at, content):
        made = draft(session, at, content)
        monkeypatch.setattr(snapshots, "_draft", draft)
        replace_snapshot(df.withColumn("v", F.lit("first")), path)
        return made

    monkeypatch.setattr(snapshots, "_draft", interrupted)
    with pytest.raises(CommitConflict):
        replace_snapshot(df.withColumn("v", F.lit("second")), path)
    assert rows_of(read_snapshot(spark, path)) == [(1, "first", 1)]


@pytest.mark.parametrize("policy, options", [
    ("last_wins", {"keep_order": True}), ("insert_ignore", {}), ("fill_zero", {"column": "y"}),
    ("coalesce", {"keep": ["v"]})])
def test_bucket_merges_equal_a_whole_merge(spark, tmp_path, policy, options):
    from starloom.operators.tables import merge_table

    rng = random.Random(4)
    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    for batch in range(4):
        rows = [(rng.randrange(40), rng.choice(["a", "b", None]), rng.choice([0, 1, 2]), batch * 100 + i)
                for i in range(30)]
        df = spark.createDataFrame(rows, "k bigint, v string, y int, o int")
        merge_table(df, whole, ["k"], ["o"], policy, **options)
        merge_snapshot(df, split, ["k"], ["o"], policy, buckets=8, **options)
        assert rows_of(read_snapshot(spark, split).select("k", "v", "y")) == rows_of(
            spark.read.parquet(whole).select("k", "v", "y"))


def test_untouched_buckets_keep_their_files(spark, path):
    rows = [(k, "a", 1) for k in range(400)]
    merge_snapshot(spark.createDataFrame(rows, SCHEMA), path, ["k"], ["o"], buckets=16, keep_order=True)
    first, before = commit_of(spark, path), files_of(path)
    merge_snapshot(spark.createDataFrame([(7, "new", 2)], SCHEMA), path, ["k"], ["o"], keep_order=True)
    second, after = commit_of(spark, path), files_of(path)
    changed = [b for b in second["folders"] if second["folders"][b] != first["folders"][b]]
    assert len(changed) == 1 and len(second["folders"]) == 16
    # old files are as they were, and only the one bucket has new ones
    assert {f: t for f, t in after.items() if f in before} == before
    assert all(second["folders"][changed[0]][0] in f for f in set(after) - set(before))
    # the merge read one bucket only: a plan over the others would list their files
    assert rows_of(lookup(spark, path, ["k"], [7])) == [(7, "new", 2)]
    assert all(second["folders"][changed[0]][0] in f for f in lookup(spark, path, ["k"], [7]).inputFiles())
    vacuum(spark, path)
    assert rows_of(read_snapshot(spark, path)) == sorted([(7, "new", 2), *[r for r in rows if r[0] != 7]])
    assert len(files_of(path)) == len(before)


def test_unknown_keys_read_only_their_buckets(spark, path):
    rows = spark.createDataFrame([(k, "a", 1) for k in range(400)], SCHEMA)
    replace_snapshot(rows, path, ["k"], 16)
    batch = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z")], "of int, x string")
    lost = unknown_keys(batch, ["of"], path, ["k"])
    assert lost.collect() == []
    files = [f for f in lost._jdf.inputFiles()]
    held = commit_of(spark, path)["folders"]
    assert files and len({f.split("_bucket=")[1].split("/")[0] for f in files}) == 1 < len(held)
    scan = lost._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in scan
    batch = spark.createDataFrame([(5,), (1000,), (-3,), (1000,)], "of bigint")
    assert sorted(r[0] for r in unknown_keys(batch, ["of"], path, ["k"]).collect()) == [-3, 1000]
    assert unknown_keys(batch.limit(0), ["of"], path, ["k"]).collect() == []


def test_empty_batches_null_keys_and_other_numbers_of_buckets(spark, path):
    empty = spark.createDataFrame([], SCHEMA)
    assert merge_snapshot(empty, path, ["k"], ["o"], buckets=4, keep_order=True) == 1
    assert rows_of(read_snapshot(spark, path)) == []
    rows = [(None, "n", 1), (1, "a", 1), (2, "b", 1)]
    merge_snapshot(spark.createDataFrame(rows, SCHEMA), path, ["k"], ["o"], keep_order=True)
    assert merge_snapshot(empty, path, ["k"], ["o"], keep_order=True) == 2
    rebucket(spark, path, ["k"], 7)
    merge_snapshot(spark.createDataFrame([(None, "m", 2)], SCHEMA), path, ["k"], ["o"], keep_order=True)
    got = {tuple(r) for r in read_snapshot(spark, path).collect()}
    assert got == {(None, "m", 2), (1, "a", 1), (2, "b", 1)} and commit_of(spark, path)["buckets"] == 7
