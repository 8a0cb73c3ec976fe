"""Numbers of appended rows: stable, without gaps, the same after a rerun."""

import pytest

from starloom.operators import identity
from starloom.operators.identity import append_numbered, ledger
from starloom.operators.snapshots import read_snapshot

SCHEMA = "v string, w int"


def rows_of(spark, path):
    return sorted((r.id, r.v, r.w) for r in read_snapshot(spark, path).collect())


def test_batches_and_reruns(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1)], SCHEMA).repartition(3)
    two = spark.createDataFrame([("z", 2), ("y", 2)], SCHEMA)
    assert append_numbered(one, path, "one", ["v"], start=10) == (10, 3)
    assert append_numbered(two, path, "two", ["v"]) == (13, 2)
    whole = [(10, "a", 1), (11, "a", 1), (12, "b", 1), (13, "y", 2), (14, "z", 2)]
    assert rows_of(spark, path) == whole
    assert append_numbered(one, path, "one", ["v"]) == (10, 3) and rows_of(spark, path) == whole
    assert ledger(spark, path) == {"one": (10, 3), "two": (13, 2)}
    # the last batch may change its size, an earlier one may not
    assert append_numbered(two.limit(1), path, "two", ["v"]) == (13, 1)
    with pytest.raises(ValueError, match="later batches"):
        append_numbered(one.limit(1), path, "one", ["v"])
    assert append_numbered(one.limit(0), path, "none", ["v"]) == (14, 0)
    assert append_numbered(one, path, "three", ["v"]) == (14, 3)
    assert [r[0] for r in rows_of(spark, path)] == [10, 11, 12, 13, 14, 15, 16]


def test_a_load_that_stops_takes_no_numbers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA)
    append_numbered(df, path, "one", ["v"])
    with monkeypatch.context() as patch:
        patch.setattr(identity, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            append_numbered(df, path, "two", ["v"])
    assert len(rows_of(spark, path)) == 2
    assert append_numbered(df, path, "two", ["v"]) == (2, 2)
