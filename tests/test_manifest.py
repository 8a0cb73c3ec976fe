"""Files that are read again: what changed, which runs follow from it, and loads that stop."""

import os
import shutil

import pytest

from starloom.contracts import TableContract
from starloom.operators.snapshots import read_snapshot
from starloom.sources import manifest
from starloom.sources.manifest import compared, listing, replay

ROWS = TableContract("rows", "k bigint, v string")
PATTERN = r"/day=([^/]+)/"


@pytest.fixture
def world(spark, tmp_path):
    root, table, kept = (str(tmp_path / n) for n in ("in", "table", "manifest"))

    def put(day, name, text):
        os.makedirs(f"{root}/day={day}", exist_ok=True)
        with open(f"{root}/day={day}/{name}.json", "w") as file:
            file.write(text)

    def run():
        return replay(spark, root, PATTERN, ROWS, table, kept)

    def rows():
        return sorted(tuple(r) for r in spark.read.schema("k bigint, v string, run string").parquet(table).collect())

    return root, put, run, rows, kept


def test_only_changed_runs_are_read(spark, world, tmp_path):
    root, put, run, rows, kept = world
    for day in ("01", "02", "03"):
        put(day, "a", f'{{"k": 1, "v": "{day}"}}\n')
    assert run() == ["01", "02", "03"] and run() == []
    untouched = {f: os.stat(f"{tmp_path}/table/run=02/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/table/run=02")}
    put("01", "a", '{"k": 9, "v": "new"}\n')           # rewritten, of the same length or not
    put("03", "late", '{"k": 2, "v": "late"}\n')       # late, for a run that is past
    assert run() == ["01", "03"]
    assert rows() == sorted([(9, "new", "01"), (1, "02", "02"), (1, "03", "03"), (2, "late", "03")])
    assert untouched == {f: os.stat(f"{tmp_path}/table/run=02/{f}").st_mtime_ns for f in os.listdir(f"{tmp_path}/table/run=02")}
    shutil.rmtree(f"{root}/day=01")                     # taken back
    assert run() == ["01"] and all(r[2] != "01" for r in rows())


def test_a_new_time_alone_reads_no_run(spark, world):
    root, put, run, rows, kept = world
    put("01", "a", '{"k": 1, "v": "x"}\n')
    put("02", "a", '{"k": 2, "v": "y"}\n')
    run()
    os.utime(f"{root}/day=01/a.json", (1, 1))
    state = compared(spark, listing(spark, root, "*.json"), read_snapshot(spark, kept))
    assert sorted(r.change for r in state.collect()) == ["same", "touched"]
    assert run() == []
    state = compared(spark, listing(spark, root, "*.json"), read_snapshot(spark, kept))
    assert {r.change for r in state.collect()} == {"same"}


def test_the_listing_reads_no_content(spark, world):
    root, put, *_ = world
    put("01", "a", '{"k": 1, "v": "x"}\n')
    plan = listing(spark, root, "*.json")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_a_load_that_stops_is_repeated(spark, world, monkeypatch):
    root, put, run, rows, kept = world
    put("01", "a", '{"k": 1, "v": "x"}\n')
    run()
    put("01", "b", '{"k": 2, "v": "y"}\n')
    with monkeypatch.context() as patch:
        patch.setattr(manifest, "replace_snapshot", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            run()
    assert run() == ["01"] and rows() == [(1, "x", "01"), (2, "y", "01")] and run() == []
