"""Bad lines as a table, counted in the read that loads the others."""

import os

import pytest

from starloom.contracts import TableContract
from starloom.sources.staging import (
    EMPTY, NOT_JSON, TYPE, TooManyErrors, load_lines, loaded, read_lines, rejects,
)

ROWS = TableContract("rows", "k bigint, v string, n decimal(9,2), value string", not_null=("k", "v"), max_length={"v": 3})
LINES = [
    '{"k": 1, "v": "abcd", "n": "1.239", "value": "x"}', '{"k": 2, "v": "b"', '   ', '{"k": "two", "v": "c"}',
    '{"v": " ", "n": "much"}', '[1]', '{"k": 5, "v": "e", "n": null}',
]


@pytest.mark.parametrize("mapping", ["auto", "exact", ["$.k", "$['v']", "$.n", "$.value"]])
def test_rows_and_rejects(spark, tmp_path, mapping):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES) + "\n")
    lines = read_lines(spark, str(tmp_path / "in"), arrival=True)
    path = str(tmp_path / "out")
    assert load_lines(lines, ROWS, path, mapping=mapping) == (2, 4)
    got = sorted((r.k, r.v, float(r.n) if r.n is not None else None) for r in loaded(spark, path, ROWS).collect())
    assert got == [(1, "abc", 1.23), (5, "e", None)]
    told = rejects(spark, path).collect()
    assert all(r.file.endswith("/a.json") and r.block == 0 for r in told)
    assert sorted((r.text, r.column or "", r.reason) for r in told) == sorted([
        (LINES[1], "", NOT_JSON), (LINES[3], "k", TYPE), (LINES[4], "k", EMPTY), (LINES[4], "v", EMPTY),
        (LINES[4], "n", TYPE), (LINES[5], "", NOT_JSON)])
    order = [t for _, t in sorted({(r.line, r.text) for r in told})]
    assert order == [LINES[1], LINES[3], LINES[4], LINES[5]]


def test_limit_and_one_read(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    with pytest.raises(TooManyErrors):
        load_lines(lines, ROWS, str(tmp_path / "few"), max_error=3)
    assert loaded(spark, str(tmp_path / "few"), ROWS).count() == 0
    assert rejects(spark, str(tmp_path / "few")).count() == 6
    assert load_lines(lines, ROWS, str(tmp_path / "enough"), max_error=4) == (2, 4)
    # lines that change when they are read again show that they are read once
    reads = spark.sparkContext.accumulator(0)

    def touched(rows):
        for r in rows:
            reads.add(1)
            yield r

    once = spark.createDataFrame(lines.rdd.mapPartitions(touched), "value string")
    load_lines(once, ROWS, str(tmp_path / "once"))
    assert reads.value == len(LINES)


def test_no_lines(spark, tmp_path):
    assert load_lines(spark.createDataFrame([], "value string"), ROWS, str(tmp_path / "none"), max_error=0) == (0, 0)
    assert loaded(spark, str(tmp_path / "none"), ROWS).count() == 0 == rejects(spark, str(tmp_path / "none")).count()
    assert os.path.isdir(tmp_path / "none")


def test_the_refresh_keeps_its_rejects(spark, tmp_path):
    from starloom.contracts import SONG_CATALOG
    from starloom.operators.tables import write_json
    from starloom.plans import refresh
    from tests.test_plays import T0, event

    write_json(spark.createDataFrame([event(T0)]), f"{tmp_path}/log/0")
    spark.createDataFrame([("{cut",), (" ",)], "value string").coalesce(1).write.text(f"{tmp_path}/log/1")
    catalog = spark.createDataFrame([], SONG_CATALOG.schema)
    paths = refresh.run_hourly(spark, f"{tmp_path}/log", catalog, f"{tmp_path}/out", max_error=1)
    assert spark.read.parquet(paths["songplays"]).count() == 1
    told = spark.read.parquet(f"{tmp_path}/out/rejects").collect()
    assert [(r.text, r.reason) for r in told] == [("{cut", NOT_JSON)] and "/log/1/" in told[0].file
    spark.createDataFrame([("{a",), ("{b",)], "value string").write.text(f"{tmp_path}/log/2")
    with pytest.raises(Exception, match="2 lines could not be loaded"):
        refresh.run_hourly(spark, f"{tmp_path}/log", catalog, f"{tmp_path}/out", max_error=1)
    assert spark.read.parquet(f"{tmp_path}/out/rejects").count() == 3
