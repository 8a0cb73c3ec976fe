"""Songs and artists from catalog files in any order, against one build over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.tables import write_json
from starloom.plans import catalogs, plays
from starloom.plans.catalogs import catalog_dims, merge_records, run_catalog
from starloom.sources.files import scan_json
from starloom.contracts import SONG_CATALOG

SCHEMA = f"{SONG_CATALOG.columns}, _order bigint"


def records(rng, n, first):
    return [(1, f"A{rng.randrange(9)}", rng.choice([None, float("nan"), 1.5, -2.0]), rng.choice([None, 7.5]),
             rng.choice(["", " ", None, "x", "y"]), f"name {rng.randrange(3)}", f"S{rng.randrange(12)}", rng.choice("tuv"),
             rng.choice([1.0, 2.0]), rng.choice([0, 0, 1999, 2004]), first + k) for k in range(n)]


def rows_of(dims):
    return {name: sorted(map(str, df.collect())) for name, df in dims.items()}


@pytest.mark.parametrize("seed", range(3))
def test_parts_in_any_order_equal_one_build(spark, tmp_path, seed):
    rng = random.Random(seed)
    parts = [records(rng, 15, k * 100) for k in range(4)]
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    want = rows_of(plays.build_song_dims(whole, plays.UPSERT))
    rng.shuffle(parts)
    for part in [*parts, parts[0]]:  # one of them twice
        merge_records(spark.createDataFrame(part, SCHEMA), str(tmp_path), ["_order"], buckets=4)
    assert rows_of(catalog_dims(spark, str(tmp_path))) == want


def test_runs_over_files_equal_one_scan(spark, tmp_path):
    rng = random.Random(9)
    songs, out = f"{tmp_path}/songs", f"{tmp_path}/out"
    for k in range(3):
        rows = spark.createDataFrame(records(rng, 12, 0), SCHEMA).drop("_order").repartition(2)
        write_json(rows, f"{songs}/{'bca'[k]}")
        dims = run_catalog(spark, songs, out, files_per_batch=1)
    want = plays.build_song_dims(scan_json(spark, songs, SONG_CATALOG, arrival=True), plays.UPSERT)
    assert rows_of(dims) == rows_of(want)
    assert rows_of(run_catalog(spark, songs, out)) == rows_of(want)


def test_a_bad_batch_is_not_merged(spark, tmp_path):
    songs, out = f"{tmp_path}/songs", f"{tmp_path}/out"
    good = spark.createDataFrame(records(random.Random(1), 5, 0), SCHEMA).drop("_order")
    write_json(good, f"{songs}/a")
    before = rows_of(run_catalog(spark, songs, out))
    write_json(good.withColumn("title", F.lit("x" * 300)), f"{songs}/b")
    with pytest.raises(Exception, match="max_length:title"):
        run_catalog(spark, songs, out)
    assert rows_of(catalog_dims(spark, out)) == before


def test_nothing_loaded(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        catalog_dims(spark, str(tmp_path))


def test_the_star_can_use_streamed_dimensions(spark, tmp_path):
    from starloom.plans import refresh
    from tests.test_plays import T0, event

    rows = [(1, "A1", None, None, "", "A", "S1", "T", 246.9, 0, 1)]
    merge_records(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/c", ["_order"])
    dims = catalogs.catalog_dims(spark, f"{tmp_path}/c")
    write_json(spark.createDataFrame([event(T0)]), f"{tmp_path}/log")
    paths = refresh.run_hourly(spark, f"{tmp_path}/log", spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/out",
                               plays.DEFAULT, dims=dims)
    assert [r.song_id for r in spark.read.parquet(paths["songplays"]).collect()] == ["S1"]
