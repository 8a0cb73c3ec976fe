"""Songs and artists from a stream of catalog files.

What a merge needs of the files it has seen is kept per song and per artist: the oldest row, the
first positive year, the newest value of each other column, each with its order. Such states
merge by minimum and maximum, so files may come in any order, in any number of runs, and twice:
the result is that of one build over all of them. They are stored in hash buckets of the key, and
a run reads and writes only the buckets of the songs and artists in its files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.contracts import ARTISTS, SONG_CATALOG, SONGS, TableContract
from starloom.operators import merge
from starloom.operators.quality import assert_quality, row_checks
from starloom.operators.snapshots import merge_snapshot, read_snapshot
from starloom.session import kept
from starloom.sources.files import ARRIVAL, arrival_order
from starloom.streaming.incremental import file_stream, run_batches

BUCKETS = 64
KEPT = ["artist_name"]


@dataclass(frozen=True)
class Kind:
    """One dimension of the catalog: its contract and how its rows merge."""

    contract: TableContract
    policy: str

    @property
    def key(self) -> list[str]:
        return list(self.contract.primary_key)

    @property
    def values(self) -> list[str]:
        return [c for c in self.contract.column_names if c not in self.key]

    def state(self, records: DataFrame, order: list[str]) -> DataFrame:
        rows, rank = records.select(*self.contract.column_names, *order), merge.order_columns(order)
        rows = rows.where(F.col(self.key[0]).isNotNull())
        if self.policy == "fill_zero":
            return merge.fill_zero_state(rows, self.key, rank, "year", self.values)
        return merge.coalesce_state(rows, self.key, rank, KEPT, self.values)

    def result(self, state: DataFrame) -> DataFrame:
        if self.policy == "fill_zero":
            return merge.fill_zero_result(state, self.key, "year", self.values)
        return merge.coalesce_result(state, self.key, KEPT, self.values)


KINDS = {"songs": Kind(SONGS, "fill_zero"), "artists": Kind(ARTISTS, "coalesce")}


def merge_records(
    records: DataFrame, out: str, order: list[str], kinds: dict[str, Kind] = KINDS, buckets: int = BUCKETS,
) -> None:
    """Merge catalog records into the stored states. `order` tells which of two rows is older."""
    for name, kind in kinds.items():
        merge_snapshot(
            kind.state(records, order), f"{out}/{name}_state", kind.key, [], buckets=buckets,
            merge=lambda state, stored, key=kind.key: merge.merge_states(state, stored, key))


def catalog_dims(spark: SparkSession, out: str, kinds: dict[str, Kind] = KINDS) -> dict[str, DataFrame]:
    """Songs and artists as of the newest version of the states."""
    states = {name: read_snapshot(spark, f"{out}/{name}_state") for name in kinds}
    missing = [name for name, state in states.items() if state is None]
    if missing:
        raise FileNotFoundError(f"no catalog has been loaded into {out}: {missing}")
    return {name: kind.result(states[name]) for name, kind in kinds.items()}


def run_catalog(
    spark: SparkSession, song_path: str, out: str, order: list[str] | None = None,
    contract: TableContract = SONG_CATALOG, buckets: int = BUCKETS, files_per_batch: int | None = None,
) -> dict[str, DataFrame]:
    """One run over the catalog files that have not been seen; the dimensions after it.

    Rows are in order of arrival (the time and path of their file), or of columns of theirs. A
    batch that breaks the ranges or lengths of a dimension stops the run before it is merged.
    """
    stream = file_stream(spark, song_path, contract, files_per_batch=files_per_batch)
    if order is None:
        stream = stream.select("*", F.col("_metadata").alias("_metadata"))

    def on_batch(batch: DataFrame, number: int) -> None:
        if order is None:
            batch = batch.select(*contract.column_names, arrival_order())
        with kept(batch, "catalog-batch") as records:
            for kind in KINDS.values():
                rows = records.select(*kind.contract.column_names).where(F.col(kind.key[0]).isNotNull())
                assert_quality(row_checks(rows, TableContract(
                    kind.contract.name, "", checks=kind.contract.checks, max_length=kind.contract.max_length)))
            merge_records(records, out, order or [ARRIVAL], buckets=buckets)

    run_batches(stream, f"{out}/_catalog_checkpoint", on_batch)
    return catalog_dims(spark, out)
