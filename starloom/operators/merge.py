"""Upsert policies as ordered aggregates.

Every policy is one `groupBy(key)` whose min/max aggregates combine on the map side, so a hot
key costs one row per map task in the shuffle and no group is ever gathered. Order columns
decide which row is older; equal order falls back to the values, so results do not depend on
partitioning. Target rows are older than every batch row, unless the target carries the order
columns: then those decide, and batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.numbers import nan_to_null
from starloom.functions.text import blank_to_null

GENERATION = "_generation"


def with_target(
    batch: DataFrame, target: DataFrame | None, order: list[str]
) -> tuple[DataFrame, list[Column]]:
    """Batch and target rows, and the columns that put them in order."""
    if target is None:
        return batch, _order(order)
    missing = [c for c in order if c not in target.columns]
    if order and not missing:
        return batch.unionByName(target), _order(order)
    blank = {c: F.lit(None).cast(batch.schema[c].dataType) for c in missing}
    older = target.withColumns({**blank, GENERATION: F.lit(0)})
    newer = batch.withColumn(GENERATION, F.lit(1))
    return older.unionByName(newer), _order([GENERATION, *order])


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"_order_{i}") for i, c in enumerate(columns)]


def _values(batch: DataFrame, key: list[str], order: list[str]) -> list[str]:
    return [c for c in batch.columns if c not in key and c not in order]


def last_wins(
    batch: DataFrame, key: list[str], order: list[str], target: DataFrame | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """The newest row replaces all columns; `keep_order` leaves the order columns in."""
    values = _values(batch, key, [] if keep_order else order)
    rows, rank = with_target(batch, target, order)
    newest = rows.groupBy(*key).agg(F.max(F.struct(*rank, *values)).alias("_newest"))
    return newest.select(*key, *[F.col(f"_newest.{c}") for c in values])


def first_wins(batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The oldest row of each key, without the order columns."""
    values = _values(batch, key, order)
    oldest = batch.groupBy(*key).agg(F.min(F.struct(*_order(order), *values)).alias("_oldest"))
    return oldest.select(*key, *[F.col(f"_oldest.{c}") for c in values])


def insert_ignore(
    batch: DataFrame, key: list[str], order: list[str], target: DataFrame | None = None
) -> DataFrame:
    """Rows to insert: the oldest of each key that the target does not hold yet."""
    rows = first_wins(batch, key, order)
    return rows if target is None else rows.join(target.select(*key), key, "left_anti")


# --- policies with a state that can be stored: states of parts of the rows, in any order, merge
# into the state of all rows ---

def _state(rows: DataFrame, key: list[str], parts: dict[str, Column]) -> DataFrame:
    """One row per key; parts named `_newest...` keep their greatest value, others their least."""
    return rows.groupBy(*key).agg(*[
        (F.max if name.startswith("_newest") else F.min)(part).alias(name) for name, part in parts.items()
    ])


def merge_states(batch: DataFrame, stored: DataFrame | None, key: list[str]) -> DataFrame:
    """The state of all rows that either state has seen; a batch that is merged twice counts once."""
    both = batch if stored is None else batch.unionByName(stored)
    return _state(both, key, {c: F.col(c) for c in batch.columns if c not in key})


def fill_zero_state(rows: DataFrame, key: list[str], order: list[Column], column: str, values: list[str]) -> DataFrame:
    """The oldest row, and the first positive value of `column` with its order."""
    positive = F.when(F.col(column) > 0, F.struct(*order, column))
    return _state(rows, key, {"_oldest": F.struct(*order, *values), "_filled": positive})


def fill_zero_result(state: DataFrame, key: list[str], column: str, values: list[str]) -> DataFrame:
    stored, first = F.col(f"_oldest.{column}"), F.col(f"_filled.{column}")
    filled = F.when(stored == 0, F.coalesce(first, stored)).otherwise(stored).alias(column)
    return state.select(*key, *[filled if c == column else F.col(f"_oldest.{c}") for c in values])


def fill_zero(
    batch: DataFrame, key: list[str], order: list[str], column: str = "year",
    target: DataFrame | None = None,
) -> DataFrame:
    """The oldest row stays; only `column` is replaced, once, by the first positive value if
    the stored one is 0."""
    values = _values(batch, key, order)
    rows, rank = with_target(batch, target, order)
    return fill_zero_result(fill_zero_state(rows, key, rank, column, values), key, column, values)


def coalesce_state(rows: DataFrame, key: list[str], order: list[Column], keep: list[str], values: list[str]) -> DataFrame:
    """The oldest row's `keep`, and of each other column the newest value with its order."""
    kinds = dict(rows.dtypes)
    clean = {c: nan_to_null(F.col(c)) for c in values if kinds[c] in ("double", "float")}
    clean |= {c: blank_to_null(F.col(c)) for c in values if kinds[c] == "string"}
    rows = rows.withColumns(clean) if clean else rows
    newest = {f"_newest_{c}": F.when(F.col(c).isNotNull(), F.struct(*order, c)) for c in values if c not in keep}
    return _state(rows, key, {"_oldest": F.struct(*order, *keep), **newest})


def coalesce_result(state: DataFrame, key: list[str], keep: list[str], values: list[str]) -> DataFrame:
    return state.select(
        *key, *[F.col(f"_oldest.{c}" if c in keep else f"_newest_{c}.{c}").alias(c) for c in values])


def coalesce_newest(
    batch: DataFrame, key: list[str], order: list[str], keep: list[str],
    target: DataFrame | None = None,
) -> DataFrame:
    """Columns in `keep` stay as in the oldest row; others take their newest non-null value.

    NaN and blank count as NULL.
    """
    values = _values(batch, key, order)
    rows, rank = with_target(batch, target, order)
    return coalesce_result(coalesce_state(rows, key, rank, keep, values), key, keep, values)


def order_columns(order: list[str]) -> list[Column]:
    """The order as a state stores it."""
    return _order(order)
