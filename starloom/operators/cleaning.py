"""Projections, row filters and null handling."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from starloom.functions.text import blank_to_null, empty_to_null
from starloom.operators.tables import filesystem


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select the named columns, in order, under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows with the given values in all key columns."""
    return df.where(reduce(Column.__and__, [F.col(c) == F.lit(v) for c, v in key.items()]))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text column is NULL, empty or blank."""
    return df.where(blank_to_null(F.col(column)).isNotNull())


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which all the listed columns are non-null."""
    return df.where(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns]))


def fill_default(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def blanks_as_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = string_columns(df) if columns is None else columns
    return df.withColumns({c: blank_to_null(F.col(c)) for c in names})


def empties_as_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = string_columns(df) if columns is None else columns
    return df.withColumns({c: empty_to_null(F.col(c)) for c in names})


def not_literal(df: DataFrame, column: str, literal: str) -> DataFrame:
    """`column <> literal`; NULLs go too, as three-valued logic has it."""
    return df.where(F.col(column) != F.lit(literal))


def any_column_rlike(df: DataFrame, pattern: str) -> DataFrame:
    """Rows in which any column, as text, matches the pattern."""
    hits = [F.coalesce(F.col(c).cast("string").rlike(pattern), F.lit(False)) for c in df.columns]
    return df.where(reduce(Column.__or__, hits))


def newest_month(df: DataFrame, ts: str, path: str) -> tuple[int, int] | None:
    """The newest of the folders year=.../month=... that holds a time; None if none does.

    The folders are listed, not read. From the newest on, each is asked for one row with a time, so
    as a rule a single file is opened.
    """
    fs, folders = filesystem(df.sparkSession, f"{path.rstrip('/')}/year=*/month=*")
    names = [status.getPath().toString() for status in fs.globStatus(folders) or []]
    found = [re.search(r"/year=(\d+)/month=(\d+)$", name) for name in names]
    for year, month in sorted({(int(f[1]), int(f[2])) for f in found if f}, reverse=True):
        rows = df.where((F.col("year") == year) & (F.col("month") == month) & F.col(ts).isNotNull())
        if not rows.isEmpty():
            return year, month
    return None


def latest_window(df: DataFrame, ts: str, interval: str = "1 week", path: str | None = None) -> DataFrame:
    """Rows no older than `interval` before the newest one.

    The newest time is an uncorrelated scalar subquery: one aggregate over one column, whose
    result reaches the scan of `df` as a range filter. If the table has folders by `year` and
    `month`, only those of the interval are opened; with the `path` of those folders, the newest
    time is looked for in the newest of them alone.
    """
    source = df
    if path is not None:
        month = newest_month(df, ts, path)
        if month is None:
            return df.where(F.lit(False))
        source = df.where((F.col("year") == month[0]) & (F.col("month") == month[1]))
    newest = source.select(F.max(ts)).scalar()
    oldest = newest - F.expr(f"INTERVAL {interval}")
    rows = df.where(F.col(ts).between(oldest, newest))
    if {"year", "month"} <= set(df.columns):
        y, m = F.col("year"), F.col("month")
        rows = rows.where((y > F.year(oldest)) | ((y == F.year(oldest)) & (m >= F.month(oldest))))
        rows = rows.where((y < F.year(newest)) | ((y == F.year(newest)) & (m <= F.month(newest))))
    return rows


def valid_codes(df: DataFrame, checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keep rows whose codes are all in their lists: {column: (list, column of the list)}."""
    for column, (codes, code) in checks.items():
        valid = codes.select(F.col(code).alias("_code")).distinct()
        df = df.join(valid, df[column] == valid["_code"], "left_semi")
    return df
