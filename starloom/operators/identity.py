"""Numbers for appended rows: each batch continues where the last one ended.

The table changes by commits (`operators.snapshots`); a commit also holds the ledger, the range of
numbers of every batch. Rows keep their numbers for good, a batch that is loaded again gets the
numbers it had, and there are no gaps. The cost of a load follows its batch: its rows are sorted
and numbered, the others are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.operators.keys import dense_key
from starloom.operators.snapshots import _commit, commit_of, versions


def ledger(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """{batch: (first number, rows)}, in order of the numbers."""
    commit = commit_of(spark, path)
    ranges = commit["ranges"] if commit else {}
    return {b: tuple(r) for b, r in sorted(ranges.items(), key=lambda x: x[1])}


def append_numbered(
    df: DataFrame, path: str, batch: str, order: list[str | Column], name: str = "id", start: int = 0,
) -> tuple[int, int]:
    """Append the rows of a batch with the next numbers, in the given order and then by all columns.

    A batch that is in the ledger is replaced, under the numbers it had; other rows than last time
    are welcome, but only the last batch may have another number of them. Returns its range.
    """
    spark = df.sparkSession
    old, known = commit_of(spark, path), ledger(spark, path)
    end = max((first + rows for first, rows in known.values()), default=start)
    first, before = known.get(batch, (end, None))
    version = old["version"] + 1 if old else (versions(spark, path) or [0])[-1] + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    dense_key(df, order, name, start=first, unique=False).write.parquet(f"{path}/{folder}")
    saved = spark.read.parquet(f"{path}/{folder}")
    rows = saved.count()
    if before is not None and rows != before and first + before != end:
        raise ValueError(f"batch {batch} had {before} rows and later batches follow it; it has {rows} now")
    ranges = {b: list(r) for b, r in known.items()} | {batch: [first, rows]}
    folders = (old["folders"] if old else {}) | {batch: [folder]}
    schema = saved.select(name, *[c for c in saved.columns if c != name]).schema
    _commit(spark, path, {"version": version, "schema": schema.jsonValue(), "buckets": None,
                          "folders": folders, "ranges": ranges})
    return first, rows
