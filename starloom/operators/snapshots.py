"""Tables that change by commits: readers always see one whole version.

A table is a folder with data folders, which are written once and never changed, and a folder
`_commits` with one small file per version. The file of a version names the data folders that
make it up. A load writes its data folders first and the file last, by one rename, so a table is
either as before or as after it, whatever stops the load. On a store whose rename is a copy, only
that small file is copied.

A dimension can be kept in hash buckets of its key. A merge then reads and writes only the
buckets that its batch touches; the next version names the new folders of those and the old
folders of all others.

Old versions stay readable until `vacuum` removes them. Two loads of one table at a time are not
meant to be; the one that commits second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom.operators.tables import POLICIES, filesystem
from starloom.session import kept

COMMITS, BUCKET = "_commits", "_bucket"
WHOLE = "all"


class CommitConflict(RuntimeError):
    """Another load has committed since this one began."""


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    return sorted(int(n) for n in _children(spark, f"{path}/{COMMITS}") if n.isdigit())


def commit_of(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """What a version (the newest by default) consists of; None if there is none.

    {"version", "schema", "buckets": None or a number, "folders": {bucket or "all": [folder]}}
    """
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    fs, p = filesystem(spark, f"{path}/{COMMITS}/{version}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _draft(spark: SparkSession, path: str, content: dict) -> str:
    """Write the file of a version under a name that is not a version."""
    draft = f"{path}/{COMMITS}/.draft-{uuid.uuid4().hex}"
    fs, p = filesystem(spark, draft)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    return draft


def _publish(spark: SparkSession, path: str, version: int, draft: str) -> None:
    """Give it its number, unless another load has taken that."""
    fs, final = filesystem(spark, f"{path}/{COMMITS}/{version}")
    _, source = filesystem(spark, draft)
    if fs.exists(final) or not fs.rename(source, final):
        fs.delete(source, False)
        raise CommitConflict(f"version {version} of {path} exists already")


def _commit(spark: SparkSession, path: str, content: dict) -> None:
    _publish(spark, path, content["version"], _draft(spark, path, content))


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version of the table (the newest by default), or None if nothing is committed.

    The result keeps reading the folders of its version, whatever is committed later.
    """
    commit = commit_of(spark, path, version)
    return None if commit is None else _read(spark, path, commit, list(commit["folders"]))


def _read(spark: SparkSession, path: str, commit: dict, names: list[str]) -> DataFrame:
    schema = StructType.fromJson(commit["schema"])
    folders = [f"{path}/{f}" for n in names for f in commit["folders"].get(n, [])]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def replace_snapshot(
    df: DataFrame, path: str, key: list[str] | None = None, buckets: int | None = None
) -> int:
    """Truncate and insert: a new version with the rows of `df`, which may read the old one.

    With a key and a number of buckets, the new version is in hash buckets of the key.
    """
    spark = df.sparkSession
    version = (versions(spark, path) or [0])[-1] + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    folders = {WHOLE: [folder]}
    if buckets:
        folders = _write_buckets(df, path, folder, key, buckets)
    else:
        df.write.parquet(f"{path}/{folder}")
    _commit(spark, path, {"version": version, "schema": df.schema.jsonValue(), "buckets": buckets,
                          "folders": folders})
    return version


def _write_buckets(df: DataFrame, path: str, folder: str, key: list[str], buckets: int) -> dict[str, list[str]]:
    """Write rows by bucket; {bucket: its folder}."""
    (df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
     .sortWithinPartitions(BUCKET, *key).write.partitionBy(BUCKET).parquet(f"{path}/{folder}"))
    names = [n for n in _children(df.sparkSession, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")]
    return {n.split("=")[1]: [f"{folder}/{n}"] for n in names}


def bucket_of(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def merge_snapshot(
    batch: DataFrame, path: str, key: list[str], order: list[str], policy: str = "last_wins",
    buckets: int = 64, merge: Callable | None = None,
    **options,
) -> int:
    """Upsert a batch into a table in hash buckets by a policy of `operators.merge`.

    Only the buckets of the batch's keys are read and written. The number of buckets is fixed by
    the first load (`rebucket` changes it). `merge(batch, target)` stands in for a policy. An
    empty batch commits nothing but the empty table. Returns the version.
    """
    spark = batch.sparkSession
    old = commit_of(spark, path)
    buckets = buckets if old is None else old["buckets"]
    if not buckets:
        raise ValueError(f"{path} is not in buckets")
    combine = merge or (lambda rows, target: POLICIES[policy](rows, key, order, target=target, **options))
    with kept(batch.withColumn(BUCKET, bucket_of(key, buckets)), "merge") as rows:
        # At most as many numbers as there are buckets.
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        rows = rows.drop(BUCKET)
        target = None if old is None else _read(spark, path, old, [str(b) for b in touched])
        merged = combine(rows, target)
        if old is not None and policy == "insert_ignore" and merge is None:
            merged = target.unionByName(merged.select(*target.columns))
        if old is not None and not touched:
            return old["version"]
        version = (versions(spark, path) or [0])[-1] + 1 if old is None else old["version"] + 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        folders = dict(old["folders"]) if old else {}
        folders |= _write_buckets(merged, path, folder, key, buckets)
        _commit(spark, path, {"version": version, "schema": merged.schema.jsonValue(), "buckets": buckets,
                              "folders": folders})
        return version


def rebucket(spark: SparkSession, path: str, key: list[str], buckets: int) -> int:
    """The same rows in another number of buckets, as a new version."""
    old = commit_of(spark, path)
    version = old["version"] + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    rows = _read(spark, path, old, list(old["folders"]))
    _commit(spark, path, old | {"version": version, "buckets": buckets,
                                "folders": _write_buckets(rows, path, folder, key, buckets)})
    return version


def lookup(spark: SparkSession, path: str, key: list[str], values: list) -> DataFrame:
    """The row of one key, from its bucket alone."""
    commit = commit_of(spark, path)
    schema = StructType.fromJson(commit["schema"])
    row = spark.createDataFrame([tuple(values)], StructType([schema[c] for c in key]))
    bucket = row.select(bucket_of(key, commit["buckets"])).first()[0]
    found = _read(spark, path, commit, [str(bucket)])
    for c, v in zip(key, values):
        found = found.where(F.col(c) == F.lit(v))
    return found


def unknown_keys(df: DataFrame, columns: list[str], path: str, key: list[str]) -> DataFrame:
    """Distinct values of `columns`, without nulls, that a table in buckets of `key` does not hold.

    Of the table, only the key columns of the values' buckets are read.
    """
    spark, commit = df.sparkSession, commit_of(df.sparkSession, path)
    schema = StructType.fromJson(commit["schema"])
    values = df.select(*[F.col(c).cast(schema[k].dataType).alias(k) for c, k in zip(columns, key)])
    values = values.dropna("any").distinct().withColumn(BUCKET, bucket_of(key, commit["buckets"]))
    touched = sorted(r[0] for r in values.select(BUCKET).distinct().collect())
    known = _read(spark, path, commit, [str(b) for b in touched]).select(*key)
    return values.drop(BUCKET).join(known, key, "left_anti")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove versions but the newest `keep`, data folders that none of those names, and drafts.

    Also removes what stopped loads left. Not to be run beside a load. Returns what it removed.
    """
    known = versions(spark, path)
    if not known:
        return []
    held = {f for v in known[-keep:] for fs in commit_of(spark, path, v)["folders"].values() for f in fs}
    whole = {f.split("/")[0] for f in held}
    gone = [f"{COMMITS}/{v}" for v in known[:-keep]]
    gone += [f"{COMMITS}/{n}" for n in _children(spark, f"{path}/{COMMITS}") if n.startswith(".draft-")]
    for name in _children(spark, path):
        if name.startswith("v") and name not in whole:
            gone.append(name)
        elif name in whole:
            inside = [f"{name}/{n}" for n in _children(spark, f"{path}/{name}") if n.startswith(f"{BUCKET}=")]
            gone += [f for f in inside if f not in held]
    for name in gone:
        fs, p = filesystem(spark, f"{path}/{name}")
        fs.delete(p, True)
    return gone
