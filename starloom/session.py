"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Joins carry no broadcast hints unless a
# size was checked: Spark picks the strategy from file statistics and, through AQE, from the
# real shuffle sizes, and splits the partitions of hot keys.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# For large tables: a task reads so much of a file at most, and intermediate tables are stored small.
# On facts the first level of zstd takes a tenth of the time of a write off the third, and no more room.
TABLE_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}
# Bytes of stored input for each partition that a shuffle begins with; AQE joins small ones.
SHUFFLE_BYTES = 8 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure_tables(spark: SparkSession, *inputs: str) -> SparkSession:
    """Settings for jobs over the tables at these paths: what one task sorts or groups in memory
    stays the same however large they are."""
    for key, value in TABLE_CONF.items():
        spark.conf.set(key, value)
    wanted = sum(stored_bytes(spark, path) for path in inputs if _exists(spark, path)) // SHUFFLE_BYTES
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, wanted)
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "starloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with our settings; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: str | None = None
_scratch_paths: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by `spark.checkpoint.dir`, which all executors share.

    Only a session in one process may fall back to a temporary folder of this machine, which
    goes when the process ends. `clear_scratch` removes the paths at the end of a run.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="starloom-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch_paths.add(path)
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _scratch_paths.discard(path)


def remove_scratch(spark: SparkSession, paths: set[str]) -> None:
    """Remove these intermediate tables; results that read them must be done."""
    for path in paths & _scratch_paths:
        _remove(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this session."""
    remove_scratch(spark, set(_scratch_paths))


@contextmanager
def scratch_made() -> Iterator[set[str]]:
    """The paths that are made inside, once it is over."""
    before, made = set(_scratch_paths), set()
    yield made
    made.update(_scratch_paths - before)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


@contextmanager
def kept(df: DataFrame, label: str, path: str | None = None) -> Iterator[DataFrame]:
    """`df` written once to the shared folder, for several reads, and removed afterwards."""
    path = path or scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _remove(df.sparkSession, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage on storage that outlives executors, so values that depend on task layout
    (partition numbers, positions) stay fixed whatever is recomputed later.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
