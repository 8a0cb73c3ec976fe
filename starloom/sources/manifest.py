"""What has been read, file by file, so that a run that changed is read again.

A manifest holds the path, size, time and digest of every file that a load has taken in. The next
load joins it with the listing: files that are new, that are other than they were, and that are
gone name their runs, and only those runs are read again and replaced. A file that only has a new
time is read for its digest and no further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.contracts import TableContract
from starloom.operators.snapshots import read_snapshot, replace_snapshot
from starloom.operators.tables import drop_table, exists, write_table
from starloom.session import kept
from starloom.sources.files import MICROS

FILE = "path string, size bigint, time timestamp, digest string"
RUN = "run"
# Files whose digests one scan takes; only the paths of changed files come to the driver.
PATHS = 10_000


def listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, size, time) of the files of a folder tree; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return files.load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time"))


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, digest) of these files."""
    out = spark.createDataFrame([], "path string, digest string")
    for k in range(0, len(paths), PATHS):
        files = spark.read.format("binaryFile").load(paths[k:k + PATHS])
        out = out.unionByName(files.select("path", F.sha2("content", 256).alias("digest")))
    return out


def compared(spark: SparkSession, found: DataFrame, known: DataFrame) -> DataFrame:
    """(path, size, time, digest, change) of all files of either; change is 'new', 'changed',
    'gone', 'touched' (another time, the same content) or 'same'."""
    both = found.join(
        known.select("path", F.col("size").alias("old_size"), F.col("time").alias("old_time"),
                     F.col("digest").alias("old_digest")), "path", "full")
    same = F.col("size").eqNullSafe(F.col("old_size")) & F.col("time").eqNullSafe(F.col("old_time"))
    to_read = [r.path for r in both.where(F.col("size").isNotNull() & ~same).select("path").collect()]
    both = both.join(digests(spark, to_read), "path", "left")
    digest = F.when(same, F.col("old_digest")).otherwise(F.col("digest"))
    change = (
        F.when(F.col("size").isNull(), "gone").when(F.col("old_size").isNull(), "new")
        .when(same, "same").when(digest == F.col("old_digest"), "touched").otherwise("changed"))
    return both.select("path", "size", "time", digest.alias("digest"), change.alias("change"))


def run_of(path: Column, pattern: str) -> Column:
    """The run a file belongs to: the first group of a pattern on its path."""
    return F.regexp_extract(path, pattern, 1)


def replay(
    spark: SparkSession, root: str, pattern: str, contract: TableContract, table: str, manifest: str,
    glob: str = "*.json", fmt: str = "json",
) -> list[str]:
    """Bring a table by run up to the files under `root`; returns the runs that were read.

    Runs with a new, changed or missing file are read whole and replace their partition; a run
    without files loses it. The manifest is committed last, so a load that stops is repeated.
    Columns are those of the contract and `run`.
    """
    known = read_snapshot(spark, manifest)
    if known is None:
        known = spark.createDataFrame([], FILE)
    state = compared(spark, listing(spark, root, glob), known).withColumn(RUN, run_of(F.col("path"), pattern))
    with kept(state, "files") as files:
        dirty = files.where("change IN ('new', 'changed', 'gone')").select(RUN).distinct()
        runs = sorted(r[0] for r in dirty.collect())
        if runs:
            paths = [r.path for r in files.where(F.col("size").isNotNull()).join(dirty, RUN, "left_semi")
                     .select("path").collect()]
            rows = spark.createDataFrame([], contract.schema).withColumn(RUN, F.lit(""))
            if paths:
                rows = spark.read.schema(contract.schema).option("timestampNTZFormat", MICROS).format(fmt).load(paths)
                rows = rows.withColumn(RUN, run_of(F.col("_metadata.file_path"), pattern))
            write_table(rows, table, [RUN], only_touched=True)
            full = {r[0] for r in files.where(F.col("size").isNotNull()).select(RUN).distinct().collect()}
            for run in set(runs) - full:
                if exists(spark, f"{table}/{RUN}={run}"):
                    drop_table(spark, f"{table}/{RUN}={run}")
        if files.where("change <> 'same'").limit(1).count():
            replace_snapshot(files.where(F.col("size").isNotNull()).select("path", "size", "time", "digest"), manifest)
    return runs
