"""Sinks, table creation and loads over parquet folders."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession, functions as F

from starloom.contracts import TableContract
from starloom.operators import merge as policies
from starloom.operators.layout import repartition_by_columns
from starloom.session import kept

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class KeyConflict(ValueError):
    """A batch holds different rows of one key."""


def filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def drop_table(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (),
    mode: str = "overwrite", only_touched: bool = False,
    sort_by: list[str] | tuple[str, ...] = (), gather: bool = True,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write parquet. Partitioned writes bring the rows of a partition value together first,
    splitting hot ones, unless `gather` says that each task has few of them; `late` adds
    what follows from the rows after they have been moved; `only_touched` replaces just the partitions present in `df`. Files are
    sorted by `sort_by`, so that a lookup skips row groups."""
    out = repartition_by_columns(df, list(partition_by)) if partition_by and gather else df
    out = late(out) if late else out
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if only_touched:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


@contextmanager
def beside(
    df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...],
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> Iterator[tuple[DataFrame, str]]:
    """`df` written once beside the table at `path` and in its layout, to be checked and then moved
    in: its rows, and the folder they lie in, of which what was not moved is removed afterwards."""
    spark, folder = df.sparkSession, f"{path.rstrip('/')}__batch"
    drop_table(spark, folder)  # of a run that was killed
    try:
        write_table(df, folder, partition_by, late=late)
        yield spark.read.schema((late(df) if late else df).schema).parquet(folder), folder
    finally:
        drop_table(spark, folder)


def move_in(spark: SparkSession, folder: str, path: str, replace: bool = False) -> None:
    """Move the files of a table written `beside` the one at `path` into it. With `replace` each
    folder with files takes the place of the old one; others stay as they are."""
    fs, source = filesystem(spark, folder)
    _, target = filesystem(spark, path)

    def rename(old, new) -> None:
        if not fs.rename(old, new):
            raise OSError(f"could not move {old.toString()} to {new.toString()}")

    def move(old, new) -> None:
        names = [(s, s.getPath().getName()) for s in fs.listStatus(old)]
        found = [s for s, name in names if name[0] not in "_." or "=" in name]
        folders, files = [s for s in found if s.isDirectory()], [s for s in found if s.isFile()]
        if files and not folders and new.toString() != target.toString():
            if replace:
                fs.delete(new, True)
            if not fs.exists(new):
                fs.mkdirs(new.getParent())
                return rename(old, new)
        fs.mkdirs(new)
        for status in found:
            inside = filesystem(spark, f"{new.toString()}/{status.getPath().getName()}")[1]
            (move if status.isDirectory() else rename)(status.getPath(), inside)

    move(source, target)


def write_csv_quoted(df: DataFrame, path: str) -> None:
    """CSV with a header and every field quoted."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').option("timestampNTZFormat", MICROS).csv(path))


def write_json(df: DataFrame, path: str, compressed: bool = False) -> None:
    writer = df.write.mode("overwrite").option("timestampNTZFormat", MICROS)
    (packed(writer) if compressed else writer).json(path)


def packed(writer: DataFrameWriter) -> DataFrameWriter:
    """Text files by gzip: a tenth of the bytes, each file read by one task."""
    return writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")


def ensure_table(
    spark: SparkSession, contract: TableContract, path: str, drop_first: bool = False
) -> DataFrame:
    """Create an empty table of the contract unless it exists; the table as a DataFrame."""
    if drop_first:
        drop_table(spark, path)
    if not exists(spark, path):
        spark.createDataFrame([], contract.schema).write.parquet(path)
    return spark.read.schema(contract.schema).parquet(path)


def insert_select(df: DataFrame, contract: TableContract, path: str) -> None:
    """INSERT INTO table (columns) SELECT ...: columns by name, in the types of the contract."""
    contract.conform(df).write.mode("append").parquet(path)


def _from(columns: list[str], row: Row, at_least: bool) -> Column:
    """`columns`, compared in their order, are at or beyond the values of `row`."""
    out = None
    for c in reversed(columns):
        value = F.lit(row[c])
        beyond = F.col(c) > value if at_least else F.col(c) < value
        out = beyond | (F.col(c) == value) & (F.lit(True) if out is None else out)
    return out


def _touched(existing: DataFrame, batch: DataFrame, columns: list[str]) -> DataFrame | None:
    """`existing` cut to the partitions from the least to the greatest of the batch, and to
    those with a null if the batch has one. None if the batch is empty."""
    values, missing = F.struct(*columns), reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    known = F.when(~missing, values)
    span = batch.agg(
        F.min(known).alias("low"), F.max(known).alias("high"), F.max(missing).alias("missing")
    ).first()
    if span.missing is None:
        return None
    part = F.lit(False)
    if span.low is not None:
        part = _from(columns, span.low, True) & _from(columns, span.high, False)
    return existing.where(part | missing if span.missing else part)


def append_fact(
    df: DataFrame, path: str, key: list[str], partition_by: list[str] | tuple[str, ...] = (),
    drop_first: bool = False, before: Callable[[DataFrame], None] | None = None,
    conflicts: str | None = None, stored: bool = False,
    hashed: list[str | Column] | None = None, ready: str | None = None,
) -> None:
    """Append the rows whose key is new, creating the table if needed; safe to run again.

    Rows that are alike in all columns are one row. Different rows of one key are an error, and
    nothing is appended: a key must be the key of the fact's rows. Rows with a NULL in the key
    have no key; they are compared as a whole, and of alike ones as many are stored as the batch
    or the table has, whichever has more. Partition columns must follow from the key: then only
    the partitions between the batch's first and last are read. `before` gets the batch before it
    is appended: it may refuse it by raising, or load what the batch refers to. With a path for
    `conflicts`, the different rows of one key are written there, none of them is appended, and
    the others are. The batch is read several times and therefore written first, unless it is
    `stored`: cheaply made from rows that are.

    First the hashes of the keys alone are counted. Keys whose hash occurs once and not in the
    table are new, and their rows go to the table as they are. Only rows whose hash occurs again
    are grouped and compared by the key itself. `hashed` are columns that follow from the key and
    are cheaper to read and hash. If the batch was written `beside` the table, its folder is given
    as `ready`: where no key occurs again, its files are moved in instead of being written again.
    """
    spark, hashed = df.sparkSession, hashed or key
    if drop_first:
        drop_table(spark, path)
    unknown = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    with nullcontext(df) if stored else kept(df, "batch") as batch:
        existing = None
        there = exists(spark, path)
        if there:
            existing = spark.read.schema(df.schema).parquet(path)
            if partition_by:
                existing = _touched(existing, batch, list(partition_by))
            elif batch.isEmpty():
                existing = None
        with kept(_repeated(batch, existing, unknown, hashed), "repeated") as repeated:
            known = batch.where(~unknown)
            if repeated.isEmpty():
                if ready is not None and batch.where(unknown).isEmpty():
                    if before is not None:
                        before(batch)
                    if not there or existing is not None:
                        move_in(spark, ready, path)
                    return
                rows, again = known, known.limit(0)
            else:
                marked = known.withColumn(HASH, F.xxhash64(*hashed))
                rows = marked.join(repeated, HASH, "left_anti").select(*batch.columns)
                again = marked.join(repeated, HASH, "left_semi").select(*batch.columns)
            torn = _conflicts(again, key, conflicts) if conflicts is not None else None
            if torn is not None:
                again = again.join(torn, key, "left_anti").select(*batch.columns)
            if before is not None:
                before(batch if torn is None else rows.unionByName(again).unionByName(batch.where(unknown)))
            if there and existing is None:
                return
            again, loose = _one_per_key(again, key), batch.where(unknown)
            if existing is not None:
                again = again.join(existing.where(~unknown).select(*key), key, "left_anti")
                loose = loose.exceptAll(existing.where(unknown).select(*df.columns))
            new = rows.select(*df.columns).unionByName(again.select(*df.columns)).unionByName(loose)
            try:
                write_table(new, path, partition_by, mode="append")
            except Exception as error:
                if CONFLICT in str(error):
                    raise KeyConflict(f"a key ({', '.join(key)}) has different rows in a batch") from error
                raise


def missing_in(
    rows: DataFrame, path: str, key: list[str], partition_by: list[str], batch: DataFrame,
) -> DataFrame | None:
    """The keys of `rows` that the table at `path` lacks, each once, to be appended; all if there is
    no table.

    For tables that are made of nothing but their key, which has the partition columns in it and no
    NULL. Rows and stored keys are shuffled once, by the partition columns, so that the result needs
    no gathering before it is written. `batch` is what the rows come from: only the partitions
    between its first and last are read. None if it is empty and the table is there.
    """
    spark, new = rows.sparkSession, F.lit(True).alias("_new")
    both = rows.select(*key, new)
    if exists(spark, path):
        existing = _touched(spark.read.parquet(path), batch, partition_by)
        if existing is None:
            return None
        both = both.unionByName(existing.select(*key, F.lit(False).alias("_new")))
    keys = repartition_by_columns(both, partition_by).groupBy(*key).agg(F.min("_new").alias("_new"))
    return keys.where("_new").select(*key)


CONFLICT = "different rows of one key"
HASH = "_hash"


def _repeated(batch: DataFrame, existing: DataFrame | None, unknown: Column, key: list[str]) -> DataFrame:
    """Hashes of the batch's keys that it has more than once or that the table has too."""
    hashes = batch.where(~unknown).select(F.xxhash64(*key).alias(HASH), F.lit(1).alias("_n"))
    if existing is not None:
        old = existing.where(~unknown).select(F.xxhash64(*key).alias(HASH), F.lit(0).alias("_n"))
        hashes = hashes.unionByName(old)
    counts = hashes.groupBy(HASH).agg(F.sum("_n").alias("_n"), F.count("*").alias("_all"))
    return counts.where("_n > 0 AND _all > 1").select(HASH)


def _one_per_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """The row of each key; rows of one key that differ fail the job that reads the result."""
    values = [c for c in rows.columns if c not in key]
    if not values:
        return rows.distinct()
    row = F.struct(*values)
    both = rows.groupBy(*key).agg(F.min(row).alias("_least"), F.max(row).alias("_greatest"))
    stop = F.raise_error(F.lit(CONFLICT)).cast("boolean")
    alike = F.col("_least").eqNullSafe(F.col("_greatest"))
    return both.where(F.when(alike, True).otherwise(stop)).select(*key, "_least.*")


def _conflicts(rows: DataFrame, key: list[str], path: str) -> DataFrame | None:
    """Write the rows of keys that have different rows to `path`; those keys, None if there are none."""
    values = [c for c in rows.columns if c not in key]
    if not values:
        return None
    row = F.struct(*values)
    torn = rows.groupBy(*key).agg(F.min(row).alias("_least"), F.max(row).alias("_greatest")).where(
        ~F.col("_least").eqNullSafe(F.col("_greatest"))).select(*key)
    rows.join(torn, key, "left_semi").select(*rows.columns).write.mode("overwrite").parquet(path)
    torn = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return None if torn.isEmpty() else torn.select(*key).distinct()


def load_dimension(
    df: DataFrame, path: str, truncate: bool = True, drop_first: bool = False,
    partition_by: list[str] | tuple[str, ...] = (),
) -> None:
    """Rebuild a dimension (`truncate`), or add rows to it. A rebuilt one replaces the old one
    whole, after it is written."""
    if drop_first:
        drop_table(df.sparkSession, path)
    if truncate:
        swap_in(df, path, partition_by)
    else:
        write_table(df, path, partition_by, mode="append")


def recover(spark: SparkSession, path: str) -> None:
    """Put the old table back if a run stopped between the two renames of `swap_in`."""
    fs, target = filesystem(spark, path)
    _, old_path = filesystem(spark, f"{path.rstrip('/')}__old")
    if not fs.exists(target) and fs.exists(old_path):
        fs.rename(old_path, target)


def stage_in(
    df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (),
    sort_by: list[str] | tuple[str, ...] = (), gather: bool = True,
    late: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write a new table beside the one at `path`; the new one, to be checked and published."""
    fresh = f"{path.rstrip('/')}__new"
    write_table(df, fresh, partition_by, sort_by=sort_by, gather=gather, late=late)
    return df.sparkSession.read.schema((late(df) if late else df).schema).parquet(fresh)


def publish(spark: SparkSession, path: str) -> None:
    """Rename what `stage_in` wrote to `path`; a failure leaves the old table as it was."""
    fs, target = filesystem(spark, path)
    _, fresh_path = filesystem(spark, f"{path.rstrip('/')}__new")
    _, old_path = filesystem(spark, f"{path.rstrip('/')}__old")
    fs.delete(old_path, True)
    if fs.exists(target) and not fs.rename(target, old_path):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(fresh_path, target):
        fs.rename(old_path, target)
        raise OSError(f"could not move the new table to {path}")
    fs.delete(old_path, True)


def swap_in(df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = ()) -> None:
    """Replace a table that `df` itself may read: the new table is written whole beside the old
    one and then renamed."""
    stage_in(df, path, partition_by)
    publish(df.sparkSession, path)


POLICIES = {
    "last_wins": policies.last_wins,
    "insert_ignore": policies.insert_ignore,
    "fill_zero": policies.fill_zero,
    "coalesce": policies.coalesce_newest,
}


def merge_table(
    batch: DataFrame, path: str, key: list[str], order: list[str], policy: str = "last_wins",
    **options,
) -> None:
    """Upsert a batch into a dimension by a policy of `operators.merge`.

    `insert_ignore` only adds rows, so it appends; the others replace the table.
    """
    spark = batch.sparkSession
    recover(spark, path)
    target = spark.read.parquet(path) if exists(spark, path) else None
    merged = POLICIES[policy](batch, key, order, target=target, **options)
    if policy == "insert_ignore" and target is not None:
        write_table(merged, path, mode="append")
    else:
        swap_in(merged, path)


def load_targets(source: DataFrame, targets: dict[str, tuple]) -> None:
    """Feed one input to several tables: {path: (function of the input, partition columns)}.

    The input is written once to the shared folder and removed at the end.
    """
    with kept(source, "source") as rows:
        for path, (build, partition_by) in targets.items():
            write_table(build(rows), path, partition_by)
