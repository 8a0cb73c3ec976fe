"""Data-quality checks. Each returns rows (check_name, violations); 0 violations is a pass.

All row-level checks of a table are conditional counts in one aggregate, so a table is scanned
once however many checks it has. Keys are counted before they are shuffled or joined, so a hot
key costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.contracts import TableContract
from starloom.operators.snapshots import unknown_keys


class QualityError(Exception):
    """A check did not pass."""


def _one_pass(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One aggregate over `df`, turned into one row per check."""
    if not counts:
        return df.sparkSession.createDataFrame([], "check_name string, violations bigint")
    names = list(counts)
    wide = df.agg(*[F.coalesce(counts[n], F.lit(0)).cast("bigint").alias(f"_c{i}")
                    for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_c{i}").alias("violations"))
                      for i, n in enumerate(names)])
    return wide.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULLs per column."""
    names = df.columns if columns is None else columns
    return _one_pass(df, {f"null:{c}": F.count_if(F.col(c).isNull()) for c in names})


def not_null(df: DataFrame, contract: TableContract) -> DataFrame:
    counts = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in contract.not_null}
    return _one_pass(df, counts)


def _range_counts(contract: TableContract) -> dict[str, Column]:
    # A predicate that is NULL does not violate a CHECK.
    return {f"check:{n}": F.count_if(~F.expr(p)) for n, p in contract.checks.items()}


def check_ranges(df: DataFrame, contract: TableContract) -> DataFrame:
    return _one_pass(df, _range_counts(contract))


def max_lengths(df: DataFrame, contract: TableContract) -> DataFrame:
    """Values longer than declared, counted before any truncation."""
    return _one_pass(df, {
        f"max_length:{c}": F.count_if(F.char_length(c) > n)
        for c, n in contract.max_length.items()
    })


def row_checks(df: DataFrame, contract: TableContract) -> DataFrame:
    """NOT NULL, CHECK and length checks of a contract in one pass."""
    counts = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in contract.not_null}
    counts |= _range_counts(contract)
    counts |= {f"max_length:{c}": F.count_if(F.char_length(c) > n)
               for c, n in contract.max_length.items()}
    return _one_pass(df, counts)


def has_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One violation per empty table; reads no more than one row of each."""
    parts = [
        df.limit(1).agg((F.lit(1) - F.count("*")).cast("bigint").alias("violations"))
        .select(F.lit(f"has_rows:{name}").alias("check_name"), "violations")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def required_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Differences from the required names and order; empty if they agree."""
    found = df.columns
    problems = []
    if len(found) != len(names):
        problems.append(f"{len(found)} columns, {len(names)} required")
    problems += [
        f"column {i} is {have!r}, {want!r} required"
        for i, (have, want) in enumerate(zip(found, names)) if have != want
    ]
    return problems


def primary_key(df: DataFrame, key: list[str], name: str = "primary_key") -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(f"{name}:{','.join(key)}").alias("check_name"), "violations"
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null value is missing in the parent."""
    known = parent.select(F.col(parent_column).alias("_parent"))
    present = child.where(F.col(column).isNotNull())
    return present.join(known, present[column] == known["_parent"], "left_anti")


def foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str = "foreign_key"
) -> DataFrame:
    """Number of orphan rows.

    Child rows are counted per value first. An outer join keeps it that way: an anti join would
    be moved below the aggregate, to all the rows of the child. A value that the parent has several
    times is found several times, which an orphan is not, so the parent is taken as it is.
    """
    counts = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(
        F.count("*").alias("_n")
    )
    known = parent.select(F.col(parent_column).alias("_value"))
    lost = counts.join(known.withColumn("_found", F.lit(True)), "_value", "left").where(
        "_found IS NULL"
    )
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(f"{name}:{column}").alias("check_name"), "violations"
    )


def foreign_key_in_buckets(
    child: DataFrame, column: str, path: str, parent_column: str, name: str = "foreign_key"
) -> DataFrame:
    """Number of distinct orphan values, against a table in hash buckets of its key.

    Only the buckets of the child's values are read, and only their key column.
    """
    lost = unknown_keys(child, [column], path, [parent_column])
    return lost.agg(F.count("*").alias("violations")).select(
        F.lit(f"{name}:{column}").alias("check_name"), "violations")


def wrong_cardinality(df: DataFrame, group: list[str], expected: int) -> DataFrame:
    """Groups that do not hold exactly `expected` rows."""
    counts = df.groupBy(*group).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") != expected)


def group_cardinality(df: DataFrame, group: list[str], expected: int) -> DataFrame:
    return wrong_cardinality(df, group, expected).agg(
        F.count("*").alias("violations")
    ).select(F.lit(f"rows_per_group:{','.join(group)}").alias("check_name"), "violations")


def contract_report(
    df: DataFrame, contract: TableContract, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """All checks of a contract; foreign keys into `tables`, where given."""
    report = row_checks(df, contract)
    if contract.primary_key:
        report = report.unionByName(primary_key(df, list(contract.primary_key)))
    for column, (table, parent_column) in contract.foreign_keys.items():
        if tables and table in tables:
            report = report.unionByName(foreign_key(df, column, tables[table], parent_column))
    return report


@dataclass(frozen=True)
class Expectation:
    """A query whose first value must equal `expected`, or not exceed `at_most`."""

    check_name: str
    sql: str
    expected: object = None
    at_most: float | None = None


def expect(spark: SparkSession, checks: list[Expectation]) -> DataFrame:
    """Run each query and report (check_name, expected, actual, passed). No result fails."""
    rows = []
    for check in checks:
        first = spark.sql(check.sql).first()
        actual = None if first is None or len(first) == 0 else first[0]
        if first is None or actual is None:
            passed = False
        elif check.at_most is not None:
            passed = actual <= check.at_most
        else:
            passed = actual == check.expected
        wanted = f"<= {check.at_most}" if check.at_most is not None else str(check.expected)
        rows.append((check.check_name, wanted, None if actual is None else str(actual), passed))
    return spark.createDataFrame(
        rows, "check_name string, expected string, actual string, passed boolean"
    )


def assert_quality(report: DataFrame, allowed: dict[str, int] | None = None) -> None:
    """Raise QualityError for checks above their allowed number of violations (default 0)."""
    allowed = allowed or {}
    if "passed" in report.columns:
        failed = [r.asDict() for r in report.where(~F.col("passed")).collect()]
    else:
        rows = report.where("violations > 0").collect()
        failed = [r.asDict() for r in rows if r.violations > allowed.get(r.check_name, 0)]
    if failed:
        raise QualityError(f"{len(failed)} checks failed: {failed}")
