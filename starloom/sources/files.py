"""File scans. Every scan is given its schema; many small files are packed by Spark."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom.contracts import ARRIVALS, TableContract
from starloom.functions.text import split_city_state, strip_prefix

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Labels that mark a code as unusable.
INVALID_MARKERS = ("INVALID", "No Country Code", "Collapsed", "No PORT Code")


def _tree(spark: SparkSession, schema: StructType, glob: str) -> DataFrameReader:
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("timestampNTZFormat", MICROS)
    )


ARRIVAL = "_order"


def arrival_order() -> Column:
    """Where a row of a file scan stands in the order of arrival: the file's time and path, the
    block and the row. Row numbers rise within a block, and are compared in no wider range. Must
    be selected from the scan itself, or from a micro-batch whose stream selects `_metadata`."""
    file = F.col("_metadata")
    return F.struct(
        file["file_modification_time"].alias("time"), file["file_path"].alias("path"),
        file["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"),
    ).alias(ARRIVAL)


def scan_json(
    spark: SparkSession, path: str, contract: TableContract, glob: str = "*.json{,.gz}",
    arrival: bool = False,
) -> DataFrame:
    """JSON lines, or one record per file, from a directory tree; `arrival` adds the order."""
    rows = _tree(spark, contract.schema, glob).json(path)
    return rows.select("*", arrival_order()) if arrival else rows


def scan_csv(
    spark: SparkSession, path: str, contract: TableContract, sep: str = ",", glob: str = "*.csv{,.gz}"
) -> DataFrame:
    """All CSV files of a directory tree as one table; each file's header line is skipped."""
    return (
        _tree(spark, contract.schema, glob)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Give all-text columns their types; text that does not fit becomes NULL."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table from its root, which keeps the partition columns."""
    return spark.read.parquet(path)


def scan_arrivals(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Arrival records of one or more months; `path` may hold globs.

    Codes come as doubles and are made ints here, once.
    """
    reader = spark.read.schema(ARRIVALS.schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return typed_arrivals(reader.format(fmt).load(path))


def typed_arrivals(df: DataFrame) -> DataFrame:
    ints = ["i94yr", "i94mon", "i94cit", "arrdate", "i94mode", "depdate", "i94bir", "i94visa",
            "biryear"]
    return df.withColumns({c: F.col(c).cast("int") for c in ints})


def scan_for_run(
    spark: SparkSession, template: str, run_time: datetime, contract: TableContract,
    fmt: str = "json",
) -> DataFrame:
    """Read only the input of one run: `{...}` fields of the template are filled from the run
    time, e.g. "log/{run:%Y}/{run:%m}/{run:%Y-%m-%d}.json"."""
    return _scan_runs(spark, template.format(run=run_time), contract, fmt)


def scan_all_runs(
    spark: SparkSession, template: str, contract: TableContract, fmt: str = "json"
) -> DataFrame:
    """The input of all runs in one scan: the fields of the template match anything."""
    return _scan_runs(spark, re.sub(r"\{[^}]*\}", "*", template), contract, fmt)


def _scan_runs(spark: SparkSession, path: str, contract: TableContract, fmt: str) -> DataFrame:
    reader = spark.read.schema(contract.schema).option("timestampNTZFormat", MICROS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def _is_valid(label: Column) -> Column:
    return ~label.rlike(f"^(?:{'|'.join(INVALID_MARKERS)})")


# The strict line patterns of the legacy parse.
LEGACY_PORT_LINE = r"^\s+'(.+)'\s+=\s+'(.+)'\s*$"
LEGACY_COUNTRY_LINE = r"\s+(\d{3})\s+=\s+'(\w+)'"
# Any listing line: code with or without quotes, label in quotes, optional closing semicolon.
CODE_LINE = r"^\s*'?([A-Za-z0-9]+)'?\s*=\s*'(.*)'[^']*$"


def parse_codes(lines: DataFrame, pattern: str = CODE_LINE, legacy: bool = False) -> DataFrame:
    """Code listing lines (column `value`) as (code, label, is_valid); other lines are dropped.

    The label loses blanks at its ends, a leading "INVALID: " and doubled quotes.
    """
    text = F.col("value")
    raw = F.rtrim(F.regexp_extract(text, pattern, 2))
    label = raw if legacy else F.replace(F.trim(raw), F.lit("''"), F.lit("'"))
    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.where(text.rlike(pattern)).select(
        F.regexp_extract(text, pattern, 1).alias("code"), label.alias("label"), *rest
    )
    return parsed.select(
        "code",
        strip_prefix(F.col("label"), "INVALID: ").alias("label"),
        _is_valid(F.col("label")).alias("is_valid"),
        *rest,
    )


def scan_codes(
    spark: SparkSession, path: str, pattern: str = CODE_LINE, legacy: bool = False
) -> DataFrame:
    """Parse a `'CODE' = 'LABEL'` text listing into a code table."""
    return parse_codes(spark.read.text(path), pattern, legacy)


def scan_port_codes(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """Port listing: code, label, is_valid, lower-case city and state, and line order.

    With `legacy` only lines of the strict pattern are taken and every code counts as valid.
    """
    return port_codes(spark.read.text(path), legacy)


def port_codes(lines: DataFrame, legacy: bool = False) -> DataFrame:
    numbered = lines.withColumn("line_no", F.monotonically_increasing_id())
    codes = parse_codes(numbered, LEGACY_PORT_LINE if legacy else CODE_LINE, legacy)
    city, state = split_city_state(F.col("label"), legacy)
    return codes.select(
        "code",
        "label",
        (F.lit(True) if legacy else F.col("is_valid")).alias("is_valid"),
        city.alias("city"),
        state.alias("state"),
        "line_no",
    )


def scan_country_codes(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """Country listing: int code, lower-case country and is_valid."""
    return country_codes(spark.read.text(path), legacy)


def country_codes(lines: DataFrame, legacy: bool = False) -> DataFrame:
    codes = parse_codes(lines, LEGACY_COUNTRY_LINE if legacy else CODE_LINE, legacy)
    return codes.select(
        F.col("code").cast("int").alias("code"),
        F.lower("label").alias("country"),
        (F.lit(True) if legacy else F.col("is_valid")).alias("is_valid"),
    )
