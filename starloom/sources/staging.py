"""Bulk load of JSON lines into a typed staging table, with load options.

One JSON parse per line yields all fields as text; they are mapped to the columns of a
contract, cleaned, cut and cast. A line is bad if it is not JSON, if a value does not fit its
type, or if a NOT NULL column is empty. `load_lines` stores good lines and bad ones, with what is
wrong with them, in one read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType, StructType

from starloom.contracts import TableContract
from starloom.functions.numbers import fit_decimal
from starloom.functions.text import blank_to_null, empty_to_null, truncate
from starloom.operators.tables import drop_table, exists
from starloom.session import written
from starloom.sources.files import ARRIVAL, arrival_order

BAD = "_bad"
# Number of a line. A filter that uses it stays above the parse: without it the optimizer would
# move the check for bad lines below, and every line would be parsed twice.
LINE = "_line"
# A bad line itself, and what is wrong with it: (column, reason) for each fault.
RAW, ERRORS = "_raw", "_errors"
NOT_JSON, EMPTY, TYPE = "not a JSON record", "empty, but required", "does not fit the type"


def replace_invalid_utf8(text: Column, substitute: str = "�") -> Column:
    """Valid UTF-8 text, each broken byte sequence replaced by a substitute."""
    fixed = F.make_valid_utf8(text)
    if substitute != "�":
        fixed = F.when(F.is_valid_utf8(text), text).otherwise(
            F.replace(fixed, F.lit("�"), F.lit(substitute))
        )
    return fixed


def read_lines(
    spark: SparkSession, path: str, glob: str = "*.json{,.gz}", arrival: bool = False
) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    return lines.select("value", arrival_order()) if arrival else lines


CORRUPT = "_corrupt"


def _simple_name(path: str) -> str | None:
    """The field of a top-level JSON path, or None for a deeper one."""
    found = re.fullmatch(r"\$(?:\.(\w+)|\['(\w+)'\])", path)
    return (found[1] or found[2]) if found else None


def _raw_fields(
    lines: DataFrame, names: list[str], mapping: str | list[str], extra: list[str]
) -> DataFrame:
    """All fields of each line as text, under the column names, and whether it was JSON.

    Known field names are parsed straight into a struct. Names in any letter case need a map of
    the whole record, which costs more.
    """
    line = F.col("value")
    if mapping == "auto":
        keyed = F.transform_keys(F.from_json(line, "map<string,string>"), lambda k, _: F.lower(k))
        return lines.select(keyed.alias("f"), *extra).select(
            F.col("f").isNull().alias("_not_json"), *extra,
            *[F.try_element_at("f", F.lit(n.lower())).alias(n) for n in names],
        )
    paths = [f"$.{n}" for n in names] if mapping == "exact" else list(mapping)
    if len(paths) != len(names):
        raise ValueError("one JSON path per column is needed")
    fields = {p: _simple_name(p) for p in paths}
    known = sorted({f for f in fields.values() if f})
    schema = ", ".join(f"`{f}` string" for f in [*known, CORRUPT])
    parsed = F.from_json(line, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return lines.select(line, parsed.alias("f"), *extra).select(
        F.col(f"f.{CORRUPT}").isNotNull().alias("_not_json"), *extra,
        *[(F.col(f"f.{fields[p]}") if fields[p] else F.get_json_object(line, p)).alias(n)
          for n, p in zip(names, paths)],
    )


def _fit(text: Column, kind: DataType, decimal_mode: str) -> Column:
    if isinstance(kind, DecimalType):
        return fit_decimal(text, kind.scale, decimal_mode, kind.precision)
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, IntegralType):
        # Whole numbers may be written as 1.5E12 or 338.0. A text with a point is no plain integer,
        # and a try_cast that fails makes an exception, which costs more than the rest of the line.
        number = text.try_cast("decimal(38,6)").try_cast(kind)
        return F.when(F.contains(text, F.lit(".")), number).otherwise(F.coalesce(text.try_cast(kind), number))
    return text.try_cast(kind)


def stage_lines(
    lines: DataFrame,
    contract: TableContract,
    *,
    mapping: str | list[str] = "auto",
    blanks_as_null: bool = True,
    empty_as_null: bool = True,
    truncate_columns: bool = True,
    length_unit: str = "chars",
    replace_invalid: str | None = "�",
    decimal_mode: str = "truncate",
    reasons: bool = False,
) -> DataFrame:
    """Columns of the contract plus `_bad` and `_line`, from text lines (column `value`).

    `mapping` is "auto" (by name, in any letter case), "exact" (by name) or a list of JSON paths
    in column order. Each step is its own projection, so no value is computed twice. Lines
    without a character other than blanks are no lines. The order of arrival is kept, if given.
    With `reasons`, `_errors` tells what is wrong with a bad line and `_raw` is that line.
    """
    extra = [ARRIVAL] if ARRIVAL in lines.columns else []
    kept_columns, extra = extra, extra + [RAW] * reasons
    # Trimmed on the left, a line with anything else is not read to its end.
    lines = lines.where(F.ltrim("value", F.lit(" \t\r")) != "")
    if replace_invalid is not None:
        fixed = replace_invalid_utf8(F.col("value"), replace_invalid).alias("value")
        lines = lines.select(fixed, *kept_columns)
    if reasons:
        lines = lines.withColumn(RAW, F.col("value"))
    fields = list(contract.schema)
    clean = blank_to_null if blanks_as_null else empty_to_null if empty_as_null else None
    rows = _raw_fields(lines, [f.name for f in fields], mapping, extra)
    if clean is not None:
        rows = rows.select("_not_json", *extra, *[clean(F.col(f.name)).alias(f.name) for f in fields])
    texts = {f.name: f"_text_{f.name}" for f in fields if not isinstance(f.dataType, StringType)}
    fitted = []
    for f in fields:
        value = _fit(F.col(f.name), f.dataType, decimal_mode)
        if truncate_columns and f.name in contract.max_length:
            value = truncate(value, contract.max_length[f.name], length_unit)
        fitted.append(value.alias(f.name))
    rows = rows.select("_not_json", *extra, *fitted, *[F.col(n).alias(t) for n, t in texts.items()])
    bad = F.col("_not_json")
    for f in fields:
        if f.name in contract.not_null:
            bad = bad | F.col(f.name).isNull()
        elif f.name in texts:
            bad = bad | (F.col(texts[f.name]).isNotNull() & F.col(f.name).isNull())
    bad = F.coalesce(bad, F.lit(False))
    told = [_errors(fields, contract, texts, bad), F.when(bad, F.col(RAW)).alias(RAW)] if reasons else []
    return rows.select(
        *[f.name for f in fields],
        *kept_columns,
        *told,
        bad.alias(BAD),
        F.monotonically_increasing_id().alias(LINE),
    )


def _errors(fields: list, contract: TableContract, texts: dict[str, str], bad: Column) -> Column:
    """The faults of a line; of one that is not JSON only that."""
    def fault(column: str | None, reason: str) -> Column:
        return F.struct(F.lit(column).cast("string").alias("column"), F.lit(reason).alias("reason"))

    found = []
    for f in fields:
        unfit = F.col(texts[f.name]).isNotNull() & F.col(f.name).isNull() if f.name in texts else F.lit(False)
        if f.name in contract.not_null:
            found.append(F.when(unfit, fault(f.name, TYPE)).when(F.col(f.name).isNull(), fault(f.name, EMPTY)))
        elif f.name in texts:
            found.append(F.when(unfit, fault(f.name, TYPE)))
    each = F.array_compact(F.array(*found)) if found else F.array(fault(None, NOT_JSON))
    return F.when(bad, F.when(F.col("_not_json"), F.array(fault(None, NOT_JSON))).otherwise(each)).alias(ERRORS)


class TooManyErrors(ValueError):
    """A load has more bad lines than it may have."""


def load_lines(
    lines: DataFrame, contract: TableContract, path: str, max_error: int | None = None, **options
) -> tuple[int, int]:
    """Stage lines into a new table and its rejects; (rows loaded, lines set aside).

    One read parses, counts and writes: good rows under `path/_bad=false`, bad lines under
    `path/_bad=true`. With more than `max_error` bad lines the load fails; the rejects stay to be
    looked at, and nothing is loaded. Options as for `stage_lines`.
    """
    spark = lines.sparkSession
    seen = Observation("load")
    staged = stage_lines(lines, contract, reasons=True, **options).observe(
        seen, F.count("*").alias("lines"), F.coalesce(F.count_if(BAD), F.lit(0)).alias("bad"))
    staged.write.partitionBy(BAD).parquet(path)
    counts = seen.get
    if max_error is not None and counts["bad"] > max_error:
        drop_table(spark, f"{path}/{BAD}=false")
        raise TooManyErrors(f"{counts['bad']} lines could not be loaded, {max_error} may")
    return counts["lines"] - counts["bad"], counts["bad"]


def _part(spark: SparkSession, path: str, bad: bool, schema: StructType) -> DataFrame:
    folder = f"{path}/{BAD}={str(bad).lower()}"
    return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)


def loaded(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """The rows of a load."""
    return _part(spark, path, False, contract.schema)


REJECTS = (
    f"{ARRIVAL} struct<time: timestamp, path: string, block: bigint, row: bigint>, "
    f"{ERRORS} array<struct<column: string, reason: string>>, {RAW} string, {LINE} bigint")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, column, reason, text): one row for each fault of a line.

    `line` rises from line to line of a block. File and block are null unless the lines were read
    with their order of arrival; `column` is null for a line that is not JSON.
    """
    rows = _part(spark, path, True, StructType.fromDDL(REJECTS))
    return rows.select(
        F.col(f"{ARRIVAL}.path").alias("file"), F.col(f"{ARRIVAL}.block").alias("block"),
        F.coalesce(f"{ARRIVAL}.row", LINE).alias("line"), F.explode(ERRORS).alias("e"),
        F.col(RAW).alias("text"),
    ).select("file", "block", "line", "e.column", "e.reason", "text")


def enforce_max_error(staged: DataFrame, max_error: int = 0) -> DataFrame:
    """Drop `_bad` rows, failing if there are more than `max_error`.

    At 0 the check is part of the scan itself and costs no extra pass. Above 0 the rows are
    written once, so that what is counted is what is loaded.
    """
    if max_error == 0:
        stop = F.raise_error(F.lit("a line could not be loaded and max_error is 0"))
        kept = staged.where(F.when(F.col(BAD), stop.cast("boolean")).otherwise(F.col(LINE) >= 0))
    else:
        staged = written(staged, "staged")
        found = staged.where(BAD).limit(max_error + 1).count()
        if found > max_error:
            raise ValueError(f"more than {max_error} lines could not be loaded")
        kept = staged.where(~F.col(BAD) & (F.col(LINE) >= 0))
    return kept.drop(BAD, LINE)


def stage_json(
    spark: SparkSession, path: str, contract: TableContract, *, max_error: int = 0,
    arrival: bool = False, **options
) -> DataFrame:
    """Staging load of every JSON file under `path`; options as for `stage_lines`."""
    lines = read_lines(spark, path, arrival=arrival)
    return enforce_max_error(stage_lines(lines, contract, **options), max_error)
