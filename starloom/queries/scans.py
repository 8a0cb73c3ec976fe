"""Sources and staging loads: tables are written in a format and scanned back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.contracts import TableContract
from starloom.functions.timeparts import timestamp_to_epoch_ms
from starloom.operators.keys import monotonic_key
from starloom.operators.tables import drop_table, write_csv_quoted, write_json, write_table
from starloom.queries import shapes
from starloom.queries.registry import query
from starloom.sources import files, staging
from starloom.sources.manifest import replay

EVENTS = TableContract(
    "events",
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
)
EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query("scan_json_lines", EVENTS_SQL)
def scan_json_lines(t):
    path = t.folder("json-lines")
    write_json(t("events"), path)
    return files.scan_json(t.spark, path, EVENTS)


RECORD = TableContract(
    "record",
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, duration double, "
    "year int",
)


@query("scan_json_records", f"WITH {shapes.CATALOG_SQL} SELECT * EXCLUDE (_order) FROM catalog")
def scan_json_records(t):
    """Many small files in nested folders."""
    path = t.folder("json-records")
    nested = shapes.catalog(t).withColumn("folder", F.pmod("_order", F.lit(40))).drop("_order")
    nested.write.partitionBy("folder").json(path)
    return files.scan_json(t.spark, path, RECORD)


@query("scan_csv_union", EVENTS_SQL)
def scan_csv_union(t):
    path = t.folder("csv-union")
    write_csv_quoted(t("events").repartition(6, "event_id"), path)
    return files.scan_csv(t.spark, path, EVENTS)


PART_TYPES = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}


@query(
    "scan_csv_typed",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def scan_csv_typed(t):
    path = t.folder("csv-typed")
    part = t("part")
    part.write.option("header", True).option("sep", ";").csv(path)
    text = TableContract("part", ", ".join(f"{c} string" for c in part.columns))
    return files.typed(files.scan_csv(t.spark, path, text, sep=";"), PART_TYPES)


@query("scan_partitioned_parquet", EVENTS_SQL)
def scan_partitioned_parquet(t):
    path = t.folder("partitioned")
    write_table(t("events"), path, ["event_type"])
    return files.read_table(t.spark, path)


@query("scan_text_codes", f"WITH {shapes.PORTS_SQL} SELECT * FROM ports")
def scan_text_codes(t):
    path = t.folder("codes")
    shapes.port_lines(t).write.text(path)
    return files.scan_port_codes(t.spark, path).drop("line_no")


@query(
    "scan_arrivals",
    f"""WITH {shapes.ARRIVALS_SQL}
    SELECT cast(i94yr AS int) AS i94yr, cast(i94mon AS int) AS i94mon, cast(i94cit AS int) AS i94cit,
           i94port, cast(arrdate AS int) AS arrdate, cast(i94mode AS int) AS i94mode, i94addr,
           cast(depdate AS int) AS depdate, cast(i94bir AS int) AS i94bir,
           cast(i94visa AS int) AS i94visa, cast(biryear AS int) AS biryear, gender
    FROM arrivals""",
)
def scan_arrivals(t):
    path = t.folder("arrivals")
    rows = shapes.arrivals(t).withColumn("month", F.col("i94mon").cast("int"))
    write_table(rows, path, ["month"])
    return files.scan_arrivals(t.spark, f"{path}/month=*")


@query("scan_incremental", EVENTS_SQL)
def scan_incremental(t):
    """The input of the daily runs: all days in one scan, but for one day that its run reads."""
    path = t.folder("incremental")
    events = t("events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    (events.hint("rebalance", "day").write.partitionBy("day")
     .option("timestampNTZFormat", files.MICROS).json(path))
    first = t("events").agg(F.min("ts")).first()[0]
    template = path + "/day={run:%Y-%m-%d}"
    one = files.scan_for_run(t.spark, template, first, EVENTS)
    rest = files.scan_all_runs(t.spark, template, EVENTS)
    after = F.lit(first.strftime("%Y-%m-%d")).cast("timestamp_ntz") + F.expr("INTERVAL 1 day")
    return one.unionByName(rest.where(F.col("ts") >= after))


_DAY = "strftime(ts, '%Y-%m-%d')"


@query(
    "scan_replay",
    f"""WITH days AS (SELECT *, {_DAY} AS run, dense_rank() OVER (ORDER BY {_DAY}) AS d FROM events)
    SELECT event_id, ts, user_id, event_type, CASE WHEN d = 1 THEN value * 2 ELSE value END AS value, props, run
    FROM days WHERE d <> 3
    UNION ALL SELECT event_id + 1000000000, ts, user_id, event_type, value, props, run FROM days
    WHERE d = 2 AND event_id % 2 = 0""",
)
def scan_replay(t):
    """Daily runs of which one is written anew, one gets a late file and one is taken back."""
    root, table, manifest = t.folder("replayed"), t.folder("replayed-table"), t.folder("manifest")
    events = t("events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    (events.hint("rebalance", "day").write.partitionBy("day")
     .option("timestampNTZFormat", files.MICROS).json(root))
    replay(t.spark, root, r"/day=([^/]+)/", EVENTS, table, manifest)
    first, second, third = (r.day for r in events.select("day").distinct().orderBy("day").take(3))
    write_json(events.where(F.col("day") == first).drop("day").withColumn("value", F.col("value") * 2),
               f"{root}/day={first}")
    late = events.where((F.col("day") == second) & (F.col("event_id") % 2 == 0)).drop("day")
    write_json(late.withColumn("event_id", F.col("event_id") + 1_000_000_000), f"{root}/day={second}/late")
    drop_table(t.spark, f"{root}/day={third}")
    replay(t.spark, root, r"/day=([^/]+)/", EVENTS, table, manifest)
    return t.spark.read.schema(f"{EVENTS.columns}, run string").parquet(table)


# --- staging ---

STAGED = TableContract(
    "staged_events",
    "event_id bigint, user_id int, event_type string, value decimal(15,5), ms bigint",
    not_null=("event_id",),
    max_length={"event_type": 4},
)
STAGED_SQL = f"WITH {shapes.DIRTY_SQL} SELECT event_id, cast(user_id AS int) AS user_id, "


def _lines(t, **extra) -> DataFrame:
    """Events as JSON lines, with field names in another letter case."""
    rows = shapes.dirty_events(t).select(
        F.col("event_id").alias("Event_ID"),
        F.col("user_id").cast("string").alias("userId" if extra.get("nested") else "User_Id"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.col("value").alias("Value"),
        timestamp_to_epoch_ms(F.col("ts")).alias("MS"),
        F.struct(F.col("event_type").alias("kind")).alias("meta"),
    )
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def _written_lines(t, lines: DataFrame) -> str:
    path = t.folder("lines")
    lines.write.text(path)
    return path


def _shown(staged: DataFrame) -> DataFrame:
    return staged.withColumn("value", F.col("value").cast("double"))


PLAIN = dict(blanks_as_null=False, empty_as_null=False, truncate_columns=False)


@query(
    "stage_column_map",
    STAGED_SQL + "event_type, value, epoch_us(ts) // 1000 AS ms FROM dirty",
)
def stage_column_map(t):
    path = _written_lines(t, _lines(t))
    lines = staging.read_lines(t.spark, path, "*")
    staged = staging.stage_lines(lines, STAGED, **PLAIN)
    return _shown(staging.enforce_max_error(staged))


@query(
    "stage_column_map_paths",
    STAGED_SQL + "event_type, value, epoch_us(ts) // 1000 AS ms FROM dirty",
)
def stage_column_map_paths(t):
    """Columns from an ordered list of JSON paths, one of them nested."""
    lines = _lines(t, nested=True)
    paths = ["$.Event_ID", "$['userId']", "$.meta.kind", "$.Value", "$.MS"]
    staged = staging.stage_lines(lines, STAGED, mapping=paths, **PLAIN)
    return _shown(staging.enforce_max_error(staged))


@query(
    "stage_blanks_as_null",
    STAGED_SQL + "CASE WHEN trim(event_type) = '' THEN NULL ELSE event_type END AS event_type, "
    "value, epoch_us(ts) // 1000 AS ms FROM dirty",
)
def stage_blanks_as_null(t):
    staged = staging.stage_lines(_lines(t), STAGED, truncate_columns=False)
    return _shown(staging.enforce_max_error(staged))


@query(
    "stage_empty_as_null",
    STAGED_SQL + "nullif(event_type, '') AS event_type, value, epoch_us(ts) // 1000 AS ms "
    "FROM dirty",
)
def stage_empty_as_null(t):
    staged = staging.stage_lines(
        _lines(t), STAGED, blanks_as_null=False, truncate_columns=False
    )
    return _shown(staging.enforce_max_error(staged))


@query(
    "stage_truncate_columns",
    STAGED_SQL + "substring(CASE WHEN trim(event_type) = '' THEN NULL ELSE event_type END, 1, 4) "
    "AS event_type, value, epoch_us(ts) // 1000 AS ms FROM dirty",
)
def stage_truncate_columns(t):
    return _shown(staging.enforce_max_error(staging.stage_lines(_lines(t), STAGED)))


@query(
    "stage_max_error",
    STAGED_SQL + "event_type, value, epoch_us(ts) // 1000 AS ms FROM dirty "
    "WHERE event_id % 97 <> 5",
)
def stage_max_error(t):
    """Every 97th line is cut short and may be skipped, as the limit allows it."""
    whole = _lines(t)
    number = F.get_json_object("value", "$.Event_ID").cast("bigint")
    cut = F.expr("substring(value, 1, length(value) - 9)")
    lines = whole.select(
        F.when(F.pmod(number, F.lit(97)) == 5, cut).otherwise(F.col("value")).alias("value")
    )
    staged = staging.stage_lines(lines, STAGED, **PLAIN)
    return _shown(staging.enforce_max_error(staged, max_error=t("events").count()))


def _faulty_lines(t) -> DataFrame:
    """Lines that are cut short, lack a required value or hold one of another type."""
    n = F.col("event_id")
    rows = t("events").select(
        n.alias("N"), F.when(F.pmod(n, F.lit(89)) != 3, n).alias("Event_ID"),
        F.col("user_id").cast("string").alias("User_Id"), F.col("event_type").alias("EVENT_TYPE"),
        F.when(F.pmod(n, F.lit(83)) == 7, F.lit("x")).otherwise(F.col("value").cast("string")).alias("Value"))
    whole = F.to_json(F.struct("*"))
    cut = F.expr("substring(line, 1, length(line) - 5)")
    return rows.select("N", whole.alias("line")).select(
        F.when(F.pmod("N", F.lit(97)) == 5, cut).otherwise(F.col("line")).alias("value"))


@query(
    "stage_rejects",
    f"""SELECT event_id AS n, NULL::VARCHAR AS "column", '{staging.NOT_JSON}' AS reason FROM events WHERE event_id % 97 = 5
    UNION ALL SELECT event_id, 'event_id', '{staging.EMPTY}' FROM events WHERE event_id % 89 = 3 AND event_id % 97 <> 5
    UNION ALL SELECT event_id, 'value', '{staging.TYPE}' FROM events WHERE event_id % 83 = 7 AND event_id % 97 <> 5
    UNION ALL SELECT count(*), 'rows loaded', '' FROM events
    WHERE NOT (event_id % 97 = 5 OR event_id % 89 = 3 OR event_id % 83 = 7)""",
)
def stage_rejects(t):
    """What is wrong with each line that a load set aside, and how many rows it loaded."""
    lines = staging.read_lines(t.spark, _written_lines(t, _faulty_lines(t)), "*", arrival=True)
    path = t.folder("load")
    staging.load_lines(lines, STAGED, path, **PLAIN)
    number = F.regexp_extract("text", r'"N":(\d+)', 1).cast("bigint")
    told = staging.rejects(t.spark, path).select(number.alias("n"), "column", "reason")
    rows = staging.loaded(t.spark, path, STAGED).agg(F.count("*").alias("n"))
    return told.unionByName(rows.select("n", F.lit("rows loaded").alias("column"), F.lit("").alias("reason")))


@query(
    "stage_replace_invalid_chars",
    "SELECT doc_id, md5(source || '?' || text) AS text_md5, "
    "cast(length(source || '?' || text) AS int) AS n_chars FROM documents",
)
def stage_replace_invalid_chars(t):
    """Texts with a byte that is not UTF-8 in them."""
    raw = F.expr(
        "cast(concat(encode(source, 'UTF-8'), X'FF', encode(text, 'UTF-8')) AS string)"
    )
    fixed = t("documents").select("doc_id", staging.replace_invalid_utf8(raw, "?").alias("text"))
    return fixed.select(
        "doc_id", F.md5("text").alias("text_md5"), F.char_length("text").alias("n_chars")
    )


@query(
    "stage_identity",
    f"WITH {shapes.DIRTY_SQL} SELECT event_type, count(*) AS n_rows, count(*) AS n_ids "
    "FROM dirty GROUP BY event_type",
)
def stage_identity(t):
    """A sequence on staged rows; its values differ from run to run, so they are counted."""
    staged = staging.enforce_max_error(staging.stage_lines(_lines(t), STAGED, **PLAIN))
    numbered = monotonic_key(staged, "staged_id")
    return numbered.groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.count_distinct("staged_id").alias("n_ids")
    )
