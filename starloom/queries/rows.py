"""Projections, filters and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.text import blank_to_null
from starloom.functions.timeparts import on_day, within_years
from starloom.operators import cleaning
from starloom.operators.tables import write_table
from starloom.queries import shapes
from starloom.queries.registry import query
from starloom.sources.files import country_codes, port_codes

DIRTY = f"WITH {shapes.DIRTY_SQL} "


@query(
    "project_rename",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority "
    "FROM orders",
)
def project_rename(t):
    names = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderpriority": "priority"}
    return cleaning.rename(t("orders"), names)


@query(
    "project_add_drop",
    "SELECT event_id, user_id, event_type, value, year(ts)::int AS year, month(ts)::int AS month "
    "FROM events",
)
def project_add_drop(t):
    return t("events").withColumns({"year": F.year("ts"), "month": F.month("ts")}).drop(
        "ts", "props"
    )


@query("filter_equals", "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_equals(t):
    return cleaning.equals(t("events"), "event_type", "purchase").select(
        "event_id", "user_id", "value"
    )


@query("filter_point_lookup", "SELECT role, text FROM conversations WHERE conv_id = 7 AND turn = 1")
def filter_point_lookup(t):
    return cleaning.lookup(t("conversations"), conv_id=7, turn=1).select("role", "text")


@query(
    "filter_blank_rows",
    DIRTY + "SELECT event_id, event_type FROM dirty WHERE trim(event_type) <> ''",
)
def filter_blank_rows(t):
    return cleaning.drop_blank(shapes.dirty_events(t), "event_type").select(
        "event_id", "event_type"
    )


@query(
    "filter_required_not_null",
    DIRTY + "SELECT event_id, event_type, value FROM dirty WHERE event_type IS NOT NULL "
    "AND value IS NOT NULL",
)
def filter_required_not_null(t):
    return cleaning.require(shapes.dirty_events(t), ["event_type", "value"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "drop_na_any",
    DIRTY + "SELECT event_id, ts, user_id, event_type, value FROM dirty "
    "WHERE event_type IS NOT NULL AND value IS NOT NULL",
)
def drop_na_any(t):
    return shapes.dirty_events(t).dropna("any")


@query(
    "drop_na_subset",
    DIRTY + "SELECT event_id, event_type, value FROM dirty WHERE event_type IS NOT NULL",
)
def drop_na_subset(t):
    return shapes.dirty_events(t).dropna(subset=["event_type"]).select(
        "event_id", "event_type", "value"
    )


@query(
    "fill_na_default",
    DIRTY + "SELECT event_id, coalesce(value, 0) AS value, event_type FROM dirty",
)
def fill_na_default(t):
    return cleaning.fill_default(shapes.dirty_events(t), {"value": 0.0}).select(
        "event_id", "value", "event_type"
    )


@query(
    "blank_to_null",
    DIRTY + "SELECT event_id, CASE WHEN trim(event_type) = '' THEN NULL ELSE event_type END "
    "AS event_type FROM dirty",
)
def blank_to_null_query(t):
    return shapes.dirty_events(t).select(
        "event_id", blank_to_null(F.col("event_type")).alias("event_type")
    )


@query(
    "filter_not_literal",
    DIRTY + "SELECT event_id, event_type FROM dirty WHERE event_type <> 'view'",
)
def filter_not_literal(t):
    return cleaning.not_literal(shapes.dirty_events(t), "event_type", "view").select(
        "event_id", "event_type"
    )


@query(
    "filter_is_null",
    DIRTY + "SELECT event_id, event_type FROM dirty WHERE event_type IS NULL",
)
def filter_is_null(t):
    return shapes.dirty_events(t).where(F.col("event_type").isNull()).select(
        "event_id", "event_type"
    )


@query(
    "filter_year_range",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
)
def filter_year_range(t):
    return t("orders").where(within_years(F.col("o_orderdate"), 1996, 1998)).select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "filter_calendar_day",
    "SELECT event_id, ts FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 21",
)
def filter_calendar_day(t):
    return t("events").where(on_day(F.col("ts"), 2024, 1, 21)).select("event_id", "ts")


@query(
    "filter_latest_interval",
    "SELECT event_id, ts FROM events WHERE ts BETWEEN (SELECT max(ts) FROM events) "
    "- INTERVAL '1 week' AND (SELECT max(ts) FROM events)",
)
def filter_latest_interval(t):
    return cleaning.latest_window(t("events"), "ts").select("event_id", "ts")


@query(
    "filter_latest_interval_folders",
    "SELECT event_id, ts FROM events WHERE ts BETWEEN (SELECT max(ts) FROM events) "
    "- INTERVAL '1 week' AND (SELECT max(ts) FROM events)",
)
def filter_latest_interval_folders(t):
    """On a table by month: the newest time is looked for in the newest folder alone."""
    path = t.folder("events-by-month")
    rows = t("events").select("event_id", "ts", F.year("ts").alias("year"), F.month("ts").alias("month"))
    write_table(rows, path, ["year", "month"])
    stored = t.spark.read.schema("event_id bigint, ts timestamp_ntz, year int, month int").parquet(path)
    return cleaning.latest_window(stored, "ts", path=path).select("event_id", "ts")


@query(
    "filter_valid_code",
    f"""WITH {shapes.PORTS_SQL}, {shapes.COUNTRIES_SQL}, {shapes.ARRIVALS_SQL}
    SELECT i94port, cast(i94cit AS int) AS i94cit, i94addr, gender FROM arrivals
    WHERE i94port IN (SELECT code FROM ports WHERE is_valid)
      AND cast(i94cit AS int) IN (SELECT code FROM countries WHERE is_valid)""",
)
def filter_valid_code(t):
    rows = shapes.arrivals(t).select(
        "i94port", F.col("i94cit").cast("int").alias("i94cit"), "i94addr", "gender"
    )
    return cleaning.valid_codes(rows, {
        "i94port": (port_codes(shapes.port_lines(t)).where("is_valid"), "code"),
        "i94cit": (country_codes(shapes.country_lines(t)).where("is_valid"), "code"),
    })


@query(
    "filter_any_column_rlike",
    DIRTY + r"""SELECT event_id, event_type, value FROM dirty
    WHERE coalesce(regexp_matches(cast(event_id AS varchar), '^\s*$'), false)
       OR coalesce(regexp_matches(event_type, '^\s*$'), false)""",
)
def filter_any_column_rlike(t):
    rows = shapes.dirty_events(t).select("event_id", "event_type", "value")
    return cleaning.any_column_rlike(rows, r"^\s*$")
