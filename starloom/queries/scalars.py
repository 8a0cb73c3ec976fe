"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import codes, numbers, text, timeparts
from starloom.queries import shapes
from starloom.queries.registry import query

DIRTY = f"WITH {shapes.DIRTY_SQL} "


def _epochs(t):
    return t("events").select(
        "event_id", timeparts.timestamp_to_epoch_ms(F.col("ts")).alias("ms")
    )


@query(
    "fn_epoch_ms_to_timestamp",
    "SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS start_time FROM events",
)
def fn_epoch_ms_to_timestamp(t):
    return _epochs(t).select(
        "event_id", timeparts.epoch_ms_to_timestamp(F.col("ms")).alias("start_time")
    )


@query(
    "fn_epoch_ms_to_seconds_ts",
    "SELECT event_id, date_trunc('second', ts) AS start_time FROM events",
)
def fn_epoch_ms_to_seconds_ts(t):
    return _epochs(t).select(
        "event_id", timeparts.epoch_ms_to_seconds(F.col("ms")).alias("start_time")
    )


@query(
    "fn_epoch_to_string",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time FROM events",
)
def fn_epoch_to_string(t):
    return _epochs(t).select(
        "event_id", timeparts.epoch_ms_to_text(F.col("ms")).alias("start_time")
    )


PARTS = (
    "hour({c})::int AS hour, day({c})::int AS day, week({c})::int AS week, "
    "month({c})::int AS month, year({c})::int AS year"
)


@query(
    "fn_calendar_parts",
    f"SELECT o_orderkey, {PARTS.format(c='o_orderdate')}, dayofweek(o_orderdate)::int AS weekday "
    "FROM orders",
)
def fn_calendar_parts(t):
    return t("orders").select("o_orderkey", *timeparts.calendar_parts(F.col("o_orderdate")))


@query(
    "fn_weekday_mon0",
    "SELECT o_orderkey, (isodow(o_orderdate) - 1)::int AS weekday FROM orders",
)
def fn_weekday_mon0(t):
    return t("orders").select(
        "o_orderkey", timeparts.weekday_mon0(F.col("o_orderdate")).alias("weekday")
    )


@query(
    "fn_weekday_sun0",
    "SELECT o_orderkey, dayofweek(o_orderdate)::int AS weekday, "
    "cast(dayofweek(o_orderdate) AS varchar) AS weekday_text FROM orders",
)
def fn_weekday_sun0(t):
    day = F.col("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        timeparts.weekday_sun0(day).alias("weekday"),
        timeparts.weekday_sun0(day, as_text=True).alias("weekday_text"),
    )


@query(
    "fn_sas_date",
    f"""WITH {shapes.ARRIVALS_SQL}
    SELECT i94port, strftime(date '1960-01-01' + cast(arrdate AS int), '%Y-%m-%d') AS arr_date,
           strftime(date '1960-01-01' + cast(depdate AS int), '%Y-%m-%d') AS dep_date
    FROM arrivals""",
)
def fn_sas_date(t):
    return shapes.arrivals(t).select(
        "i94port",
        timeparts.sas_date_text(F.col("arrdate")).alias("arr_date"),
        timeparts.sas_date_text(F.col("depdate")).alias("dep_date"),
    )


@query(
    "fn_month_year_of_date",
    "SELECT o_orderkey, month(o_orderdate)::int AS month, year(o_orderdate)::int AS year "
    "FROM orders",
)
def fn_month_year_of_date(t):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    dates = t("orders").select("o_orderkey", timeparts.parse_date(iso).alias("d"))
    return dates.select("o_orderkey", F.month("d").alias("month"), F.year("d").alias("year"))


@query(
    "fn_cast_timestamp",
    "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN date_trunc('second', ts) END AS ts, "
    "CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events",
)
def fn_cast_timestamp(t):
    """Texts to times; every ninth is no time and becomes NULL."""
    written = F.when(
        F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.lit("not a time"))
    rows = t("events").select("event_id", written.alias("text"))
    return rows.select(
        "event_id",
        timeparts.parse_timestamp(F.col("text")).alias("ts"),
        timeparts.parse_date(F.col("text")).cast("string").alias("day"),
    )


@query(
    "fn_cast_numeric",
    "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN user_id::int END AS as_int, "
    "CASE WHEN event_id % 8 <> 0 THEN value END AS as_double, "
    "CASE WHEN event_id % 8 <> 0 THEN cast(cast(value AS decimal(15,5)) AS double) END "
    "AS as_decimal FROM events",
)
def fn_cast_numeric(t):
    rows = t("events").select(
        "event_id",
        F.when(F.col("event_id") % 9 != 0, F.col("user_id").cast("string"))
        .otherwise("n/a").alias("whole"),
        F.when(F.col("event_id") % 8 != 0, F.col("value").cast("string"))
        .otherwise("").alias("number"),
    )
    return rows.select(
        "event_id",
        numbers.to_int(F.col("whole")).alias("as_int"),
        numbers.to_double(F.col("number")).alias("as_double"),
        numbers.to_decimal(F.col("number")).cast("double").alias("as_decimal"),
    )


@query(
    "fn_interval_arithmetic",
    "SELECT event_id, ts - INTERVAL '1 week' AS week_before, "
    "ts + to_seconds(user_id) AS seconds_after FROM events",
)
def fn_interval_arithmetic(t):
    ts = F.col("ts")
    return t("events").select(
        "event_id",
        timeparts.shift(ts, "WEEK", -1).alias("week_before"),
        timeparts.shift(ts, "SECOND", F.col("user_id")).alias("seconds_after"),
    )


@query(
    "fn_round_decimal",
    "SELECT p_partkey, cast(cast(p_retailprice + 0.000004::double AS decimal(18,5)) AS double) "
    "AS at5, cast(cast(p_retailprice AS decimal(18,0)) AS double) AS rounded, "
    "trunc(p_retailprice) AS cut FROM part",
)
def fn_round_decimal(t):
    price = F.col("p_retailprice")
    return t("part").select(
        "p_partkey",
        numbers.fit_decimal(price + F.lit(0.000004), 5).cast("double").alias("at5"),
        numbers.fit_decimal(price, 0).cast("double").alias("rounded"),
        numbers.fit_decimal(price, 0, "truncate").cast("double").alias("cut"),
    )


@query(
    "fn_coalesce",
    DIRTY + "SELECT event_id, coalesce(value, user_id::double) AS v FROM dirty",
)
def fn_coalesce(t):
    """A NaN counts as missing, so it is made NULL first."""
    value = numbers.nan_to_null(F.coalesce("value", F.lit(float("nan"))))
    return shapes.dirty_events(t).select(
        "event_id", F.coalesce(value, F.col("user_id").cast("double")).alias("v")
    )


@query(
    "fn_conditional",
    "SELECT event_id, CASE WHEN value >= 50 THEN 'high' WHEN value >= 10 THEN 'middle' "
    "ELSE 'low' END AS band FROM events",
)
def fn_conditional(t):
    value = F.col("value")
    band = F.when(value >= 50, "high").when(value >= 10, "middle").otherwise("low")
    return t("events").select("event_id", band.alias("band"))


CONCAT_SQL = "user_id || strftime(ts, '%Y-%m-%d %H:%M:%S')"


@query("fn_concat", f"SELECT event_id, {CONCAT_SQL} AS joined FROM events")
def fn_concat(t):
    joined = F.concat(text.as_text(F.col("user_id")), text.as_text(F.col("ts"), "timestamp"))
    return t("events").select("event_id", joined.alias("joined"))


@query("fn_md5", "SELECT doc_id, md5(text) AS digest FROM documents")
def fn_md5(t):
    return t("documents").select("doc_id", F.md5("text").alias("digest"))


@query(
    "fn_regex_extract",
    "SELECT event_id, cast(json_extract_string(props, '$.k') AS int) AS k, "
    "regexp_matches(event_type, '^c.*k$') AS is_click FROM events",
)
def fn_regex_extract(t):
    return t("events").select(
        "event_id",
        F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int").alias("k"),
        F.col("event_type").rlike("^c.*k$").alias("is_click"),
    )


@query(
    "fn_split_city_state",
    "SELECT c_custkey, 'customer#' || lpad(c_custkey::varchar, 9, '0') || ' town' AS city, "
    "substring('abcdefghijklmnopqrstuvwxyzabcd', c_nationkey + 1, 2) AS state FROM customer",
)
def fn_split_city_state(t):
    """Labels with ", ", with "," and with a blank before the state."""
    state = F.expr("substring('ABCDEFGHIJKLMNOPQRSTUVWXYZABCD', c_nationkey + 1, 2)")
    kind = F.col("c_custkey") % 3
    glue = F.when(kind == 0, ", ").when(kind == 1, ",").otherwise(" ")
    label = F.concat(F.col("c_name"), F.lit(" TOWN"), glue, state, F.lit("    "))
    city, short = text.split_city_state(F.col("label"))
    return t("customer").select("c_custkey", label.alias("label")).select(
        "c_custkey", city.alias("city"), short.alias("state")
    )


@query(
    "fn_case_normalise",
    "SELECT p_partkey, lower(p_type) AS lowered, array_to_string(list_transform("
    "string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS titled FROM part",
)
def fn_case_normalise(t):
    return t("part").select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        text.title_case(F.col("p_name")).alias("titled"),
    )


@query("fn_trim", "SELECT c_custkey, c_name AS label FROM customer")
def fn_trim(t):
    padded = F.concat("c_name", F.repeat(F.lit(" "), (F.col("c_custkey") % 5).cast("int")))
    return t("customer").select("c_custkey", F.rtrim(padded).alias("label"))


@query(
    "fn_strip_prefix",
    "SELECT c_custkey, c_name AS label, c_custkey % 4 <> 1 AS is_valid FROM customer",
)
def fn_strip_prefix(t):
    marked = F.when(
        F.col("c_custkey") % 4 == 1, F.concat(F.lit("INVALID: "), "c_name")
    ).otherwise(F.col("c_name"))
    rows = t("customer").select("c_custkey", marked.alias("raw"))
    return rows.select(
        "c_custkey",
        text.strip_prefix(F.col("raw"), "INVALID: ").alias("label"),
        (~F.startswith("raw", F.lit("INVALID"))).alias("is_valid"),
    )


@query(
    "fn_code_label",
    f"""WITH {shapes.ARRIVALS_SQL}
    SELECT i94port, CASE cast(i94mode AS int) WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' ELSE 'Land' END
             AS mode,
           CASE cast(i94visa AS int) WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure'
             ELSE 'Student' END AS visa,
           CASE WHEN i94addr IN ('AL', 'AK') THEN i94addr ELSE '99' END AS state
    FROM arrivals""",
)
def fn_code_label(t):
    addr = F.when(F.col("i94addr").isin("AL", "AK"), F.col("i94addr")).otherwise("??")
    return shapes.arrivals(t).select(
        "i94port",
        codes.code_label(F.col("i94mode").cast("int"), codes.ARRIVAL_MODES).alias("mode"),
        codes.code_label(F.col("i94visa").cast("int"), codes.VISA_CATEGORIES).alias("visa"),
        codes.state_code(addr).alias("state"),
    )
