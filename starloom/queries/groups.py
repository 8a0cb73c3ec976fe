"""Aggregates, distinct, merge policies, keys, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import aggregates, keys, layout, merge
from starloom.operators.identity import append_numbered
from starloom.operators.snapshots import read_snapshot
from starloom.plans.plays import plays_of
from starloom.queries import shapes
from starloom.queries.registry import query

DIRTY = f"WITH {shapes.DIRTY_SQL} "


@query(
    "agg_count_by_group",
    DIRTY + "SELECT user_id, count(event_type) AS n FROM dirty GROUP BY user_id",
)
def agg_count_by_group(t):
    return aggregates.count_by_group(shapes.dirty_events(t), ["user_id"], "event_type")


@query("agg_count_global", f"WITH {shapes.PLAYS_SQL} SELECT count(*) AS n FROM plays")
def agg_count_global(t):
    return plays_of(shapes.play_log(t)).agg(F.count("*").alias("n"))


@query(
    "agg_count_distinct",
    f"WITH {shapes.CATALOG_SQL} SELECT year, count(DISTINCT title) AS titles FROM catalog "
    "GROUP BY year",
)
def agg_count_distinct(t):
    return shapes.catalog(t).groupBy("year").agg(F.count_distinct("title").alias("titles"))


def _city_months(t):
    orders, customer = t("orders"), t("customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "c_nationkey", F.month("o_orderdate").alias("month"), "o_orderdate", "o_totalprice"
    )


CITY_MONTHS = """WITH c AS (SELECT c_nationkey, month(o_orderdate)::int AS month, o_orderdate
                            FROM orders JOIN customer ON o_custkey = c_custkey) """


@query(
    "agg_max_by_group",
    CITY_MONTHS + "SELECT c_nationkey, month, max(o_orderdate) AS latest FROM c GROUP BY ALL",
)
def agg_max_by_group(t):
    return _city_months(t).groupBy("c_nationkey", "month").agg(
        F.max("o_orderdate").alias("latest")
    )


@query(
    "agg_nested_min_of_max",
    CITY_MONTHS + "SELECT min(latest) AS first_latest FROM "
    "(SELECT max(o_orderdate) AS latest FROM c GROUP BY c_nationkey)",
)
def agg_nested_min_of_max(t):
    latest = _city_months(t).groupBy("c_nationkey").agg(F.max("o_orderdate").alias("latest"))
    return latest.agg(F.min("latest").alias("first_latest"))


@query(
    "agg_global_min_max",
    "SELECT min(ts) AS first_ts, max(ts) AS last_ts, min(day(ts))::int AS first_day, "
    "max(day(ts))::int AS last_day FROM events",
)
def agg_global_min_max(t):
    day = F.dayofmonth("ts")
    return t("events").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
    )


@query(
    "agg_avg_median",
    "SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean, "
    "round(median(o_totalprice), 6) AS median FROM orders GROUP BY o_orderpriority",
)
def agg_avg_median(t):
    orders = t("orders").select("o_orderpriority", "o_totalprice")
    means = orders.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 6).alias("mean"))
    medians = aggregates.median_by_group(orders, ["o_orderpriority"], "o_totalprice")
    return means.join(medians, "o_orderpriority").withColumn("median", F.round("median", 6))


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t):
    return t("lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


# --- merge policies: the first half of the events is the stored table, the second the batch ---

_YEAR = "cast(case when event_id % 3 = 0 then 0 else event_id % 50 end as int)"
_NAME = "('name ' || (event_id % 10))"
_PLACE = "case when event_id % 4 = 0 then '  ' when event_id % 6 = 1 then null " \
         "else event_type end"
_LATITUDE = "case when event_id % 5 < 3 then null else value end"


def _halves(t, *exprs):
    rows = t("events").selectExpr("user_id", "event_id", *exprs)
    half = rows.count() // 2
    return rows.where(F.col("event_id") < half), rows.where(F.col("event_id") >= half)


@query(
    "merge_insert_ignore",
    "SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_min(ts, event_id) AS ts "
    "FROM events GROUP BY user_id",
)
def merge_insert_ignore(t):
    stored, batch = _halves(t, "event_type", "ts")
    target = merge.insert_ignore(stored, ["user_id"], ["event_id"])
    new = merge.insert_ignore(batch, ["user_id"], ["event_id"], target)
    return target.unionByName(new)


@query(
    "merge_last_wins",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) "
    "AS value FROM events GROUP BY user_id",
)
def merge_last_wins(t):
    stored, batch = _halves(t, "event_type", "value")
    target = merge.last_wins(stored, ["user_id"], ["event_id"])
    return merge.last_wins(batch, ["user_id"], ["event_id"], target)


@query(
    "merge_fill_zero",
    f"""WITH e AS (SELECT user_id, event_id, event_type AS title, {_YEAR} AS year FROM events)
    SELECT user_id, arg_min(title, event_id) AS title,
           CASE WHEN arg_min(year, event_id) = 0
                THEN coalesce(arg_min(year, event_id) FILTER (WHERE year > 0), 0)
                ELSE arg_min(year, event_id) END AS year
    FROM e GROUP BY user_id""",
)
def merge_fill_zero(t):
    stored, batch = _halves(t, "event_type AS title", f"{_YEAR} AS year")
    target = merge.fill_zero(stored, ["user_id"], ["event_id"])
    return merge.fill_zero(batch, ["user_id"], ["event_id"], target=target)


@query(
    "merge_coalesce",
    f"""WITH e AS (SELECT user_id, event_id, {_NAME} AS name, {_PLACE} AS place,
                          {_LATITUDE} AS latitude FROM events)
    SELECT user_id, arg_min(name, event_id) AS name,
           arg_max(place, event_id) FILTER (WHERE trim(place) <> '') AS place,
           arg_max(latitude, event_id) FILTER (WHERE latitude IS NOT NULL) AS latitude
    FROM e GROUP BY user_id""",
)
def merge_coalesce(t):
    stored, batch = _halves(
        t, f"{_NAME} AS name", f"{_PLACE} AS place", f"{_LATITUDE} AS latitude"
    )
    target = merge.coalesce_newest(stored, ["user_id"], ["event_id"], ["name"])
    return merge.coalesce_newest(batch, ["user_id"], ["event_id"], ["name"], target)


# --- surrogate keys ---

@query(
    "window_row_number_desc",
    "SELECT event_id, ts, row_number() OVER (ORDER BY ts DESC, event_id) AS row_number FROM events",
)
def window_row_number_desc(t):
    events = t("events").select("event_id", "ts")
    return keys.dense_key(events, [F.col("ts").desc(), "event_id"], "row_number", start=1)


@query(
    "key_dense",
    "SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS id "
    "FROM events",
)
def key_dense(t):
    events = t("events").select("event_id", "user_id", "ts")
    return keys.dense_key(events, ["user_id", "ts", "event_id"]).drop("ts")


@query(
    "key_dense_copies",
    "SELECT event_type, l_returnflag, row_number() OVER (ORDER BY event_type, l_returnflag) AS id "
    "FROM (SELECT l_returnflag AS event_type, l_linestatus AS l_returnflag FROM lineitem)",
)
def key_dense_copies(t):
    """Few distinct rows with very many copies each."""
    rows = t("lineitem").selectExpr("l_returnflag AS event_type", "l_linestatus AS l_returnflag")
    return keys.dense_key(rows, ["event_type"], "id", start=1, unique=False)


@query(
    "key_dense_appended",
    """SELECT event_id, user_id, row_number() OVER (ORDER BY event_id % 3, ts, event_id) - 1 AS id
       FROM events""",
)
def key_dense_appended(t):
    """Three batches and a rerun of the second: rows keep their numbers and there is no gap."""
    path = t.folder("numbered")
    events = t("events").select("event_id", "user_id", "ts")
    for i in (0, 1, 2, 1):
        append_numbered(events.where(F.pmod("event_id", F.lit(3)) == i), path, f"drop-{i}", ["ts", "event_id"])
    return read_snapshot(t.spark, path).drop("ts")


@query(
    "key_monotonic",
    "SELECT event_type, count(*) AS n_rows, count(*) AS n_ids FROM events GROUP BY event_type",
)
def key_monotonic(t):
    """Values differ from run to run; their number must not."""
    return keys.monotonic_key(t("events")).groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids")
    )


@query(
    "key_md5",
    "SELECT event_id, md5(user_id || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS id FROM events",
)
def key_md5(t):
    return keys.hashed_key(t("events"), ["user_id", "ts"]).select("event_id", "id")


# --- sorts and limits ---

@query(
    "topk_desc",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey "
    "ORDER BY n DESC, l_partkey LIMIT 20",
)
def topk_desc(t):
    counts = aggregates.count_by_group(t("lineitem"), ["l_partkey"], "l_partkey")
    return aggregates.top_k(counts, "n", 20, ["l_partkey"])


@query(
    "topk_asc",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey "
    "ORDER BY n, l_partkey LIMIT 20",
)
def topk_asc(t):
    counts = aggregates.count_by_group(t("lineitem"), ["l_partkey"], "l_partkey")
    return aggregates.top_k(counts, "n", 20, ["l_partkey"], ascending=True)


@query(
    "sort_multi_key",
    CITY_MONTHS + "SELECT c_nationkey, month, max(o_orderdate) AS latest FROM c GROUP BY ALL "
    "ORDER BY c_nationkey, month",
)
def sort_multi_key(t):
    return agg_max_by_group(t).orderBy("c_nationkey", "month")


@query(
    "sort_within_key",
    "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations ORDER BY conv_id, turn",
)
def sort_within_key(t):
    turns = t("conversations").select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))
    return layout.read_in_order(turns, ["conv_id"], ["turn"])


@query(
    "limit_preview",
    "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 5",
)
def limit_preview(t):
    return t("events").select("event_id", "ts", "event_type").orderBy("ts", "event_id").limit(5)
