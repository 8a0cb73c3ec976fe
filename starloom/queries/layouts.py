"""Layout operators: the rows must come back unchanged (plans are tested in tests/)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.operators import hot_keys, layout
from starloom.queries.registry import query

LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
LINES_SQL = f"SELECT {', '.join(LINES)} FROM lineitem"


@query("layout_distribute_sort", LINES_SQL)
def layout_distribute_sort(t):
    path = t.folder("distributed")
    rows = t("lineitem").select(*LINES)
    layout.distribute_sort(rows, ["l_orderkey"], ["l_orderkey", "l_linenumber"]).write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "layout_replicate",
    "SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def layout_replicate(t):
    part = layout.replicate(t("part").select("p_partkey", "p_brand"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", "p_brand"
    )


@query(
    "layout_partition_cluster",
    "SELECT conv_id, role, turn, md5(text) AS text_md5 FROM conversations",
)
def layout_partition_cluster(t):
    """A bucketed table with a composite key, sorted by the clustering column."""
    path, name = t.folder("clustered"), f"clustered_{uuid.uuid4().hex}"
    turns = t("conversations").select("conv_id", "role", "turn", F.md5("text").alias("text_md5"))
    layout.bucket_table(turns, name, path, ["conv_id", "role"], ["turn"], 8)
    return t.spark.table(name)


@query(
    "layout_bucketed_join",
    "SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem "
    "ON o_orderkey = l_orderkey",
)
def layout_bucketed_join(t):
    """Two tables bucketed alike are joined without a shuffle."""
    run = uuid.uuid4().hex
    layout.bucket_table(
        t("orders").select("o_orderkey", "o_custkey"), f"orders_{run}", t.folder("b-orders"),
        ["o_orderkey"], ["o_orderkey"], 8,
    )
    layout.bucket_table(
        t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), f"lines_{run}",
        t.folder("b-lines"), ["l_orderkey"], ["l_orderkey"], 8,
    )
    orders, lines = t.spark.table(f"orders_{run}"), t.spark.table(f"lines_{run}")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).drop("l_orderkey")


def _hot_lines(t):
    """Lines of which those of every third order are of the first order."""
    first = t("orders").agg(F.min("o_orderkey")).first()[0]
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(first)).otherwise(F.col("l_orderkey"))
    return t("lineitem").select(key.alias("l_orderkey"), "l_linenumber", "l_quantity")


HOT_LINES_SQL = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders) ELSE l_orderkey END
    AS l_orderkey, l_linenumber, l_quantity FROM lineitem"""


@query("layout_cluster_hot", HOT_LINES_SQL)
def layout_cluster_hot(t):
    """A bucketed table of which one key holds a third of the rows."""
    lines = _hot_lines(t)
    hot = hot_keys.shared_hot([(lines, ["l_orderkey"])], 1 / 8)
    split = hot_keys.split_table(
        lines, f"hot_{uuid.uuid4().hex}", t.folder("hot"), ["l_orderkey"], ["l_linenumber"], 8, hot)
    return split.rows(t.spark)


@query(
    "layout_bucketed_join_hot",
    f"SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN ({HOT_LINES_SQL}) AS l "
    "ON o_orderkey = l_orderkey",
)
def layout_bucketed_join_hot(t):
    """The buckets are joined without a shuffle, the rows of the hot key apart from them."""
    orders, lines = t("orders").select("o_orderkey", "o_custkey"), _hot_lines(t)
    hot = hot_keys.shared_hot([(orders, ["o_orderkey"]), (lines, ["l_orderkey"])], 1 / 8)
    run = uuid.uuid4().hex
    left = hot_keys.split_table(lines, f"l_{run}", t.folder("l"), ["l_orderkey"], ["l_linenumber"], 8, hot)
    right = hot_keys.split_table(orders, f"o_{run}", t.folder("o"), ["o_orderkey"], [], 8, hot)
    return hot_keys.join_split(t.spark, left, right).drop("l_orderkey")


@query(
    "layout_repartition_by_columns",
    "SELECT o_orderkey, o_custkey, year(o_orderdate)::int AS year, month(o_orderdate)::int AS month "
    "FROM orders",
)
def layout_repartition_by_columns(t):
    path = t.folder("by-month")
    rows = t("orders").select(
        "o_orderkey", "o_custkey",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )
    layout.repartition_by_columns(rows, ["year", "month"]).write.partitionBy(
        "year", "month"
    ).parquet(path)
    return t.spark.read.parquet(path)


@query(
    "layout_cache",
    "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events "
    "GROUP BY event_type",
)
def layout_cache(t):
    """One pruned source for two results; both are written before it is released."""
    source = layout.cached(t("events"), ["event_type", "user_id"])
    counts, users = t.folder("cache-counts"), t.folder("cache-users")
    try:
        source.groupBy("event_type").agg(F.count("*").alias("n")).write.parquet(counts)
        source.groupBy("event_type").agg(
            F.count_distinct("user_id").alias("users")
        ).write.parquet(users)
    finally:
        source.unpersist()
    return t.spark.read.parquet(counts).join(t.spark.read.parquet(users), "event_type")
