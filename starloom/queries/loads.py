"""Sinks and table loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.contracts import TableContract
from starloom.operators import tables
from starloom.operators.snapshots import read_snapshot, replace_snapshot
from starloom.queries.registry import query
from starloom.queries.scans import EVENTS, EVENTS_SQL
from starloom.sources import files

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders"


@query("sink_parquet_overwrite", EVENTS_SQL)
def sink_parquet_overwrite(t):
    path = t.folder("overwrite")
    tables.write_table(t("orders"), path)
    tables.write_table(t("events"), path)
    return t.spark.read.parquet(path)


@query(
    "sink_parquet_partitioned",
    "SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::int AS year, "
    "month(o_orderdate)::int AS month FROM orders",
)
def sink_parquet_partitioned(t):
    """All partitions, then a rerun of one year that replaces only its partitions."""
    path = t.folder("partitioned-sink")
    rows = t("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )
    tables.write_table(rows, path, ["year", "month"])
    again = rows.where("year = 1997")
    tables.write_table(again, path, ["year", "month"], only_touched=True)
    return files.read_table(t.spark, path)


@query("sink_csv_quoted", EVENTS_SQL)
def sink_csv_quoted(t):
    path = t.folder("quoted")
    tables.write_csv_quoted(t("events"), path)
    return files.scan_csv(t.spark, path, EVENTS)


# Every 50th event has lost its key; every 100th of these arrives twice in its batch.
_KEYLESS = {"event_id": "case when event_id % 50 = 7 then null else event_id end"}
_FACT = "ts, user_id, event_type, value, props"


@query(
    "load_append_fact",
    f"""WITH rows AS (SELECT {_KEYLESS["event_id"]} AS id, event_id AS n, {_FACT} FROM events)
    SELECT id AS event_id, {_FACT} FROM rows
    UNION ALL SELECT id AS event_id, {_FACT} FROM rows WHERE id IS NULL AND n % 100 = 7""",
)
def load_append_fact(t):
    """Two batches that share a third of the events, some without a key, and a rerun of both."""
    path = t.folder("fact")
    events = t("events")
    n = events.count()
    twice = events.where("event_id % 100 = 7")
    rows = events.unionByName(twice)

    def batch(part):
        return part.selectExpr(f"{_KEYLESS['event_id']} AS event_id", *_FACT.split(", "))

    early = batch(rows.where(F.col("event_id") < n * 2 // 3))
    late = batch(rows.where(F.col("event_id") >= n // 3))
    for part in (early, late, late, early):
        tables.append_fact(part, path, ["event_id"])
    return t.spark.read.schema(EVENTS.schema).parquet(path)


@query(
    "load_append_fact_partitioned",
    "SELECT event_id, ts, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def load_append_fact_partitioned(t):
    """The same on a table by day, where only the days of the batch are compared."""
    path = t.folder("fact-by-day")
    events = t("events").select(
        "event_id", "ts", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    middle = events.select(F.max("ts").alias("b"), F.min("ts").alias("a")).first()
    cut = middle.a + (middle.b - middle.a) / 2
    cut = F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")
    key = ["event_id", "day"]
    tables.append_fact(events.where(F.col("ts") < cut), path, key, ["day"])
    overlap = F.timestamp_add("DAY", F.lit(-5), cut)
    tables.append_fact(events.where(F.col("ts") >= overlap), path, key, ["day"])
    tables.append_fact(events.where("event_id < 0"), path, key, ["day"])
    return t.spark.read.schema("event_id bigint, ts timestamp_ntz, user_id bigint, day string"
                               ).parquet(path)


@query(
    "load_truncate_insert",
    "SELECT o_custkey, o_orderpriority, count(*) AS n_orders FROM orders GROUP BY ALL",
)
def load_truncate_insert(t):
    """A dimension built from the first half of the orders, then rebuilt from all."""
    path = t.folder("dimension")
    for rows in _halves(t):
        replace_snapshot(_dimension(rows), path)
    return read_snapshot(t.spark, path)


def _halves(t):
    orders = t("orders")
    return orders.where(F.col("o_orderkey") < orders.count() // 2), orders


def _dimension(rows):
    return rows.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n_orders"))


@query(
    "load_truncate_insert_versions",
    """SELECT 1 AS version, o_custkey, o_orderpriority, count(*) AS n_orders FROM orders
       WHERE o_orderkey < (SELECT count(*) // 2 FROM orders) GROUP BY ALL
       UNION ALL SELECT 2, o_custkey, o_orderpriority, count(*) FROM orders GROUP BY ALL""",
)
def load_truncate_insert_versions(t):
    """A reader of the old version goes on reading it after the new one is there."""
    path = t.folder("versions")
    readers = []
    for rows in _halves(t):
        replace_snapshot(_dimension(rows), path)
        readers.append(read_snapshot(t.spark, path))
    old, new = (r.withColumn("version", F.lit(k + 1)) for k, r in enumerate(readers))
    return old.unionByName(new)


ORDER_TABLE = TableContract(
    "order_totals",
    "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string",
    primary_key=("o_orderkey",),
)


@query("load_insert_select", ORDERS_SQL)
def load_insert_select(t):
    path = t.folder("insert-select")
    tables.ensure_table(t.spark, ORDER_TABLE, path)
    tables.insert_select(t("orders"), ORDER_TABLE, path)
    return t.spark.read.parquet(path)


@query(
    "load_multi_target",
    """SELECT 'by_customer' AS target, cast(o_custkey AS varchar) AS k, count(*) AS n FROM orders
       GROUP BY o_custkey
       UNION ALL SELECT 'by_status', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus
       UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM orders
       GROUP BY o_orderpriority""",
)
def load_multi_target(t):
    root = t.folder("targets")
    keys = {"by_customer": "o_custkey", "by_status": "o_orderstatus",
            "by_priority": "o_orderpriority"}

    def counted(column):
        return lambda df: df.groupBy(F.col(column).cast("string").alias("k")).agg(
            F.count("*").alias("n")
        )

    source = t("orders").select(*keys.values())
    tables.load_targets(source, {f"{root}/{k}": (counted(c), ()) for k, c in keys.items()})
    parts = [
        t.spark.read.parquet(f"{root}/{k}").select(F.lit(k).alias("target"), "k", "n") for k in keys
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("table_contract_create", ORDERS_SQL)
def table_contract_create(t):
    """Create twice (the second is a no-op), fill, drop and create, fill again."""
    path = t.folder("contract")
    tables.ensure_table(t.spark, ORDER_TABLE, path)
    tables.insert_select(t("orders"), ORDER_TABLE, path)
    tables.ensure_table(t.spark, ORDER_TABLE, path)
    tables.ensure_table(t.spark, ORDER_TABLE, path, drop_first=True)
    tables.insert_select(t("orders"), ORDER_TABLE, path)
    return t.spark.read.schema(ORDER_TABLE.schema).parquet(path)
