"""Data-quality checks as (check_name, violations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.contracts import TableContract
from starloom.operators import quality
from starloom.operators.snapshots import replace_snapshot
from starloom.queries import shapes
from starloom.queries.joins import TEMP_SQL, temperature_dim
from starloom.queries.registry import query

DIRTY = f"WITH {shapes.DIRTY_SQL} "


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


@query(
    "dq_sql_expect",
    """SELECT 'orders_have_customers' AS check_name, '0' AS expected, cast(count(*) AS varchar)
              AS actual, count(*) = 0 AS passed
       FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
       UNION ALL
       SELECT 'no_failed_orders', '0', cast(count(*) AS varchar), count(*) = 0
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL
       SELECT 'few_null_types', '<= 1000000000', cast(count(*) AS varchar), count(*) <= 1000000000
       FROM events WHERE event_id % 7 = 0""",
)
def dq_sql_expect(t):
    """One check passes, one fails, and one has a threshold."""
    t("orders").createOrReplaceTempView("dq_orders")
    t("customer").createOrReplaceTempView("dq_customer")
    shapes.dirty_events(t).createOrReplaceTempView("dq_events")
    return quality.expect(t.spark, [
        quality.Expectation(
            "orders_have_customers",
            "SELECT count(*) FROM dq_orders LEFT ANTI JOIN dq_customer ON o_custkey = c_custkey", 0,
        ),
        quality.Expectation(
            "no_failed_orders", "SELECT count(*) FROM dq_orders WHERE o_orderstatus = 'F'", 0
        ),
        quality.Expectation(
            "few_null_types", "SELECT count(*) FROM dq_events WHERE event_type IS NULL",
            at_most=1_000_000_000,
        ),
    ])


@query(
    "dq_null_count",
    DIRTY + _union([
        f"SELECT 'null:{c}' AS check_name, count(*) AS violations FROM dirty WHERE {c} IS NULL"
        for c in ("event_id", "ts", "user_id", "event_type", "value")
    ]),
)
def dq_null_count(t):
    return quality.null_counts(shapes.dirty_events(t))


@query(
    "dq_has_rows",
    "SELECT 'has_rows:orders' AS check_name, 0::bigint AS violations "
    "UNION ALL SELECT 'has_rows:refunds', "
    "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::bigint FROM events WHERE event_type = 'refund'",
)
def dq_has_rows(t):
    """The second table is empty."""
    refunds = t("events").where("event_type = 'refund'")
    return quality.has_rows({"orders": t("orders"), "refunds": refunds})


@query(
    "dq_required_columns",
    "SELECT 'orders' AS table_name, 0 AS problems, count(*) AS n_rows FROM orders "
    "UNION ALL SELECT 'customer', 2, count(*) FROM customer",
)
def dq_required_columns(t):
    """Names and order: the first table agrees, the second lacks a column at its end and has
    another name in between."""
    required = {
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority"],
        "customer": ["c_custkey", "c_label", "c_nationkey", "c_acctbal"],
    }
    parts = []
    for name, columns in required.items():
        table = t(name)
        problems = len(quality.required_columns(table, columns))
        parts.append(table.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(problems).alias("problems"), "n_rows"
        ))
    return parts[0].unionByName(parts[1])


@query(
    "dq_group_cardinality",
    f"WITH {TEMP_SQL} SELECT city, count(*) AS n FROM dim_temp GROUP BY city HAVING count(*) <> 12",
)
def dq_group_cardinality(t):
    """Cities without exactly twelve monthly readings."""
    return quality.wrong_cardinality(temperature_dim(t), ["city"], 12)


CATALOG_CONTRACT = TableContract(
    "catalog",
    "artist_id string, artist_name string, artist_latitude double, year int, duration double, "
    "artist_location string",
    not_null=("artist_id", "artist_latitude"),
    checks={
        "year_range": "year >= 1960",
        "duration_range": "duration > 0",
        "latitude_range": "isnan(artist_latitude) OR artist_latitude BETWEEN -90 AND 10",
    },
    max_length={"artist_name": 8, "artist_location": 40},
)
_CAT = f"WITH {shapes.CATALOG_SQL} "


@query(
    "dq_check_range",
    _CAT + _union([
        f"SELECT 'check:{n}' AS check_name, count(*) AS violations FROM catalog WHERE NOT ({p})"
        for n, p in (
            ("year_range", "year >= 1960"), ("duration_range", "duration > 0"),
            ("latitude_range", "artist_latitude BETWEEN -90 AND 10"),
        )
    ]),
)
def dq_check_range(t):
    return quality.check_ranges(shapes.catalog(t), CATALOG_CONTRACT)


@query(
    "dq_not_null",
    _CAT + _union([
        f"SELECT 'not_null:{c}' AS check_name, count(*) AS violations FROM catalog "
        f"WHERE {c} IS NULL" for c in ("artist_id", "artist_latitude")
    ]),
)
def dq_not_null(t):
    return quality.not_null(shapes.catalog(t), CATALOG_CONTRACT)


@query(
    "dq_primary_key",
    """SELECT 'primary_key:l_orderkey,l_linenumber' AS check_name, count(*) AS violations FROM
         (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL SELECT 'primary_key:o_orderkey', count(*) FROM
         (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
)
def dq_primary_key(t):
    return quality.primary_key(t("lineitem"), ["l_orderkey", "l_linenumber"]).unionByName(
        quality.primary_key(t("orders"), ["o_orderkey"])
    )


@query(
    "dq_foreign_key",
    """SELECT 'foreign_key:l_orderkey' AS check_name, count(*) AS violations FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL SELECT 'foreign_key:o_custkey', count(*) FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def dq_foreign_key(t):
    payers = t("customer").where("c_acctbal > 0")
    return quality.foreign_key(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey").unionByName(
        quality.foreign_key(t("orders"), "o_custkey", payers, "c_custkey")
    )


@query(
    "dq_foreign_key_buckets",
    """SELECT 'foreign_key:l_partkey' AS check_name, count(DISTINCT l_partkey) AS violations FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 5 <> 0)""",
)
def dq_foreign_key_buckets(t):
    """Against keys in buckets, of which every fifth is missing."""
    path = t.folder("part-keys")
    replace_snapshot(t("part").select("p_partkey").where("p_partkey % 5 <> 0"), path, ["p_partkey"], 16)
    return quality.foreign_key_in_buckets(t("lineitem"), "l_partkey", path, "p_partkey")


@query(
    "dq_max_length",
    _CAT + "SELECT 'max_length:artist_name' AS check_name, count(*) AS violations FROM catalog "
    "WHERE length(artist_name) > 8 UNION ALL SELECT 'max_length:artist_location', count(*) "
    "FROM catalog WHERE length(artist_location) > 40",
)
def dq_max_length(t):
    return quality.max_lengths(shapes.catalog(t), CATALOG_CONTRACT)
