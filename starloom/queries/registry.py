"""Registry of queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starloom.session import configure, configure_tables, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Columns of the input tables; a declared schema saves a footer-reading job per scan.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


# The tables that tell the size of a run.
SIZED = ("lineitem", "orders", "events")


class Tables:
    """The input tables of one run: `t("orders")` reads a table, `t.folder(...)` is scratch."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.sf_dir = str(sf_dir).rstrip("/")
        self.spark = configure_tables(
            configure(spark), *[f"{self.sf_dir}/{name}.parquet" for name in SIZED])

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under a name, with its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
