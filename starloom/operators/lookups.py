"""Code lookups against small dimensions.

No broadcast is forced: Spark broadcasts a listing that is small by its files or, at run time,
by its shuffle size, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def add_lookup(
    df: DataFrame, dim: DataFrame, on: dict[str, str], columns: list[str]
) -> DataFrame:
    """Add columns of a dimension through {df column: unique key column of dim}; NULL where
    the key is unknown."""
    keys = {f"_key_{i}": k for i, k in enumerate(on.values())}
    small = dim.select(*[F.col(k).alias(a) for a, k in keys.items()], *columns)
    cond = [df[c] == small[a] for c, a in zip(on, keys)]
    return df.join(small, cond, "left").drop(*keys)


def city_index(ports: DataFrame, by_state: bool = False, legacy: bool = False) -> DataFrame:
    """One port code per city (or per city and state): the smallest valid one.

    With `legacy` the state is ignored and the last line of the listing wins, for which `ports`
    needs a `line_no` column.
    """
    if legacy:
        return ports.groupBy("city").agg(F.max_by("code", "line_no").alias("port_code"))
    keys = ["city", "state"] if by_state else ["city"]
    return ports.where("is_valid").groupBy(*keys).agg(F.min("code").alias("port_code"))


def add_port_code(
    df: DataFrame, ports: DataFrame, city: str, state: str | None = None, legacy: bool = False
) -> DataFrame:
    """Add `port_code` by lower-case city name, and by state where the table has one."""
    by_state = state is not None and not legacy
    index = city_index(ports, by_state, legacy)
    keyed = df.withColumn("_city", F.lower(city))
    on = {"_city": "city"}
    if by_state:
        keyed = keyed.withColumn("_state", F.lower(state))
        on["_state"] = "state"
    return add_lookup(keyed, index, on, ["port_code"]).drop("_city", "_state")
