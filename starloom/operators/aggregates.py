"""Group maxima, medians and top-k on top of Spark's own aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.keys import BEFORE, running_total


def rows_at_max(df: DataFrame, group: list[str], measure: str) -> DataFrame:
    """Rows that hold the maximum of their group; ties are kept.

    The group maxima are aggregated on the map side and joined back, so that a group with a
    large share of the rows is never sorted in one task, as it would be by a window.
    """
    peaks = df.groupBy(*group).agg(F.max(measure).alias("_peak"))
    matched = df.withColumn("_peak", F.col(measure))
    return matched.join(peaks, [*group, "_peak"], "left_semi").drop("_peak")


def median_by_group(
    df: DataFrame, group: list[str], value: str, name: str = "median", weight: str | None = None
) -> DataFrame:
    """Exact median per group (mean of the two middle values); NULLs are left out.

    A row counts `weight` times, or once. Equal values are counted first; the counts are put in
    order over range partitions, and the middle values are found by position. No group is gathered
    in one task. Without group columns all rows are one group.
    """
    if not group:
        whole = df.withColumn("_whole", F.lit(0))
        return median_by_group(whole, ["_whole"], value, name, weight).drop("_whole")
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).alias("_value"))
        .agg((F.sum(weight) if weight else F.count("*")).alias("_n"))
    )
    order = [*[F.col(g) for g in group], F.col("_value")]
    placed = running_total(counted, order, "_n")
    names = {g: f"_group_{i}" for i, g in enumerate(group)}
    totals = placed.groupBy(*[F.col(g).alias(a) for g, a in names.items()]).agg(
        F.sum("_n").alias("_all"), F.min(BEFORE).alias("_base")
    )
    same = [F.col(g).eqNullSafe(F.col(a)) for g, a in names.items()]
    first = F.col(BEFORE) - F.col("_base")
    lower, upper = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)

    def covers(position: Column) -> Column:
        return (first <= position) & (position < first + F.col("_n"))

    middle = placed.join(totals, same).where(covers(lower) | covers(upper))
    return middle.groupBy(*group).agg(F.avg(F.col("_value").cast("double")).alias(name))


def count_by_group(df: DataFrame, group: list[str], column: str, name: str = "n") -> DataFrame:
    """COUNT(column) per group; NULLs are not counted."""
    return df.groupBy(*group).agg(F.count(column).alias(name))


def top_k(df: DataFrame, by: str, k: int, ties: list[str], ascending: bool = False) -> DataFrame:
    """First k rows by a measure; `ties` makes the order total."""
    first = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(first, *ties).limit(k)


def counts_with_names(
    fact: DataFrame, key: str, dim: DataFrame, dim_key: str, names: list[str], name: str = "n"
) -> DataFrame:
    """Fact rows per descriptive column of a dimension.

    Facts are counted per key before the join, so the join moves one row per key.
    """
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    named = counts.join(dim, counts[key] == dim[dim_key])
    return named.groupBy(*[dim[c] for c in names]).agg(F.sum("_n").alias(name))
