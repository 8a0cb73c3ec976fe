"""The arrivals star: arrivals x city temperature x city demographics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.contracts import (
    ARRIVALS, CITY_DEMOGRAPHICS_CSV, CITY_TEMPERATURE_CSV, DIM_CITY_DEMOS, DIM_IMMIGRATIONS,
    DIM_TEMPERATURES, FACT_IMMIGRATIONS,
)
from starloom.functions.text import title_case
from starloom.functions.timeparts import sas_date, within_years
from starloom.operators.aggregates import rows_at_max
from starloom.operators.cleaning import require, valid_codes
from starloom.operators.lookups import add_lookup, add_port_code
from starloom.operators.quality import QualityError, assert_quality, has_rows, required_columns
from starloom.operators.tables import write_table

# Fixed value: the country whose cities are kept.
COUNTRY = "United States"


def clean_arrivals(arrivals: DataFrame, ports: DataFrame, countries: DataFrame) -> DataFrame:
    """Arrivals with all required values, a valid port and a valid country of origin.

    The null filter comes first: it is the cheaper one and reaches the scan.
    """
    complete = require(arrivals, list(ARRIVALS.not_null))
    return valid_codes(complete, {
        "i94port": (ports.where("is_valid"), "code"),
        "i94cit": (countries.where("is_valid"), "code"),
    })


def dim_immigrations(cleaned: DataFrame) -> DataFrame:
    return DIM_IMMIGRATIONS.conform(cleaned.select(
        F.col("i94yr").alias("year"),
        F.col("i94mon").alias("month"),
        F.col("i94cit").alias("origin_country_code"),
        F.col("i94port").alias("port_code"),
        sas_date(F.col("arrdate")).alias("arr_date"),
        sas_date(F.col("depdate")).alias("dep_date"),
        F.col("i94mode").alias("mode"),
        F.col("i94addr").alias("addr_state_abbr"),
        F.col("i94bir").alias("age"),
        F.col("i94visa").alias("reason"),
        F.col("biryear").alias("birth_year"),
        "gender",
    ))


def clean_temperatures(
    temperatures: DataFrame, min_year: int | None = None, max_year: int | None = None
) -> DataFrame:
    """Complete readings of the country's cities within inclusive years."""
    typed = temperatures.withColumns({
        "dt": F.col("dt").try_cast("date"),
        "AverageTemperature": F.col("AverageTemperature").try_cast("double"),
    }).where(F.col("Country") == COUNTRY)
    kept = typed.where(within_years(F.col("dt"), min_year, max_year))
    return require(kept, list(CITY_TEMPERATURE_CSV.not_null))


def dim_temperatures(cleaned: DataFrame, ports: DataFrame, legacy: bool = False) -> DataFrame:
    """The latest reading of every (city, month), with its port; cities without one go.

    Two places of one name and date give two rows.
    """
    monthly = cleaned.withColumn("_month", F.month("dt"))
    latest = rows_at_max(monthly, ["City", "_month"], "dt")
    coded = add_port_code(latest, ports, "City", legacy=legacy)
    return DIM_TEMPERATURES.conform(coded.select(
        F.col("dt").alias("date"),
        F.col("AverageTemperature").alias("avg_temperature"),
        F.col("City").alias("city"),
        F.col("Country").alias("country"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        "port_code",
    ).dropna(subset=["port_code"]))


def dim_city_demos(demographics: DataFrame, ports: DataFrame, legacy: bool = False) -> DataFrame:
    """Demographics per (city, race) with the port of the city; cities without one go.

    The state code tells cities of one name apart, except with `legacy`.
    """
    complete = require(demographics, list(CITY_DEMOGRAPHICS_CSV.not_null))
    coded = add_port_code(complete, ports, "City", "State Code", legacy=legacy)
    renamed = coded.select(
        F.col("City").alias("city"),
        F.col("State").alias("state"),
        F.col("Median Age").alias("median_age"),
        F.col("Male Population").alias("male_population"),
        F.col("Female Population").alias("female_population"),
        F.col("Total Population").alias("total_population"),
        F.col("Number of Veterans").alias("veteran_population"),
        F.col("`Foreign-born`").alias("foreign_born_population"),
        F.col("Average Household Size").alias("avg_household_size"),
        F.col("State Code").alias("state_abbr"),
        F.col("Race").alias("race"),
        F.col("Count").alias("race_count"),
        "port_code",
    ).dropna(subset=["port_code"])
    numbers = {
        f.name: F.col(f.name).try_cast(f.dataType)
        for f in DIM_CITY_DEMOS.schema if f.dataType.typeName() in ("double", "long")
    }
    return renamed.withColumns(numbers)


def readings_of(dim_temp: DataFrame, distinct: bool = False) -> DataFrame:
    """(port_code, month, temperature_avg): the newest reading, the warmer of two of one day; all
    readings with `distinct`."""
    rows = dim_temp.select(
        "port_code", F.month("date").alias("month"), "date", F.col("avg_temperature").alias("temperature_avg")
    )
    if distinct:
        return rows.drop("date")
    newest = F.max(F.struct("date", "temperature_avg")).alias("_newest")
    return rows.groupBy("port_code", "month").agg(newest).select(
        "port_code", "month", F.col("_newest.temperature_avg").alias("temperature_avg"))


def fact_immigrations(
    dim_imm: DataFrame, dim_temp: DataFrame, dim_demo: DataFrame, countries: DataFrame,
    distinct: bool = False, keep_unmatched: bool = False,
) -> DataFrame:
    """Arrivals with the temperature of their port and month and the city's age and size.

    Temperature is joined on port and calendar month, whatever the year. By default a port has
    one reading a month and one city before the joins, so each arrival is one row. With
    `distinct` all readings and race rows multiply and a distinct on the fact, a shuffle of all
    of it, merges them and identical travellers too. Arrivals whose port has no reading of the
    month or no city are left out, unless `keep_unmatched`.
    """
    city = dim_demo.select(
        "port_code",
        F.col("median_age").alias("city_median_age"),
        F.col("total_population").alias("city_total_population"),
    )
    if not distinct:
        city = city.groupBy("port_code").agg(
            F.min(F.struct("city_median_age", "city_total_population")).alias("_city")
        ).select("port_code", "_city.*")
    how = "left" if keep_unmatched else "inner"
    origins = countries.select("code", title_case(F.col("country")).alias("origin_country"))
    joined = dim_imm.join(readings_of(dim_temp, distinct), ["port_code", "month"], how)
    named = add_lookup(
        joined.join(city, "port_code", how), origins, {"origin_country_code": "code"}, ["origin_country"])
    fact = FACT_IMMIGRATIONS.conform(named)
    return fact.distinct() if distinct else fact


def matched_arrivals(dim_imm: DataFrame, dim_temp: DataFrame, dim_demo: DataFrame) -> int:
    """Arrivals whose port has a reading of the month and a city; counted per port and month
    before they meet the readings."""
    counts = dim_imm.groupBy("port_code", "month").count()
    known = counts.join(readings_of(dim_temp), ["port_code", "month"], "left_semi").join(
        dim_demo.select("port_code"), "port_code", "left_semi")
    return known.agg(F.sum("count")).first()[0] or 0


def build_arrivals_star(
    arrivals: DataFrame, temperatures: DataFrame, demographics: DataFrame,
    ports: DataFrame, countries: DataFrame, distinct: bool = False, legacy: bool = False,
) -> dict[str, DataFrame]:
    dim_imm = dim_immigrations(clean_arrivals(arrivals, ports, countries))
    dim_temp = dim_temperatures(clean_temperatures(temperatures), ports, legacy)
    dim_demo = dim_city_demos(demographics, ports, legacy)
    return {
        "dim_immigrations": dim_imm,
        "dim_temperatures": dim_temp,
        "dim_city_demos": dim_demo,
        "fact_immigrations": fact_immigrations(dim_imm, dim_temp, dim_demo, countries, distinct),
    }


CONTRACTS = {
    c.name: c for c in (DIM_IMMIGRATIONS, DIM_TEMPERATURES, DIM_CITY_DEMOS, FACT_IMMIGRATIONS)
}


def run_arrivals_star(
    arrivals: DataFrame, temperatures: DataFrame, demographics: DataFrame,
    ports: DataFrame, countries: DataFrame, out: str, distinct: bool = False,
    by_port: bool = False,
) -> dict[str, str]:
    """Write the dimensions, build and write the fact from them, and check all four tables.

    The fact and the checks read what was written, so no dimension is computed twice. The city
    dimensions hold a few rows per port: they are sorted by port, which lets a scan skip row
    groups, and only `by_port` makes a folder per port of them.
    """
    spark = arrivals.sparkSession
    paths = {name: f"{out}/{name}" for name in CONTRACTS}

    def save(name: str, table: DataFrame) -> DataFrame:
        contract = CONTRACTS[name]
        problems = required_columns(table, contract.column_names)
        if problems:
            raise QualityError(f"{name}: {problems}")
        folders = contract.partition_by
        if contract.sort_by:
            folders = ("port_code",) if by_port else ()
            table = table.sort(*contract.sort_by)
        write_table(table, paths[name], folders)
        return contract.conform(spark.read.schema(table.schema).parquet(paths[name]))

    cleaned = clean_arrivals(arrivals, ports, countries)
    tables = {
        "dim_immigrations": save("dim_immigrations", dim_immigrations(cleaned)),
        "dim_temperatures": save(
            "dim_temperatures", dim_temperatures(clean_temperatures(temperatures), ports)
        ),
        "dim_city_demos": save("dim_city_demos", dim_city_demos(demographics, ports)),
    }
    fact = fact_immigrations(*tables.values(), countries, distinct)
    tables["fact_immigrations"] = save("fact_immigrations", fact)
    assert_quality(has_rows(tables))
    if not distinct:
        rows, wanted = tables["fact_immigrations"].count(), matched_arrivals(*list(tables.values())[:3])
        if rows != wanted:
            raise QualityError(f"fact_immigrations has {rows} rows for {wanted} matched arrivals")
    return paths
