import pytest
from pyspark.sql import functions as F

from starloom.contracts import (
    ARRIVALS, CITY_DEMOGRAPHICS_CSV, CITY_TEMPERATURE_CSV, FACT_IMMIGRATIONS,
)
from starloom.operators.quality import QualityError
from starloom.plans import arrivals
from starloom.sources.files import typed_arrivals


@pytest.fixture(scope="module")
def ports(spark):
    return spark.createDataFrame([
        ("POM", "portland", "me", True, 1), ("POO", "portland", "or", True, 2),
        ("SFR", "san francisco", "ca", True, 3), ("BAD", "nowhere", None, False, 4),
    ], "code string, city string, state string, is_valid boolean, line_no bigint")


@pytest.fixture(scope="module")
def countries(spark):
    return spark.createDataFrame([
        (135, "united kingdom", True), (582, "mexico", True), (403, "american samoa", False),
    ], "code int, country string, is_valid boolean")


@pytest.fixture(scope="module")
def people(spark):
    def person(port="SFR", country=135.0, gender="F", dep=20555.0, age=30.0):
        return (2016.0, 4.0, country, port, 20545.0, 1.0, "CA", dep, age, 2.0, 1986.0, gender)

    rows = [person(), person(), person(country=403.0), person(port="BAD"), person(gender=None),
            person(dep=None), person(port="POO", country=582.0)]
    return typed_arrivals(spark.createDataFrame(rows, ARRIVALS.schema))


@pytest.fixture(scope="module")
def temperatures(spark):
    def reading(dt, t="10.5", city="San Francisco", country="United States", lat="1N"):
        return (dt, t, "0.1", city, country, lat, "2W")

    rows = [
        reading("2012-04-01"), reading("2013-04-01", "12.5"), reading("2013-05-01", "13.0"),
        reading("2014-04-01", None), reading("2013-04-01", "9.0", city="portland"),
        reading("2013-04-01", "8.0", city="portland", lat="3N"), reading("2013-04-01", city="York"),
        reading("2013-04-01", country="Canada"),
    ]
    return spark.createDataFrame(rows, CITY_TEMPERATURE_CSV.schema)


@pytest.fixture(scope="module")
def demographics(spark):
    def city(name, code, race, age="38.3"):
        return (name, "State", age, "1", "2", "3", "4", "5", "2.5", code, race, "6")

    rows = [city("San Francisco", "CA", "White"), city("San Francisco", "CA", "Asian"),
            city("Portland", "OR", "White", "36.7"), city("Portland", "ME", "White", None)]
    return spark.createDataFrame(rows, CITY_DEMOGRAPHICS_CSV.schema)


def test_only_complete_and_valid_arrivals(people, ports, countries):
    cleaned = arrivals.clean_arrivals(people, ports, countries)
    assert sorted(r.i94port for r in cleaned.collect()) == ["POO", "SFR", "SFR"]
    dim = arrivals.dim_immigrations(cleaned).first()
    assert str(dim.arr_date) == "2016-04-01" and dim.year == 2016


def test_latest_reading_per_city_and_month(temperatures, ports):
    cleaned = arrivals.clean_temperatures(temperatures)
    dim = arrivals.dim_temperatures(cleaned, ports)
    got = sorted((r.port_code, str(r.date), r.avg_temperature) for r in dim.collect())
    assert got == [
        ("POM", "2013-04-01", 8.0), ("POM", "2013-04-01", 9.0),
        ("SFR", "2013-04-01", 12.5), ("SFR", "2013-05-01", 13.0),
    ]
    old = arrivals.clean_temperatures(temperatures, max_year=2012)
    assert old.count() == 1


def test_state_tells_cities_of_one_name_apart(demographics, ports):
    dim = arrivals.dim_city_demos(demographics, ports)
    assert {(r.city, r.state_abbr, r.port_code) for r in dim.collect()} == {
        ("San Francisco", "CA", "SFR"), ("Portland", "OR", "POO")
    }


def test_race_rows_do_not_multiply_arrivals(people, temperatures, demographics, ports, countries):
    fact = arrivals.build_arrivals_star(
        people, temperatures, demographics, ports, countries
    )["fact_immigrations"]
    rows = fact.collect()
    assert fact.columns == FACT_IMMIGRATIONS.column_names
    assert [(r.port_code, r.origin_country) for r in rows] == [("SFR", "United Kingdom")] * 2
    merged = arrivals.build_arrivals_star(
        people, temperatures, demographics, ports, countries, distinct=True
    )["fact_immigrations"]
    assert merged.count() == 1


def test_readings_do_not_multiply_arrivals(spark, people, temperatures, demographics, ports, countries):
    twice = temperatures.unionByName(temperatures.withColumn("AverageTemperature", F.lit("40")))
    star = arrivals.build_arrivals_star(people, twice, demographics, ports, countries)
    assert [r.temperature_avg for r in star["fact_immigrations"].collect()] == [40.0, 40.0]
    kept = arrivals.fact_immigrations(
        *[star[n] for n in ("dim_immigrations", "dim_temperatures", "dim_city_demos")], countries,
        keep_unmatched=True)
    assert kept.count() == star["dim_immigrations"].count() == 3
    assert arrivals.matched_arrivals(
        *[star[n] for n in ("dim_immigrations", "dim_temperatures", "dim_city_demos")]) == 2


def test_run_writes_and_checks(spark, people, temperatures, demographics, ports, countries, tmp_path):
    paths = arrivals.run_arrivals_star(
        people, temperatures, demographics, ports, countries, str(tmp_path / "a"), by_port=True
    )
    assert spark.read.parquet(paths["fact_immigrations"]).count() == 2
    assert spark.read.parquet(paths["dim_temperatures"]).where("port_code = 'SFR'").count() == 2
    with pytest.raises(QualityError, match="has_rows:fact_immigrations"):
        arrivals.run_arrivals_star(
            people.where(F.lit(False)), temperatures, demographics, ports, countries,
            str(tmp_path / "b"),
        )
