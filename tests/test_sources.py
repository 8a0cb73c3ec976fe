import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.contracts import CITY_DEMOGRAPHICS_CSV, EVENT_CSV, PLAY_LOG, TableContract
from starloom.operators.lookups import add_port_code, city_index
from starloom.sources import files, staging

PORTS = (
    "   'ALC'\t=\t'ALCAN, AK             '\n"
    "   'POM'\t=\t'PORTLAND, ME          '\n"
    "   'POO'\t=\t'PORTLAND, OR          '\n"
    "   'MAP'\t=\t'MARIPOSA AZ           '\n"
    "   'PDN'\t=\t'PASO DEL NORTE,TX     '\n"
    "   'GTF'\t=\t'Collapsed into INT, MN'\n"
    "   'INT'\t=\t'INT''L FALLS, MN      '\n"
    "   'CHN'\t=\t'No PORT Code (CHN)'\n"
    "some heading\n"
    "   'YUM'\t=\t'YUMA, AZ'"
)
COUNTRIES = (
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'\n"
    "   236 =  'AFGHANISTAN'\n"
    "   687 =  'ARGENTINA '\n"
    "   518 =  'ANTIGUA-BARBUDA'\n"
    "   403 =  'INVALID: AMERICAN SAMOA'\n"
    "    0  =  'INVALID: STATELESS'\n"
    "   712 =  'INVALID: ANTARCTICA' \n"
    "   996 =  'No Country Code (996)'\n"
)


@pytest.fixture
def ports(spark, tmp_path):
    (tmp_path / "ports.txt").write_text(PORTS)
    return str(tmp_path / "ports.txt")


def test_every_port_line_is_parsed(spark, ports):
    rows = {r.code: r for r in files.scan_port_codes(spark, ports).collect()}
    assert set(rows) == {"ALC", "POM", "POO", "MAP", "PDN", "GTF", "INT", "CHN", "YUM"}
    assert (rows["ALC"].city, rows["ALC"].state) == ("alcan", "ak")
    assert (rows["PDN"].city, rows["PDN"].state) == ("paso del norte", "tx")
    assert rows["INT"].city == "int'l falls"
    assert [c for c in sorted(rows) if not rows[c].is_valid] == ["CHN", "GTF"]


def test_city_index_by_state_and_by_smallest_code(spark, ports):
    table = files.scan_port_codes(spark, ports)
    by_city = {r.city: r.port_code for r in city_index(table).collect()}
    assert by_city["portland"] == "POM"
    cities = spark.createDataFrame(
        [("Portland", "OR"), ("Portland", "ME"), ("Nowhere", "TX")], "city string, st string"
    )
    found = {(r.city, r.st): r.port_code
             for r in add_port_code(cities, table, "city", "st").collect()}
    assert found == {
        ("Portland", "OR"): "POO", ("Portland", "ME"): "POM", ("Nowhere", "TX"): None
    }


def test_legacy_index_takes_the_last_line(spark, ports):
    table = files.scan_port_codes(spark, ports, legacy=True)
    assert table.where("not is_valid").isEmpty()
    by_city = {r.city: r.port_code for r in city_index(table, legacy=True).collect()}
    assert by_city["portland"] == "POO"


def test_country_listing(spark, tmp_path):
    (tmp_path / "countries.txt").write_text(COUNTRIES)
    path = str(tmp_path / "countries.txt")
    rows = {r.code: r for r in files.scan_country_codes(spark, path).collect()}
    assert len(rows) == 8
    assert rows[687].country == "argentina" and rows[687].is_valid
    assert rows[403].country == "american samoa" and not rows[403].is_valid
    assert rows[0].country == "stateless"
    assert not rows[996].is_valid
    legacy = {r.code for r in files.scan_country_codes(spark, path, legacy=True).collect()}
    assert legacy == {236}


def test_json_tree_is_read_with_the_schema(spark, tmp_path):
    for folder, page in (("a/b", "NextSong"), ("c", "Home")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "log.json").write_text(
            json.dumps({"page": page, "ts": 1541121934796, "userId": "", "extra": 1}) + "\n"
        )
    (tmp_path / "notes.txt").write_text("not json")
    rows = files.scan_json(spark, str(tmp_path), PLAY_LOG)
    assert rows.columns == PLAY_LOG.column_names
    assert {(r.page, r.userId, r.artist) for r in rows.collect()} == {
        ("NextSong", "", None), ("Home", "", None)
    }


def test_csv_union_keeps_quoted_commas(spark, tmp_path):
    header = ",".join(EVENT_CSV.column_names)
    line = 'Faithless,Logged In,Ann,F,4,Lee,495.3,free,"San Jose, CA",PUT,NextSong,1.5E+12,338,'
    for name in ("x.csv", "sub/y.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f'{header}\n{line}"Say ""Hi""",200,1.54E+12,10\n')
    rows = files.scan_csv(spark, str(tmp_path), EVENT_CSV).collect()
    assert len(rows) == 2
    assert rows[0].location == "San Jose, CA" and rows[0].song == 'Say "Hi"'


def test_semicolon_csv(spark, tmp_path):
    header = ";".join(CITY_DEMOGRAPHICS_CSV.column_names)
    (tmp_path / "d.csv").write_text(f"{header}\nPortland;Oregon;36.7;1;2;3;4;5;2.4;OR;White;6\n")
    rows = files.scan_csv(spark, str(tmp_path), CITY_DEMOGRAPHICS_CSV, sep=";")
    typed = files.typed(rows, {"Median Age": "double", "Count": "bigint"})
    row = typed.first()
    assert (row["Median Age"], row["Count"], row["State Code"]) == (36.7, 6, "OR")


def test_scan_for_run_reads_one_run(spark, tmp_path):
    contract = TableContract("t", "x int")
    for day in ("2018-11-01", "2018-11-02"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "a.json").write_text(json.dumps({"x": int(day[-1])}))
    template = str(tmp_path) + "/{run:%Y-%m-%d}"
    rows = files.scan_for_run(spark, template, datetime(2018, 11, 2), contract).collect()
    assert [r.x for r in rows] == [2]


STAGE = TableContract(
    "stage", "id int, name string, amount decimal(18,0)", not_null=("id",), max_length={"name": 3}
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_staging_options(spark):
    rows = lines(
        spark, '{"ID": "1", "Name": "abcdef", "AMOUNT": 246.9}',
        '{"id": 2, "name": " \\t", "amount": null}',
    )
    staged = staging.enforce_max_error(staging.stage_lines(rows, STAGE))
    got = {r.id: (r.name, None if r.amount is None else int(r.amount)) for r in staged.collect()}
    assert got == {1: ("abc", 246), 2: (None, None)}
    kept = staging.stage_lines(rows, STAGE, decimal_mode="round", truncate_columns=False,
                               blanks_as_null=False)
    got = {r.id: (r.name, r.amount) for r in kept.collect()}
    assert got[1] == ("abcdef", 247) and got[2][0] == " \t"


def test_whole_numbers_may_be_written_as_doubles(spark):
    staged = staging.stage_lines(lines(spark, '{"id": 1.5E3}', '{"id": 338.0}', '{"id": "7"}'), STAGE)
    assert sorted(r.id for r in staging.enforce_max_error(staged).collect()) == [7, 338, 1500]


def test_exact_names_and_paths(spark):
    rows = lines(spark, '{"id": 1, "name": "a", "amount": "2.5", "in": {"x": "deep"}}',
                 '{"ID": 5, "id": 2}')
    exact = staging.enforce_max_error(staging.stage_lines(rows, STAGE, mapping="exact"))
    assert {(r.id, r.name) for r in exact.collect()} == {(1, "a"), (2, None)}
    by_path = staging.stage_lines(rows, STAGE, mapping=["$.id", "$.in.x", "$['amount']"])
    assert {(r.id, r.name) for r in by_path.collect()} == {(1, "dee"), (2, None)}
    with pytest.raises(ValueError):
        staging.stage_lines(rows, STAGE, mapping=["$.id"])


@pytest.mark.parametrize("mapping", ["auto", "exact"])
@pytest.mark.parametrize("bad", ["not json", '{"id": "x"}', '{"name": "a"}'])
def test_a_bad_line_stops_the_load(spark, bad, mapping):
    staged = staging.stage_lines(lines(spark, '{"id": 1}', bad), STAGE, mapping=mapping)
    with pytest.raises(Exception, match="could not be loaded"):
        staging.enforce_max_error(staged).select(F.lit(1)).collect()
    assert staging.enforce_max_error(staged, max_error=1).count() == 1
    with pytest.raises(ValueError):
        staging.enforce_max_error(
            staging.stage_lines(lines(spark, bad, bad), STAGE, mapping=mapping), max_error=1
        )


def test_invalid_bytes_are_replaced(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"id": 1, "name": "a\xffb"}\n')
    row = staging.stage_json(spark, str(tmp_path), STAGE, replace_invalid="?").first()
    assert row.name == "a?b"
    row = staging.stage_json(spark, str(tmp_path), STAGE).first()
    assert row.name == "a�b"


@pytest.mark.parametrize("mapping", ["auto", "exact", ["$.page", "$.ts"]])
def test_blank_lines_are_no_lines(spark, mapping):
    contract = TableContract("c", "page string, ts bigint")
    text = ['{"page": "a", "ts": 1}', "", "  \t", '{"page": "b"}', "\r", "{cut"]
    lines = spark.createDataFrame([(x,) for x in text], "value string")
    staged = staging.stage_lines(lines, contract, mapping=mapping)
    assert sorted((r.page, r.ts, r._bad) for r in staged.collect() if r.page) == [
        ("a", 1, False), ("b", None, False)]
    assert staged.count() == 3 and staged.where("_bad").count() == 1


def test_arrival_order_follows_files_and_lines(spark, tmp_path):
    (tmp_path / "z.json").write_text("".join(json.dumps({"page": f"z{i}"}) + "\n" for i in range(50)))
    os.utime(tmp_path / "z.json", (1_000_000_000, 1_000_000_000))
    (tmp_path / "a.json").write_text("".join(json.dumps({"page": f"a{i}"}) + "\n" for i in range(50)))
    rows = files.scan_json(spark, str(tmp_path), PLAY_LOG, arrival=True)
    got = [r.page for r in rows.orderBy(files.ARRIVAL).collect()]
    assert got == [f"z{i}" for i in range(50)] + [f"a{i}" for i in range(50)]
    staged = staging.stage_json(
        spark, str(tmp_path), TableContract("c", "page string"), mapping="exact", arrival=True)
    assert [r.page for r in staged.orderBy(files.ARRIVAL).collect()] == got
