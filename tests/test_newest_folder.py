"""The newest time from the newest folder that has one."""

from pyspark.sql import functions as F

from starloom.operators.cleaning import latest_window, newest_month
from starloom.operators.tables import write_table


def test_one_month_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    times = [f"2018-{m:02d}-{d:02d} 10:00:00" for m in (9, 10, 11) for d in (1, 30)]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    rows = rows.withColumns({"year": F.year("ts"), "month": F.month("ts")})
    # the newest folder holds no time, and one beside it no row
    empty = spark.createDataFrame([(None, 2019, 1)], "ts timestamp_ntz, year int, month int")
    write_table(rows.unionByName(empty), path, ["year", "month"])
    (tmp_path / "t" / "year=2019" / "month=2").mkdir()
    stored = spark.read.schema(empty.schema).parquet(path)
    assert newest_month(stored, "ts", path) == (2018, 11)
    week = latest_window(stored, "ts", "31 days", path=path)
    assert sorted(str(r.ts)[:10] for r in week.collect()) == ["2018-10-30", "2018-11-01", "2018-11-30"]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = week._jdf.queryExecution().explainString(mode)
    subqueries = [p.split("\n")[0] for p in plan.split("PartitionFilters: ")[1:] if "(year#" in p.split("\n")[0]]
    assert any("= 2018)" in p and "= 11)" in p for p in subqueries)


def test_no_times(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "ts timestamp_ntz, year int, month int"
    write_table(spark.createDataFrame([(None, 2019, 1)], schema), path, ["year", "month"])
    stored = spark.read.schema(schema).parquet(path)
    assert newest_month(stored, "ts", path) is None
    assert latest_window(stored, "ts", path=path).collect() == []
    assert newest_month(stored, "ts", str(tmp_path / "nowhere")) is None
