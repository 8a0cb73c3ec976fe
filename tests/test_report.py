"""Checks of a star: made once, before its tables get their names."""

from starloom.contracts import PLAY_LOG
from starloom.operators import quality
from starloom.operators.tables import write_json
from starloom.plans import plays
from tests.test_plays import T0, catalog, event, events  # noqa: F401

DAY = 24 * 3600 * 1000


def test_the_report_of_a_star_is_made_once(spark, events, catalog, tmp_path, monkeypatch):
    made, whole = [], plays.star_report
    monkeypatch.setattr(plays, "star_report", lambda *a: made.append(1) or whole(*a))
    write_json(events.where("userId <> ''"), f"{tmp_path}/log")
    write_json(catalog, f"{tmp_path}/songs")
    reports = []
    plays.run_play_star(spark, f"{tmp_path}/log", f"{tmp_path}/songs", f"{tmp_path}/out", reports=reports)
    assert len(made) == len(reports) == 1
    found = sorted(tuple(r) for r in reports[0].collect())
    assert found == sorted((t, c, 0) for t, c in plays.report_names(plays.DEFAULT))


def test_gathered_times_are_shuffled_once(spark):
    times = [None, *[T0 + d * DAY + ms for d in range(70) for ms in (0, 1, 999, 1000)]]
    log = spark.createDataFrame([tuple(event(ts).values()) for ts in times], PLAY_LOG.schema)
    apart, together = plays.build_times(log), plays.build_times(log, gathered=True)
    assert sorted(apart.collect()) == sorted(together.collect()) and together.count() == 140
    text = plays.build_times(log, gathered=True)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "hashpartitioning(year" in text


def test_a_parent_that_has_a_value_twice_hides_no_orphan(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    report = quality.foreign_key(child, "k", parent, "k")
    assert [tuple(r) for r in report.collect()] == [("foreign_key:k", 2)]
    none = quality.foreign_key(child.where("k < 3"), "k", parent, "k")
    assert [tuple(r) for r in none.collect()] == [("foreign_key:k", 0)]
    # the parent is not made distinct before it is joined
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
