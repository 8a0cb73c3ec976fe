"""Merge policies: sequential semantics, idempotence, independence of partitioning."""

import math

from hypothesis import HealthCheck, given, settings, strategies as st

from starloom.operators import merge

SCHEMA = "k int, o int, name string, year int"
ROWS = st.lists(
    st.tuples(
        st.integers(0, 3), st.integers(0, 50), st.sampled_from(["a", "b", "", None]),
        st.sampled_from([0, 0, 1999, 2004]),
    ),
    min_size=1, max_size=14, unique_by=lambda r: (r[0], r[1]),
)
QUICK = settings(max_examples=8, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def replay(rows, step):
    """Apply row by row in order, as an upsert does."""
    state = {}
    for k, _, name, year in sorted(rows, key=lambda r: r[1]):
        state[k] = step(state.get(k), (name, year))
    return sorted(((k, *v) for k, v in state.items()), key=str)


@QUICK
@given(ROWS)
def test_last_wins(spark, rows):
    got = result(merge.last_wins(frame(spark, rows), ["k"], ["o"]))
    assert got == replay(rows, lambda old, new: new)


@QUICK
@given(ROWS)
def test_insert_ignore(spark, rows):
    got = result(merge.insert_ignore(frame(spark, rows), ["k"], ["o"]))
    assert got == replay(rows, lambda old, new: old or new)


@QUICK
@given(ROWS)
def test_fill_zero(spark, rows):
    def step(old, new):
        if old is None:
            return new
        return (old[0], new[1]) if old[1] == 0 and new[1] > 0 else old

    got = result(merge.fill_zero(frame(spark, rows), ["k"], ["o"]))
    assert got == replay(rows, step)


@QUICK
@given(ROWS)
def test_coalesce(spark, rows):
    def step(old, new):
        name = new[0] or None
        return (name if old is None or name else old[0], (old or new)[1])

    got = result(merge.coalesce_newest(frame(spark, rows), ["k"], ["o"], keep=["year"]))
    assert got == replay(rows, step)


@QUICK
@given(ROWS, st.integers(0, 50))
def test_two_batches_equal_one(spark, rows, cut):
    """A stored table and a later batch give what one batch gives, and again is the same."""
    early = [r for r in rows if r[1] < cut]
    late = [r for r in rows if r[1] >= cut]
    if not early or not late:
        return
    for policy in (merge.last_wins, merge.fill_zero):
        target = policy(frame(spark, early, 1), ["k"], ["o"])
        merged = policy(frame(spark, late, 2), ["k"], ["o"], target=target)
        assert result(merged) == result(policy(frame(spark, rows), ["k"], ["o"]))
        again = policy(frame(spark, late, 4), ["k"], ["o"], target=merged)
        assert result(again) == result(merged)


def test_equal_order_does_not_depend_on_partitioning(spark):
    rows = [(1, 5, n, y) for n, y in (("a", 1), ("c", 2), ("b", 3))]
    seen = {tuple(result(merge.last_wins(frame(spark, rows, p), ["k"], ["o"]))) for p in (1, 2, 3)}
    assert len(seen) == 1


def test_nan_and_blank_do_not_overwrite(spark):
    rows = [(1, 1, "x", 1.5), (1, 2, "  ", math.nan), (1, 3, None, None)]
    df = spark.createDataFrame(rows, "k int, o int, place string, latitude double")
    assert result(merge.coalesce_newest(df, ["k"], ["o"], keep=[])) == [(1, "x", 1.5)]


def test_target_with_order_columns_lets_batches_come_in_any_order(spark):
    new = spark.createDataFrame([(1, 9, "new")], "k int, o int, v string")
    old = spark.createDataFrame([(1, 3, "old")], "k int, o int, v string")
    stored = merge.last_wins(new, ["k"], ["o"], keep_order=True)
    merged = merge.last_wins(old, ["k"], ["o"], target=stored, keep_order=True)
    assert [r.v for r in merged.collect()] == ["new"]


def test_insert_ignore_against_a_target(spark):
    target = spark.createDataFrame([(1, "stored")], "k int, v string")
    batch = spark.createDataFrame([(1, 1, "late"), (2, 2, "b"), (2, 1, "a")], "k int, o int, v string")
    assert result(merge.insert_ignore(batch, ["k"], ["o"], target)) == [(2, "a")]
