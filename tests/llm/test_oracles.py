"""The queries of the subpackage that have an SQL twin, and the plans of those without Python."""

import re

import pytest

from starloom.llm.queries import ORACLES, QUERIES
from tests.oracle import _norm, _sort_key, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_twin(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in columns) for r in df.collect()), key=_sort_key)
    want = sorted((tuple(map(_norm, r)) for r in result.fetchall()), key=_sort_key)
    assert got == want and got


@pytest.mark.parametrize("name", [
    "op3_mix_curriculum", "op5_pii_surrogates", "op7_chat_reply_trees", "op10_scaled_sketch",
])
def test_no_python_in_native_queries(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
