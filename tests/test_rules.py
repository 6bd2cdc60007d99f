import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quality_lake import ContractError
from quality_lake.operators import apply_rules, explain_rejects

NAN, INF = float("nan"), float("inf")


def kept(df):
    out = []
    for r in df.collect():
        v = r.v
        out.append("nan" if v is not None and math.isnan(v) else v)
    return sorted(out, key=str)


@pytest.mark.parametrize("rule,expected", [
    ({"rule": "finite"}, [1.0, None]),
    ({"rule": "minimum", "value": 0}, [1.0, INF, "nan", None]),
    ({"rule": "maximum", "value": 100}, [1.0, None]),
    ({"rule": "between", "minimum": 0, "maximum": 100}, [1.0, None]),
    ({"rule": "not_null"}, [1.0, INF, "nan"]),
])
def test_null_nan_matrix(session_modes, rule, expected):
    spark = session_modes
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (INF,)], "v double")
    got = kept(apply_rules(df, [{**rule, "column": "v"}]))
    assert got == sorted(expected, key=str)


def test_not_null_blank_strings(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("",), (None,), ("\t",)], "s string")
    got = sorted(r.s for r in apply_rules(df, [{"rule": "not_null", "column": "s"}]).collect())
    assert got == ["\t", "a"]


def test_after_or_equal_and_unknown(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 2)], "a int, b int")
    assert sorted(r.a or 0 for r in apply_rules(
        df, [{"rule": "after_or_equal", "column": "b", "other_column": "a"}]).collect()) == [0, 1]
    with pytest.raises(ContractError):
        apply_rules(df, [{"rule": "unique", "column": "a"}])
    with pytest.raises(ContractError):
        apply_rules(df, [{"rule": "finite", "column": "zz"}])


def test_rules_compile_to_one_filter(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = apply_rules(df, [{"rule": "finite", "column": "a"}, {"rule": "minimum", "column": "b", "value": 0}])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=32)),
                min_size=0, max_size=20))
def test_kept_plus_rejected_is_input(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    rules = [{"rule": "finite", "column": "v"}, {"rule": "between", "column": "v", "minimum": -5, "maximum": 5}]
    kept_ids = {r.id for r in apply_rules(df, rules).collect()}
    rejected_ids = {r.id for r in explain_rejects(df, rules).collect()}
    assert kept_ids.isdisjoint(rejected_ids)
    assert kept_ids | rejected_ids == set(range(len(values)))
