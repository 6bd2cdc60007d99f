import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from quality_lake import ContractError
from quality_lake.operators import (
    add_generated_key,
    assert_primary_key,
    key_stats,
    key_violations,
    observed_key_stats,
)


def test_generated_key_payload(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "null")], "x int, y string, z string")
    got = [r.k for r in add_generated_key(df, "k", ["x", "y", "z"]).collect()]
    assert got[0] == hashlib.sha256(b'{"x":1,"y":"a","z":null}').hexdigest()
    assert got[0] != got[1]  # null vs the text "null"
    swapped = add_generated_key(df, "k", ["y", "x", "z"]).first().k
    assert swapped != got[0]  # column order is part of the identity


def test_generated_key_ntz_and_errors(session_modes):
    spark = session_modes
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    got = add_generated_key(df, "k", ["t"]).first().k
    assert got == hashlib.sha256(b'{"t":"2024-03-10T02:30:00.000"}').hexdigest()
    with pytest.raises(ContractError):
        add_generated_key(df, "t", ["t"])
    with pytest.raises(ContractError):
        add_generated_key(df, "k", [])
    with pytest.raises(ContractError):
        add_generated_key(df, "k", ["nope"])


def test_key_stats_counts(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, " "), (4, "d")]
    df = spark.createDataFrame(rows, "k1 int, k2 string")
    s = key_stats(df, ["k1", "k2"]).first().asDict()
    # missing: (None,c) x2 and (3,' ') x1; duplicates: (1,a) x3 and (None,c) x2
    assert s == {"missing_key_rows": 3, "duplicate_key_groups": 2, "duplicate_key_rows": 3}
    assert key_violations(df, ["k1", "k2"]).count() == 3
    with pytest.raises(ContractError, match="does not identify rows"):
        assert_primary_key(df, ["k1", "k2"])


def test_key_stats_nan_and_empty(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert key_stats(df, ["v"]).first().missing_key_rows == 1
    empty = df.limit(0)
    assert key_stats(empty, ["v"]).first().asDict() == {
        "missing_key_rows": 0, "duplicate_key_groups": 0, "duplicate_key_rows": 0}
    assert assert_primary_key(empty, ["v"])["duplicate_key_rows"] == 0


def test_observed_key_stats_match_the_frame(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b"), (2, " "), (3, "c")],
                               "k long, s string")
    assert observed_key_stats(df, ["k", "s"]) == key_stats(df, ["k", "s"]).first().asDict() == {
        "missing_key_rows": 2, "duplicate_key_groups": 1, "duplicate_key_rows": 2}
    empty = df.filter(F.lit(False))
    assert observed_key_stats(empty, ["k"]) == {
        "missing_key_rows": 0, "duplicate_key_groups": 0, "duplicate_key_rows": 0}
