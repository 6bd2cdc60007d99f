"""Property tests (hypothesis) over small frames."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quality_lake.operators import add_generated_key, join_context, key_stats, sorted_result

small_rows = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])),
                      min_size=0, max_size=15)


@settings(max_examples=6, deadline=None)
@given(small_rows)
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    once = df.dropDuplicates()
    assert sorted(map(tuple, once.collect()), key=str) == \
        sorted(map(tuple, once.dropDuplicates().collect()), key=str)
    assert once.count() == len(set(rows))


@settings(max_examples=6, deadline=None)
@given(small_rows, st.lists(st.integers(0, 4), min_size=1, max_size=6))
def test_context_join_preserves_rows_iff_keys_unique(spark, facts, ctx_keys):
    f = spark.createDataFrame(facts, "k int, v string")
    c = spark.createDataFrame([(k, str(k)) for k in ctx_keys], "ck int, label string")
    joined = join_context(f, c, {"k": "ck"}, ["label"], "ctx")
    unique = key_stats(c, ["ck"]).first().duplicate_key_groups == 0
    fact_keys = {k for k, _ in facts}
    dup_hit = any(ctx_keys.count(k) > 1 for k in fact_keys)
    assert (joined.count() == len(facts)) == (unique or not dup_hit)


def test_key_hash_order_null_and_precision(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1, 0, 0, 0, 179575)),
                                (1, "null", dt.datetime(2024, 1, 1, 0, 0, 0, 179999))],
                               "a int, b string, t timestamp_ntz")
    ms = [r.k for r in add_generated_key(df.select("a", "t"), "k", ["a", "t"]).collect()]
    assert ms[0] == ms[1]  # default NTZ text keeps milliseconds only
    us = [r.k for r in add_generated_key(df.select("a", "t"), "k", ["a", "t"],
                                         timestamp_ntz_format="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").collect()]
    assert us[0] != us[1]
    assert us[0] == hashlib.sha256(b'{"a":1,"t":"2024-01-01T00:00:00.179575"}').hexdigest()
    nulls = [r.k for r in add_generated_key(df, "k", ["a", "b"]).collect()]
    assert nulls[0] != nulls[1]


def test_sorted_result_orders_by_text_of_first_column(spark):
    df = spark.createDataFrame([(10, "x"), (9, "y"), (None, "z")], "n int, s string")
    assert [r.n for r in sorted_result(df).collect()] == [None, 10, 9]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \ta", max_size=4)), min_size=1, max_size=20))
def test_blank_text_agrees_with_trim(spark, values):
    from pyspark.sql import functions as F

    from quality_lake.functions import blank_text
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(blank_text(F.col("s")).alias("a"), (F.trim("s") == "").alias("b")).collect()
    assert all(r.a == r.b for r in got)
