import pytest

from pyspark.sql import functions as F

from quality_lake.operators.report import compare_results, diff_results, sorted_result, unequal_buckets
from tests.conftest import plan_text

NAN, INF = float("nan"), float("inf")


def side(spark, rows):
    return spark.createDataFrame(rows, "k int, v double")


@pytest.mark.parametrize("a,b,same", [
    (1.0, 1.0 + 1e-10, True), (1.0, 1.001, False), (0.0, 5e-8, True), (INF, INF, True), (INF, 1.0, False), (INF, -INF, False),
    (NAN, 1.0, False), (1.0, NAN, False), (NAN, NAN, False), (NAN, INF, False), (None, None, True), (None, 1.0, False), (NAN, None, False)])
def test_values_agree_or_not(spark, a, b, same):
    assert compare_results(side(spark, [(1, a)]), side(spark, [(1, b)]), ["k"]).first().matches is same


def test_repeated_and_missing_keys_never_match(spark):
    one, two = side(spark, [(1, 2.0), (None, 3.0)]), side(spark, [(1, 2.0), (1, 2.0), (None, 3.0)])
    for a, b in ((one, two), (two, one), (two, two)):
        assert [r.k for r in diff_results(a, b, ["k"]).collect()] == [1]
    assert diff_results(one, one, ["k"]).isEmpty()
    assert [r.k for r in diff_results(one, side(spark, [(1, 2.0)]), ["k"]).collect()] == [None]
    with pytest.raises(ValueError):
        compare_results(one, one.withColumnRenamed("v", "w"), ["k"])


def test_sorted_result_orders_by_text(spark):
    assert [r.k for r in sorted_result(side(spark, [(10, 1.0), (9, 1.0), (2, 1.0)])).collect()] == [10, 2, 9]


def _sides(spark, n=400):
    i = F.col("id")
    base = spark.range(0, n, 1, 3).select(i.alias("k"), F.concat(F.lit("s"), i % 7).alias("s"), (i / 3).alias("x"), F.array(i, i + 1).alias("a"))
    return base, base.repartition(5).select("x", "a", "s", "k")


def _diff(left, right, **options):
    return sorted(r["k"] for r in diff_results(left, right, ["k"], **options).collect())


def test_equal_results_are_never_joined(spark):
    left, right = _sides(spark)
    assert unequal_buckets(left, right, ["k"]) == []
    out = diff_results(left, right, ["k"])
    assert out.count() == 0 and out.columns == ["k", "left_s", "right_s", "left_x", "right_x", "left_a", "right_a", "matches"]
    assert "Join" not in plan_text(out)


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_differing_buckets_are_compared_row_by_row(spark, buckets):
    left, right = _sides(spark)
    k = F.col("k")
    changed = right.withColumn("x", F.when(k == 5, F.col("x") + 1e-12).when(k == 6, F.col("x") + 1).otherwise(F.col("x")))
    changed = changed.withColumn("s", F.when(k == 9, F.lit(None)).otherwise(F.col("s"))).filter("k <> 11")
    changed = changed.unionByName(right.filter("k = 13")).unionByName(right.filter("k = 14").withColumn("k", F.lit(1000).cast("long")))
    want = sorted(r["k"] for r in compare_results(left, changed, ["k"]).filter("not matches").collect())
    assert _diff(left, changed, buckets=buckets) == want == [6, 9, 11, 13, 1000]
    if buckets == 4096:  # only what differs is read again
        assert 5 <= len(unequal_buckets(left, changed, ["k"])) <= 7


def test_what_equal_sums_must_not_hide(spark):
    """A NaN on both sides, a key that stands twice on both sides, and two rows that swapped their values."""
    rows = [(1, 1.0), (2, float("nan")), (3, 2.0), (3, 2.0), (4, 7.0), (5, 8.0), (None, 0.0)]
    left = spark.createDataFrame(rows, "k int, x double")
    assert [r["k"] for r in diff_results(left, left, ["k"]).orderBy("k").collect()] == [2, 3]
    swapped = left.withColumn("x", F.when(F.col("k") == 4, 8.0).when(F.col("k") == 5, 7.0).otherwise(F.col("x")))
    assert sorted(r["k"] for r in diff_results(left, swapped, ["k"]).collect()) == [2, 3, 4, 5]
    zero = left.withColumn("x", F.when(F.col("x") == 0, F.lit(-0.0)).otherwise(F.col("x")))
    assert sorted(r["k"] for r in diff_results(left, zero, ["k"]).collect()) == [2, 3]
    assert diff_results(left.limit(0), left.limit(0), ["k"]).count() == 0
    assert diff_results(left.filter("k = 1"), left.limit(0), ["k"]).count() == 1
    wider = left.withColumn("k", F.col("k").cast("long"))
    assert sorted(r["k"] for r in diff_results(left, wider, ["k"]).collect()) == [2, 3]
