import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quality_lake import ContractError
from quality_lake.operators import count_copies, drop_copies
from quality_lake.operators.membership import bitmap_words, key_hash, with_membership
from tests.conftest import plan_text

SCHEMA = "a int, b string, c double, d array<double>, e struct<x:int,y:float>, f binary"
value = st.tuples(st.sampled_from([None, 0, 1]), st.sampled_from([None, "", "a"]), st.sampled_from([None, 0.0, -0.0, float("nan"), 1.5]),
                  st.sampled_from([None, [], [0.0], [-0.0], [float("nan")], [None]]), st.sampled_from([None, (1, 0.0), (1, -0.0), (None, None)]),
                  st.sampled_from([None, b"", b"\x00"]))


def plain(df):
    """Rows as Spark groups them, as text (a zero's sign left out)."""
    return sorted(str(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


@given(st.lists(value, max_size=25))
@settings(max_examples=15, deadline=None)
def test_both_forms_agree_with_grouping(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")))
    assert plain(count_copies(df, by="rows")) == want
    assert plain(count_copies(df, by="digest")) == want


def test_collisions_cost_time_and_nothing_else(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("a"), F.lit("x").alias("b"))
    same = F.lit(7).cast("long"), F.lit(7).cast("long")  # every digest collides
    for digest, bits in ((same, 64), (None, 64), (None, 1 << 26)):
        got = count_copies(df, by="digest", digest=digest, bits=bits)
        assert got.count() == 100 and got.filter("copies = 3").count() == 100
    assert drop_copies(df.limit(0)).count() == 0
    with pytest.raises(ContractError, match="form of dedup"):
        count_copies(df, by="x")
    with pytest.raises(ContractError, match="already has"):
        count_copies(df, "a")


def test_rows_without_copies_are_not_shuffled(spark, tmp_dir):
    wide = spark.range(4000).select("id", *[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 512).alias(f"c{i}") for i in range(6)])
    wide.unionByName(wide.filter("id % 40 = 0")).write.parquet(f"{tmp_dir}/w")
    df = spark.read.parquet(f"{tmp_dir}/w")
    out = drop_copies(df)
    assert out.count() == 4000
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

    digest, rows = drop_copies(df, by="digest"), drop_copies(df, by="rows")
    for f in (digest, rows):
        f.collect()
    assert moved_bytes(spark, digest) < 0.25 * moved_bytes(spark, rows)


def moved_bytes(spark, df):
    """Bytes that the shuffles of one run of ``df`` wrote, from its executed plan's metrics."""
    total, todo, seen = 0, [df._jdf.queryExecution().executedPlan()], set()
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "Exchange" and node.id() not in seen:
                seen.add(node.id())
                total += node.metrics().apply("shuffleBytesWritten").value()
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_membership_never_loses_a_key(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k"), key_hash(F.col("id")).alias("h"))
    facts = spark.range(9000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"))
    hashed = F.when(F.col("k").isNotNull(), key_hash(F.col("k")))
    for bits, most in ((64, 9000), (1 << 12, 9000), (1 << 26, 1010)):
        words = bitmap_words(keys, "h", bits)
        assert words.count() <= bits // 64
        marked = with_membership(facts, hashed, words, "may", bits)
        assert marked.count() == 9000 and marked.filter("k is null and may").count() == 0
        assert marked.filter("may").join(keys, "k").count() == facts.join(keys, "k").count()
        assert marked.filter("may").count() <= most
