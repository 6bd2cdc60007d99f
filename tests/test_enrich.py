import re

import pytest
from pyspark.sql import functions as F

from quality_lake import ContractError
from quality_lake.operators import (
    JoinSpec,
    assert_unique_context_key,
    enrich,
    hourly_summary,
    join_context,
    match_rates,
    restrict_to,
)
from quality_lake.operators.enrich import heavy_hashes
from tests.conftest import plan_text


@pytest.fixture
def frames(spark, tmp_dir):
    # Real scans (not local relations), so plans show the join strategy.
    facts = spark.createDataFrame(
        [(i, i % 5 if i % 7 else None, i % 3) for i in range(200)], "id long, zone int, other int")
    zones = spark.createDataFrame([(z, f"Z{z}", f"B{z % 2}") for z in range(4)],
                                  "location_id int, zone string, borough string")
    facts.write.parquet(tmp_dir + "/facts")
    zones.write.parquet(tmp_dir + "/zones")
    return spark.read.parquet(tmp_dir + "/facts"), spark.read.parquet(tmp_dir + "/zones")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_broadcast_and_shuffle_fallback_agree(spark, frames):
    facts, zones = frames
    b = join_context(facts, zones, {"zone": "location_id"}, ["zone", "borough"], "pickup")
    assert b.columns == ["id", "zone", "other", "pickup_zone", "pickup_borough"]
    assert "BroadcastHashJoin" in plan_text(b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = join_context(facts, zones, {"zone": "location_id"}, ["zone", "borough"], "pickup",
                         broadcast=False, heavy_share=None, member_filter=False)
        plan = plan_text(s)
        assert "SortMergeJoin" in plan
        # facts without a key do not shuffle: they are appended
        assert "Union" in plan and re.search(r"Filter isnotnull\(zone#\d+\)", plan) and re.search(r"Filter isnull\(zone#\d+\)", plan)
        srows = _rows(s)
        for options in ({}, {"heavy_share": None}, {"member_filter": False}, {"heavy_share": 0.5}, {"max_broadcast_rows": 0}):
            assert srows == _rows(join_context(facts, zones, {"zone": "location_id"}, ["zone", "borough"], "pickup", broadcast=False, **options))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert _rows(b) == srows
    assert b.count() == facts.count()
    assert b.filter(F.col("zone").isNull()).filter(F.col("pickup_zone").isNotNull()).count() == 0


def test_size_check_falls_back(frames):
    facts, zones = frames
    chosen = {}
    small_limit = join_context(facts, zones, {"zone": "location_id"}, ["zone"], "p",
                               broadcast=True, max_broadcast_rows=2, strategies=chosen)
    assert chosen == {"p": "shuffle"} and "SortMergeJoin" in plan_text(small_limit)
    assert small_limit.count() == facts.count()
    join_context(facts, zones, {"zone": "location_id"}, ["zone"], "p", strategies=chosen)
    assert chosen == {"p": "broadcast"}


def test_size_is_measured_not_assumed(spark, frames):
    from quality_lake.operators.enrich import broadcast_fits, measure
    facts, zones = frames
    wide = zones.withColumn("zone", F.repeat(F.lit("x"), 100_000))
    rows, size = measure(wide)
    assert rows == 4 and size > 400_000
    assert broadcast_fits(zones, max_bytes=100_000) and not broadcast_fits(wide, max_bytes=100_000)
    chosen = {}
    enrich(facts, {"zones": wide}, [JoinSpec("zones", {"zone": "location_id"}, ("zone",), "p")],
           max_broadcast_bytes=100_000, strategies=chosen)
    assert chosen == {"p": "shuffle"}
    # columns that the join does not use do not count
    enrich(facts, {"zones": wide}, [JoinSpec("zones", {"zone": "location_id"}, ("borough",), "p")],
           max_broadcast_bytes=100_000, strategies=chosen)
    assert chosen == {"p": "broadcast"}


def test_shuffle_join_takes_any_column_and_reads_only_what_is_used(spark, frames, tmp_dir):
    facts, zones = frames
    mapped = facts.withColumn("tags", F.create_map(F.lit("k"), F.col("id")))
    mapped.write.parquet(tmp_dir + "/mapped")
    mapped = spark.read.parquet(tmp_dir + "/mapped")
    forms = [join_context(mapped, zones, {"zone": "location_id"}, ["zone"], "p", broadcast=b, marker=True) for b in (True, False)]
    a, b = ({r.id: (r.zone, r.other, r.tags, r.p_zone, r.p_matched) for r in f.collect()} for f in forms)
    assert len(a) == 200 and a == b
    narrow = forms[1].select("id", "p_zone")
    assert "tags" not in re.findall(r"ReadSchema: (struct<[^\n]*)", plan_text(narrow))[0]
    assert "other" not in plan_text(narrow)


def test_chain_keys_on_earlier_output_and_projection(spark, frames):
    facts, zones = frames
    boroughs = spark.createDataFrame([("B0", "zero"), ("B1", "one")], "borough string, label string")
    joins = [JoinSpec("zones", {"zone": "location_id"}, ("zone", "borough"), "pickup",
                      match_column="zone", output_columns=("zone",)),
             JoinSpec("boroughs", {"pickup_borough": "borough"}, ("label",), "area", match_column="label")]
    out = enrich(facts, {"zones": zones, "boroughs": boroughs}, joins)
    assert out.columns == ["id", "zone", "other", "pickup_zone", "area_label"]
    m = match_rates(out, {"pickup": "pickup_zone", "area": "area_label"}).first()
    expected = facts.filter(F.col("zone").between(0, 3)).count()
    assert (m.rows, m.pickup_matches, m.area_matches) == (200, expected, expected)


def test_name_clash_and_duplicate_context(spark, frames):
    facts, zones = frames
    once = join_context(facts, zones, {"zone": "location_id"}, ["zone"], "p")
    with pytest.raises(ContractError, match="already have columns"):
        join_context(once, zones, {"zone": "location_id"}, ["zone"], "p")
    with pytest.raises(ContractError, match="no such join"):
        join_context(facts, zones, {"zone": "location_id"}, ["nothing"], "p")
    dup = zones.unionByName(zones.limit(1))
    with pytest.raises(ContractError, match="duplicate keys"):
        assert_unique_context_key(dup, ["location_id"])
    # null context keys never match, so they do not break row preservation
    assert_unique_context_key(zones.unionByName(
        spark.createDataFrame([(None, "n", "n"), (None, "m", "m")], zones.schema)), ["location_id"])


def test_restrict_to_and_hourly_summary(spark):
    import datetime as dt
    sensors = spark.createDataFrame([
        ("36", "081", dt.datetime(2024, 11, 3, 5, 30), 1.0, "PM2.5"),
        ("36", "081", dt.datetime(2024, 11, 3, 6, 30), 3.0, "PM2.5"),
        ("36", "081", None, 100.0, "PM2.5"),
        ("36", "999", dt.datetime(2024, 11, 3, 6, 30), 9.0, "PM2.5"),
        (None, "081", dt.datetime(2024, 11, 3, 6, 30), 9.0, "PM2.5")],
        "state_code string, county_code string, timestamp_gmt timestamp_ntz, m double, p string")
    zones = spark.createDataFrame([("36", "081"), ("36", "081"), ("34", "013")], "state_code string, county_code string")
    kept = restrict_to(sensors, zones, ["state_code", "county_code"])
    assert kept.count() == 3
    s = hourly_summary(kept, ["state_code", "county_code"], "timestamp_gmt", "America/New_York", "m", ["p"])
    rows = [tuple(r) for r in s.collect()]
    assert rows == [("36", "081", dt.datetime(2024, 11, 3, 1), 2.0, "PM2.5")]


def test_enrich_rejects_duplicate_context_keys(frames):
    facts, zones = frames
    joins = [JoinSpec("zones", {"zone": "location_id"}, ("zone",), "pickup")]
    with pytest.raises(ContractError, match="duplicate keys"):
        enrich(facts, {"zones": zones.unionByName(zones)}, joins)
    # the same context in two roles is profiled once and joined twice
    two = joins + [JoinSpec("zones", {"other": "location_id"}, ("borough",), "other")]
    out = enrich(facts, {"zones": zones}, two)
    assert out.columns[-2:] == ["pickup_zone", "other_borough"]
    assert plan_text(out).count("BroadcastHashJoin") == 2


def test_match_marker_separates_null_columns_from_no_match(spark, frames):
    facts, zones = frames
    zones = zones.withColumn("zone", F.when(F.col("location_id") == 1, None).otherwise(F.col("zone")))
    out = join_context(facts, zones, {"zone": "location_id"}, ["zone"], "p", marker=True)
    got = {(r.zone, r.p_zone is None, r.p_matched) for r in out.collect()}
    assert (1, True, True) in got        # matched, but the match column is null
    assert (4, True, False) in got       # no context row
    assert (None, True, False) in got    # null key never matches


def test_shuffle_fallback_splits_a_hot_key(spark, tmp_dir):
    # A third of the fact rows share one key and a tenth have none.  In the
    # shuffle join the null keys take no part, and AQE's skew-join handling cuts
    # the hot key's partition into several tasks; every row keeps its match.
    n = 30_000
    i = F.col("id")
    zone = (F.when(i % 3 == 0, F.lit(7)).when(i % 10 == 1, F.lit(None))
            .otherwise((i % 500).cast("int")).cast("int"))
    spark.range(n, numPartitions=4).select(i, zone.alias("zone")).write.parquet(tmp_dir + "/hot_f")
    spark.range(500).select(i.cast("int").alias("location_id"),
                            F.concat(F.lit("Z"), i).alias("zname")).write.parquet(tmp_dir + "/hot_z")
    facts, zones = spark.read.parquet(tmp_dir + "/hot_f"), spark.read.parquet(tmp_dir + "/hot_z")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        j = join_context(facts, zones, {"zone": "location_id"}, ["zname"], "p", broadcast=False, heavy_share=None)
        got = j.agg(F.count(F.lit(1)).alias("rows"), F.count("p_zname").alias("matched"),
                    F.count_if(F.col("p_zname") != F.concat(F.lit("Z"), F.col("zone"))).alias("wrong"))
        r = got.collect()[0]  # runs this frame's own plan, so its final form is inspectable
        assert "skew=true" in plan_text(got)
    finally:
        for k in conf:
            spark.conf.unset(k)
    nulls = facts.filter(F.col("zone").isNull()).count()
    assert (r.rows, r.matched, r.wrong) == (n, n - nulls, 0)


def test_profiles_of_several_contexts_in_one_job(spark, frames):
    from quality_lake.operators.enrich import context_profiles, row_count
    facts, zones = frames
    empty = zones.filter(F.lit(False))
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    got = context_profiles([(zones, ["location_id"]), (empty, ["location_id"]),
                            (zones.unionByName(zones.limit(1)), ["location_id"]), (nulls, ["k"]),
                            (facts, ["zone", "other"])])
    # null keys never match, so two null-key rows do not count as a repeat
    assert [g[:2] for g in got[:4]] == [(4, 1), (0, 0), (5, 2), (3, 1)]
    assert got[0][2] == 4 * (24 + 8 * 3 + 4) and got[1][2] == 0
    per_key = facts.filter(F.col("zone").isNotNull()).groupBy("zone", "other").count()
    assert got[4][:2] == (200, per_key.agg(F.max("count")).first()[0])
    assert context_profiles([]) == []
    assert (row_count(facts), row_count(empty)) == (200, 0)
    # the empty projection keeps an aggregate's grouping: groups are counted, not input rows
    assert row_count(facts.select("zone").distinct()) == 6
    assert row_count(facts.groupBy("other").count()) == 3


def test_a_heavy_key_is_broadcast_and_not_shuffled(spark, tmp_dir):
    """A third of all facts on one key, AQE off: no task of the join gets over twice the median."""
    n, i = 40_000, F.col("id")
    spark.range(n, numPartitions=4).select(i, F.when(i % 3 == 0, F.lit(7)).otherwise((i * 7919) % 900).cast("int").alias("k")).write.parquet(f"{tmp_dir}/f")
    spark.range(800).select(i.alias("k"), F.concat(F.lit("Z"), i).alias("name")).write.parquet(f"{tmp_dir}/c")  # int joins bigint
    facts, ctx = spark.read.parquet(f"{tmp_dir}/f"), spark.read.parquet(f"{tmp_dir}/c")
    assert len(heavy_hashes(facts, F.xxhash64(F.col("k").cast("long")))) == 1
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        def tasks(**options):
            j = join_context(facts, ctx, {"k": "k"}, ["name"], "p", broadcast=False, **options)
            per_task = {r["t"]: r["count"] for r in j.groupBy(F.spark_partition_id().alias("t")).count().collect()}
            rows = j.agg(F.count(F.lit(1)), F.count("p_name"), F.count_if(F.col("p_name") != F.concat(F.lit("Z"), "k"))).first()
            joined = sorted(per_task.get(t, 0) for t in range(16))  # the merge join's partitions come first in the union
            return joined, tuple(rows)
        hot, want = tasks(heavy_share=None)
        even, got = tasks()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    median = lambda x: x[len(x) // 2]
    assert got == want == (n, facts.filter("k < 800").count(), 0)
    assert hot[-1] > 4 * median(hot) and even[-1] <= 2 * median(even) and sum(even) < 0.7 * n


def test_facts_that_cannot_match_are_not_shuffled(spark, tmp_dir):
    n, i = 20_000, F.col("id")
    spark.range(n, numPartitions=4).select(i, F.when(i % 10 == 0, i % 700).otherwise(i + 10**7).alias("k"), (i % 3).cast("string").alias("s")).write.parquet(f"{tmp_dir}/f")
    facts = spark.read.parquet(f"{tmp_dir}/f")
    ctx = spark.range(700).select(i.alias("k"), (i % 3).cast("string").alias("s"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for keys in ({"k": "k"}, {"k": "k", "s": "s"}):
            j = join_context(facts, ctx, keys, ["name"], "p", broadcast=False, heavy_share=None, marker=True)
            merged = [r["count"] for r in j.groupBy(F.spark_partition_id().alias("t")).count().orderBy("t").collect() if r["t"] < 8]
            assert j.count() == n and sum(merged) <= 0.12 * n  # nine tenths stay where they were read
            plain = join_context(facts, ctx, keys, ["name"], "p", broadcast=False, heavy_share=None, member_filter=False, marker=True)
            assert _rows(j) == _rows(plain)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_of_other_types_take_the_plain_way(spark):
    facts = spark.createDataFrame([("1",), ("x",), (None,)], "k string")
    ctx = spark.createDataFrame([(1, "one")], "k int, name string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = join_context(facts, ctx, {"k": "k"}, ["name"], "p", broadcast=False)
        assert sorted(str(tuple(r)) for r in got.collect()) == ["('1', 'one')", "('x', None)", "(None, None)"]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    floats = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "k double")
    names = spark.createDataFrame([(-0.0, "zero"), (float("nan"), "nan")], "k double, name string")
    for share in (None, 0.01):
        got = join_context(floats, names, {"k": "k"}, ["name"], "p", broadcast=False, heavy_share=share)
        assert sorted(str(r["p_name"]) for r in got.collect()) == ["None", "nan", "zero", "zero"]
