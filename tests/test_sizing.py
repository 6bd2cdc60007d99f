import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quality_lake.plans.layouts import ReportColumns, reconcile, write_layout
from quality_lake.plans.sizing import planned_files, sized_session, table_bytes
from quality_lake.sources import publish, read_table
from tests.conftest import plan_text


def _sizes(path, folder=""):
    return [os.path.getsize(f"{path}/{folder}/{f}") for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]


@pytest.fixture
def busy(spark):
    """Nine tenths of the rows in one month; 5 input partitions."""
    n, i = 20_000, F.col("id")
    month = F.when(i % 10 > 0, F.lit(3)).otherwise((i / 10 % 12 + 1).cast("int"))
    ts = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.pmod(i * 7919, F.lit(86400)).cast("int"))
    return spark.range(0, n, 1, 5).select(i, ts.alias("ts"), F.lit(2024).alias("y"), month.cast("int").alias("m"), F.sha2(i.cast("string"), 256).alias("t"))


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_a_month_with_most_rows_gets_most_files(spark, busy, tmp_dir, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        write_layout(busy, f"{tmp_dir}/t", ["y", "m"], cluster_by=["ts"], target_file_bytes=250_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    per_month = {m: _sizes(f"{tmp_dir}/t", f"y=2024/m={m}") for m in range(1, 13)}
    assert all(len(s) == 1 for m, s in per_month.items() if m != 3)  # whatever the session's partitions
    assert 8 <= len(per_month[3]) <= 16 and max(per_month[3]) < 2 * sorted(per_month[3])[len(per_month[3]) // 2]
    back = read_table(spark, f"{tmp_dir}/t")
    assert sorted(back.select("id").toPandas().id) == list(range(20_000))
    ranges = (back.filter("m = 3").groupBy(F.input_file_name().alias("f")).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("a").collect())
    assert all(x.b <= y.a for x, y in zip(ranges, ranges[1:]))  # files hold ranges of the time


def test_one_time_with_all_rows_is_spread(spark, tmp_dir):
    df = spark.range(0, 5000, 1, 4).select("id", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1).alias("m"))
    write_layout(df, f"{tmp_dir}/t", ["m"], cluster_by=["ts"], target_file_bytes=30_000)
    sizes = _sizes(f"{tmp_dir}/t", "m=1")
    assert len(sizes) >= 6 and max(sizes) < 3 * min(sizes) and read_table(spark, f"{tmp_dir}/t").count() == 5000
    same = df.select(F.lit(1).alias("a"), "m")  # equal rows, no order: spread by the task that read them
    write_layout(same, f"{tmp_dir}/u", ["m"], cluster_by=["ts"], target_file_bytes=30_000)
    assert 2 <= len(_sizes(f"{tmp_dir}/u", "m=1")) and read_table(spark, f"{tmp_dir}/u").count() == 5000


def test_layouts_without_partitions_null_keys_and_no_rows(spark, busy, tmp_dir):
    write_layout(busy, f"{tmp_dir}/flat", [], cluster_by=["t"], target_file_bytes=500_000)
    assert 4 <= len(_sizes(f"{tmp_dir}/flat")) <= 12 and read_table(spark, f"{tmp_dir}/flat").count() == 20_000
    nulls = busy.withColumn("m", F.when(F.col("id") % 2 == 0, F.col("m"))).withColumn("ts", F.when(F.col("id") % 3 == 0, F.col("ts")))
    write_layout(nulls, f"{tmp_dir}/nulls", ["m"], cluster_by=["ts"], target_file_bytes=400_000)
    assert read_table(spark, f"{tmp_dir}/nulls").filter("m is null").count() == 10_000
    write_layout(busy.limit(0), f"{tmp_dir}/none", ["m"], cluster_by=["ts"])
    assert read_table(spark, f"{tmp_dir}/flat").count() == 20_000
    many = planned_files(busy.select("id", "m"), ["m"], ["id"], target_bytes=50)  # more files than quantiles
    assert many.rdd.getNumPartitions() > 1000 and many.count() == 20_000
    assert "repartitionbyid" in plan_text(many).lower() or "Exchange" in plan_text(many)


def test_a_task_sorts_no_more_than_its_memory_holds(spark, busy, tmp_dir):
    """Files far below the target, whose rows take more than a task should sort: short rows, then a busy month."""
    short = spark.range(0, 6_000_000, 1, 4).select((F.col("id") * 7919 % 6_000_011).alias("id"))
    parts = planned_files(short, [], ["id"]).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    parts = parts.orderBy("a").collect()
    assert len(parts) == 3 and sum(r.n for r in parts) == 6_000_000 and max(r.n for r in parts) < 2_500_000
    assert all(x.b <= y.a for x, y in zip(parts, parts[1:]))
    write_layout(busy, f"{tmp_dir}/t", ["y", "m"], cluster_by=["ts"], sort_bytes=400_000)
    per_month = {m: len(_sizes(f"{tmp_dir}/t", f"y=2024/m={m}")) for m in range(1, 13)}
    assert 8 <= per_month.pop(3) <= 16 and set(per_month.values()) == {1}
    back = read_table(spark, f"{tmp_dir}/t")
    assert sorted(back.select("id").toPandas().id) == list(range(20_000))


def test_rows_without_a_time_are_spread_too(spark, tmp_dir):
    """Most rows have no cluster value: they are not all sorted by one task, nor mixed with those that have one."""
    i = F.col("id")
    ts = F.when(i % 4 == 0, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (i * 7919 % 86400).cast("int")))
    parts = planned_files(spark.range(0, 20_000, 1, 4).select(i, ts.alias("ts")), [], ["ts"], sort_bytes=200_000)
    rows = F.count(F.lit(1))
    files = parts.groupBy(F.spark_partition_id()).agg(rows.alias("n"), F.count("ts").alias("timed"), F.min("ts").alias("a"), F.max("ts").alias("b")).collect()
    assert len(files) >= 8 and sum(r.n for r in files) == 20_000 and sum(r.timed for r in files) == 5_000
    assert max(r.n for r in files) < 2 * 20_000 / len(files) and sum(0 < r.timed < r.n for r in files) <= 1
    timed = sorted((r for r in files if r.timed), key=lambda r: r.a)
    assert all(x.b <= y.a for x, y in zip(timed, timed[1:]))


def test_layouts_of_more_than_a_task_sorts_reconcile(spark, tmp_dir):
    i = F.col("id")
    facts = spark.range(0, 2_400_000, 1, 4).select(
        i, F.when(i % 50 > 0, i % 97).alias("zone"), (i % 1000 / 4).alias("fare"),
        F.timestamp_seconds(F.lit(1_700_000_000) + i * 7919 % 5_000_000).alias("at"), (i % 12).cast("int").alias("m"))
    labels = spark.range(0, 90).select(i.alias("zone"), F.concat(F.lit("b"), i % 5).alias("borough"))
    for name, columns in (("flat", []), ("month", ["m"])):
        write_layout(facts, f"{tmp_dir}/{name}", columns, cluster_by=["at"])
    assert len(_sizes(f"{tmp_dir}/flat")) == 2 and len(_sizes(f"{tmp_dir}/month", "m=0")) == 1
    tables = {name: read_table(spark, f"{tmp_dir}/{name}") for name in ("flat", "month")}
    got = reconcile(tables, labels, columns=ReportColumns("at", "at", "fare", "zone"))
    assert got["rows"] == {"flat": 2_400_000, "month": 2_400_000} and got["keys"]["trips_per_borough"] == 6


def test_a_session_sized_from_tables_and_files(spark, tmp_dir):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for n in (3, 2):
        v = publish(spark.range(1000).repartition(n), f"{tmp_dir}/t")
    spark.range(1000).write.parquet(f"{tmp_dir}/plain")
    assert table_bytes(spark, f"{tmp_dir}/t") == v.data_bytes  # the current version alone
    size = v.data_bytes + table_bytes(spark, f"{tmp_dir}/plain")
    own = sized_session(spark, f"{tmp_dir}/t", f"{tmp_dir}/plain", target_bytes=100)
    assert own.conf.get(key) == str(-(-size // 100)) and spark.conf.get(key, None) != own.conf.get(key)
