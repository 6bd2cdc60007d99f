import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quality_lake.sources import (
    append_run_record,
    file_stats,
    files_under,
    read_table,
    run_record,
    scratch_root,
    stage,
    staging,
    write_table,
)


def _files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_hot_partition_value_is_split_over_tasks(spark, tmp_dir):
    # Every row falls in one month; a hash on (year, month) would give the whole
    # table to a single write task.
    df = spark.range(2000).select(
        F.col("id"),
        (F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"))
    df = df.withColumn("y", F.year("ts")).withColumn("m", F.month("ts"))
    path = f"{tmp_dir}/t"
    write_table(df, path, partition_by=["y", "m"], repartition=4, cluster_by=["ts"],
                max_records_per_file=None)
    assert len(_files(f"{path}/y=2024/m=1")) >= 3
    back = read_table(spark, path)
    assert back.count() == 2000
    stats = file_stats(files_under(spark, path)).first()
    assert os.listdir(f"{path}/y=2024") == ["m=1"]
    assert stats.data_files == len(_files(f"{path}/y=2024/m=1"))
    assert stats.data_bytes > 0


def test_identical_cluster_values_are_split(spark, tmp_dir):
    # one exact timestamp for every row, in 4 input partitions
    df = (spark.range(0, 4000, 1, 4)
          .withColumn("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
          .withColumn("y", F.lit(2024)))
    path = f"{tmp_dir}/same"
    write_table(df, path, partition_by=["y"], repartition=4, cluster_by=["ts"], max_records_per_file=None)
    sizes = [os.path.getsize(f"{path}/y=2024/{f}") for f in _files(f"{path}/y=2024")]
    assert len(sizes) >= 3
    assert read_table(spark, path).count() == 4000


def test_round_robin_without_cluster_columns(spark, tmp_dir):
    df = spark.range(1000).withColumn("p", F.lit(1))
    path = f"{tmp_dir}/rr"
    write_table(df, path, partition_by=["p"], repartition=3, max_records_per_file=None)
    assert len(_files(f"{path}/p=1")) == 3


def test_run_records_append_and_stage(spark, tmp_dir):
    path = f"{tmp_dir}/runs"
    for n in (10, 20):
        append_run_record(spark, run_record("t", "src", dt.datetime.now(dt.timezone.utc), 1.5, n, n - 1, 2), path)
    runs = read_table(spark, path)
    assert runs.count() == 2 and [f.nullable for f in runs.schema.fields] == [True] * 9
    assert sorted(r.rejected_records for r in runs.collect()) == [1, 1]
    staged = stage(spark.range(5), "unit")
    assert staged.count() == 5
    assert staged.inputFiles()[0].startswith(scratch_root(spark).replace("file:", "file://")[:12])


def test_a_blocks_staged_tables_are_released(spark):
    with pytest.raises(ZeroDivisionError), staging(spark) as keep:
        held = keep(spark.range(1000), "block")
        assert held.count() == 1000
        path = held.inputFiles()[0].rsplit("/", 1)[0]
        1 / 0
    left = files_under(spark, path).agg(F.sum("file_size"), F.count(F.lit(1))).first()
    assert spark.read.parquet(path).count() == 0 and left[1] == 1 and left[0] < 1000


def test_shuffle_sizing(spark, tmp_dir):
    from quality_lake.plans.sizing import shuffle_partitions_for, sized_shuffle, source_bytes
    assert shuffle_partitions_for(100 * 2**40, 8000) == 102_400  # 100 TiB -> 1 GiB partitions
    assert shuffle_partitions_for(10, 8) == 8
    spark.range(1000).write.parquet(f"{tmp_dir}/s")
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), sized_shuffle(spark, f"{tmp_dir}/s", target_bytes=100) as n:
        assert n == -(-source_bytes(spark, f"{tmp_dir}/s") // 100) and spark.conf.get(key) == str(n)
        1 / 0
    assert spark.conf.get(key, None) == before
    with sized_shuffle(spark, None) as n:
        assert n is None


def test_file_stats_count_files_without_rows(spark, tmp_dir):
    spark.range(0).write.parquet(f"{tmp_dir}/none")
    stats = file_stats(files_under(spark, f"{tmp_dir}/none")).first()
    assert stats.data_files == 1 and stats.data_bytes > 0


def test_cluster_session_without_checkpoint_dir_is_refused():
    # On a cluster, scratch data must go to the shared folder the cluster names;
    # a machine-local temporary folder is only made for local sessions.
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
