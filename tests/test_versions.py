import os

import pytest
from pyspark.sql import functions as F

from quality_lake import Contract, ContractError
from quality_lake.operators import register_transform
from quality_lake.plans import ingest, ingest_frame, read_rejects, tagged_frame
from quality_lake.sources import (
    current_version,
    expire_versions,
    files_under,
    publish,
    read_table,
    save,
    storage_stats,
    table_versions,
    versions,
    write_table,
)
from tests.conftest import plan_text


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions_replace_and_append(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert current_version(spark, path) is None
    publish(spark.range(5).repartition(2), path)
    publish(spark.range(10, 13).repartition(3), path)
    publish(spark.range(20, 22).repartition(1), path, "append")
    assert rows(read_table(spark, path)) == [(10,), (11,), (12,), (20,), (21,)]
    assert rows(read_table(spark, path, version=1)) == [(i,) for i in range(5)]
    assert rows(read_table(spark, path, version=2)) == [(10,), (11,), (12,)]
    assert [tuple(r) for r in table_versions(spark, path).orderBy("version").select("version", "mode", "rows", "data_files", "active").collect()] == [
        (1, "overwrite", 5, 2, False), (2, "overwrite", 3, 3, False), (3, "append", 5, 4, True)]
    with pytest.raises(ContractError, match="no version 9"):
        read_table(spark, path, version=9)
    with pytest.raises(ContractError, match="exists"):
        publish(spark.range(1), path, "errorifexists")
    with pytest.raises(ContractError, match="another schema"):
        publish(spark.range(1).select(F.col("id").cast("string")), path, "append")


def test_active_and_total_storage(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for n in (4, 2):
        publish(spark.range(100).repartition(n), path)
    write_table(spark.range(10).repartition(3), f"{path}/data/{'0' * 32}")  # a write that was never published
    s = storage_stats(spark, path).first()
    assert (s.version, s.active_files, s.total_files, s.missing_files) == (2, 2, 9, 0)
    assert s.total_bytes == sum(r.file_size for r in files_under(spark, f"{path}/data").collect()) > s.active_bytes > 0
    assert expire_versions(spark, path) == [1]
    s = storage_stats(spark, path).first()
    assert s.active_files == 2 and s.total_files < 9
    assert read_table(spark, path).count() == 100
    gone = next(f for f in read_table(spark, path).inputFiles())
    os.remove(gone.replace("file://", ""))
    assert storage_stats(spark, path).first().missing_files == 1


def test_a_job_that_dies_before_the_manifest_leaves_the_table(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    publish(spark.range(3), path)

    def killed(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(versions, "_append_line", killed)
        with pytest.raises(KeyboardInterrupt):
            publish(spark.range(100), path)
    assert rows(read_table(spark, path)) == [(0,), (1,), (2,)] and current_version(spark, path).version == 1
    # an interrupted write of the line itself: what Spark has not committed is no line
    os.makedirs(f"{path}/manifest/_temporary/0/task")
    with open(f"{path}/manifest/_temporary/0/task/part-0.json", "w") as h:
        h.write('{"version": 99')
    assert current_version(spark, path).version == 1
    with pytest.raises(ContractError, match="too many"):
        publish(spark.range(100), path, audit=lambda df: (_ for _ in ()).throw(ContractError(f"too many: {df.count()}")))
    assert current_version(spark, path).version == 1
    publish(spark.range(7), path)
    assert read_table(spark, path).count() == 7 and current_version(spark, path).version == 2


def test_a_second_writer_is_noticed(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    publish(spark.range(1), path)
    append, before = versions._append_line, []

    def another_first(spark, path, line):
        if not before:  # the other run publishes between this one's read and its line
            before.append(1)
            monkeypatch.setattr(versions, "_append_line", append)
            publish(spark.range(50), path)
        append(spark, path, line)
    monkeypatch.setattr(versions, "_append_line", another_first)
    with pytest.raises(ContractError, match="another run"):
        publish(spark.range(2), path)
    assert read_table(spark, path).count() == 50


def test_partitions_prune_and_nothing_is_published_for_plain_folders(spark, tmp_dir):
    df = spark.range(40).withColumn("m", (F.col("id") % 4).cast("int"))
    save(df, f"{tmp_dir}/t", partition_by=["m"])
    t = read_table(spark, f"{tmp_dir}/t")
    assert t.columns == ["id", "m"] and t.filter("m = 2").count() == 10
    assert "PartitionFilters: [isnotnull(m" in plan_text(t.filter("m = 2"))
    save(df.limit(0), f"{tmp_dir}/none", partition_by=["m"])
    assert read_table(spark, f"{tmp_dir}/none").count() == 0 and storage_stats(spark, f"{tmp_dir}/none").first().active_files == 0
    write_table(df, f"{tmp_dir}/plain")
    assert read_table(spark, f"{tmp_dir}/plain").count() == 40
    for call in (lambda: table_versions(spark, f"{tmp_dir}/plain"), lambda: storage_stats(spark, f"{tmp_dir}/plain"),
                 lambda: expire_versions(spark, f"{tmp_dir}/plain"), lambda: read_table(spark, f"{tmp_dir}/plain", version=1),
                 lambda: read_rejects(spark, f"{tmp_dir}/plain"), lambda: publish(df, f"{tmp_dir}/t", "ignore")):
        with pytest.raises(ContractError):
            call()


CONTRACT = Contract.from_dict({
    "table_name": "t", "format": "parquet", "primary_key": ["k"], "generated_key": {"name": "id", "columns": ["k", "x"]},
    "columns": [{"name": "k", "type": "long", "nullable": False}, {"name": "x", "type": "double"},
                {"name": "month", "type": "int"}, {"name": "day", "type": "int"}, {"name": "year", "type": "int", "nullable": False, "default": 2024}, {"name": "tag", "type": "string", "nullable": False, "default": "none"}],
    "extra_functions": ["separate_time_to_timestamp"],
    "quality_rules": [{"rule": "minimum", "column": "x", "value": 0}, {"rule": "finite", "column": "x"}]})
RAW = [("1", "1.5", "2", "3", None, "a"), ("1", "1.5", "2", "3", None, "a"), ("2", "zz", "1", "3x", None, "a"), ("2", "zz", "1", "3x", None, "a"),
       (" ", "1", "1", "3", None, None), ("4", "1", "13", "3", None, "a"), ("5", "-1", "1", "3", None, "b"), ("6", "NaN", "1", "3", "2024", "b"),
       ("7", "", "1", "3", None, "  "), ("8", "-1", "1", "77", None, "b")]
SCHEMA = "k string, x string, month string, day string, year string, tag string"


@pytest.mark.parametrize("dedup", ["rows", "digest"])
def test_one_write_keeps_rejects_and_exact_counts(spark, tmp_dir, dedup):
    raw = spark.createDataFrame(RAW, SCHEMA).repartition(3)
    res = ingest_frame(raw, CONTRACT, f"{tmp_dir}/t", stage_counts=True, dedup=dedup)
    assert res.stage_rows == {"input": 10, "conformed": 8, "null_policy": 7, "transforms": 5, "rules": 3, "deduplicated": 2}
    assert (res.record["input_records"], res.record["processed_records"]) == (10, 2)
    t = read_table(spark, f"{tmp_dir}/t")
    assert t.columns == ["k", "x", "tag", "timestamp", "id"]
    assert [(r.k, r.x, r.tag) for r in t.orderBy("k").collect()] == [(1, 1.5, "a"), (7, None, "none")]
    got = sorted((r.rejected_at, tuple(r.causes), r.copies, r.raw) for r in read_rejects(spark, f"{tmp_dir}/t").collect())
    assert got == [
        ("conformed", ("x", "day"), 2, '{"k":"2","x":"zz","month":"1","day":"3x","year":null,"tag":"a"}'),
        ("null_policy", ("k",), 1, '{"k":" ","x":"1","month":"1","day":"3","year":null,"tag":null}'),
        ("rules", ("finite:x",), 1, '{"k":"6","x":"NaN","month":"1","day":"3","year":"2024","tag":"b"}'),
        ("rules", ("minimum:x",), 1, '{"k":"5","x":"-1","month":"1","day":"3","year":null,"tag":"b"}'),
        ("transforms", ("separate_time_to_timestamp:timestamp",), 1, '{"k":"4","x":"1","month":"13","day":"3","year":null,"tag":"a"}'),
        ("transforms", ("separate_time_to_timestamp:timestamp",), 1, '{"k":"8","x":"-1","month":"1","day":"77","year":null,"tag":"b"}')]


def test_the_run_reads_its_source_once(spark, tmp_dir):
    spark.createDataFrame(RAW, SCHEMA).write.parquet(f"{tmp_dir}/raw")
    plan = plan_text(tagged_frame(spark.read.parquet(f"{tmp_dir}/raw"), CONTRACT))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_counts_survive_tasks_that_run_twice(spark, tmp_dir):
    """Counts are sums over committed rows: writing the same run again gives the same numbers."""
    raw = spark.createDataFrame(RAW, SCHEMA)
    twice = [ingest_frame(raw, CONTRACT, f"{tmp_dir}/t", stage_counts=True).stage_rows for _ in range(2)]
    assert twice[0] == twice[1]


def test_nothing_accepted_and_nothing_rejected(spark, tmp_dir):
    bad = spark.createDataFrame([RAW[2]], SCHEMA)
    assert ingest_frame(bad, CONTRACT, f"{tmp_dir}/bad").record["processed_records"] == 0
    assert read_table(spark, f"{tmp_dir}/bad").count() == 0 and read_rejects(spark, f"{tmp_dir}/bad").count() == 1
    good = spark.createDataFrame([RAW[0]], SCHEMA)
    ingest_frame(good, CONTRACT, f"{tmp_dir}/good")
    assert read_table(spark, f"{tmp_dir}/good").count() == 1 and read_rejects(spark, f"{tmp_dir}/good").count() == 0
    none = ingest_frame(good.limit(0), CONTRACT, f"{tmp_dir}/none", stage_counts=True)
    assert set(none.stage_rows.values()) == {0} and read_table(spark, f"{tmp_dir}/none").count() == 0


def test_rows_that_a_transform_drops_silently_are_counted(spark, tmp_dir):
    register_transform("only_small", lambda df: df.filter("k < 3"))
    c = Contract.from_dict({"table_name": "t", "format": "parquet", "primary_key": ["k"], "columns": [{"name": "k", "type": "long"}],
                            "extra_functions": ["only_small"]})
    res = ingest_frame(spark.range(5).select(F.col("id").alias("k")), c, f"{tmp_dir}/t", stage_counts=True)
    assert res.stage_rows == {"input": 5, "conformed": 5, "null_policy": 5, "transforms": 3, "rules": 3, "deduplicated": 3}
    named = Contract.from_dict({**c.raw, "columns": [{"name": "ql_raw", "type": "long"}], "primary_key": ["ql_raw"], "extra_functions": []})
    with pytest.raises(ContractError, match="ql_raw"):
        ingest_frame(spark.range(5).select(F.col("id").alias("ql_raw")), named, f"{tmp_dir}/u")


def test_a_run_leaves_the_callers_session_alone(spark, tmp_dir):
    spark.range(9).select(F.col("id").alias("k")).write.parquet(f"{tmp_dir}/raw")
    c = Contract.from_dict({"table_name": "t", "format": "parquet", "primary_key": ["k"], "columns": [{"name": "k", "type": "long"}]})
    seen, key = [], "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.getAll
    register_transform("look", lambda df: seen.append((spark.conf.get(key, None), df.sparkSession.conf.get(key),
                                                       df.sparkSession.conf.get("spark.sql.session.timeZone"))) or df)
    ingest(spark, f"{tmp_dir}/raw", Contract.from_dict({**c.raw, "extra_functions": ["look"]}), f"{tmp_dir}/t")
    assert seen[0][0] == before.get(key) and int(seen[0][1]) >= 1 and seen[0][2] == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.getAll == before
