"""Table sinks and sources: path-addressed directory tables, run records, file
statistics, and the shared scratch folder.

Scratch data (staged tables, materialised context tables) always goes to the
folder the cluster names in ``spark.checkpoint.dir``, which is shared storage
and survives the loss of any executor.  Only when the session has none (local
tests) is a private folder set.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (set one only if unset)."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not str(master).startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set: staged tables need a folder that every "
                    "executor can reach and that survives executor loss; set it to shared storage")
            root = tempfile.mkdtemp(prefix="quality-lake-ckpt-")  # local sessions (tests) only
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir()
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table path under the shared scratch folder."""
    return f"{scratch_root(spark)}/quality_lake/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite",
                partition_by=(), max_records_per_file: int | None = None,
                repartition: int | None = None, cluster_by=(), options: dict | None = None) -> None:
    """Write a directory table.

    With ``cluster_by`` columns the rows are range-partitioned on the partition
    columns followed by those columns: every task then writes one or two
    partition directories, and a partition value - or a single cluster value -
    holding a large share of the rows is still split over many tasks (a hash on
    the partition columns alone would send it to one).  The number of write tasks
    is the session's shuffle partition count, which ``plans.sizing`` derives from
    the input's bytes, unless ``repartition`` sets it; without ``cluster_by``,
    ``repartition`` spreads rows round-robin.  ``max_records_per_file`` is off
    unless given.
    Overwrite also replaces the schema (``overwriteSchema`` for Delta).
    """
    partition_by, cluster_by = list(partition_by or ()), list(cluster_by or ())
    if repartition or cluster_by:
        if cluster_by:
            # Deterministic tie-breakers: a row hash, then the input partition,
            # so even rows sharing one exact cluster value (or exact copies) can
            # be cut into several ranges - a tie group is at most one input split.
            ties = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.spark_partition_id()]
            order = [*partition_by, *cluster_by, *ties]
            df = df.repartitionByRange(repartition, *order) if repartition else df.repartitionByRange(*order)
        else:
            df = df.repartition(repartition)
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if mode == "overwrite" and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared scratch folder and
    return a frame over it: cuts the lineage, survives executor loss, and later
    reads can prune to the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, "parquet", "errorifexists")
    return read_staged(spark, path, df.schema)


def read_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a table this job just wrote with ``schema``: passing the known
    schema skips Parquet schema inference, which is a Spark job of its own."""
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Free a staged table's storage: overwrite it with an empty frame of the
    same schema, which makes Spark's writer delete the old files on any file
    system (no file-system API needed)."""
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException:  # nothing was written there
        return
    empty_frame(spark, schema).write.mode("overwrite").parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A block's own ``stage``: what it has staged is released behind the block, also after an error."""
    paths: list[str] = []

    def own(df: DataFrame, name: str = "stage") -> DataFrame:
        paths.append(scratch_path(spark, name))
        write_table(df, paths[-1], "parquet", "errorifexists")
        return read_staged(spark, paths[-1], df.schema)

    try:
        yield own
    finally:
        for path in paths:
            release(spark, path)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A frame with ``schema`` and no rows, built JVM-side (a frame made from a
    Python list would start Python workers on the executors just to produce it)."""
    return spark.range(0, numPartitions=1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def files_under(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """``(file_path, file_size)`` of the Parquet, CSV, ... files under a path.  Spark
    lists them (its ``binaryFile`` source, of which only path and length are read);
    no file is opened, so files without rows count too."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
             .select(F.col("path").alias("file_path"), F.col("length").alias("file_size")))
    name = F.regexp_extract("file_path", r"([^/]*)$", 1)
    return found.filter(~name.startswith("_") & ~name.startswith("."))


def file_stats(files: DataFrame, by=()) -> DataFrame:
    """Data files and bytes of ``files_under``, in all or by expressions over ``file_path``."""
    return files.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("data_files"),
                                  F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("data_bytes"))


# The run-record schema, all fields required.
RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("source_path", T.StringType(), False),
    T.StructField("started_at_utc", T.StringType(), False),
    T.StructField("execution_seconds", T.DoubleType(), False),
    T.StructField("input_records", T.LongType(), False),
    T.StructField("processed_records", T.LongType(), False),
    T.StructField("rejected_records", T.LongType(), False),
    T.StructField("schema_version", T.IntegerType(), False),
])


def run_record(table_name: str, source_path: str, started: datetime, seconds: float,
               input_records: int, processed_records: int, schema_version: int) -> dict:
    return {
        "run_id": str(uuid.uuid4()), "table_name": table_name, "source_path": str(source_path),
        "started_at_utc": started.isoformat(), "execution_seconds": float(seconds),
        "input_records": int(input_records), "processed_records": int(processed_records),
        "rejected_records": int(input_records) - int(processed_records),
        "schema_version": int(schema_version),
    }


def literal_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows (run records, observed counts) as a frame of
    literals, built JVM-side: no Python workers are started to produce it."""
    if not rows:
        return empty_frame(spark, schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def run_record_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    rows = [tuple(r[f.name] for f in RUN_RECORD_SCHEMA.fields) for r in records]
    return literal_frame(spark, rows, RUN_RECORD_SCHEMA)


def append_run_record(spark: SparkSession, record: dict, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    write_table(run_record_frame(spark, [record]), path, fmt, "append")
