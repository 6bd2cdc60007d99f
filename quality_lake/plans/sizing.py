"""Sizes from the data: shuffle partitions from the input's bytes, files from bytes per partition value.

AQE can merge small shuffle partitions but not split large ones (skew handling
aside), so the *initial* partition count must grow with the data: e.g. a 100 TB
dedup with 200 partitions would put ~500 GB in each.  ``sized_session`` gives a session
of the run's own with that number, ``sized_shuffle`` sets it for a block.

``planned_files`` deals rows out to files before a partitioned write: one aggregate finds
the rows, bytes and quantiles of the cluster column for each partition value; from them
follow the number of files that each value needs and the ranges that they hold.  The
number of write tasks is the number of files, whatever the session's settings.  A task sorts
its file, so a file has no more rows than are sorted in ``sort_bytes`` of memory.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import value_bytes
from ..sources.tables import file_stats, files_under, stage
from ..sources.versions import current_version

DEFAULT_TARGET_PARTITION_BYTES = 1 << 30
#: Bytes of values in a file (Parquet stores them in a half to a tenth).
DEFAULT_TARGET_FILE_BYTES = 1 << 30
#: Memory in which a task sorts the rows of its file, and what a row takes there beside its values.
DEFAULT_SORT_BYTES, SORT_ROW_BYTES = 1 << 28, 64
#: Ranges that the files of one partition value are cut by; beyond, rows of a range are spread by their hash.
QUANTILES = 256
_CONFS = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled",
          "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def shuffle_partitions_for(data_bytes: int, parallelism: int,
                           target_bytes: int = DEFAULT_TARGET_PARTITION_BYTES) -> int:
    return max(int(parallelism), math.ceil(data_bytes / target_bytes))


def source_bytes(spark: SparkSession, path: str) -> int:
    """Bytes on disk of the files behind ``path`` (file, directory or name glob): one listing, no file is opened."""
    return int(file_stats(files_under(spark, path)).first()["data_bytes"])


@contextmanager
def sized_shuffle(spark: SparkSession, path: str | None, target_bytes: int = DEFAULT_TARGET_PARTITION_BYTES):
    """Inside the block, AQE's initial shuffle partitions fit jobs over the files
    behind ``path`` (None: nothing changes); yields their number."""
    if path is None:
        yield None
        return
    n = shuffle_partitions_for(source_bytes(spark, path), spark.sparkContext.defaultParallelism, target_bytes)
    before = {k: spark.conf.get(k, None) for k in _CONFS}
    try:
        for k, v in zip(_CONFS, ("true", "true", str(n))):
            spark.conf.set(k, v)
        yield n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table: as its manifest says, or those of the files behind the path."""
    version = current_version(spark, path)
    return source_bytes(spark, path) if version is None else version.data_bytes


def sized_session(spark: SparkSession, *paths: str, target_bytes: int = DEFAULT_TARGET_PARTITION_BYTES) -> SparkSession:
    """A session of the same application with the same settings, but for AQE's initial
    shuffle partitions, which fit jobs over the tables or files behind ``paths`` together.  The
    caller's session, and whoever else uses it, sees no change."""
    size = sum(table_bytes(spark, p) for p in paths)
    n = shuffle_partitions_for(size, spark.sparkContext.defaultParallelism, target_bytes)
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **dict(zip(_CONFS, ("true", "true", str(n))))}.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def order_number(c: Column, kind: T.DataType) -> Column | None:
    """A double in the order of the column's values (text: of its first six bytes); None for types without one."""
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return None


def planned_files(df: DataFrame, partition_by=(), cluster_by=(), target_bytes: int = DEFAULT_TARGET_FILE_BYTES,
                  sort_bytes: int = DEFAULT_SORT_BYTES) -> DataFrame:
    """``df`` dealt out so that a write partitioned by ``partition_by`` gives files of about
    ``target_bytes`` of values, or of as many rows as a task sorts in about ``sort_bytes`` of
    memory if that is less, each with a range of the first ``cluster_by`` column.

    A partition value below both is one file; a larger one gets as many as it needs.
    Rows at a boundary, and all rows of one value that is itself beyond the target (or of
    none: null), are spread by their hash.  ``df`` is read twice; stage one that is expensive to make.
    The plan has a row per partition value, which is a folder of the table.
    """
    partition_by, cluster_by = list(partition_by or ()), list(cluster_by or ())
    kinds = {f.name: f.dataType for f in df.schema.fields}
    number = order_number(F.col(f"`{cluster_by[0]}`"), kinds[cluster_by[0]]) if cluster_by else None
    # rows without a value come first, as they are sorted
    number = F.lit(None).cast("double") if number is None else F.coalesce(number, F.lit(float("-inf")))
    steps = [i / QUANTILES for i in range(1, QUANTILES)]
    keys = [F.col(f"`{c}`").alias(f"__key{i}") for i, c in enumerate(partition_by)]
    names = [f"__key{i}" for i in range(len(partition_by))]
    sizes = (df.select(*keys, number.alias("__x"), value_bytes(df.schema).alias("__bytes")).groupBy(*names)
             .agg(F.sum("__bytes").alias("__bytes"), F.count(F.lit(1)).alias("__rows"), F.percentile_approx("__x", steps, 4 * QUANTILES).alias("__q")))
    sorted_bytes = F.col("__bytes") + SORT_ROW_BYTES * F.col("__rows")
    files = F.greatest(F.ceil(F.col("__bytes") / target_bytes), F.ceil(sorted_bytes / sort_bytes), F.lit(1)).cast("int")
    ranges = F.least(files, F.lit(QUANTILES))
    at = F.transform(F.sequence(F.lit(1), F.col("__ranges") - 1),
                     lambda i: F.element_at("__q", F.ceil(i * QUANTILES / F.col("__ranges")).cast("int")))
    plan = sizes.select(*names, files.alias("__files"), ranges.alias("__ranges"), "__q").select(
        *names, F.ceil(F.col("__files") / F.col("__ranges")).cast("int").alias("__per"), "__ranges",
        F.when((F.col("__ranges") > 1) & F.col("__q").isNotNull(), at).otherwise(F.array().cast("array<double>")).alias("__bounds"))
    own = F.col("__per") * F.col("__ranges")
    # one row per folder, in one task
    plan = stage(plan.withColumn("__first", (F.sum(own).over(Window.orderBy(*(names or [F.lit(0)]))) - own).cast("int")), "file-plan")
    total = plan.agg(F.max(F.col("__first") + own)).first()[0]
    if total is None:  # no rows
        return df
    low = F.size(F.filter("__bounds", lambda b: b < F.col("__x")))
    high = F.size(F.filter("__bounds", lambda b: b <= F.col("__x")))
    anywhere = F.size("__bounds") == 0  # no order to cut by
    low = F.when(anywhere, F.lit(0)).otherwise(low)
    high = F.when(anywhere, F.col("__ranges") - 1).otherwise(high)
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    file = F.col("__first") + (low + F.pmod("__salt", high - low + 1)) * F.col("__per") + F.pmod(F.shiftright("__salt", 20), F.col("__per"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in zip(partition_by, names)]
    joined = df.withColumns({"__x": number, "__salt": salt}).join(F.broadcast(plan), same or F.lit(True))
    dealt = joined.select(*[F.col(f"`{c}`") for c in df.columns], file.cast("int").alias("__file")).repartitionById(int(total), "__file")
    return dealt.drop("__file").sortWithinPartitions(*[F.col(f"`{c}`") for c in [*partition_by, *cluster_by]])
