"""Tables that are published by manifest: versioned folders, and a small log that names the current one.

    <table>/data/<id>/...       the files of one write, never changed afterwards
    <table>/files/<id>/         their list: path below ``data``, bytes (one row per file)
    <table>/manifest/*.json     one line per version: its folders, schema, rows, files and bytes

A version is a list of folders: an overwrite names its own folder only, an append the
folders of the version before and its own.  Publishing is one append of one line,
which Spark's committer makes visible as a whole.  A job that dies before it leaves
the table as it was, with an unnamed folder beside it.  ``publish`` writes the rows
once: an audit reads the very files that become the version.

Spark's readers and writers do all of it, on any store that they reach.  Two writers
at once are noticed, not serialised: of two lines for one version the one that the store
committed first counts, and the writer of the other raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError
from .tables import DEFAULT_FORMAT, empty_frame, file_stats, files_under, literal_frame, read_staged, release, write_table

# The fields of a manifest line.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("publish_id", T.StringType()),
    T.StructField("published_at_utc", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("folders", T.ArrayType(T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("data_files", T.LongType()),
    T.StructField("data_bytes", T.LongType()),
])
_FILE_LIST = T.StructType([T.StructField("data_path", T.StringType()), T.StructField("file_size", T.LongType())])
#: A file's path below ``data``: the write's id and what follows it.
_BELOW_DATA = r"/([0-9a-f]{32}/.*)$"


@dataclass(frozen=True)
class Version:
    """One line of a table's manifest."""

    path: str
    version: int
    publish_id: str
    published_at_utc: str
    mode: str
    folders: tuple[str, ...]
    schema: T.StructType
    rows: int
    data_files: int
    data_bytes: int

    @property
    def data_paths(self) -> list[str]:
        return [f"{self.path}/data/{f}" for f in self.folders]

    def read(self, spark: SparkSession) -> DataFrame:
        """The version's rows; partition columns come from its folders, so filters on them prune."""
        return spark.read.schema(self.schema).parquet(*self.data_paths)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """A table's manifest, or None if it has none."""
    try:
        lines = spark.read.schema(MANIFEST_SCHEMA).json(f"{path.rstrip('/')}/manifest")
        return lines.filter("version is not null").withColumn("committed", F.col("_metadata.file_modification_time"))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "does not exist" in str(err):
            return None
        raise


def _first_of_each(lines: DataFrame) -> DataFrame:
    """One line per version: of two writers that took one number, the one whose line the store has had for longer."""
    others = [c for c in lines.columns if c not in ("version", "committed", "publish_id")]
    return lines.groupBy("version").agg(F.min(F.struct("committed", "publish_id", *others)).alias("line")).select("version", "line.*")


def _version(path: str, row) -> Version:
    return Version(path.rstrip("/"), row["version"], row["publish_id"], row["published_at_utc"], row["mode"], tuple(row["folders"]),
                   T.StructType.fromJson(json.loads(row["schema_json"])), row["rows"], row["data_files"], row["data_bytes"])


def current_version(spark: SparkSession, path: str, version: int | None = None) -> Version | None:
    """The newest version, or the one asked for; None if the path is no published table."""
    lines = _lines(spark, path)
    if lines is None:
        return None
    wanted = lines if version is None else lines.filter(F.col("version") == version)
    found = _first_of_each(wanted).orderBy(F.desc("version")).limit(1).collect()
    if not found and version is not None:
        raise ContractError(f"{path}: no version {version}")
    return _version(path, found[0]) if found else None


def table_versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version, without its schema and folders, and whether it is the current one."""
    lines = _lines(spark, path)
    if lines is None:
        raise ContractError(f"{path} is not a published table")
    every = _first_of_each(lines).select("version", "published_at_utc", "mode", "rows", "data_files", "data_bytes")
    newest = every.agg(F.max("version").alias("newest"))  # one row
    return every.join(F.broadcast(newest)).select(*every.columns, (F.col("version") == F.col("newest")).alias("active"))


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds a folder (or file) there."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "does not exist" in str(err):
            return False
        raise


def publish(df: DataFrame, path: str, mode: str = "overwrite", *, audit: Callable[[DataFrame], object] | None = None,
            rows: Callable[[str], int] | None = None, inside: str = "", columns=None, **write_options) -> Version:
    """Writes ``df`` as a new version of the table at ``path``.

    ``audit`` gets the written rows before anything is published; what it raises
    leaves the table as it is and the written folder for inspection.  ``rows`` gives
    the number of rows, from the folder that was written, where the caller knows better than
    to count Parquet's footers.  ``inside`` names a partition folder of the write
    (``outcome=accepted``) that alone is the version; the rest of the write stays beside
    it.  ``columns`` are the version's, if it does not show all that is written.
    ``write_options`` are those of ``write_table``.
    """
    if mode not in ("overwrite", "append", "errorifexists"):
        raise ContractError(f"Unsupported write mode of a published table: {mode}")
    spark, path = df.sparkSession, path.rstrip("/")
    before = current_version(spark, path)
    if before is not None and mode == "errorifexists":
        raise ContractError(f"{path}: the table exists (version {before.version})")
    left_out = inside.split("=")[0]
    partitions = [c for c in write_options.get("partition_by") or () if c != left_out]
    own = uuid.uuid4().hex
    folder = f"{own}/{inside}" if inside else own
    write_table(df, f"{path}/data/{own}", "parquet", "errorifexists", **write_options)
    fields = [f for f in df.schema.fields if f.name != left_out and (columns is None or f.name in columns)]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [
        *[f for f in fields if f.name not in partitions], *[f for f in fields if f.name in partitions]]])
    if mode == "append" and before is not None and [(f.name, f.dataType) for f in before.schema] != [(f.name, f.dataType) for f in schema]:
        raise ContractError(f"{path}: the appended rows have another schema than version {before.version}")
    if inside and not folder_exists(spark, f"{path}/data/{folder}"):  # no row went there
        empty_frame(spark, schema).write.parquet(f"{path}/data/{folder}")
    written = read_staged(spark, f"{path}/data/{folder}", schema)
    if audit is not None:
        audit(written)
    listed = files_under(spark, f"{path}/data/{folder}").select(
        F.regexp_extract("file_path", _BELOW_DATA, 1).alias("data_path"), "file_size")
    write_table(listed, f"{path}/files/{own}", "parquet", "errorifexists")
    stats = file_stats(read_staged(spark, f"{path}/files/{own}", _FILE_LIST)).first()
    n = rows(f"{path}/data/{own}") if rows is not None else written.count()
    base = before if mode == "append" else None
    line = (1 if before is None else before.version + 1, own, datetime.now(timezone.utc).isoformat(timespec="microseconds"), mode,
            [*(base.folders if base else ()), folder], schema.json(), n + (base.rows if base else 0),
            stats["data_files"] + (base.data_files if base else 0), stats["data_bytes"] + (base.data_bytes if base else 0))
    _append_line(spark, path, line)
    found = current_version(spark, path, line[0])
    if found.publish_id != own:
        raise ContractError(f"{path}: version {line[0]} was published by another run meanwhile")
    return found


def _append_line(spark: SparkSession, path: str, line: tuple) -> None:
    literal_frame(spark, [line], MANIFEST_SCHEMA).write.mode("append").json(f"{path}/manifest")


def save(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "overwrite", **options) -> Version | None:
    """``publish`` for Parquet; formats with commits of their own (Delta) are written by their writer."""
    if fmt == "parquet":
        return publish(df, path, mode, **options)
    options = {k: v for k, v in options.items() if k not in ("audit", "rows", "inside", "columns")}
    write_table(df, path, fmt, mode, **options)
    return None


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, version: int | None = None) -> DataFrame:
    """A table by its path: the current (or the given) version of a published one, or a plain folder."""
    if fmt == "parquet":
        found = current_version(spark, path, version)
        if found is not None:
            return found.read(spark)
    if version is not None:
        raise ContractError(f"{path} is not a published table, so it has no version {version}")
    return spark.read.format(fmt).load(path)


def _active_files(spark: SparkSession, version: Version) -> DataFrame:
    ids = [f.split("/")[0] for f in version.folders]
    return spark.read.schema(_FILE_LIST).parquet(*[f"{version.path}/files/{i}" for i in ids])


def storage_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: the files and bytes that the current version names, all data files and
    bytes under the table (superseded and unpublished writes too), and how many named
    files are gone.  The lists are joined as tables, so they may be long."""
    now = current_version(spark, path)
    if now is None:
        raise ContractError(f"{path} is not a published table")
    here = files_under(spark, f"{now.path}/data").select(F.regexp_extract("file_path", _BELOW_DATA, 1).alias("data_path"),
                                                        F.col("file_size").alias("bytes_here"))
    named = _active_files(spark, now).withColumn("named", F.lit(True))
    both = here.join(named, "data_path", "full")
    active = F.col("named") & F.col("bytes_here").isNotNull()
    count = lambda c: F.count(F.when(c, 1)).cast("long")
    size = lambda c: F.coalesce(F.sum(F.when(c, F.col("bytes_here"))), F.lit(0)).cast("long")
    return both.agg(F.lit(now.version).cast("long").alias("version"), count(active).alias("active_files"), size(active).alias("active_bytes"),
                    count(F.col("bytes_here").isNotNull()).alias("total_files"), size(F.col("bytes_here").isNotNull()).alias("total_bytes"),
                    count(F.col("named") & F.col("bytes_here").isNull()).alias("missing_files"))


def expire_versions(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Frees the folders that none of the newest ``keep`` versions names; returns the expired versions.

    Their lines stay as history.  A folder is freed by Spark's writer (``release``), which leaves
    one file without rows; folders of writes that were never published are not touched.
    """
    lines = _lines(spark, path)
    if lines is None:
        raise ContractError(f"{path} is not a published table")
    versions = [_version(path, r) for r in _first_of_each(lines).orderBy(F.desc("version")).collect()]  # one row per publish
    held = {f for v in versions[:max(1, keep)] for f in v.folders}
    gone: dict[str, None] = {}
    expired = []
    for v in versions[max(1, keep):]:
        own = [f for f in v.folders if f not in held]
        if own:
            expired.append(v.version)
            gone |= dict.fromkeys(own)
    for f in gone:
        release(spark, f"{path.rstrip('/')}/data/{f.split('/')[0]}")
    return sorted(expired)
