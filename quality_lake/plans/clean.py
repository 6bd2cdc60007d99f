"""Cleaning a source by its contract, and publishing the cleaned table.

Stage order (kept on purpose): conform -> rename -> null policy -> named
transforms -> drop unwanted columns -> quality rules -> exact-row dedup ->
generated key -> primary-key validation.  Rules see derived columns; dedup runs
after the drops; the key is computed on deduplicated rows.

``clean_frame`` is lazy and builds one plan of the accepted rows: a single fused
projection/filter span, then the exact-row dedup.

``tagged_frame`` is the same plan with marks instead of filters: it also yields every
rejected row once, with the stage that rejected it, the causes, the raw values and
the number of equal rows.  ``ingest`` writes that plan once, by one write partitioned
by outcome (write-audit-publish): the key audit reads the accepted files, and only
then does the manifest name them as the table's new version.  All counts of a run
are sums over the written rows, so a task that ran twice counts once.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, ContractError, check_key_spec
from ..operators.conform import apply_null_policy, conform, drop_unwanted, rename_columns
from ..operators.dedup import count_copies
from ..operators.derive import apply_transforms, transform_named
from ..operators.enrich import row_count
from ..operators.keys import add_generated_key, assert_primary_key
from ..operators.quality import apply_rules
from ..operators.tagging import AT, CAUSES, RAW, tag_conform, tag_null_policy, tag_rules, tag_transforms
from ..sources.files import read_source
from ..sources.tables import (
    DEFAULT_FORMAT,
    append_run_record,
    empty_frame,
    release,
    run_record,
    scratch_path,
    write_table,
)
from ..sources.versions import Version, current_version, folder_exists, publish
from .sizing import sized_session

# Stage names, in execution order, for the opt-in stage counts.
STAGES = ("input", "conformed", "null_policy", "transforms", "rules", "deduplicated")
# Columns of a written run beside the data, and its two outcomes.
OUTCOME, REJECTED_AT, REASONS, RAW_ROW, COPIES = "ql_outcome", "ql_rejected_at", "ql_causes", "ql_raw", "ql_copies"
ACCEPTED, REJECTED = "accepted", "rejected"
_BESIDE = (REJECTED_AT, REASONS, RAW_ROW, COPIES, OUTCOME)


def clean_frame(raw: DataFrame, contract: Contract, *, dedup: bool = True,
                stage_counts: dict | None = None) -> DataFrame:
    """All cleaning steps up to (not including) key validation, as one plan.

    ``stage_counts``: pass a dict to receive one ``Observation`` per stage (see
    ``STAGES``); all are filled by the first action on the returned frame, so
    counting costs no extra pass.  Off by default: an observation blocks filter
    pushdown below it, and counts taken before the dedup shuffle can repeat if
    a stage is re-executed after an executor loss - they are diagnostics.
    """
    def mark(df: DataFrame, stage: str) -> DataFrame:
        if stage_counts is None:
            return df
        obs = Observation(f"quality_lake_{stage}_{uuid.uuid4().hex[:12]}")
        stage_counts[stage] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    df = mark(raw, "input")
    df = mark(conform(df, contract), "conformed")
    df = rename_columns(df, contract)
    df = mark(apply_null_policy(df, contract), "null_policy")
    df = mark(apply_transforms(df, contract.transforms), "transforms")
    df = drop_unwanted(df, contract)
    df = mark(apply_rules(df, contract.rules), "rules")
    if dedup:
        df = df.dropDuplicates()
    df = mark(df, "deduplicated")
    if contract.generated_key is not None:
        gk = contract.generated_key
        df = add_generated_key(df, gk.name, gk.columns)
    return df


def stage_rows(stage_counts: dict) -> dict[str, int]:
    """Row counts per stage after the action ran (input first)."""
    return {name: stage_counts[name].get["rows"] for name in STAGES if name in stage_counts}


def clean(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Read ``path`` (file or name glob) and clean it; lazy."""
    return clean_frame(read_source(spark, path, contract), contract)


def tagged_frame(raw: DataFrame, contract: Contract, dedup: str = "rows") -> DataFrame:
    """The whole cleaning as one lazy plan that keeps rejected rows.

    Accepted rows have the cleaned columns; rejected ones have nulls there, and the
    rejecting stage, the causes and the raw row as JSON.  Equal rows are one row with
    their number in ``ql_copies``.  ``dedup`` is the form of it (``operators.dedup``).
    """
    df = rename_columns(tag_conform(raw, contract), contract)
    df = tag_transforms(tag_null_policy(df, contract), contract.transforms)
    df = tag_rules(drop_unwanted(df, contract), contract.rules)
    own = [c for c in df.columns if c not in (AT, CAUSES, RAW)]
    gk = contract.generated_key
    clash = sorted(set(_BESIDE) & {*own, *([gk.name] if gk else [])})
    if clash:
        raise ContractError(f"{contract.table_name}: columns named like those of a written run: {clash}")
    accepted = F.col(AT).isNull()
    raw_row = F.to_json(RAW, {"ignoreNullFields": "false", "timeZone": "UTC"})
    flat = df.select(*[F.when(accepted, F.col(f"`{c}`")).alias(c) for c in own], F.col(AT).alias(REJECTED_AT), F.col(CAUSES).alias(REASONS),
                     F.when(~accepted, raw_row).alias(RAW_ROW))
    out = count_copies(flat, COPIES, dedup)
    kept = F.col(REJECTED_AT).isNull()
    if gk is not None:
        out = add_generated_key(out, gk.name, gk.columns).withColumn(gk.name, F.when(kept, F.col(f"`{gk.name}`")))
        own = [*own, gk.name]
    return out.select(*[F.col(f"`{c}`") for c in own], *_BESIDE[:-1], F.when(kept, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)).alias(OUTCOME))


def written_counts(run: DataFrame, input_rows: int | None = None) -> dict[str, int]:
    """Rows per stage (``STAGES``) of a written run: what came into a stage less what it rejected.

    ``input_rows`` is needed where a transform may drop rows itself; what is
    missing then counts as dropped by the transforms.
    """
    sums = {r[REJECTED_AT]: (r["rows"], r["copies"]) for r in run.groupBy(REJECTED_AT).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(COPIES).alias("copies")).collect()}  # one row per stage
    seen = sum(copies for _, copies in sums.values())
    out = {"input": seen if input_rows is None else input_rows}
    left = out["input"]
    for stage in ("conformed", "null_policy", "transforms", "rules"):
        left -= sums.get(stage, (0, 0))[1] + (out["input"] - seen if stage == "transforms" else 0)
        out[stage] = left
    return out | {"deduplicated": sums.get(None, (0, 0))[0]}


@dataclass
class IngestResult:
    record: dict
    key_stats: dict
    table_path: str
    staged_path: str
    stage_rows: dict | None = None
    version: Version | None = None


def _drops_rows(contract: Contract) -> bool:
    return not all(transform_named(n).keeps_rows for n in contract.transforms)


def ingest(spark: SparkSession, path: str, contract: Contract, target: str, *,
           fmt: str = DEFAULT_FORMAT, runs_path: str | None = None,
           max_records_per_file: int | None = None,
           validate_key: bool = True, stage_counts: bool = False,
           size_shuffle_partitions: bool = True, keep_staged: bool = False, dedup: str = "rows") -> IngestResult:
    """Clean ``path``, audit the primary key, publish a new version of ``target``, append a run record.

    The contract must name a primary key; ``validate_key=False`` is the only way
    to go without the audit.  A key violation raises before ``target`` is touched.
    The run has a session of its own, in which shuffle partitions are sized from the source's bytes
    (``plans.sizing``; off with ``size_shuffle_partitions=False``).  See ``ingest_frame``.
    """
    own = sized_session(spark, path) if size_shuffle_partitions else spark
    return ingest_frame(read_source(own, path, contract), contract, target, source=path, fmt=fmt, runs_path=runs_path,
                        max_records_per_file=max_records_per_file, validate_key=validate_key, stage_counts=stage_counts,
                        keep_staged=keep_staged, dedup=dedup)


def ingest_frame(raw: DataFrame, contract: Contract, target: str, *, source: str = "", fmt: str = DEFAULT_FORMAT,
                 runs_path: str | None = None, max_records_per_file: int | None = None, validate_key: bool = True,
                 stage_counts: bool = False, keep_staged: bool = False, dedup: str = "rows") -> IngestResult:
    """``ingest`` for a raw frame.

    Parquet: the rows are written once, below ``target``; the accepted files are what
    the manifest then names, the rejected ones stay beside them (``read_rejects``).
    After a key violation the written run stays for inspection.  Other formats: the
    run is written to the shared folder and its accepted rows from there to
    ``target``; it is released after that unless ``keep_staged``.
    """
    spark, started_at, t0 = raw.sparkSession, datetime.now(timezone.utc), time.perf_counter()
    run = tagged_frame(raw, contract, dedup)
    columns = [c for c in run.columns if c not in _BESIDE]
    key = check_key_spec(contract.primary_key, columns) if validate_key else []
    stats: dict = {}
    counts: dict = {}

    def read_run(folder: str) -> DataFrame:
        return spark.read.schema(run.schema).parquet(folder)

    def audit(rows: DataFrame) -> None:
        if validate_key:
            stats.update(assert_primary_key(rows, key, contract.table_name))

    def count(folder: str) -> int:
        counts.update(written_counts(read_run(folder), row_count(raw) if _drops_rows(contract) else None))
        return counts["deduplicated"]

    options = {"partition_by": [OUTCOME], "max_records_per_file": max_records_per_file}
    version = None
    if fmt == "parquet":
        version = publish(run, target, "overwrite", audit=audit, rows=count, inside=f"{OUTCOME}={ACCEPTED}", columns=columns, **options)
        staged_path = version.data_paths[0]
    else:
        staged_path = scratch_path(spark, f"staged-{contract.table_name}")
        write_table(run, staged_path, "parquet", "errorifexists", **options)
        rows = read_run(staged_path).filter(F.col(OUTCOME) == ACCEPTED).select(*[F.col(f"`{c}`") for c in columns])
        audit(rows)
        count(staged_path)
        write_table(rows, target, fmt, "overwrite", max_records_per_file=max_records_per_file)
        if not keep_staged:
            release(spark, staged_path)

    record = run_record(contract.table_name, source, started_at, time.perf_counter() - t0,
                        counts["input"], counts["deduplicated"], contract.schema_version)
    if runs_path:
        append_run_record(spark, record, runs_path)
    return IngestResult(record, stats, target, staged_path, counts if stage_counts else None, version)


def read_rejects(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rejected rows of the run that made a version: stage, causes, raw row as JSON, number of equal rows."""
    found = current_version(spark, target, version)
    if found is None:
        raise ContractError(f"{target} is not a published table")
    shown = f"{REJECTED_AT} string, {REASONS} array<string>, {RAW_ROW} string, {COPIES} bigint"
    folders = [p for p in {f"{p.rsplit('/', 1)[0]}/{OUTCOME}={REJECTED}": None for p in found.data_paths if f"{OUTCOME}=" in p}
               if folder_exists(spark, p)]
    rejects = spark.read.schema(shown).parquet(*folders) if folders else empty_frame(spark, spark.createDataFrame([], shown).schema)
    return rejects.select(F.col(REJECTED_AT).alias("rejected_at"), F.col(REASONS).alias("causes"), F.col(RAW_ROW).alias("raw"),
                          F.col(COPIES).alias("copies"))
