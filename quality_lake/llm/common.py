"""Small helpers shared by the operators of this subpackage.

Every operator reads the documents table ``(doc_id, text, lang, source,
n_chars)``; a null text counts as empty and other columns are carried only when
an operator says so.  Hashing helpers work on whole Arrow batches with numpy, in
slices of bounded size, so a task's memory does not depend on the partition.
"""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quality_lake.sources import stage

#: ``[^\\x20\\x09-\\x0D]+``: the words of the data model (ASCII white space only).
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy step works on (a longer document is a step of its own).
STEP_BYTES = 2 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets the executors' Python workers import this package, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp()) / "quality_lake.zip"  # on the driver; Spark hands it to the executors
        with zipfile.ZipFile(at, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(at))
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose texts hold about ``step_bytes``."""
    offsets = _offsets(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + step_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield batch.slice(start, stop - start)
        start = stop


def _offsets(col: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1]
    return raw.astype(np.int64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and each row's offsets into them."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = _offsets(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit values."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = seeded(256, 7)
_BYTE[_SPACE] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 64), _BASE, np.uint64)
        grown[0] = 1
        grown = np.multiply.accumulate(grown)
        if len(grown) > 1 << 20:  # a very long word: not kept
            return grown
        _POWERS = grown
    return _POWERS


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a run of texts, in order, and the number of words of each text."""
    n_docs = len(offsets) - 1
    inside = ~_SPACE[raw]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(raw)]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    segments = np.diff(starts, append=len(raw))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, segments)
    value = (_BYTE_LOWER if lower else _BYTE)[raw[starts[0]:]]
    value *= _powers(int(segments.max()))[place]
    words = mix64(np.add.reduceat(value, starts - starts[0]))
    counts = np.diff(np.searchsorted(starts, offsets))
    return words, counts


ROW = "_row_number_"
# The columns that operators add to the documents' own on their way, in lower case.
OWN_NAMES = frozenset({ROW, "_file_number_", "_file_path_", "_own_path_", "_own_place_", "_runs_", "_later_", "_chunks_", "_first_", "pass"})


def free_names(operator):
    """Lets an operator of documents work whatever their other columns are called: a column
    with one of ``OWN_NAMES`` has another name meanwhile."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **options):
        taken = [c for c in docs.columns if c.lower() in OWN_NAMES]
        if not taken:
            return operator(docs, *args, **options)
        names, free = {}, {c.lower() for c in docs.columns}
        for c in taken:
            names[c] = next(n for n in (f"documents_{c}_{k}" for k in range(len(free) + 1)) if n.lower() not in free)
            free.add(names[c].lower())
        out = operator(docs.withColumnsRenamed(names), *args, **options)
        return out.withColumnsRenamed({n: c for c, n in names.items() if n in out.columns})
    return run



def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number, so that repeated or null ids never mix rows up.

    The number depends on the file splits: it holds for one scan, the result of which
    is written down.  For what is scanned again, see ``placed``.
    """
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def _is_files(docs: DataFrame) -> bool:
    """Whether ``docs`` is some columns of a table of files and nothing else."""
    plan = docs._jdf.queryExecution().analyzed().toString().strip().splitlines()
    return (all(re.match(r"[ :+-]*(Project|Relation) \[", line) for line in plan) and plan[-1].rstrip().endswith(" parquet")
            and "_metadata" not in docs.columns)


def as_files(docs: DataFrame) -> DataFrame:
    """``docs`` if it is read from files, or else a copy that is, so that it can be scanned twice."""
    return docs if _is_files(docs) else stage(docs, "rows")


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number made of the file's number, in order of the paths,
    and the row's place in the file: the same in every scan, however the files are
    split over tasks.  ``docs`` must come from ``as_files`` if it is scanned again."""
    if not _is_files(docs):
        return numbered(docs)
    path = F.col("_metadata.file_path")
    paths = sorted(r["path"] for r in docs.select(path.alias("path")).distinct().collect())  # one row per file
    files = docs.sparkSession.createDataFrame(list(enumerate(paths)), "_file_number_ bigint, _file_path_ string")
    held = docs.withColumns({"_own_path_": path, "_own_place_": F.col("_metadata.row_index")})
    own = held.join(F.broadcast(files), F.col("_own_path_") == F.col("_file_path_"))
    return own.select(*[F.col(f"`{c}`") for c in docs.columns], (F.shiftleft("_file_number_", 40) + F.col("_own_place_")).alias(ROW))


def rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` (from ``as_files``) whose numbers are in ``chosen`` (a column ``ROW``), with the columns of ``docs``."""
    return placed(docs).join(chosen.select(ROW), ROW, "left_semi").drop(ROW)


def bounds_by_range(df: DataFrame, total: str, part: str = "part") -> dict[int, int]:
    """Running totals before each partition of a table written in range order: one
    row per *partition* comes to the driver, whatever the number of documents."""
    sums = sorted((int(r[part]), int(r["n"])) for r in df.groupBy(part).agg(F.sum(total).alias("n")).collect())
    out, run = {}, 0
    for p, n in sums:
        out[p] = run
        run += n
    return out


def offset_column(before: dict[int, int], part: str = "part"):
    """The running total before a row's partition, as a column."""
    if not before:
        return F.lit(0).cast("long")
    # chunked so that thousands of partitions stay a shallow expression
    keys = sorted(before)
    base = F.array(*[F.lit(before[k]).cast("long") for k in keys])
    if keys == list(range(len(keys))):
        return F.element_at(base, F.col(part).cast("int") + 1)
    where = F.array(*[F.lit(k).cast("int") for k in keys])
    return F.element_at(base, F.array_position(where, F.col(part).cast("int")).cast("int"))
