"""Line dedup by content-defined line chunks (operator 6).

A run is two or more lines with words, the blank lines between them included.  Later
copies of runs that occur again go, wherever they begin and end.

A text's lines are hashed, and a rolling hash over the last ``WINDOW`` line hashes
chooses chunk boundaries, so that a passage which many texts share is cut alike in
all of them.  A chunk of two or more lines with words that occurs more than once is
known as a whole: all of it is a later copy everywhere but at its first place.

A run need not hold a whole chunk, and where it does it may reach beyond the chunk's
edges.  What whole chunks leave is therefore matched by its *windows*, two neighbouring
lines with words each: those that lie in no later copy of a chunk are joined over the
corpus.  (The windows of a chunk's later copies also stand in its first place, which is
earlier, so they take no part; in the first place they are known to occur again.)  A line
lies in a later copy of some run exactly if it lies in a window that has an earlier place.

A first place is the smallest id (then row), and in it the first line.  Lines in windows
that have an earlier place go, except those that also lie in the first place of another
repeated window: whatever the copies had is still there.

Chunks and windows are compared by their bytes: those that occur again are read once more
(a bitmap of fixed size preselects them and only lets too many through when full), distinct
``(identifier, bytes)`` pairs are gathered, and if one identifier had two contents
everything would start over with another seed, as in exact dedup.

Occurrences are counted with partial aggregation, and both sides of the joins that
bring the verdicts back are tables, so a chunk that a third of all texts have is
split over tasks.

Cases: null counts as empty and stays null; blank lines around a run stay; lines
are what newlines separate; a text of which everything is removed becomes empty;
null ids count as larger than all others (so that a named text keeps its lines);
other columns stay as they are, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import ROW, as_files, free_names, mix64, placed, seeded, slices, text_or_empty
from .ngram_join import bitmap

#: Lines whose hashes choose a boundary, lines of a usual chunk, and of the longest.
WINDOW, USUAL, MOST = 1, 4, 32
ID_BYTES = 16
_BLANK = " \t\x0b\x0c\r"
_HALF = (1 << 64) - 1
CHUNK, PAIR = 0, 1


def worded(lines: list[str]) -> list[int]:
    """The places of the lines with words."""
    return [k for k, s in enumerate(lines) if s.strip(_BLANK)]


def chunk_lines(lines: list[str]) -> list[tuple[int, int]]:
    """``(first line, line behind the last)`` of a text's chunks, in order and without gaps."""
    h = np.array([xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) for s in lines], np.uint64)
    rolled = np.zeros_like(h)
    for k, factor in enumerate(seeded(WINDOW, 29)):
        rolled[k:] ^= mix64(h[:len(h) - k] * (factor | np.uint64(1)))
    out, start = [], 0
    for stop in [*(np.flatnonzero(rolled % np.uint64(USUAL) == 0) + 1).tolist(), len(lines)]:
        while stop - start > MOST:
            out.append((start, start + MOST))
            start += MOST
        if stop > start:
            out.append((start, stop))
            start = stop
    return out


def content_id(content: str, seed: int, width: int) -> tuple[int, int]:
    """The first ``width`` bytes of a 128-bit hash, as two signed numbers."""
    h = xxhash.xxh3_128_intdigest(content.encode("utf-8", "surrogatepass"), seed) & ((1 << 8 * width) - 1)
    return tuple(k - (1 << 64) if k >> 63 else k for k in (h & _HALF, h >> 64))


def parts(text: str):
    """``(kind, first line, chunk, content)`` of a text's chunks with two lines with words or
    more and of its windows; a window that no one chunk holds has the chunk -1."""
    lines = text.split("\n")
    full = worded(lines)
    if len(full) < 2:
        return
    chunks = chunk_lines(lines)
    starts = np.array([a for a, _ in chunks])
    own = (np.searchsorted(starts, full, side="right") - 1).tolist()
    size = np.bincount(own, minlength=len(chunks))
    for number in np.flatnonzero(size > 1).tolist():
        a, b = chunks[number]
        yield CHUNK, a, number, "\n".join(lines[a:b])
    for k in range(len(full) - 1):
        yield PAIR, full[k], own[k] if own[k] == own[k + 1] else -1, "\n".join(lines[full[k]:full[k + 1] + 1])


def occurrences(docs: DataFrame, seed: int = 0, width: int = ID_BYTES) -> DataFrame:
    """``(ROW, doc_id, kind, at, chunk, k1, k2)`` of every chunk and window."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                out = [(row, doc, kind, at, chunk, *content_id(content, seed, width))
                       for row, doc, text in zip(*(piece.column(k).to_pylist() for k in (ROW, "doc_id", "text")))
                       for kind, at, chunk, content in parts(text)]
                columns = list(zip(*out)) or [[]] * 7
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                                 names=[ROW, "doc_id", "kind", "at", "chunk", "k1", "k2"])

    return placed(docs).select(ROW, F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run, f"{ROW} bigint, doc_id bigint, kind int, at int, chunk int, k1 bigint, k2 bigint")


def one_content(docs: DataFrame, repeated: DataFrame, seed: int, width: int) -> bool:
    """Whether no identifier of ``repeated`` (``k1, k2``) stands for two different contents."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(repeated))

    def run(batches):
        on = shared.value
        bits = len(on) * 64
        for batch in batches:
            for piece in slices(batch, "text"):
                own = {}
                for text in piece.column("text").to_pylist():
                    for *_, content in parts(text):
                        key = content_id(content, seed, width)
                        if all(int(on[k % bits // 64]) >> (k % bits % 64) & 1 for k in key):
                            own[content] = key
                keys = np.array(list(own.values()), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(own.keys(), pa.string())], names=["k1", "k2", "content"])

    read = docs.select(text_or_empty().alias("text")).mapInArrow(run, "k1 bigint, k2 bigint, content string").distinct()
    return read.groupBy("k1", "k2").count().filter("count > 1").isEmpty()


def _first(at: str):
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", ROW, at)).alias("first")


def _here(at: str):
    return (F.col(ROW) == F.col(f"first.{ROW}")) & (F.col(at) == F.col(f"first.{at}"))


def verdicts(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From all occurrences: the chunks and windows that occur again, by identifier (``k1, k2``);
    ``(ROW, chunk, later)`` of every place of a repeated chunk; and ``(ROW, at, later)`` of the
    repeated windows that lie in no later copy of a chunk."""
    chunks = found.filter(F.col("kind") == CHUNK)
    again = stage(chunks.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), _first("chunk")).filter("n > 1"), "repeated-chunks")
    copies = stage(chunks.join(again, ["k1", "k2"]).select(ROW, "chunk", (~_here("chunk")).alias("later")), "chunk-places")
    pairs = (found.filter(F.col("kind") == PAIR).join(copies, [ROW, "chunk"], "left").filter("later IS NULL OR NOT later")
             .select(ROW, "doc_id", "at", "k1", "k2", F.col("later").isNotNull().alias("known")))
    left = stage(pairs, "windows-left")
    repeated = stage(left.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("known").alias("known"), _first("at")).filter("n > 1 OR known"),
                     "repeated-windows")
    marks = left.join(repeated, ["k1", "k2"]).select(ROW, "at", (~_here("at")).alias("later"))
    ids = again.select("k1", "k2").unionByName(repeated.filter("n > 1").select("k1", "k2"))
    return ids, copies, marks


def repeats(docs: DataFrame, width: int = ID_BYTES) -> tuple[DataFrame, DataFrame]:
    """The verdicts on chunks and on windows under identifiers that stand for one content each."""
    for seed in range(8):
        ids, copies, marks = verdicts(stage(occurrences(docs, seed, width), "line-chunks"))
        if one_content(docs, ids, seed, width):
            return copies, marks
        width = min(ID_BYTES, 2 * width)
    raise RuntimeError("identifiers of chunks collide under every seed")


def left_over(lines: list[str], chunks: set[int], later: set[int], first: set[int]) -> list[str]:
    """The lines that stay, given the chunks that are later copies and the first lines of
    windows that have an earlier place, and of repeated ones that have none."""
    full, gone, safe = worded(lines), set(), set()
    if chunks:
        cut = chunk_lines(lines)
        starts = np.array([a for a, _ in cut])
        own = (np.searchsorted(starts, full, side="right") - 1).tolist()
    for k, (a, b) in enumerate(zip(full, full[1:])):
        if a in later or (chunks and own[k] == own[k + 1] and own[k] in chunks):
            gone.update(range(a, b + 1))
        elif a in first:
            safe.update(range(a, b + 1))
    return [s for k, s in enumerate(lines) if k not in gone or k in safe]


@free_names
def line_dedup(docs: DataFrame, width: int = ID_BYTES) -> DataFrame:
    """``docs`` with later copies of repeated runs taken out of ``text``, and ``n_lines``
    and ``n_removed_lines`` behind (columns of those names are replaced)."""
    docs = as_files(docs)
    copies, windows = repeats(docs, width)
    none = F.lit(None).cast("int")
    both = (copies.filter("later").select(ROW, F.col("chunk"), none.alias("at"), F.lit(True).alias("later"))
            .unionByName(windows.select(ROW, none.alias("chunk"), "at", "later")))
    marks = both.groupBy(ROW).agg(  # a text's own chunks and windows
        F.collect_list("chunk").alias("_chunks_"), F.collect_list(F.when(F.col("later"), F.col("at"))).alias("_later_"),
        F.collect_list(F.when(~F.col("later"), F.col("at"))).alias("_first_"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    at = kept.index("text")
    joined = placed(docs).join(marks, ROW, "left").select(*[F.col(f"`{c}`") for c in kept], "_chunks_", "_later_", "_first_")

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                texts, totals, removed = [], [], []
                for text, chunks, later, first in zip(*(piece.column(k).to_pylist() for k in (at, len(kept), len(kept) + 1, len(kept) + 2))):
                    lines = (text or "").split("\n")
                    left = left_over(lines, set(chunks), set(later), set(first)) if chunks or later else lines
                    texts.append("\n".join(left) if len(left) < len(lines) else text)
                    totals.append(len(lines))
                    removed.append(len(lines) - len(left))
                columns = list(piece.columns[:-3])
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], names=[*kept, "n_lines", "n_removed_lines"])

    zero = F.lit(0).cast("long")
    return joined.mapInArrow(run, docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn("n_lines", zero).withColumn("n_removed_lines", zero).schema)
