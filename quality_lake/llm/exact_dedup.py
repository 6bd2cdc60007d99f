"""Exact dedup by content-defined chunk recipes (operator 1).

Each text is cut into chunks where a rolling (gear) hash of the last 32 bytes
says so.  A chunk's identifier is a 128-bit hash; identifiers are *verified*: all
distinct ``(identifier, bytes)`` pairs are gathered once, with map-side partial
aggregation, and if one identifier has two contents the run starts over with a
wider identifier and another seed.  A text is then its ordered list of verified
identifiers, its recipe, and two texts are equal exactly when their recipes are:
groups are formed on recipes, so a long text moves once at most (as chunks, in
the verification) and a chunk that many texts share moves once per task.

Cases: a null text counts as empty; empty texts are equal to each other; of equal
texts the row with the largest id stays, of several such rows the last one read;
a null id is smaller than any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import ROW, as_files, free_names, placed, rows_of, seeded, slices, text_or_empty, utf8

#: Chunk sizes in bytes: none shorter (but a text's last), the usual, none longer.
LEAST, USUAL, MOST = 256, 2048, 16384
#: Bytes of a chunk identifier.
ID_BYTES = 16

_GEAR = (seeded(256, 11) >> np.uint64(32)).astype(np.uint32)


def _gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash of the 32 bytes up to each position, by doubling the window five times."""
    h = _GEAR[raw]
    for width in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h = wider
    return h


def chunk_ends(raw: np.ndarray, offsets: np.ndarray) -> Iterator[list[int]]:
    """For each text of a run, the ends of its chunks (positions in ``raw``).  Only a
    text's own bytes decide: a boundary has ``LEAST`` >= 32 bytes of it before it."""
    hits = np.flatnonzero(_gear(raw) < np.uint32((1 << 32) // USUAL)) + 1
    firsts = np.searchsorted(hits, offsets)
    for i in range(len(offsets) - 1):
        start, stop = int(offsets[i]), int(offsets[i + 1])
        ends = []
        for hit in [*hits[firsts[i]:firsts[i + 1]].tolist(), stop]:
            while hit - start > MOST:
                start += MOST
                ends.append(start)
            if hit - start >= LEAST and hit < stop:
                ends.append(hit)
                start = hit
        if start < stop:
            ends.append(stop)
        yield ends


def chunk_id(chunk: bytes, seed: int, width: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)[:width]


def _chunked(part: pa.RecordBatch, seed: int, width: int):
    """The identifiers and chunks of each text of a run of bounded bytes."""
    raw, offsets = utf8(part.column("text"))
    data = raw.tobytes()
    for i, ends in enumerate(chunk_ends(raw, offsets)):
        chunks, start = [], int(offsets[i])
        for end in ends:
            chunks.append(data[start:end])
            start = end
        yield [chunk_id(c, seed, width) for c in chunks], chunks


def recipes(docs: DataFrame, seed: int = 0, width: int = ID_BYTES) -> DataFrame:
    """``(ROW, doc_id, text_sha256, recipe)``; the recipe is the identifiers in order, end to end."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                made = [b"".join(ids) for ids, _ in _chunked(part, seed, width)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(ROW), part.column("doc_id"), part.column("text_sha256"), pa.array(made, pa.binary())],
                    names=[ROW, "doc_id", "text_sha256", "recipe"])

    text = text_or_empty()
    return (placed(docs).select(ROW, F.col("doc_id").cast("long"), text.alias("text"), F.sha2(text, 256).alias("text_sha256"))
            .mapInArrow(run, f"{ROW} long, doc_id long, text_sha256 string, recipe binary"))


def distinct_chunks(docs: DataFrame, seed: int = 0, width: int = ID_BYTES) -> DataFrame:
    """Every distinct ``(id, chunk)`` of the corpus; copies within a run of texts and a task fall away before the shuffle."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                seen = {}
                for ids, chunks in _chunked(part, seed, width):
                    seen.update(zip(chunks, ids))
                yield pa.RecordBatch.from_arrays([pa.array(seen.values(), pa.binary()), pa.array(seen.keys(), pa.binary())], names=["id", "chunk"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, "id binary, chunk binary").distinct()


def verified(docs: DataFrame, width: int = ID_BYTES) -> tuple[int, int]:
    """A seed and width under which no two different chunks of ``docs`` have one identifier."""
    for seed in range(8):
        if distinct_chunks(docs, seed, width).groupBy("id").count().filter("count > 1").isEmpty():
            return seed, width
        width = min(ID_BYTES, 2 * width)
    raise RuntimeError("chunk identifiers collide under every seed")


@free_names
def dedup_decisions(docs: DataFrame, width: int = ID_BYTES) -> DataFrame:
    """``(ROW, doc_id, keep_id, group_size, kept, text_sha256)`` of every row.

    Only groups of two or more go into the table that is joined back, and both
    sides of that join are tables, so that a group holding a third of all rows is
    split over tasks by skew handling.
    """
    made = stage(recipes(docs, *verified(docs, width)), "recipes")
    groups = stage(made.groupBy("recipe").agg(F.max(F.struct("doc_id", ROW)).alias("keep"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1"), "recipe-groups")
    joined = made.join(groups, "recipe", "left")
    return joined.select(
        ROW, "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col(f"keep.{ROW}") == F.col(ROW))).alias("kept"), "text_sha256")


@free_names
def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay."""
    docs = as_files(docs)
    return rows_of(docs, dedup_decisions(docs).filter("kept"))
