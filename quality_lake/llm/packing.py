"""Packing along a space-filling curve (operator 4).

A text's hashed word vector (``sqrt`` counts in ``DIMS`` buckets, length 1) is
projected to ``AXES`` dimensions by a fixed random matrix, each axis is cut into
2**``BITS`` cells of equal probability, and the cell's place on the Hilbert curve
is the text's key.  Texts are range-partitioned and sorted by that key, so that
sequences are filled with neighbours; each task lays its texts' ids end to end
and cuts them every ``length`` ids.  What is left at a task's end becomes
sequences of the powers of two that it is the sum of, so nothing is padded.

The sort is by key, then id, then row number: a group of equal texts has one key,
but its rows still spread over many ranges.  A text's ids are made after the
exchange, so ids never move.

Cases: a null text counts as empty; an empty text has the end id only; null ids
sort first; equal rows are packed each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, numbered, seeded, slices, text_or_empty, utf8, word_hashes
from .tokens import encode

DIMS, AXES, BITS = 512, 4, 10
_PROJECTION = np.random.default_rng(5).standard_normal((DIMS, AXES)).astype(np.float32)

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The places on the Hilbert curve of ``(n, axes)`` cells, each below 2**bits (Skilling's transform)."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(axes):
            swap = (x[:, 0] ^ x[:, i]) & low
            flip = (x[:, i] & q) != 0
            x[:, 0] ^= np.where(flip, low, swap)
            x[:, i] ^= np.where(flip, 0, swap)
        q >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, -1] & q, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def curve_keys(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The Hilbert keys of a run of texts."""
    words, counts = word_hashes(raw, offsets, lower=True)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), counts)
    buckets = (words >> np.uint64(40)).astype(np.int64) % DIMS
    vectors = np.sqrt(np.bincount(doc * DIMS + buckets, minlength=n * DIMS).reshape(n, DIMS)).astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    spots = vectors @ _PROJECTION
    share = 1 / (1 + np.exp(-1.702 * spots.astype(np.float64)))  # about the normal distribution function
    return hilbert(np.clip((share * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1))


def along_curve(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(doc_id, text)`` in partitions that follow each other along the curve, sorted within."""
    def keys(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(curve_keys(*utf8(piece.column("text")))), *piece.columns], names=["key", ROW, "doc_id", "text"])

    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (numbered(docs).select(ROW, F.col("doc_id").cast("long"), text_or_empty().alias("text"))
            .mapInArrow(keys, f"key bigint, {ROW} bigint, doc_id bigint, text string")
            .repartitionByRange(n, "key", "doc_id", ROW).sortWithinPartitions("key", "doc_id", ROW)
            .select("doc_id", "text"))


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Fills one partition's sequences.  Whole sequences leave with the batch that
    filled them; only the pieces of an unfinished one are held."""
    sequence = TaskContext.get().partitionId() << 32
    open_pieces: list[tuple] = []  # (doc_id, start, doc_tokens, ids) of the sequence being filled
    fill = 0

    def rows(pieces: list[tuple]) -> list[tuple]:
        out, at = [], 0
        for doc, start, total, ids in pieces:
            raw = ids.astype("<u4").tobytes()
            out.append((doc, start, len(ids), crc32(raw), total, sequence, at, raw))
            at += len(ids)
        return out

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*made))
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        names = [f.split()[0] for f in PIECES.split(", ")]
        if with_ids:
            arrays.append(pa.array(columns[7], pa.binary()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        for piece in slices(batch, "text"):
            made = []
            encoded = encode(piece.column("text").to_pylist(), tokenizer, end_id)
            for doc, ids in zip(piece.column("doc_id").to_pylist(), encoded):
                start = 0
                while start < len(ids):
                    take = min(length - fill, len(ids) - start)
                    open_pieces.append((doc, start, len(ids), ids[start:start + take]))
                    start += take
                    fill += take
                    if fill == length:
                        made += rows(open_pieces)
                        open_pieces, fill, sequence = [], 0, sequence + 1
            if made:
                yield batch_of(made)
    made = []
    for size in (1 << b for b in range(fill.bit_length() - 1, -1, -1) if fill >> b & 1):
        own, room = [], size
        while room:
            doc, start, total, ids = open_pieces.pop(0)
            own.append((doc, start, total, ids[:room]))
            if len(ids) > room:
                open_pieces.insert(0, (doc, start + room, total, ids[room:]))
            room -= len(own[-1][3])
        made += rows(own)
        sequence += 1
    if made:
        yield batch_of(made)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = 1024, with_ids: bool = True) -> DataFrame:
    """The pieces of all texts, as columns ``PIECES`` and ``ids`` (little-endian 32-bit
    numbers; left out if ``with_ids`` is False).  ``sequence_id`` rises along the curve."""
    return along_curve(docs).mapInArrow(
        lambda batches: _cut(batches, tokenizer, end_id, length, with_ids), PIECES + ", ids binary" * with_ids)
