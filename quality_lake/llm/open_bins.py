"""Best-fit packing with a bounded number of open bins (operator 13).

A text's ids, with the end id behind, are one piece if they fit into a sequence of
``length`` ids; a longer text is cut into pieces of exactly ``length``, but for the
first, which takes the rest.  Whole pieces are sequences of their own.  Every other
piece goes online, as it comes, to the open bin that it leaves with the least room:
open bins stand in lists by free space, and a bitset of the free spaces that some bin
has finds the smallest sufficient one by a shift and its lowest set bit.  At most
``open_bins`` are open: if none has room for a piece and all are in use, the fullest
(the lowest bit) closes and a new one opens.  A bin without room closes by itself.

Each task packs what it reads, without a shuffle: texts never move, a row leaves with
the batch that placed it, and a task's memory is one batch and the open bins' numbers.
Pieces of one slice of texts (``slices``) are placed longest first, which helps best
fit; the slice's size is fixed, so this holds back a bounded number of pieces.  Bins
still open at a task's end stay as they are, about one sequence's room a task; where
tasks are very small, ``partitions`` joins them beforehand, without a shuffle.

Cases: a null text counts as empty; an empty text has the end id only; rows with one
id are packed each on its own, as are rows without one; an empty table gives no rows.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty
from .tokens import encode

OPEN_BINS = 1024
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Bins:
    """Open bins by free space; ``place`` gives a piece's bin and its place there."""

    def __init__(self, length: int, most: int, first: int = 0):
        self.length, self.most, self.next, self.open = length, most, first, 0
        self.free: list[list[int]] = [[] for _ in range(length + 1)]  # bins by free space
        self.spaces = 0  # bit f: a bin with f ids of room is open

    def _take(self, room: int) -> int:
        own = self.free[room]
        number = own.pop()
        self.open -= 1
        if not own:
            self.spaces ^= 1 << room
        return number

    def place(self, size: int) -> tuple[int, int]:
        wide = self.spaces >> size
        if wide and size < self.length:
            room = size + (wide & -wide).bit_length() - 1
            number = self._take(room)
        else:
            number, room = self.next, self.length
            self.next += 1
            if size < room and self.open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
        left = room - size
        if left:
            self.free[left].append(number)
            self.spaces |= 1 << left
            self.open += 1
        return number, self.length - room


def cuts(n: int, length: int) -> list[int]:
    """The lengths of a text's pieces."""
    first = n % length
    return [first] * bool(first) + [length] * (n // length)


def pack_open(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 1024, open_bins: int = OPEN_BINS,
              with_ids: bool = True, partitions: int | None = None) -> DataFrame:
    """The pieces of all texts, as columns ``PIECES`` and ``ids`` (little-endian 32-bit
    numbers; left out if ``with_ids`` is False)."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]

    def run(batches):
        bins = Bins(length, open_bins, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [x.astype("<u4") for x in encode(part.column("text").to_pylist(), tokenizer, end_id)]
                pieces = []  # (length, text, piece, start)
                for text, own in enumerate(ids):
                    start = 0
                    for piece, n in enumerate(cuts(len(own), length)):
                        pieces.append((n, text, piece, start))
                        start += n
                pieces.sort(key=lambda p: -p[0])
                own_ids, rows, raws = part.column("doc_id").to_pylist(), [], []
                for n, text, piece, start in pieces:
                    raw = ids[text][start:start + n].tobytes()
                    rows.append((own_ids[text], piece, start, n, crc32(raw), *bins.place(n)))
                    raws.append(raw)
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(raws, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return (texts.coalesce(partitions) if partitions else texts).mapInArrow(run, PIECES + ", ids binary" * with_ids)
