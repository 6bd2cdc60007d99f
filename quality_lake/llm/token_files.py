"""Token ids written as binary blocks and read back (operator 7).

A block holds the ids of a run of documents, in ascending id order, as
*frequency ranks* in byte-aligned variable-length coding: the block's table maps
rank to id (rank 0 is its most frequent id), a rank takes one to four bytes, and
the lengths stand apart, two bits each, four to a control byte.  Decoding looks
whole control bytes up in a table and gathers the bytes with numpy.

Blocks are self-contained: the table counts the block's own ids, so a text is
tokenized and written in one pass, a lost task rewrites its own blocks only, and
readers need nothing but the row.  A file is Parquet with one row per block

    part int, block int, ahead long (ids before it in its part),
    doc_ids array<long>, lengths array<long>,
    ranked binary (u32 ids by rank), control binary, data binary

written by Spark's committer, so it works on any store that Spark reaches.

Cases: a null text counts as empty; an empty text still has the end id; null ids
come first; rows with one id follow each other in the order of their texts'
hashes; an empty table gives no blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from zlib import crc32

from quality_lake.sources import scratch_path

from .common import bounds_by_range, offset_column, slices, text_or_empty
from .tokens import encode

#: Ids below this are counted by place, others by sorting.
MOST_COUNTED = 1 << 20
#: Ids in a block, beyond which the next document begins another one.
BLOCK_IDS = 1 << 20
FILE_SCHEMA = ("part int, block int, ahead bigint, doc_ids array<bigint>, lengths array<bigint>, "
               "ranked binary, control binary, data binary")
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("ahead", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("lengths", pa.list_(pa.int64())), ("ranked", pa.binary()), ("control", pa.binary()), ("data", pa.binary())])

#: For each control byte the four lengths that it holds.
_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """``(ranked, control, data)`` of a block's ids."""
    if len(ids) and ids.max() < MOST_COUNTED:
        every = np.bincount(ids)
        values = np.flatnonzero(every)
        counts, inverse = every[values], ids
        rank_of = np.empty(len(every), np.uint32)
        names = values
    else:
        values, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        rank_of = np.empty(len(values), np.uint32)
        names = np.arange(len(values))
    order = np.argsort(-counts, kind="stable")  # ties: the smaller id first
    rank_of[names[order]] = np.arange(len(values), dtype=np.uint32)
    ranks = rank_of[inverse]
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = lengths - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    table = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = table[np.arange(4) < lengths[:, None]]
    return values[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def unpack(n: int, ranked: bytes, control: bytes, data: bytes) -> np.ndarray:
    """A block's ids, as 32-bit numbers."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        more = lengths > k
        ranks[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranked, "<u4")[ranks]


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[dict]:
    part, block, ahead, n = TaskContext.get().partitionId(), 0, 0, 0
    docs: list[int | None] = []
    held: list[np.ndarray] = []

    def made() -> dict:
        ranked, control, data = pack(np.concatenate(held))
        return {"part": [part], "block": [block], "ahead": [ahead], "doc_ids": [docs], "lengths": [[len(x) for x in held]],
                "ranked": [ranked], "control": [control], "data": [data]}

    for batch in batches:
        for piece in slices(batch, "text"):
            ids = encode(piece.column("text").to_pylist(), tokenizer, end_id)
            for doc, own in zip(piece.column("doc_id").to_pylist(), ids):
                docs.append(doc)
                held.append(own)
                n += len(own)
                if n >= BLOCK_IDS:
                    yield made()
                    block, ahead, n, docs, held = block + 1, ahead + n, 0, [], []
    if held:
        yield made()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Tokenizes whole texts and writes their blocks under ``path``.  The range
    exchange moves each text once; ids never move between tasks."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))

    def run(batches):
        for block in _blocks(batches, tokenizer, end_id):
            yield pa.RecordBatch.from_pydict(block, schema=_ARROW)

    # the payload is dense already
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document ``(doc_id, start, n_tokens, ids_crc32, ids)`` from the files: the
    number of ids of all documents before, and the decoded ids as little-endian
    32-bit numbers (``with_ids`` False leaves that column out)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = bounds_by_range(sizes, "n")
    out = "part int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                raw = unpack(sum(row["lengths"]), row["ranked"], row["control"], row["data"])
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                firsts = ends - row["lengths"]
                texts = [raw[a:b].tobytes() for a, b in zip(firsts.tolist(), ends.tolist())]
                columns = {"part": pa.array([row["part"]] * len(ends), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                           "within": pa.array(row["ahead"] + firsts), "n_tokens": pa.array(row["lengths"], pa.int64()),
                           "ids_crc32": pa.array([crc32(x) for x in texts], pa.int64())}
                yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(texts, pa.binary())} if with_ids else {}))

    decoded = files.mapInArrow(run, out)
    return decoded.select("doc_id", (offset_column(before) + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Writes the token files of ``docs`` (under the shared folder unless ``path`` says where) and reads them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(spark, path, with_ids)
