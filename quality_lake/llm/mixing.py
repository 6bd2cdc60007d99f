"""Mixing sources to target weights by blocks of words (operator 2).

Each source's texts, laid end to end in id order, are cut into blocks of
``BLOCK`` words.  The mix is a sequence of slots, ``SHARD`` of them to an output
shard.  A shard draws how many of its slots each source gets from a multinomial
distribution over the target weights; a source's slots are numbered through all
shards, and slot k is block perm(k mod n) of pass k div n, where perm is that
source's pseudorandom permutation of its n blocks.  So every block is taken once
before any is taken twice.  Slots and blocks then meet in a join on (source, block).

The draws of all shards together miss each source's quota by some slots.  The
slots that a source has too many, its last ones, go to the sources that have too
few, so that totals are exact to a block and no text is taken more than ``CAP``
times.

Targets: shares by weight (5, 2, 1, repeating, over the sources in code point
order, null last) of all words; a source stops at ``CAP`` times its own words and
the excess goes to the others by weight, until none is above.

The driver sees one row per source and one per (partition, source) boundary;
more than ``MAX_SOURCES`` sources are refused, not cut.  Everything is a function
of the rows and ``seed``.

Cases: null texts have no words; a text without words is in no block and has
``taken`` 0; null is a source of its own; rows with one id follow each other by
row number; if nothing has a word all targets are 0 and the mix is empty.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import ROW, WORD, as_files, free_names, placed, seeded, slices, text_or_empty

WEIGHTS, CAP = (5, 2, 1), 3
BLOCK, SHARD, MAX_SOURCES = 64, 1 << 14, 100_000

PLAN = "rank int, source string, source_size bigint, target double, blocks bigint, quota bigint"


def targets(sizes: list[int], weights=WEIGHTS, cap: int = CAP) -> list[float]:
    """How many words the mix should hold of each source, given in the order of their ranks."""
    out, left = [0.0] * len(sizes), float(sum(sizes))
    free = [i for i, n in enumerate(sizes) if n > 0]
    while free:
        unit = left / sum(weights[i % len(weights)] for i in free)
        full = [i for i in free if weights[i % len(weights)] * unit > cap * sizes[i]]
        if not full:
            for i in free:
                out[i] = weights[i % len(weights)] * unit
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def quota(size: int, target: float, block: int) -> int:
    """How many blocks make up a target: whole passes, then as much of a pass as comes nearest."""
    if not size:
        return 0
    n, passes = -(-size // block), int(target // size)
    part = min(n, round((target - passes * size) / block))
    return passes * n + part


def plan(sized: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK) -> list[tuple]:
    """One row ``PLAN`` per source, by rank."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(((r["source"], int(r["n"])) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    wanted = targets([n for _, n in rows], weights, cap)
    return [(i, s, n, t, -(-n // block), quota(n, t, block)) for i, ((s, n), t) in enumerate(zip(rows, wanted))]


def sizes(docs: DataFrame) -> DataFrame:
    """``(ROW, doc_id, source, size)``, written down once."""
    return stage(placed(docs).select(
        ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")


def places(sized: DataFrame, rows: list[tuple]) -> DataFrame:
    """``(ROW, doc_id, rank, size, start)``: where each text begins among its source's words."""
    spark = sized.sparkSession
    ranks = F.broadcast(spark.createDataFrame(rows, PLAN).select("rank", F.col("source").alias("named")))
    ranked = sized.join(ranks, sized["source"].eqNullSafe(F.col("named"))).select("rank", "doc_id", ROW, "size")

    def run(batches):
        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            rank, size = np.asarray(batch.column("rank")), np.asarray(batch.column("size"))
            total = np.cumsum(size)
            first = np.flatnonzero(np.diff(rank, prepend=rank[:1] - 1))  # the sort makes a source's rows adjacent
            base = np.repeat((total - size)[first], np.diff(first, append=len(rank)))
            start = total - size - base
            if len(rank) and rank[0] == last:
                start[:first[1] if len(first) > 1 else len(rank)] += at
            if len(rank):
                last, at = rank[-1], int(start[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(start), pa.array(np.full(len(rank), part, np.int32))],
                                             names=["rank", "doc_id", ROW, "size", "within", "part"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = stage(ranked.repartitionByRange(n, "rank", "doc_id", ROW).sortWithinPartitions("rank", "doc_id", ROW)
                 .mapInArrow(run, f"rank int, doc_id bigint, {ROW} bigint, size bigint, within bigint, part int"), "mix-places")
    # ranges follow each other, so there is about one row for each partition and each source
    sums = sorted(tuple(map(int, r)) for r in held.groupBy("rank", "part").agg(F.sum("size")).collect())
    before, out = {}, []
    for rank, part, size in sums:
        out.append((rank, part, before.get(rank, 0)))
        before[rank] = before.get(rank, 0) + size
    ahead = spark.createDataFrame(out, "rank int, part int, ahead bigint")
    return held.join(F.broadcast(ahead), ["rank", "part"]).select(ROW, "doc_id", "rank", "size", (F.col("ahead") + F.col("within")).alias("start"))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1 for each key: four Feistel rounds, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k, x = half[todo], mask[todo], key[todo], out[todo]
        left, right = x >> h, x & m
        for turn in seeded(4, 23):
            mixed = (right + k) * np.uint64(0xBF58476D1CE4E5B9) ^ turn
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


@dataclass
class Settled:
    """The plan as arrays by rank, and how slots drawn too many move."""

    quota: np.ndarray
    blocks: np.ndarray
    drawn: np.ndarray
    seed: int

    def slots(self, rank: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(rank, block, pass)`` of the k-th slot that was drawn for a source."""
        rank, k = rank.copy(), k.copy()
        over, under = np.maximum(self.drawn - self.quota, 0), np.maximum(self.quota - self.drawn, 0)
        spare = np.flatnonzero(k >= self.quota[rank])
        if len(spare):
            number = (np.cumsum(over) - over)[rank[spare]] + k[spare] - self.quota[rank[spare]]
            ends = np.cumsum(under)
            to = np.searchsorted(ends, number, side="right")
            k[spare] = self.drawn[to] + number - (ends - under)[to]
            rank[spare] = to
        n = self.blocks[rank]
        turn = k // n
        key = seeded(len(self.quota), self.seed)[rank] + turn.astype(np.uint64)
        return rank, permuted(k % n, n, key), turn


def draw(spark: SparkSession, rows: list[tuple], seed: int, shard: int = SHARD) -> DataFrame:
    """``(shard, place, rank, block, pass)``: the mix's slots; a shard is read in the order of ``place``."""
    quotas = np.array([r[5] for r in rows], np.int64)
    total = int(quotas.sum())
    out = "shard bigint, place bigint, rank int, block bigint, pass int"
    if not total:
        return spark.createDataFrame([], out)
    share = quotas / total
    shards = -(-total // shard)

    def counts(batches):
        for batch in batches:
            for j in batch.column("id").to_pylist():
                n = np.random.default_rng([seed, j]).multinomial(min(shard, total - j * shard), share)
                got = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), j)), pa.array(got.astype(np.int32)), pa.array(n[got])], names=["shard", "rank", "n"])

    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    drawn = stage(spark.range(0, shards, 1, parts).mapInArrow(counts, "shard bigint, rank int, n bigint"), "mix-draws")
    sums = np.zeros(len(rows), np.int64)
    for r in drawn.groupBy("rank").agg(F.sum("n").alias("n")).collect():
        sums[r["rank"]] = r["n"]
    settled = Settled(quotas, np.array([r[4] for r in rows], np.int64), sums, seed)
    # a row per shard and source: shards of a million words each
    numbered_slots = drawn.selectExpr("shard", "rank", "n", "sum(n) OVER (PARTITION BY rank ORDER BY shard) - n AS ahead")

    def slots(batches):
        for batch in batches:
            at, rank, n, ahead = (np.asarray(batch.column(c)) for c in ("shard", "rank", "n", "ahead"))
            k = np.arange(int(n.sum())) + np.repeat(ahead - (np.cumsum(n) - n), n)
            own, shard_of = np.repeat(rank, n).astype(np.int64), np.repeat(at, n)
            to, block, turn = settled.slots(own, k)
            place = seeded(1, seed)[0] ^ (own.astype(np.uint64) << np.uint64(44)) ^ k.astype(np.uint64)
            place = (place * np.uint64(0xBF58476D1CE4E5B9) ^ (place >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of), pa.array(place.view(np.int64)), pa.array(to.astype(np.int32)),
                                              pa.array(block), pa.array(turn.astype(np.int32))],
                                             names=["shard", "place", "rank", "block", "pass"])

    return numbered_slots.mapInArrow(slots, out)


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(ROW, doc_id, rank, block, first, words)``: the part of each text in each block, from its word ``first`` on."""
    low = F.col("block") * block
    begin, stop = F.greatest(low, F.col("start")), F.least(low + block, F.col("start") + F.col("size"))
    return (placed.filter("size > 0")
            .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
            .select(ROW, "doc_id", "rank", "block", (begin - F.col("start")).alias("first"), (stop - begin).alias("words")))


@dataclass
class Mix:
    manifest: DataFrame  # (shard, place, rank, block, pass, ROW, doc_id, first, words): what the mix holds, in order of (shard, place)
    sized: DataFrame     # (ROW, doc_id, source, size) of every text
    plan: list[tuple]    # a row PLAN per source


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, shard: int = SHARD, seed: int = 1) -> Mix:
    sized = sizes(docs)
    rows = plan(sized, weights, cap, block)
    if not rows:
        rows = [(0, None, 0, 0.0, 0, 0)]
    slots = draw(docs.sparkSession, rows, seed, shard)
    # slots and blocks grow with the corpus, which Spark's estimate of a mapped table does not show: never broadcast
    return Mix(slots.hint("merge").join(pieces(places(sized, rows), block), ["rank", "block"]), sized, rows)


@free_names
def taken(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken)`` of every row."""
    made = mix(docs, **options)
    spark = docs.sparkSession
    words = made.manifest.groupBy(ROW).agg(F.sum("words").alias("taken")).hint("merge")
    sources = F.broadcast(spark.createDataFrame(made.plan, PLAN).select(F.col("source").alias("named"), "source_size", "target"))
    return (made.sized.join(words, ROW, "left").join(sources, made.sized["source"].eqNullSafe(F.col("named")))
            .select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


_WORD = re.compile(WORD)


def cut_words(text: str, runs: list[tuple[int, int]]) -> str:
    """The text of ``(first word, number of words)`` runs, adjacent ones together, the others on lines of their own."""
    spans = [m.span() for m in _WORD.finditer(text)]
    joined: list[list[int]] = []
    for first, n in runs:
        if joined and joined[-1][1] == first:
            joined[-1][1] = first + n
        else:
            joined.append([first, first + n])
    if joined == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in joined)


@free_names
def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row for each pass that
    took words of a text, its text being those words (the whole text where the pass
    took all of it); ``n_chars``, if there, is the new text's length."""
    docs = as_files(docs)
    made = mix(docs, **options)
    runs = (made.manifest.groupBy(ROW, "pass").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_runs_")))  # a text's blocks
    joined = placed(docs).join(runs.hint("merge"), ROW).drop(ROW, "pass")
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = [cut_words(t or "", [(r["first"], r["words"]) for r in own])
                         for t, own in zip(piece.column("text").to_pylist(), piece.column("_runs_").to_pylist())]
                columns = list(piece.columns[:-1])
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = joined.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
