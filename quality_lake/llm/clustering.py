"""Centroid clustering over zone maps along a space-filling curve (operator 11).

Vectors become integers, ``floor(scale * x)``, and everything that decides is exact
integer arithmetic.  They are sorted once along a Hilbert curve through their first
principal axes and written as blocks of ``BLOCK`` neighbours.  A block's zone map is
its minimum and maximum along every principal axis, its size and its sum.

A round compares the boxes with the centroids first.  The difference of a point's
squared distances to two centroids is linear in the point, so its least value over a
box is known from the box alone; a centroid that loses to another one everywhere in
the box is no candidate there.  A block with one candidate adds its stored sum without
a look at its vectors; in the others the candidates alone are compared, by one matrix
product a block.  Tasks add up per cluster and Spark sums those, so the driver sees
``k x dims`` numbers a round, whatever the number of vectors.

The principal axes come from one pass of moments over all vectors; they steer the
order and the boxes' size, never the result.  Rounds end early at a fixed point, as
all further ones would repeat it.

Cases: a null vector, one of another length and one with a null or non-finite
component are left out; a component of 2**27 / scale or more raises, as squared
distances would leave 64 bits; null ids are clustered but start no centroid; rows
that repeat count each; with fewer distinct rows than ``k`` there are fewer
centroids; equal distances go to the smaller number; an empty table gives no rows; a
sum of distances beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .packing import hilbert

#: Vectors in a block, the axes of the curve and the bits of each.
BLOCK, AXES, BITS = 256, 3, 20
#: Vectors that one task sorts and writes.
TASK_VECTORS = 1 << 18
LIMIT = 1 << 27

BLOCKS = "part int, block int, n int, ids array<bigint>, points binary, low binary, high binary, total binary"
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int64())),
                    ("points", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("total", pa.binary())])


def kept_vectors(vectors: DataFrame, dims: int) -> DataFrame:
    """``(vec_id, embedding)`` of the vectors that take part."""
    wrong = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .filter((F.size("embedding") == dims) & ~wrong))


def _integers(column: pa.ListArray, dims: int, scale: int) -> np.ndarray:
    """The integer vectors of a batch, as 64-bit numbers."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * float(scale)).reshape(-1, dims)
    if x.size and not np.abs(x).max() < LIMIT:
        raise OverflowError(f"a component of {LIMIT / scale:g} or more: squared distances would leave 64 bits")
    return x.astype(np.int64)


def moments(kept: DataFrame, dims: int, scale: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and covariance of all vectors; a task gives one row, Spark adds them up."""
    def run(batches):
        n, sums = 0, np.zeros(dims + dims * dims)
        for batch in batches:
            v = _integers(batch.column("embedding"), dims, scale).astype(float)
            n += len(v)
            sums += np.concatenate([v.sum(axis=0), (v.T @ v).ravel()])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()])], names=["n", "sums"])

    parts = kept.select("embedding").mapInArrow(run, "n bigint, sums array<double>")
    rows = (parts.select("n", F.posexplode("sums").alias("place", "x"))
            .groupBy("place").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect())  # dims * (dims + 1) numbers
    if not rows:
        return 0, np.zeros(dims), np.eye(dims)
    n, sums = rows[0]["n"], np.zeros(dims + dims * dims)
    for r in rows:
        sums[r["place"]] = r["x"]
    mean = sums[:dims] / n
    return n, mean, sums[dims:].reshape(dims, dims) / n - np.outer(mean, mean)


def zone_map(kept: DataFrame, dims: int, scale: int, block: int = BLOCK) -> tuple[DataFrame, np.ndarray, int]:
    """The staged blocks in Hilbert order, the rotation to their boxes' axes, and the number of vectors."""
    n, mean, spread = moments(kept, dims, scale)
    values, axes = np.linalg.eigh(spread)
    axes = np.ascontiguousarray(axes[:, ::-1])
    curve = min(AXES, dims)
    width = np.sqrt(np.maximum(values[::-1][:curve], 1e-9))

    def keys(batches):
        for batch in batches:
            spots = (_integers(batch.column("embedding"), dims, scale) - mean) @ axes[:, :curve] / width
            share = 1 / (1 + np.exp(-1.702 * np.clip(spots, -30, 30)))  # cells of about equal probability
            cells = np.clip((share * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(hilbert(cells, BITS)), *batch.columns], names=["key", "tie", "vec_id", "embedding"])

    def blocks(batches):
        part, number, ids, held = TaskContext.get().partitionId(), 0, [], []

        def made(rows: int) -> pa.RecordBatch:
            nonlocal number, ids, held
            own = np.concatenate(held)
            points, held = own[:rows], [own[rows:]]
            spots = points.astype(float) @ axes
            row = {"part": [part], "block": [number], "n": [rows], "ids": [ids[:rows]], "points": [points.astype("<i4").tobytes()],
                   "low": [spots.min(axis=0).tobytes()], "high": [spots.max(axis=0).tobytes()], "total": [points.sum(axis=0).tobytes()]}
            ids, number = ids[rows:], number + 1
            return pa.RecordBatch.from_pydict(row, schema=_ARROW)

        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            held.append(_integers(batch.column("embedding"), dims, scale))
            while len(ids) >= block:
                yield made(block)
        if ids:
            yield made(len(ids))

    cores = kept.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-n // TASK_VECTORS), min(cores, n // (4 * block)))
    ordered = (kept.select(F.monotonically_increasing_id().alias("tie"), "vec_id", "embedding")
               .mapInArrow(keys, "key bigint, tie bigint, vec_id bigint, embedding array<double>")
               .repartitionByRange(tasks, "key", "vec_id", "tie").sortWithinPartitions("key", "vec_id", "tie")
               .select("vec_id", "embedding"))
    return stage(ordered.mapInArrow(blocks, BLOCKS), "zone-map"), axes, n


def candidates(low: np.ndarray, high: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """For boxes ``(b, dims)`` and centroids ``(k, dims)`` along the boxes' axes, the centroids
    that may be nearest (or tie) somewhere in each box, as ``(b, k)`` booleans.

    Least over the box of d(x, j) - d(x, i) is |j|^2 - |i|^2 - 2 max x.(j - i); beyond
    rounding above zero, j is nowhere nearest.
    """
    k = len(spots)
    toward = (spots[None] - spots[:, None]).reshape(k * k, -1)  # row i * k + j: j - i
    reach = high @ np.maximum(toward, 0).T + low @ np.minimum(toward, 0).T
    norms = (spots**2).sum(axis=1)
    least = (norms[None] - norms[:, None]).reshape(1, -1) - 2 * reach
    size = np.maximum(np.abs(low), np.abs(high)) @ np.abs(toward).T + norms.max()
    return ~(least > 1e-9 * size + 1e-6).reshape(-1, k, k).any(axis=1)


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of each point's nearest centroid, the smaller of equals."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = float if 3 * points.shape[1] * most**2 < 1 << 53 else np.int64  # whole numbers, exact in either
    c = centroids.astype(kind)
    return ((c * c).sum(axis=1) - 2 * (points.astype(kind) @ c.T)).argmin(axis=1)


def _blocks_of(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, axes: np.ndarray):
    """Each block's row with the numbers of its candidate centroids."""
    spots = centroids.astype(float) @ axes
    for batch in batches:
        boxes = [np.frombuffer(b"".join(batch.column(c).to_pylist())).reshape(batch.num_rows, -1) for c in ("low", "high")]
        for k, may in enumerate(candidates(*boxes, spots)):
            yield batch, k, np.flatnonzero(may)


def _points(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return np.frombuffer(batch.column("points")[k].as_buffer(), "<i4").reshape(batch.column("n")[k].as_py(), -1).astype(np.int64)


def sums_by_cluster(blocks: DataFrame, centroids: np.ndarray, axes: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """The number and the componentwise sum of the vectors nearest to each centroid."""
    k, dims = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch, row, near in _blocks_of(batches, centroids, axes):
            if len(near) == 1:
                counts[near[0]] += batch.column("n")[row].as_py()
                sums[near[0]] += np.frombuffer(batch.column("total")[row].as_buffer(), np.int64)
                continue
            points = _points(batch, row)
            own = _nearest(points, centroids[near])
            for place, number in enumerate(near):
                mine = points[own == place]
                counts[number] += len(mine)
                sums[number] += mine.sum(axis=0)
        held = np.flatnonzero(counts)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held]), pa.array(sums[held].tolist())],
                                             names=["cluster", "n", "sums"])

    parts = blocks.mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    rows = (parts.select("cluster", "n", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())  # k * dims rows
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["place"]] = int(r["x"])
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray, axes: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    def run(batches):
        for batch, row, near in _blocks_of(batches, centroids, axes):
            points = _points(batch, row)
            own = near[_nearest(points, centroids[near])] if len(near) > 1 else np.repeat(near, len(points))
            away = points - centroids[own]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids")[row].values, pa.array(own.astype(np.int32)), pa.array((away * away).sum(axis=1))],
                names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


@dataclass
class Clustering:
    """``vectors``: vec_id, cluster, distance (a staged table); ``clusters``: cluster,
    centroid, size, inertia, centroid_sha256 (k rows); and the sum of all inertias."""

    vectors: DataFrame
    clusters: DataFrame
    inertia: int | None


_CLUSTERS = "cluster int, centroid array<bigint>, size bigint, inertia bigint, centroid_sha256 string"


def _long(x: int) -> int | None:
    return x if x < 1 << 63 else None


def cluster(vectors: DataFrame, k: int = 8, dims: int = 64, rounds: int = 10, scale: int = 1024, seed: str = "3",
            block: int = BLOCK) -> Clustering:
    """Lloyd's rounds from the ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>``."""
    spark, kept = vectors.sparkSession, kept_vectors(vectors, dims)
    blocks, axes, _ = zone_map(kept, dims, scale, block)
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = kept.filter("vec_id is not null").orderBy(digest, "embedding").limit(k).select("embedding").collect()
    if not first:  # nothing to cluster, or nothing with an id to start from
        return Clustering(stage(assigned(blocks.limit(0), np.zeros((1, dims), np.int64), axes), "assigned"),
                          spark.createDataFrame([], _CLUSTERS), 0)
    centroids = np.floor(np.array([r["embedding"] for r in first]) * float(scale)).astype(np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for number, (n, sums) in sums_by_cluster(blocks, centroids, axes).items():
            moved[number] = [x // n for x in sums]
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    made = stage(assigned(blocks, centroids, axes), "assigned")
    found = {r["cluster"]: (r["n"], int(r["x"])) for r in made.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    rows = []
    for number, own in enumerate(centroids.tolist()):
        n, inertia = found.get(number, (0, 0))
        rows.append((number, own, n, _long(inertia), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()))
    return Clustering(made, spark.createDataFrame(rows, _CLUSTERS), _long(sum(x for _, x in found.values())))
