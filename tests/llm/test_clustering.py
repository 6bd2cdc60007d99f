import hashlib
import random

import numpy as np
import pytest

from quality_lake.llm import clustering
from quality_lake.llm.clustering import _nearest, candidates, cluster, kept_vectors, zone_map

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, distance string, key string, n string, part string"


def brute(rows, k, dims, rounds, scale, seed="3"):
    """Lloyd's rounds with Python's whole numbers: (vec_id, cluster, distance) of every kept row, and the centroids."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest(), x[1]))[:k]
    c = [list(v) for _, v in first]
    if not c:
        return [], []

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i if i is not None else -1, *near(v)[::-1]) for i, v in kept)), c


def held(found):
    return sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"]) for r in found.vectors.collect())


def check(spark, rows, **params):
    df = spark.createDataFrame([(i, v, 0, "c", "d", "k", "n", "p") for i, v in rows], SCHEMA).repartition(3)
    found = cluster(df, block=params.pop("block", 16), **params)
    want, centroids = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], params["k"], params["dims"], params["rounds"], params["scale"])
    assert held(found) == want
    clusters = {r["cluster"]: r for r in found.clusters.collect()}
    assert [clusters[j]["centroid"] for j in range(len(centroids))] == centroids
    assert found.inertia == sum(d for *_, d in want)
    for j, m in enumerate(centroids):
        assert clusters[j]["inertia"] == sum(d for _, c, d in want if c == j) and clusters[j]["size"] == sum(c == j for _, c, _ in want)
        assert clusters[j]["centroid_sha256"] == hashlib.sha256(",".join(map(str, m)).encode()).hexdigest()
    return found


def test_the_given_vectors_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(spark, rows, k=8, dims=64, rounds=10, scale=1024, block=64)


@pytest.mark.parametrize("seed", range(3))
def test_ties_copies_and_few_values(spark, seed):
    r = random.Random(seed)
    rows = [(r.randrange(60), [r.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for _ in range(300)]
    rows += [(1000 + i, [0.25, 0.25, 0.25]) for i in range(200)]  # one vector has two fifths of all rows
    check(spark, rows, k=5, dims=3, rounds=4, scale=8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [0.5]), (4, [0.5, None]), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, [-inf, 1.0]), (8, [1.0, 2.0, 3.0]),
            (9, []), (None, [0.75, 1.0]), (None, [0.75, 1.0]), (10, [-3.999, 4.0]), (10, [-3.999, 4.0]), (1, [0.5, 1.0])]
    found = check(spark, rows, k=8, dims=2, rounds=3, scale=1024)
    assert found.vectors.count() == 6 and found.clusters.count() == 4
    assert cluster(spark.createDataFrame([], SCHEMA), dims=2).vectors.count() == 0
    only = cluster(spark.createDataFrame([(None, [1.0, 2.0])], "vec_id bigint, embedding array<float>"), dims=2)
    assert only.vectors.count() == 0 and only.inertia == 0  # nothing to start from


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="would leave 64 bits"):
        cluster(df, dims=2)
    large = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(0).uniform(-131000, 131000, (40, 2)))]
    check(spark, large, k=4, dims=2, rounds=3, scale=1024)  # whole numbers of 64 bits instead of doubles


def test_a_box_never_loses_its_nearest_centroid():
    g = np.random.default_rng(1)
    for _ in range(300):
        dims, k = g.integers(1, 6), g.integers(1, 7)
        points = g.integers(-30, 30, (g.integers(1, 20), dims)) // g.integers(1, 20)
        centroids = g.integers(-30, 30, (k, dims))
        centroids[g.integers(k)] = centroids[0]
        turn = np.linalg.qr(g.standard_normal((dims, dims)))[0]
        spots = points @ turn
        may = candidates(spots.min(axis=0)[None], spots.max(axis=0)[None], centroids @ turn)[0]
        d = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert may[d.argmin(axis=1)].all()
        assert (d.argmin(axis=1) == _nearest(points, centroids)).all()


def test_boxes_of_neighbours_leave_few_candidates(spark):
    """Eight far groups: nearly every block has one candidate, and a round reads no vectors of it."""
    g = np.random.default_rng(2)
    middles = g.uniform(-1, 1, (8, 6))
    rows = [(i, (middles[i % 8] + 0.01 * g.standard_normal(6)).tolist()) for i in range(4000)]
    blocks, axes, n = zone_map(kept_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 6), 6, 1024, 64)
    assert n == 4000 and sum(r["n"] for r in blocks.select("n").collect()) == 4000
    spots = np.floor(1024 * middles) @ axes
    boxes = blocks.select("low", "high").collect()
    left = candidates(np.stack([np.frombuffer(r["low"]) for r in boxes]), np.stack([np.frombuffer(r["high"]) for r in boxes]), spots)
    assert (left.sum(axis=1) == 1).mean() > 0.8


def test_blocks_hold_hilbert_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    blocks, _, n = zone_map(kept_vectors(df, 64), 64, 1024, 32)
    rows = blocks.collect()
    assert sorted(i for r in rows for i in r["ids"]) == sorted(r["vec_id"] for r in df.collect()) and n == 500
    assert all(len(r["ids"]) == r["n"] <= 32 for r in rows)
    for r in rows:
        points = np.frombuffer(r["points"], "<i4").reshape(-1, 64)
        assert np.frombuffer(r["total"], np.int64).tolist() == points.sum(axis=0).tolist()


def test_production_limits_are_bounds_not_caps():
    assert clustering.TASK_VECTORS * 64 * 4 <= 1 << 27  # a task's integers
