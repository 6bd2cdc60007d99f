import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from quality_lake.llm.common import WORD
from quality_lake.llm.mixing import cut_words, mix, mixed_documents, permuted, quota, taken, targets


def test_targets():
    assert targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    assert targets([10, 1000, 0]) == [30.0, 980.0, 0.0]
    assert targets([0, 0]) == [0.0, 0.0] and targets([]) == []
    for sizes in ([5, 1, 900, 33, 2], [1] * 7, [1000, 1, 1, 1]):
        t = targets(sizes)
        assert abs(sum(t) - sum(sizes)) < 1e-6 and all(x <= 3 * n + 1e-9 for x, n in zip(t, sizes))


def test_quota():
    assert quota(0, 0.0, 64) == 0 and quota(640, 1920.0, 64) == 30 and quota(100, 130.0, 64) == 2


def test_permutation():
    for n in (1, 2, 7, 1000):
        for key in (1, 99):
            got = permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got.tolist()) == list(range(n))
    assert permuted(np.arange(100), np.full(100, 100), np.full(100, 5, np.uint64)).tolist() != list(range(100))


def check(docs, block=64, shard=1 << 14, near=0.03):
    rows = taken(docs, block=block, shard=shard).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    by = defaultdict(int)
    for r in texts:
        by[r["source"]] += len(re.findall(WORD, r["text"] or ""))
    order = sorted(by, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, targets([by[s] for s in order])))
    got = defaultdict(int)
    for r in rows:
        assert r["source_size"] == by[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[r["source"]] += r["taken"]
    for s in order:
        assert abs(got[s] - want[s]) <= max(2 * block, near * want[s])
    again = taken(docs, block=block, shard=shard).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_taken(docs, odd, none):
    check(docs)
    check(docs, block=16, shard=100)
    check(odd, block=8)
    assert taken(none).count() == 0


def test_shards_draw_by_weight_and_blocks_are_used_evenly(docs):
    made = mix(docs, block=16, shard=200)
    per = made.manifest.select("shard", "place", "rank").distinct().groupBy("shard").count().collect()
    assert len(per) > 5 and sorted(r["count"] for r in per)[-1] == 200
    uses = made.manifest.select("rank", "block", "pass").distinct().groupBy("rank", "block").count().groupBy("rank").agg(
        F.max("count").alias("most"), F.min("count").alias("least")).collect()
    assert all(r["most"] - r["least"] <= 1 for r in uses)


def test_documents_of_the_mix(docs, odd):
    for d in (docs, odd):
        out = mixed_documents(d, block=16)
        assert out.schema == d.schema or out.columns == d.columns
        n = sum(len(re.findall(WORD, r["text"])) for r in out.collect())
        assert n == sum(r["taken"] for r in taken(d, block=16).collect())


def test_cut_words():
    assert cut_words("a b  c\nd", [(0, 2), (2, 2)]) == "a b  c\nd"
    assert cut_words(" a b  c\nd ", [(0, 1), (2, 2)]) == "a\nc\nd"
