import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quality_lake.llm.resampling import Dictionary, bucket_counts, features, gains, joined_crc, resample

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_features(text, n, buckets):
    w = words_of(text)
    return [crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, n, buckets, least, percent, seed="2024"):
    s = Counter(b for _, t in rows for b in brute_features(t, n, buckets))
    g = Counter(b for t in target for b in brute_features(t, n, buckets))
    S, T = sum(s.values()), sum(g.values())
    out = []
    for i, t in rows:
        own = brute_features(t, n, buckets)
        weight = sum(math.floor(1000 * math.log((g[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in own)
        h = int(hashlib.sha256((f"{seed}:{i}" if i is not None else seed).encode()).hexdigest()[:8], 16)
        out.append([i, len(words_of(t)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = [r for r in out if r[1] >= least]
    drawn = sorted(able, key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[2]))[:percent * len(able) // 100]
    return out, [(r[0], r[4]) for r in drawn]


def check(docs, target, **p):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, drawn = brute(rows, [r["text"] for r in target.collect()], p["n"], p["buckets"], p["least_words"], p["percent"])
    got = resample(docs, target, **p).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, ((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got))) == sorted(map(key, want))
    ranked = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [r[1:] for r in ranked] == drawn
    return got


def test_the_given_tables_against_brute_force(spark, docs):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    check(docs, target, n=1, buckets=10_000, least_words=20, percent=10)
    check(docs, target, n=3, buckets=997, least_words=1, percent=50)


def test_odd_and_empty_tables(spark, odd, none):
    target = spark.createDataFrame([(1, "one two three"), (2, None), (3, ""), (4, "ONE w17 W17")], "item_id bigint, text string")
    for n in (1, 2):
        check(odd, target, n=n, buckets=64, least_words=2, percent=100)
        check(odd, target.limit(0), n=n, buckets=64, least_words=0, percent=30)
    assert resample(none, target).count() == 0


@given(st.binary(max_size=30), st.binary(max_size=3000))
@settings(max_examples=200, deadline=None)
def test_joined_crcs(a, b):
    made = joined_crc(np.array([crc32(a)], np.uint32), np.array([crc32(b)], np.uint32), np.array([len(b)]))
    assert made[0] == crc32(a + b)


def test_a_crc_is_carried_over_long_words():
    a, b = b"x" * 7, bytes(5_000_000)
    assert joined_crc(np.array([crc32(a)], np.uint32), np.array([crc32(b)], np.uint32), np.array([len(b)]))[0] == crc32(a + b)


@given(st.lists(st.text(st.sampled_from(list("abZz 9.\n\t\x00é漢  -")), max_size=60), min_size=1, max_size=6),
       st.integers(1, 3), st.sampled_from([8, 64, 1 << 20]))
@settings(max_examples=200, deadline=None)
def test_features_whatever_the_parts(texts, n, most):
    small = Dictionary(most_words=40, first_words=3)  # learns, fills up and leaves the rest to the bytes
    for _ in range(2):  # the second time from the automaton
        got = [[] for _ in texts]
        words = [0] * len(texts)
        for first, counts, text, buckets in features(pa.record_batch({"text": pa.array(texts)}), small, n, 1009, most):
            for i, c in enumerate(counts):
                words[first + i] += c
            for i, b in zip(text, buckets):
                got[first + i].append(int(b))
        assert [sorted(g) for g in got] == [sorted(brute_features(t, n, 1009)) for t in texts]
        assert words == [len(words_of(t)) for t in texts]


def test_the_automaton_emits_what_the_bytes_give():
    r = random.Random(3)
    pool = ["".join(r.choice("abcdé") for _ in range(r.randrange(1, 9))) for _ in range(900)] + ["w" * 65, "v" * 70_000]
    batch = pa.record_batch({"text": pa.array([" , ".join(r.choices(pool, k=400)) for _ in range(30)])})
    learns, never = Dictionary(first_words=10), Dictionary(most_words=0)
    for _ in range(3):
        both = [np.concatenate([b for *_, b in features(batch, d, 2, 1 << 30)]) for d in (learns, never)]
        assert np.array_equal(*both)
    assert learns.automaton is not None and never.automaton is None
    assert all(len(w) <= 64 for w in learns.known)


def test_counts_and_gains(spark, docs):
    counts = bucket_counts(docs, 1, 50)
    assert counts.sum() == sum(len(words_of(r["text"])) for r in docs.collect())
    assert gains(np.array([0, 9]), np.array([0, 9])).tolist() == [0, 0]


def test_a_third_of_all_rows_with_one_text_and_score(spark):
    rows = [(None, "a b c d") for _ in range(200)] + [(i, f"w{i} a b c") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    check(docs, docs.limit(0), n=1, buckets=100, least_words=1, percent=40)
