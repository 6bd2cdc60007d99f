import hashlib
from collections import Counter

import numpy as np

from quality_lake.llm.common import ROW
from quality_lake.llm.exact_dedup import LEAST, MOST, chunk_ends, dedup_decisions, exact_dedup, verified


def brute(rows):
    best = {}
    for i, t in rows:
        k = t or ""
        best[k] = max(best.get(k, -1), -1 if i is None else i)
    sizes = Counter(t or "" for _, t in rows)
    return Counter((i, None if best[t or ""] == -1 else best[t or ""], sizes[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def check(docs):
    got = dedup_decisions(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute(rows)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len({t or "" for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_against_brute_force(docs, odd, none):
    check(docs)
    check(odd)
    assert dedup_decisions(none).count() == 0


def test_rows_that_stay_keep_all_columns(odd):
    left = exact_dedup(odd)
    assert left.columns == odd.columns
    texts = [r["text"] or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r["text"] or "" for r in odd.collect()}
    assert ROW not in left.columns


def test_colliding_identifiers_are_found_and_widened(docs):
    assert verified(docs, 1)[1] > 1
    a = {(r["doc_id"], r["keep_id"]) for r in dedup_decisions(docs, 1).collect()}
    assert a == {(r["doc_id"], r["keep_id"]) for r in dedup_decisions(docs).collect()}


def test_chunks_resist_shifts():
    raw = np.frombuffer(np.random.default_rng(1).bytes(200_000), np.uint8)
    (a,) = chunk_ends(raw, np.array([0, len(raw)]))
    (b,) = chunk_ends(np.concatenate([raw[:7], raw]), np.array([0, len(raw) + 7]))
    assert a[-1] == len(raw) and max(np.diff([0, *a])) <= MOST and min(np.diff([0, *a[:-1]])) >= LEAST
    assert len(set(a) & {x - 7 for x in b}) > 0.9 * len(a)


def test_a_text_is_cut_alike_wherever_it_stands_in_a_batch():
    raw = np.frombuffer(np.random.default_rng(2).bytes(50_000), np.uint8)
    (alone,) = chunk_ends(raw, np.array([0, len(raw)]))
    _, after = chunk_ends(np.concatenate([raw[:999], raw]), np.array([0, 999, 999 + len(raw)]))
    assert alone == [x - 999 for x in after]
