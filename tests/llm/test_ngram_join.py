import random
import re
from collections import defaultdict

import numpy as np
import pytest

from quality_lake.llm import ngram_join
from quality_lake.llm.common import WORD
from quality_lake.llm.components import components
from quality_lake.llm.ngram_join import forest, group_links, join, links, one_of_each

from .conftest import words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(WORD, (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        k = find(i)
        least[k] = d if least[k] is None else least[k] if d is None else min(least[k], d)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = join(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)
    return got


def near(seed, base, edits):
    r, w = random.Random(seed), list(base)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def family(n, size, edits):
    """Edited copies of one text, most of them too far from each other to be linked, and a passage that all others share."""
    base, passage = words(size, "base", 5000), " ".join(words(60, "passage", 5000))
    rows = [(i, near(i, base, edits)) for i in range(n)]
    rows += [(n + i, passage + " " + " ".join(words(150, f"o{i}", 5000))) for i in range(60)]
    rows += [(2 * n + 100 + i, " ".join(words(5 + i % 7, i // 3, 6))) for i in range(60)]
    return rows


def test_against_brute_force(docs, odd, none):
    check(docs)
    check(odd)
    assert join(none).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_a_family_of_near_copies(spark, edits):
    check(spark.createDataFrame(family(120, 90, edits), "doc_id bigint, text string"))


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1500)
    check(spark.createDataFrame(family(120, 90, 2), "doc_id bigint, text string"))


def test_chains_are_one_component(spark):
    base = words(400, "chain", 10**6)
    rows = [(i, " ".join(base[5 * i:5 * i + 100])) for i in range(50)]
    got = check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["component_id"] for r in got} == {0}


def test_one_of_each(docs, odd):
    for d in (docs, odd):
        left = one_of_each(d)
        assert left.columns == d.columns
        rows = [(r["doc_id"], r["text"]) for r in d.collect()]
        empty = sum(not shingles(t) for _, t in rows)
        n = len({c for d_, n_, c in brute(rows) if n_}) + empty
        assert abs(left.count() - n) <= 1  # a component without ids is one more


def test_forest_by_pairs():
    r = random.Random(3)
    base = np.array(sorted(r.sample(range(10**9), 60)), np.uint64)
    sets = [np.sort(np.concatenate([r_ := np.array(r.sample(base.tolist(), 52), np.uint64), np.array(r.sample(range(10**9), r.randrange(8)), np.uint64)])) for _ in range(40)]
    want = {(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}

    def joined(links):
        root = list(range(40))
        for a, b in links:
            x, y = root[a], root[b]
            root = [x if v == y else v for v in root]
        return {(i, j) for i in range(40) for j in range(40) if root[i] == root[j]}

    got = forest(np.arange(40), sets)
    assert joined(got) == joined(want) and len(got) < 40


def brute_links(rows):
    """Links between different sets as (ids of the representatives, sizes, overlap), and each row's number of links."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    classes = defaultdict(list)
    for (d, _), own in zip(rows, sets):
        if own:
            classes[own].append(d)
    rep = {own: min(ids, key=lambda d: (d is None, d or 0)) for own, ids in classes.items()}
    different, out, degree = list(classes), [], {own: len(ids) - 1 for own, ids in classes.items()}
    for i, a in enumerate(different):
        for b in different[:i]:
            k = len(a & b)
            if k and 100 * k >= 80 * len(a | b):
                out.append((*sorted([(str(rep[a]), len(a)), (str(rep[b]), len(b))]), k))
                degree[a] += len(classes[b])
                degree[b] += len(classes[a])
    members = sorted(((d, rep[own], len(own), degree[own]) for (d, _), own in zip(rows, sets) if own), key=str)
    return sorted(out), members


def check_links(docs):
    pairs, members = links(docs)
    want, degrees = brute_links([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = sorted((*sorted([(str(r["a_id"]), r["a_size"]), (str(r["b_id"]), r["b_size"])]), r["overlap"]) for r in pairs.collect())
    assert got == want
    assert sorted(((r["doc_id"], r["rep_id"], r["n_shingles"], r["n_links"]) for r in members.collect()), key=str) == degrees
    return want


def test_every_link_between_different_texts(spark, docs, odd, none, monkeypatch):
    for d in (docs, odd):
        check_links(d)
    pairs, members = links(none)
    assert pairs.count() == 0 and members.count() == 0
    family_ = spark.createDataFrame(family(120, 90, 1), "doc_id bigint, text string")
    assert len(check_links(family_)) > 1000  # many more than connect the family
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1500)
    check_links(family_)


def test_links_by_products_and_by_lists(monkeypatch):
    r = random.Random(6)
    pool = [r.randrange(10**12) for _ in range(80)]
    sets = [np.array(sorted({*r.sample(pool, 74), *(r.randrange(10**12) for _ in range(r.randrange(5)))}), np.uint64) for _ in range(130)]
    sets += [np.array(sorted(r.sample(range(10**6), 9)), np.uint64) for _ in range(5)] + [np.array([3], np.uint64), np.array([3, 4], np.uint64)]
    cids = np.array(r.sample(range(10**6), len(sets)))
    want = sorted((*sorted((int(cids[i]), int(cids[j]))), k) for i in range(len(sets)) for j in range(i)
                  if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 80 * len(np.union1d(sets[i], sets[j])))
    assert sorted(group_links(cids, sets)) == want and len(want) > 500
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    monkeypatch.setattr(ngram_join, "LINK_ROWS", 10)
    assert sorted(group_links(cids, sets)) == want


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + (37 * i) % 211, 1000 + (37 * (i + 1)) % 211) for i in range(200)]
    got = {x["node"]: x["label"] for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    near_ = defaultdict(set)
    for a, b in links:
        if a != b:
            near_[a].add(b)
            near_[b].add(a)
    for node in near_:
        seen, todo = {node}, [node]
        while todo:
            for m in near_[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[node] == min(seen)
    assert set(got) == set(near_)
