import random
from collections import defaultdict

from pyspark.sql import functions as F

from quality_lake.llm.line_dedup import CHUNK, ID_BYTES, MOST, chunk_lines, line_dedup, occurrences, one_content, repeats, verdicts

from .conftest import words


def brute(rows):
    """What is left of each row's text, by extending every pair of equal lines to its maximal run."""
    texts = {((i is None, i or 0), k): (t or "").split("\n") for k, (i, t) in enumerate(rows)}
    word = lambda s: bool(s.strip(" \t\x0b\x0c\r"))
    at = defaultdict(list)
    for place in sorted(texts):
        for n, s in enumerate(texts[place]):
            if word(s):
                at[s].append((place, n))
    gone, safe = defaultdict(set), defaultdict(set)
    earlier, again = set(), set()
    for own in at.values():
        for x, (p, i) in enumerate(own):
            for q, j in own[x + 1:]:
                a, b = texts[p], texts[q]
                if i and j and a[i - 1] == b[j - 1] and word(a[i - 1]):
                    continue  # a maximal run begins further up
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                _mark(a, i, j, n, p, q, word, gone, earlier, again)
    for p, n, m in again - earlier:
        safe[p].update(range(n, m + 1))
    out = []
    for (key, k), lines in texts.items():
        left = [s for n, s in enumerate(lines) if n not in gone[key, k] or n in safe[key, k]]
        i, t = rows[k]
        out.append((i, t if len(left) == len(lines) else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def _mark(a, i, j, n, p, q, word, gone, earlier, again):
    worded = [k for k in range(n) if word(a[i + k])]
    if len(worded) > 1:
        gone[q].update(range(j + worded[0], j + worded[-1] + 1))
        for x, y in zip(worded, worded[1:]):
            earlier.add((q, j + x, j + y))
            again.add((p, i + x, i + y))


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = line_dedup(docs)
    assert got.columns[-2:] == ["n_lines", "n_removed_lines"]
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed_lines"]) for r in got.collect()), key=str) == brute(rows)


def test_against_maximal_runs(docs, none):
    check(docs)
    assert line_dedup(none).count() == 0


def test_short_passages_go_wherever_they_stand(spark):
    r = random.Random(3)
    rows = []
    pool = [" ".join(words(6, f"l{k}")) for k in range(60)] + ["", " "]
    for i in range(60):
        own = [" ".join(words(8, f"{i}-{k}")) for k in range(10)]
        begin, at = r.randrange(56), r.randrange(10)
        rows.append((i if i % 9 else None, "\n".join(own[:at] + r.sample(["", " "], i % 2) + pool[begin:begin + 2 + i % 4] + own[at:])))
    rows += [(100, "a b\nc d\n\ne f"), (101, "x\nc d\n\ne f\ny"), (102, "c d\n \ne f"), (103, "z\nz\nz\nz"), (103, None), (104, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(frame)
    got = {r["doc_id"]: r["text"] for r in line_dedup(frame).collect()}
    assert got[101] == "x\ny" and got[102] == "c d\n \ne f"
    assert got[103] in ("z\nz", None)


def test_nothing_but_copies_is_lost(spark):
    passage = [" ".join(words(8, f"p{i}")) for i in range(4)]
    rows = [(i, "\n".join([f"{i} own", *passage, f"{i} end"])) for i in range(30)]
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"{i} own\n{i} end" for i in range(1, 30))


def test_odd_rows(odd):
    check(odd)


def test_long_passages_are_matched_as_chunks(spark):
    """Shared passages of 40 lines at shifting places: nearly all of their later copies are whole chunks."""
    passage = [" ".join(words(8, f"p{i}")) for i in range(40)]
    rows = []
    for i in range(30):
        own = [" ".join(words(8, f"{i}-{k}")) for k in range(12)]
        rows.append((i, "\n".join(own[:i % 12] + passage + own[i % 12:])))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(frame)
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup(frame).collect()}
    assert got[0] == rows[0][1].split("\n") and all(not set(passage) & set(got[i]) for i in range(1, 30))


def test_windows_of_later_chunks_take_no_part(docs):
    found = occurrences(docs)
    _, copies, marks = verdicts(found)
    later = {(r["_row_number_"], r["chunk"]) for r in copies.filter("later").collect()}
    places = {(r["_row_number_"], r["at"]): r["chunk"] for r in found.filter(F.col("kind") != CHUNK).collect()}
    assert later and not any((r["_row_number_"], places[r["_row_number_"], r["at"]]) in later for r in marks.collect())


def test_chunks_cover_all_lines_and_find_their_edges_again():
    r = random.Random(5)
    lines = [" ".join(words(3, r.random())) for _ in range(300)]
    for own in (lines, [""], ["x"] * 100, lines[:1]):
        cut = chunk_lines(own)
        assert [a for a, _ in cut] == [0, *[b for _, b in cut][:-1]] and cut[-1][1] == len(own)
        assert max(b - a for a, b in cut) <= MOST
    whole = {tuple(lines[a:b]) for a, b in chunk_lines(lines)}
    for shift in range(1, 20):
        moved = lines[shift:]
        assert sum(tuple(moved[a:b]) in whole for a, b in chunk_lines(moved)) >= len(chunk_lines(moved)) - 2


def test_colliding_identifiers_are_found(docs):
    clash = occurrences(docs, 0, 1).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    assert not one_content(docs, clash, 0, 1)
    a, b = ([sorted(map(str, d.collect())) for d in repeats(docs, w)] for w in (1, ID_BYTES))
    assert a == b
