import random
import re

from pyspark.sql import functions as F

from quality_lake.llm.queries import with_quotes
from quality_lake.llm.quotes import RUN, latest, link_quotes

from .conftest import SF, words

SCHEMA = "conv_id bigint, turn bigint, role string, text string, at string, path string, parent string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def linked(spark, rows):
    return {(r["conv_id"], r["turn"]): r for r in link_quotes(table(spark, rows)).collect()}


def units_of(text):
    """``(level, unit, size)`` of a text, by walking its lines."""
    full = []
    for line in (text or "").split("\n"):
        marks = re.match(r"(?:[ \t]*>)+", line)
        own = line[marks.end():] if marks else line
        w = [x for x in re.split(r"\s+", own.lower(), flags=re.A) if x]
        if w:
            full.append((marks.group().count(">") if marks else 0, w))
    out, i = [], 0
    while i < len(full):
        j = i
        while j < len(full) and full[j][0] == full[i][0]:
            j += 1
        lines = [w for _, w in full[i:j]]
        flat = [x for w in lines for x in w]
        at = range(0, len(flat) - RUN + 1, RUN if full[i][0] else 1)
        out += [(full[i][0], " ".join(flat[k:k + RUN]), RUN) for k in at]
        if full[i][0] and len(flat) > RUN and len(flat) % RUN:
            out.append((full[i][0], " ".join(flat[-RUN:]), len(flat) % RUN))
        out += [(full[i][0], " ".join(w), len(w)) for w in lines if len(w) < RUN]
        if len(flat) < RUN and len(lines) > 1:
            out.append((full[i][0], " ".join(flat), len(flat)))
        i = j
    return out


def brute(rows):
    """(conv, turn) -> (reply_to of each row, parent, depth, position) by loops over each conversation."""
    convs, out = {}, {}
    for k, (conv, turn, _, text) in enumerate(rows):
        convs.setdefault(conv if conv is not None else ("row", k), []).append((-1 if turn is None else turn, k, text))
    for conv, own in convs.items():
        made = {k: units_of(text) for _, k, text in own}
        reply = {}
        for at, k, _ in own:
            sums, quoted, hit = {}, 0, 0
            for level, unit, size in made[k]:
                if level:
                    quoted += 1
                    earlier = [a for a, m, _ in own if a < at and any(lv == 0 and u == unit for lv, u, _ in made[m])]
                    if earlier:
                        hit += 1
                        sums[level, max(earlier)] = sums.get((level, max(earlier)), 0) + size
            best = max(((-lv, n, o) for (lv, o), n in sums.items()), default=None)
            reply[k] = (best[2] if best else None, quoted, hit)
        turns = sorted({a for a, _, _ in own})
        starts = {a: max(reply[k][0] for x, k, _ in own if x == a and reply[k][0] is not None)
                  for a in turns if any(x == a and reply[k][0] is not None for x, k, _ in own)}
        parent, now = {}, None
        for a in turns:
            now = starts.get(a, now)
            parent[a] = now
        place, depth = {}, {}

        def walk(up, d):
            for a in turns:
                if parent[a] == up:
                    place[a], depth[a] = len(place), d
                    walk(a, d + 1)
        walk(None, 1)
        for a, k, _ in own:
            out[k] = (*reply[k][:1], parent[a], depth[a], place[a], *reply[k][1:])
    return out


def check(spark, rows):
    got = link_quotes(table(spark, rows)).collect()
    want = brute(rows)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(key((r["conv_id"], r["turn"], r["reply_to"], r["parent"], r["depth"], r["position"], r["n_quoted"], r["n_linked"])) for r in got) == sorted(
        key((rows[k][0], rows[k][1], *w)) for k, w in want.items())
    return got


def test_nested_quotes_link_to_what_they_quote(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\nIt is long."),
        (1, 1, "assistant", "> How do I sort a list?\nUse sorted()."),
        (1, 2, "user", "Something else altogether."),
        (1, 3, "user", ">> How do I sort  a LIST?\n> Use sorted().\n\nThat worked."),
        (1, 4, "user", "Thanks."),
        (1, 5, "assistant", "> It is long.\nThen stream it."),
        (2, 0, "user", "Use sorted()."),
    ]
    check(spark, rows)
    got = linked(spark, rows)
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, 0, None, 1, None, 0]
    assert [got[1, t]["parent"] for t in range(6)] == [None, 0, 0, 1, 1, 0]
    assert [got[1, t]["depth"] for t in range(6)] == [1, 2, 2, 3, 3, 2]
    assert sorted(range(6), key=lambda t: got[1, t]["position"]) == [0, 1, 3, 4, 2, 5]
    assert got[1, 3]["text"] == "That worked." and got[1, 3]["n_quoted"] == 2 and got[1, 3]["n_linked"] == 2
    assert got[1, 1]["formatted"] == "<|assistant|>\nUse sorted().\n<|end|>"
    assert got[2, 0]["reply_to"] is None


def test_passages_that_were_wrapped_anew(spark):
    original = "The quick brown fox jumps over the lazy dog and then it sleeps\nin the warm sun until the evening comes at last."
    rows = [(1, 0, "a", original), (1, 1, "b", "> the quick brown fox jumps over the lazy\n> dog and then it\n> sleeps in the warm sun\nIt does."),
            (1, 2, "a", "Unrelated."), (1, 3, "c", "> dog and then it sleeps in the warm sun until the evening\nIndeed."), (1, 4, "a", "> dog and then\nno")]
    got = linked(spark, rows)
    check(spark, rows)
    assert got[1, 1]["reply_to"] == 0 and got[1, 3]["reply_to"] == 0
    assert got[1, 4]["reply_to"] is None  # three words that are no line of their own


def test_quotes_that_are_not_found_and_the_latest_of_several(spark):
    rows = [(1, 0, "a", "same line"), (1, 1, "b", "same line"), (1, 2, "a", "> same line\nyes"), (1, 3, "b", "> never said\nno"), (1, 4, "a", "> yes\n> same line\nboth")]
    got = linked(spark, rows)
    check(spark, rows)
    assert got[1, 2]["reply_to"] == 1 and got[1, 3]["reply_to"] is None and got[1, 3]["n_linked"] == 0
    assert got[1, 4]["reply_to"] == 1  # more words than "yes"


def test_random_conversations_against_brute_force(spark):
    for seed in range(3):
        r, rows = random.Random(seed), []
        for conv in range(4):
            said = []
            for turn in range(r.randrange(1, 25)):
                own = [" ".join(words(r.randrange(1, 14), r.random(), 30)) for _ in range(r.randrange(1, 4))]
                lines = list(own)
                for old in r.sample(said, min(len(said), r.randrange(3))):
                    flat = " ".join(old).split()
                    a = r.randrange(len(flat))
                    piece = flat[a:a + r.randrange(1, 20)]
                    cut = r.randrange(1, 6)
                    lines[:0] = ["> " * r.randrange(1, 3) + " ".join(piece[k:k + cut]) for k in range(0, len(piece), cut)]
                said.append(own)
                rows.append((conv if r.random() < 0.95 else None, turn if r.random() < 0.95 else r.choice([None, turn - 1]), "u", "\n".join(lines)))
        check(spark, rows)


def test_deep_chains_grow_with_their_turns(spark):
    rows = [(7, 0, "u", "line number 0")] + [(7, t, "u", f"> line number {t - 1}\nline number {t}") for t in range(1, 400)]
    got = linked(spark, rows)
    assert [(got[7, t]["depth"], got[7, t]["position"], got[7, t]["parent"]) for t in range(400)] == [(t + 1, t, t - 1 if t else None) for t in range(400)]
    flat = linked(spark, [(8, t, "u", "hello") for t in range(300)])
    assert [(flat[8, t]["depth"], flat[8, t]["position"]) for t in range(300)] == [(1, t) for t in range(300)]


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 0, "user", "x"), (1, None, "user", "x"), (1, 0, "user", ""), (1, 0, "user", ""),
            (1, 1, "user", ">" * 50), (1, 2, None, "> x\n>\n> > x\ny"), (1, 2, None, "> x\n>\n> > x\ny"), (2, 5, "user", "z\n" * 20000)]
    got = check(spark, rows)
    assert len(got) == len(rows)
    assert [r["reply_to"] for r in got if r["conv_id"] == 1 and r["turn"] == 2] == [-1, -1]
    assert link_quotes(table(spark, [])).count() == 0


def test_the_given_conversations_with_quotes_put_in(spark):
    df = with_quotes(spark.read.parquet(f"{SF}/conversations.parquet"))
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").count()
    got = check(spark, rows)
    assert sum(r["reply_to"] is not None for r in got) > len(rows) / 5


def test_latest_by_runs_is_latest(spark):
    r = random.Random(4)
    rows = [(r.randrange(3), r.randrange(200), r.random() < 0.2) for _ in range(400)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, k int, t bigint, own boolean")
    for inclusive in (False, True):
        got = {x["i"]: x["out"] for x in latest(df, ["k"], "t", F.col("own"), inclusive, "out", span=16).collect()}
        for i, (k, t, _) in enumerate(rows):
            known = [u for k2, u, own in rows if own and k2 == k and (u < t or (inclusive and u == t))]
            assert got[i] == (max(known) if known else None)


def test_native(spark):
    plan = link_quotes(table(spark, [(1, 0, "a", "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
