import re
from collections import Counter

from quality_lake.llm.common import WORD
from quality_lake.llm.quality import RULES, estimate, judge, votes

from .conftest import SF

W = re.compile(WORD)


def brute(text):
    t = text or ""
    w = W.findall(t)
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if W.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), dup, len(covered), failed)


def check(docs):
    got = judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    assert not any(r["kept"] and r["base_failed"] for r in got)
    return got


def test_statistics_against_brute_force(docs, odd, none):
    check(docs)
    check(odd)
    assert judge(none).count() == 0


def test_repeats_of_every_kind(spark):
    texts = ["a a a a a", "a b c a b c", "a b c x a b c y a b c", "a b a b a b a", "x y z", "a a", "b a a a c d e f g", "q w e r t y q w e"]
    check(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))


def test_verdicts_agree_with_labels(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in judge(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r["doc_id"]] for r in labels if r["quality"] == 1 and not got[r["doc_id"]]["base_failed"]]
    bad = [got[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.97 * len(good) and sum(r["kept"] for r in bad) <= 0.1 * len(bad)


def test_a_rule_that_votes_at_random_gets_no_say(spark):
    rules = {k: RULES[k] for k in ("symbols", "symbol_runs", "letters")} | {"noise": ("1.0 * noise", "x < 20", "x > 80")}
    rows = [(100 if i % 10 == 0 else 0, 100 if i % 10 == 0 else 0, 0 if i % 10 == 0 else 100, (i * 37) % 100) for i in range(3000)]
    stats = spark.createDataFrame(rows, "n_symbols long, n_symbol_runs long, n_letters long, noise long").selectExpr("*", "100L AS n_words", "100L AS word_chars")
    shares, good = estimate(votes(stats, rules), list(rules))
    assert abs(good - 0.9) < 0.02
    on_good, on_bad = shares["noise"][-1]
    assert abs(on_good - on_bad) < 0.1 and shares["symbols"][-1][1] > 0.9
