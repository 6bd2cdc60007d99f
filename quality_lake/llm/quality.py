"""Quality rules as weak supervision (operator 3, DataFrame functions only).

Rules look at a text's statistics and vote good (1), bad (-1) or abstain (0); no
single rule decides.  Expectation-maximisation over the table of vote patterns
(at most 3**rules rows, whatever the corpus) estimates how often each rule votes
each way on good and on bad texts, and the share of good texts; a text's
posterior probability of being good decides.  The table is one aggregation; the
rounds are sums over it.

The text is read once; its statistics are written to a small table.

Cases: a null or empty text has no words, so the base rules fail it; lines and
words are split at ASCII white space only; with no text at all the result is
empty; equal texts get equal verdicts; columns other than the id and the text are
ignored.
"""

from __future__ import annotations

from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import WORD, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: rule: (statistic, bad if, good if); otherwise the rule abstains.  Each kind of
#: junk is looked at by two or three rules, whose agreement tells it from noise.
RULES = {
    "symbols": ("100.0 * n_symbols / greatest(word_chars, 1)", "x > 8", "x < 2"),
    "symbol_runs": ("100.0 * n_symbol_runs / greatest(n_words, 1)", "x > 20", "x < 5"),
    "letters": ("100.0 * n_letters / greatest(word_chars, 1)", "x < 80", "x > 92"),
    "capitals": ("100.0 * n_capitals / greatest(n_letters, 1)", "x > 30", "x < 10"),
    "shouts": ("100.0 * n_shouts / greatest(n_words, 1)", "x > 20", "x < 5"),
    "repeats": ("100.0 * n_repeat_words / greatest(n_words, 1)", "x > 30", "x < 12"),
    "lines": ("100.0 * n_dup_lines / greatest(n_lines, 1)", "x > 40", "x < 10"),
    "variety": ("100.0 * n_distinct_words / greatest(n_words, 1)", "x < 15", "x > 30"),
    "word_length": ("1.0 * word_chars / greatest(n_words, 1)", "x < 2.2 OR x > 14", "x BETWEEN 3 AND 9"),
    "endings": ("100.0 * n_ended_lines / greatest(n_lines, 1)", "x < 10", "x > 50"),
}
ROUNDS = 200
#: Posterior of a text that some rule calls bad, and of any other, before the first round.
FIRST = (0.1, 0.95)


def repeat_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur at least twice in the text.

    Windows are hashed; only if two hashes are equal (one linear pass over numbers)
    are they sorted with their places, and neighbours compared word by word.
    """
    n = F.size(words)
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return hashes


def statistics(docs: DataFrame) -> DataFrame:
    """The statistics of every text, by ``doc_id``."""
    text = text_or_empty()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
                       F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    hashed = base.withColumn("h", repeat_words(F.col("w")))
    same = F.size(F.array_distinct("h")) < F.size("h")
    # (hash, place) in order; a window is repeated if a neighbour has its hash and its words
    placed = hashed.withColumn("s", F.when(same, F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def like(a: Column, j: Column) -> Column:
        b = F.get("s", j)
        return (b["h"] == a["h"]) & reduce(lambda x, y: x & y, (F.get("w", a["i"] + k) == F.get("w", b["i"] + k) for k in range(3)))

    found = placed.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(F.array_compact(F.transform(
        "s", lambda a, j: F.when(F.coalesce(like(a, j - 1), F.lit(False)) | F.coalesce(like(a, j + 1), F.lit(False)), a["i"]))))))
    covered = F.aggregate(F.transform("p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("p", j + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return found.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{L}+", ""))).cast("long").alias("n_letters"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        F.regexp_count("t", F.lit("!!")).cast("long").alias("n_shouts"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct_words"),
        F.size(F.filter("lines", lambda s: s.rlike(r"[.!?:;\"'»)][\x20\x09-\x0D]*$"))).cast("long").alias("n_ended_lines"))


def votes(stats: DataFrame, rules=RULES) -> DataFrame:
    """``stats`` with a column ``vote_<rule>`` for each rule."""
    made = {f"vote_{name}": F.expr(f"CASE WHEN {bad.replace('x', f'({x})')} THEN -1 WHEN {good.replace('x', f'({x})')} THEN 1 ELSE 0 END")
            for name, (x, bad, good) in rules.items()}
    return stats.withColumns(made)


def log_odds(names: list[str], shares: dict, good: float) -> Column:
    """The log odds of good for a row's votes; ``shares[name][vote]`` has its share on good and on bad texts."""
    terms = [F.log(F.lit(good / (1 - good)))]
    for name in names:
        cases = [(v, on_good / on_bad) for v, (on_good, on_bad) in shares[name].items()]
        term = F.lit(None)
        for v, ratio in cases:
            term = F.when(F.col(f"vote_{name}") == v, F.log(F.lit(ratio))).otherwise(term)
        terms.append(term)
    return reduce(lambda a, b: a + b, terms)


def estimate(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[dict, float]:
    """Vote shares of every rule on good and bad texts, and the share of good texts.

    The corpus is aggregated to its vote patterns, of which there are 3**rules at
    most; the rounds themselves are sums over that table on the driver.
    """
    columns = [f"vote_{n}" for n in names]
    rows = voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((tuple(r[c] for c in columns), r["n"]) for r in rows)
    total = sum(n for _, n in patterns)
    posterior = [FIRST[0] if min(p) < 0 else FIRST[1] for p, _ in patterns]
    shares, good = {n: {v: (1 / 3, 1 / 3) for v in (-1, 0, 1)} for n in names}, 0.5
    for _ in range(rounds if total else 0):
        on_good = sum(n * q for (_, n), q in zip(patterns, posterior))
        on_bad = total - on_good
        before, good = good, (on_good + 1) / (total + 2)
        for k, name in enumerate(names):
            seen = {v: [0.0, 0.0] for v in (-1, 0, 1)}
            for (p, n), q in zip(patterns, posterior):
                seen[p[k]][0] += n * q
                seen[p[k]][1] += n * (1 - q)
            shares[name] = {v: ((g + 1) / (on_good + 3), (b + 1) / (on_bad + 3)) for v, (g, b) in seen.items()}
        if abs(good - before) < 1e-9:
            break
        ratios = [{v: log(g / b) for v, (g, b) in shares[name].items()} for name in names]
        base = log(good / (1 - good))
        posterior = [1 / (1 + exp(-max(-700.0, min(700.0, base + sum(r[v] for r, v in zip(ratios, p)))))) for p, _ in patterns]
    return shares, good


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """The statistics, votes, ``quality`` (posterior), ``base_failed`` and ``kept`` of every text."""
    voted = votes(stage(statistics(docs), "text-statistics"), rules)
    names = list(rules)
    odds = log_odds(names, *estimate(voted, names))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (voted.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
