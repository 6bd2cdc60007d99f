"""Toxicity by a linear classifier over naive-Bayes-scaled character n-grams (operator 9).

Features are character n-grams (``LEAST`` to ``MOST`` code points, lower-cased), told
by whole 64-bit hashes; buckets of ``BUCKET_BITS`` bits only preselect.  From a
bounded sample of labelled texts come each n-gram's log-count ratio r = log(p/q) of
its smoothed shares among toxic and other texts; n-grams whose shares differ
significantly are kept.  A feature's value is its places per ``PER_CHARS`` characters
times r, so that a text is judged by how densely features stand in it and not by its
length; a ridge logistic regression is fitted by Newton's method on sparse rows.

Scoring is one pass over the whole text: hash, look up, add.  A text's score is that
of its most toxic window of 2 x ``STEP`` characters (windows begin every ``STEP``), so
that a toxic passage counts in a long text as it does in a short one.

Labels are learned from at most ``SAMPLE`` rows of each class, drawn by a hash of
the id (a documented bound on the labelled rows; scoring covers everything).

Cases: a null or empty text scores like a text without any feature; rows whose
label is null or whose id is null are not learned from; with no label of one of
the classes every score is 0; repeated labels count once per row; ties at the
sample's end go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, seeded, slices, text_or_empty, word_hashes
from .ngrams import ngram_hashes, points, step_texts

LEAST, MOST, BUCKET_BITS = 3, 6, 22
#: Labelled rows of each class that are learned from, at most.
SAMPLE = 3000
#: A feature's least likelihood ratio.
SIGNIFICANT = 10.0
#: ... how many sampled texts must have it
LEAST_TEXTS = 4
RIDGE = 1.0
#: A feature's value: places per so many characters, of a text taken to be so many characters longer.
PER_CHARS, FEW_CHARS = 1000, 200
#: Characters between the beginnings of windows, which are twice as long.
STEP = 2048
#: Cells of a text that are hashed at once.
PART_CELLS = 128
#: Bits of the buckets that tell which n-grams too few texts have.
COUNT_BITS = 25
#: Pairs of texts and n-grams that are counted at once.
MERGE = 1 << 21
THRESHOLD = 0.7


@dataclass
class Model:
    grams: np.ndarray   # the features: hashes of n-grams, in order
    coarse: np.ndarray  # by the first bits of a hash: whether a feature may have it
    weight: np.ndarray  # by feature: ratio times coefficient
    bias: float


def held_out(doc_id: str = "doc_id", parts: int = 3, rest: int = 1) -> Column:
    """Rows that are not learned from: crc32 of the id as text leaves ``rest``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == rest, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[list[tuple[str, int]], tuple[float, float]]:
    """Up to ``bound`` labelled texts of each class, in the order of a hash of their
    ids, and how many labelled rows each of them stands for."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out("id")).distinct())
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    out = []
    for label in (0, 1):
        chosen = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(bound)
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "id")
        out += [(r["text"], label) for r in texts.orderBy("id", "text").limit(bound).collect()]
    return out, tuple(max(1.0, sizes.get(label, 0) / bound) for label in (0, 1))


def _hits(texts: list[str], grams: np.ndarray, coarse: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, feature, character)`` of every place in ``texts`` where a feature's n-gram stands, and the texts' lengths."""
    gap = MOST - 1
    raw, owner = points(texts, gap, lower=True)
    size = np.bincount(owner, minlength=len(texts))
    size[0] -= gap
    start = gap + np.cumsum(size) - size
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, h in ngram_hashes(raw, LEAST, MOST) if len(grams) else ():
        near = np.flatnonzero(coarse[h >> np.uint64(64 - BUCKET_BITS)])
        at = np.minimum(np.searchsorted(grams, h[near]), len(grams) - 1)
        same = np.flatnonzero(grams[at] == h[near])
        places.append(near[same])
        found.append(at[same])
    place = np.concatenate(places)
    rows = owner[place]
    return rows, np.concatenate(found), np.maximum(place - start[rows], 0), size - gap


def _coarse(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BUCKET_BITS, bool)
    out[grams >> np.uint64(64 - BUCKET_BITS)] = True
    return out


def _unit(size: np.ndarray) -> np.ndarray:
    """What a place counts in so many characters: texts are judged by how densely features stand in them."""
    return PER_CHARS / (size + FEW_CHARS)


def _parts(texts: list[str]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """The texts, lower-cased, in runs of parts of whole cells, each with what its last n-grams reach
    beyond it: the numbers of the texts, the characters before the parts, the parts."""
    owners, starts, parts, size = [], [], [], 0
    for i, t in enumerate(t.lower() for t in texts):
        for start in range(0, max(1, len(t)), PART_CELLS * STEP):
            owners.append(i)
            starts.append(start)
            parts.append(t[start:start + PART_CELLS * STEP + MOST - 1])
            size += len(parts[-1])
            if size >= PART_CELLS * STEP:
                yield owners, starts, parts
                owners, starts, parts, size = [], [], [], 0
    if parts:
        yield owners, starts, parts


def scores(texts: list[str], model: Model) -> np.ndarray:
    """The score of each text's most toxic window."""
    size = np.array([len(t.lower()) for t in texts], np.int64)
    cells = np.maximum(1, -(-size // STEP))
    first = np.cumsum(cells) - cells
    last = np.cumsum(cells) - 1
    total = np.zeros(int(cells.sum()))
    for owners, starts, parts in _parts(texts):
        rows, found, place, _ = _hits(parts, model.grams, model.coarse)
        own = place < PART_CELLS * STEP  # the others begin in the next part
        at = np.array(owners)[rows[own]]
        cell = (np.array(starts)[rows[own]] + place[own]) // STEP
        np.add.at(total, first[at] + np.minimum(cell, cells[at] - 1), model.weight[found[own]])
    chars = np.full(len(total), STEP)
    chars[last] = size - (cells - 1) * STEP
    # a window is two cells; a text's last cell is one only if it is the first too
    begins = np.ones(len(total), bool)
    begins[last] = False
    total[:-1] += np.where(begins[:-1], total[1:], 0)
    chars[:-1] += np.where(begins[:-1], chars[1:], 0)
    begins[first] = True
    logit = np.maximum.reduceat(np.where(begins, total * _unit(chars) + model.bias, -np.inf), first)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def _likelihood_ratio(k1: np.ndarray, n1: int, k0: np.ndarray, n0: int) -> np.ndarray:
    """Twice the log-likelihood ratio of "two shares" against "one share" for every bucket."""
    def fits(k: np.ndarray, n: int, share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-12, 1 - 1e-12)
        return k * np.log(share) + (n - k) * np.log1p(-share)

    both = (k1 + k0) / (n1 + n0)
    return 2 * (fits(k1, n1, k1 / n1) + fits(k0, n0, k0 / n0) - fits(k1, n1, both) - fits(k0, n0, both))


def _unlike(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The rows without copies and near copies of an earlier one (one of four
    least-hash shingles in common): copies would make their own words significant."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text, label in rows:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        words, _ = word_hashes(raw, np.array([0, len(raw)]), lower=True)
        runs = mix64(words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:]) if len(words) > 2 else words
        own = {(k, int((runs ^ seed).min())) for k, seed in enumerate(seeded(4, 17))} if len(runs) else set()
        if not own & seen:
            out.append((text, label))
        seen |= own
    return out


def _own_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, n-gram hash)``, each pair once."""
    raw, owner = points(texts, MOST - 1, lower=True)
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    grams = [h for _, h in ngram_hashes(raw, LEAST, MOST)]
    rows, own, start = [], [], 0
    for text, end in enumerate(ends.tolist()):  # sorted text by text: short sorts
        h = np.sort(np.concatenate([g[start:end] for g in grams]))
        own.append(h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h)
        rows.append(np.full(len(own[-1]), text, np.int32))
        start = end
    return np.concatenate(rows), np.concatenate(own)


def _shares(rows: list[tuple[str, int]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that at least ``LEAST_TEXTS`` texts have, and the number of texts of each class that have them."""
    steps = list(step_texts([t for t, _ in rows]))
    many = np.zeros(1 << COUNT_BITS, np.uint8)
    for _, texts in steps:
        bucket, n = np.unique((_own_grams(texts)[1] >> np.uint64(64 - COUNT_BITS)).astype(np.int32), return_counts=True)
        many[bucket] = np.minimum(many[bucket] + n, LEAST_TEXTS)
    enough = np.greater_equal(many, LEAST_TEXTS, out=many.view(bool))  # a bucket without so many texts has no such n-gram
    grams, counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int32)
    held, size = [], 0
    for k, (start, texts) in enumerate(steps):
        owner, h = _own_grams(texts)
        near = enough[h >> np.uint64(64 - COUNT_BITS)]
        kinds = labels[start + owner[near]]
        held.append((h[near], np.stack([kinds == 0, kinds == 1], axis=1)))
        size += len(held[-1][0])
        if size >= MERGE or k == len(steps) - 1:
            both = np.concatenate([grams, *[g for g, _ in held]])
            order = np.argsort(both, kind="stable")
            heads = np.flatnonzero(np.concatenate(([True], np.diff(both[order]) != 0))) if len(both) else order
            counts = np.add.reduceat(np.concatenate([counts, *[c for _, c in held]])[order], heads, axis=0, dtype=np.int32) if len(both) else counts
            grams, held, size = both[order][heads], [], 0
    some = counts.sum(axis=1) >= LEAST_TEXTS
    return grams[some], counts[some].astype(np.float64)


def fit(rows: list[tuple[str, int]], weights: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Learns from ``(text, label)`` rows, each of which stands for ``weights[label]`` labelled rows; deterministic."""
    rows = _unlike(rows)
    labels = np.array([y for _, y in rows], np.int64)
    none = np.zeros(0, np.uint64)
    if not len(rows) or labels.min() == labels.max():
        return Model(none, _coarse(none), np.zeros(0), -50.0)
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    grams, counts = _shares(rows, labels)
    k0, k1 = counts.T
    score = _likelihood_ratio(k1, n1, k0, n0)
    chosen = np.flatnonzero(score >= SIGNIFICANT)
    grams, k0, k1 = grams[chosen], k0[chosen], k1[chosen]
    ratio = np.log((k1 + 1) / (n1 + 2)) - np.log((k0 + 1) / (n0 + 2))
    coarse = _coarse(grams)
    cells, unit = [], []
    for start, texts in step_texts([t for t, _ in rows]):
        at, found, _, size = _hits(texts, grams, coarse)
        cells.append(np.unique((start + at.astype(np.int64)) * max(1, len(grams)) + found, return_counts=True))
        unit.append(_unit(size))
    at, found = (np.concatenate([part(c).astype(np.int32) for c, _ in cells]) for part in (
        lambda c: c // max(1, len(grams)), lambda c: c % max(1, len(grams))))
    value = np.concatenate([n for _, n in cells]) * np.concatenate(unit)[at]
    value *= ratio[found]
    del cells, unit
    w = _logistic(at, found, value, labels, np.where(labels == 1, weights[1], weights[0]), len(grams))
    return Model(grams, coarse, w[:-1] * ratio, float(w[-1]))


class _Sparse:
    """Products of a sparse matrix (``value`` in row ``at``, column ``found``) and its transpose with
    vectors: entries stand in order of their sums, which are then taken run by run."""

    def __init__(self, at: np.ndarray, found: np.ndarray, value: np.ndarray, height: int, width: int):
        self.shape = height, width
        order = np.argsort(at, kind="stable")
        self.by_row = self._runs(at[order]), found[order], value[order]
        order = np.argsort(found, kind="stable")
        self.by_column = self._runs(found[order]), at[order], value[order]

    @staticmethod
    def _runs(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = np.flatnonzero(np.concatenate(([True], sums[1:] != sums[:-1]))) if len(sums) else np.zeros(0, np.int64)
        return sums[heads], heads

    @staticmethod
    def _times(side: tuple, v: np.ndarray, size: int) -> np.ndarray:
        (sums, heads), other, value = side
        out = np.zeros(size)
        if len(heads):
            out[sums] = np.add.reduceat(value * v[other], heads)
        return out

    def forth(self, v: np.ndarray) -> np.ndarray:
        return self._times(self.by_row, v, self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return self._times(self.by_column, v, self.shape[1])

    def squares(self, v: np.ndarray) -> np.ndarray:
        """The transpose of the squared entries times a vector."""
        (sums, heads), other, value = self.by_column
        return self._times(((sums, heads), other, value * value), v, self.shape[1])


def _logistic(at: np.ndarray, found: np.ndarray, value: np.ndarray, y: np.ndarray, share: np.ndarray, width: int, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients of a ridge logistic regression over sparse rows (``value`` in row
    ``at``, column ``found``) by Newton's method, each step solved by conjugate
    gradients as exactly as the slope is small; the last coefficient is the constant."""
    x = _Sparse(at, found, value, len(y), width)
    penalty = np.full(width + 1, ridge)
    penalty[-1] = 1e-6
    forth = lambda v: x.forth(v[:-1]) + v[-1]
    back = lambda v: np.append(x.back(v), v.sum())
    w = np.zeros(width + 1)
    loss = lambda z, w: share @ np.logaddexp(0, np.where(y == 1, -z, z)) + penalty @ w**2 / 2
    first = None
    for _ in range(100):
        z = forth(w)
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        slope = back(share * (p - y)) + penalty * w
        bend = share * np.maximum(p * (1 - p), 1e-9)
        scale = np.append(x.squares(bend), bend.sum()) + penalty
        step, rest = np.zeros(width + 1), slope.copy()
        near = rest / scale
        way, size = near.copy(), rest @ near
        first = first or size
        if size <= 1e-16 * first or size == 0:
            break
        enough = min(1e-2, (size / first) ** 0.5) * size
        for _ in range(500):
            bent = back(bend * forth(way)) + penalty * way
            far = size / (way @ bent)
            step += far * way
            rest -= far * bent
            near = rest / scale
            way, size = near + (rest @ near) / size * way, rest @ near
            if size <= enough or size == 0:
                break
        now, length = loss(z, w), 1.0
        while length > 1e-6 and loss(forth(w - length * step), w - length * step) > now:
            length /= 2
        w = w - length * step
        if np.abs(length * step).max() < 1e-7:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` behind its columns (a column of that name is replaced)."""
    kept = [c for c in docs.columns if c != "score"]
    own = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = own.value
        for batch in batches:
            for piece in slices(batch, "text"):  # of bounded bytes; each text goes in and out once
                made = scores([t or "" for t in piece.column("text").to_pylist()], m)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(made, pa.float64())], names=[*kept, "score"])

    shown = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in kept])
    return shown.mapInArrow(run, shown.withColumn("score", F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    model = fit(*sample(docs, labels))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with the columns of ``docs``."""
    own = "score" in docs.columns
    safe = docs.withColumnRenamed("score", "_own_score_") if own else docs
    stay = score(safe, fit(*sample(docs, labels))).filter(F.col("score") < threshold).drop("score")
    return stay.withColumnRenamed("_own_score_", "score").select(*docs.columns) if own else stay
