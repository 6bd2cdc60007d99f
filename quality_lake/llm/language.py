"""Language identification by string kernels (operator 8).

The kernel of two texts is the blended spectrum's presence kernel: the number of
(hashed) character n-grams of ``LEAST`` to ``MOST`` code points that both have,
divided by the root of the product of their own numbers.  Some training
texts of each language, the landmarks, span the Nystrom approximation: a text's features are its kernels with the
landmarks times the inverse root of the landmarks' own kernel matrix.  N-grams are
told by 2**``BUCKET_BITS`` buckets, which long texts do not fill; only buckets that
a landmark has are kept for the sums.  A kernel
ridge regression, one language against the rest, is solved on those features;
texts are scored by sums over their buckets of the landmarks' coefficients.

It is fitted on at most ``SAMPLE`` texts of each language, drawn by a hash of the
id: a documented bound on labelled rows.  Every language that occurs is learned and
has landmarks of its own.  Scoring covers every row and whole texts.

Cases: ``und`` with score 0 where the text is null or has no letter; rows without
language or id are not learned from; with no training row at all every text is
``und``; equal scores go to the language that is first in code point order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ngrams import ngram_hashes, points, step_texts
from .toxicity import held_out

LEAST, MOST, BUCKET_BITS = 2, 4, 20
SAMPLE, RIDGE = 300, 1e-3
#: Landmarks, dealt evenly over the languages, of which each has so many at least.
LANDMARKS, LEAST_EACH = 192, 4
NO_LETTER = "und"


@dataclass
class Model:
    languages: list[str]
    number: np.ndarray   # by bucket: its row in weights, or -1 where no landmark has it
    weights: np.ndarray  # landmarks' buckets by languages: the landmarks' coefficients, summed
    bias: np.ndarray


def spectra(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of the n-grams that each text has, each pair once, in order."""
    raw, owner = points(texts, MOST - 1, lower=True)
    keys = [(owner[:len(h)].astype(np.int64) << BUCKET_BITS) | (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) for _, h in ngram_hashes(raw, LEAST, MOST)]
    return np.divmod(np.unique(np.concatenate(keys)), 1 << BUCKET_BITS)


def normed_sums(texts: list[str], number: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of the rows of ``table`` that each text's buckets have, by the root of the number of its buckets
    (where its columns are landmarks of length 1, these are the kernels)."""
    rows, buckets = spectra(texts)
    size = np.maximum(np.bincount(rows, minlength=len(texts)), 1)
    number = number[buckets]
    held = number >= 0
    out = np.zeros((len(texts), table.shape[1]), np.float32)
    ends = np.searchsorted(rows[held], np.arange(len(texts) + 1))
    number = number[held]
    for i in range(len(texts)):  # whole rows are added, in bounded parts
        for at in range(ends[i], ends[i + 1], 1 << 14):
            out[i] += table[number[at:min(at + (1 << 14), ends[i + 1])]].sum(axis=0)
    return out / np.sqrt(size)[:, None].astype(np.float32)


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
             .filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
             .filter(~held_out("doc_id", 4, 2)))
    # a hash range that holds about twice the bound, then the first rows of it: no sort of a whole language
    sizes = known.groupBy("lang").agg((F.least(F.lit(1.0), 2 * SAMPLE / F.count(F.lit(1))) * (1 << 20)).cast("int").alias("most"))
    near = known.join(F.broadcast(sizes), "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("most") + 1)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    rows = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE).select("lang", "place", "text").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["place"]))]


def fit(rows: list[tuple[str, str]]) -> Model:
    languages = sorted({lang for _, lang in rows})
    if not rows:
        return Model([], np.full(1 << BUCKET_BITS, -1, np.int32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    kinds = np.array([languages.index(lang) for _, lang in rows])
    # landmarks: so many of each language, spread evenly over its rows
    each = max(LEAST_EACH, LANDMARKS // len(languages))
    own = (np.flatnonzero(kinds == k) for k in range(len(languages)))
    spots = np.concatenate([r[np.unique(np.linspace(0, len(r) - 1, min(each, len(r))).astype(np.int64))] for r in own])
    own = [spectra([rows[i][0]])[1] for i in spots]
    known = np.unique(np.concatenate(own))
    number = np.full(1 << BUCKET_BITS, -1, np.int32)
    number[known] = np.arange(len(known))

    def spectrum(first: int) -> np.ndarray:  # of a block of landmarks, so that many languages do not need one large matrix
        out = np.zeros((len(known), len(own[first:first + LANDMARKS])), np.float32)
        for k, buckets in enumerate(own[first:first + LANDMARKS]):
            out[number[buckets], k] = 1 / np.sqrt(max(1, len(buckets)))
        return out

    x = np.zeros((len(rows), len(spots)))
    for first in range(0, len(spots), LANDMARKS):
        block = spectrum(first)
        for start, texts in step_texts([t for t, _ in rows]):
            x[start:start + len(texts), first:first + LANDMARKS] = normed_sums(texts, number, block)
    values, vectors = np.linalg.eigh(x[spots])
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = np.hstack([x @ root, np.ones((len(rows), 1))])
    target = np.where(kinds[:, None] == np.arange(len(languages)), 1.0, 0.0)
    share = 1 / np.bincount(kinds, minlength=len(languages))[kinds]  # each language weighs the same
    weighted = features * share[:, None]
    ridge = RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(features.T @ weighted + ridge, weighted.T @ target)
    coefficients = (root @ solved[:-1]).astype(np.float32)
    weights = np.zeros((len(known), len(languages)), np.float32)
    for first in range(0, len(spots), LANDMARKS):
        weights += spectrum(first) @ coefficients[first:first + LANDMARKS]
    return Model(languages, number, weights, solved[-1].astype(np.float32))


def predict(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Each text's language and score, for texts that have letters."""
    scores = normed_sums(texts, model.number, model.weights) + model.bias
    best = scores.argmax(axis=1)
    return [model.languages[i] for i in best], np.clip(scores[np.arange(len(texts)), best], 0.0, 1.0).astype(np.float64)


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs``."""
    own = docs.sparkSession.sparkContext.broadcast(fit(sample(docs)))

    def run(batches):
        m = own.value
        for batch in batches:
            texts, lettered = batch.column("text").to_pylist(), batch.column("lettered").to_pylist()
            langs, scores = [NO_LETTER] * len(texts), np.zeros(len(texts))
            chosen = [i for i, ok in enumerate(lettered) if ok and m.languages]
            for start, part in step_texts([texts[i] for i in chosen]):
                got, values = predict(part, m)
                for k, lang in enumerate(got):
                    langs[chosen[start + k]] = lang
                    scores[chosen[start + k]] = values[k]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long"), held_out("doc_id", 4, 2).alias("held_out"), text.alias("text"),
                        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
            .mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double"))
