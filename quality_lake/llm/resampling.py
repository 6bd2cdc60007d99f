"""Importance resampling towards a target distribution (operator 12).

A text's features are all runs of 1 to ``n`` consecutive words, joined by one space;
a feature's bucket is the CRC-32 of its bytes modulo ``buckets``.  Texts are scanned by
an Aho-Corasick automaton over words between delimiters (``" word "``), whose payload
is the word's CRC and its length in bytes; the automaton emits the payloads of a run of
texts in one scan.  A longer feature's CRC is composed from the payloads of
neighbours: CRC-32 of ``a + b`` is ``crc(a)`` carried over ``len(b)`` zero bytes,
exclusive-or ``crc(b)``, where the carrying is linear and done by table lookups for
all words at once.

A worker's automaton learns the words that the worker meets and is built anew
whenever the words that wait outnumber a half of it, up to ``MOST_WORDS``.  What it
does not hold - new words, very long ones, rare ones beyond that number - gets its
payload from the bytes directly, so the dictionary decides the time and never a
result.

Two scans of the corpus: the first counts buckets (a task gives one row per bucket at
most), the second adds the gains of each text's features.  Scored rows are then
ranked by a range sort; the driver sees the ``buckets`` counts and one row per
partition.  A long text is scanned in parts that end at delimiters, of bounded size.

Cases: a null or empty text has no features, weight 0 and no rank; a null id counts
as an empty one for its random number; rows with one id and score are ordered by
weight and features, so that only equal rows can change places; an empty target or
an empty table is smoothed like any other; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage

from .common import bounds_by_range, offset_column, slices, text_or_empty, utf8

#: Words of a worker's dictionary, and the longest in it (bytes).
MOST_WORDS, LONGEST = 1 << 17, 64
#: Bytes of one scan; a longer text is cut at delimiters.
PART_BYTES = 2 << 20
#: Rows that one task ranks.
RANK_ROWS = 1 << 20

# Letters, digits and everything beyond ASCII make words; capitals are lowered; the rest are delimiters.
_FOLD = np.full(256, 32, np.uint8)
for _kept in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    _FOLD[list(_kept)] = list(_kept)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def _crc_tables(most_bits: int = 40) -> list[np.ndarray]:
    """For each ``b``, four lookup tables of 256 (one per byte of a CRC) that carry it over ``2**b`` zero bytes."""
    def apply(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        bits = (x[:, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)).astype(bool)
        return np.bitwise_xor.reduce(np.where(bits, rows[None], np.uint32(0)), axis=1)

    one_bit = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint32)  # one zero bit: shift right, polynomial if a 1 leaves
    rows = one_bit
    for _ in range(3):  # 8 zero bits
        rows = apply(rows, rows)
    every = np.arange(256, dtype=np.uint32)
    tables = []
    for _ in range(most_bits):
        tables.append(np.stack([apply(rows, every << np.uint32(8 * byte)) for byte in range(4)]))
        rows = apply(rows, rows)
    return tables


_CARRY = _crc_tables()


def carried(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs (without their own ends' inversion, as the composition needs) carried over so many zero bytes each."""
    out, rest = crc.astype(np.uint32), length.astype(np.int64)
    for b in range(int(rest.max(initial=0)).bit_length()):
        at = (rest >> b & 1).astype(bool)
        x, table = out[at], _CARRY[b]
        out[at] = table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24]
    return out


def joined_crc(a: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """CRC-32 of the joined bytes, of the CRCs of both parts and the second's length."""
    return carried(a, b_length) ^ b


class Dictionary:
    """The words a worker has met, as an automaton whose payloads are ``length << 32 | crc``."""

    def __init__(self, most_words: int = MOST_WORDS, first_words: int = 2048):
        self.most_words, self.first_words = most_words, first_words
        self.known: dict[bytes, int] = {}
        self.waiting: dict[bytes, int] = {}
        self.automaton = None

    def learn(self) -> None:
        if len(self.waiting) > max(self.first_words, len(self.known) // 2) and len(self.known) < self.most_words:
            import ahocorasick

            for word, value in self.waiting.items():
                if len(self.known) >= self.most_words:
                    break
                self.known[word] = value
            self.automaton = ahocorasick.Automaton()
            for word, value in self.known.items():
                self.automaton.add_word(f" {word.decode('latin-1')} ", value)
            self.automaton.make_automaton()
            self.waiting = {}

    def payloads(self, line: bytes, starts: np.ndarray) -> np.ndarray:
        """The payloads of all words of ``line``, which has one space before, between and behind
        its words; ``starts`` are the places of the spaces before them."""
        out = np.zeros(len(starts), np.int64)
        if self.automaton is not None and len(starts):
            # one byte a character: places are those of the bytes
            emitted = np.fromiter(chain.from_iterable(self.automaton.iter(line.decode("latin-1"))), np.int64)
            ends, values = emitted[0::2], emitted[1::2]
            out[np.searchsorted(starts, ends - (values >> 32) - 1)] = values
        missed = np.flatnonzero(out == 0)  # a word has at least one byte, so no payload is 0
        stops = np.append(starts, len(line) - 1)
        for i, a, b in zip(missed.tolist(), (starts[missed] + 1).tolist(), stops[missed + 1].tolist()):
            word = line[a:b]
            value = self.waiting.get(word)
            if value is None:
                value = len(word) << 32 | crc32(word)
                if len(word) <= LONGEST and len(self.waiting) < self.most_words:
                    self.waiting[word] = value
            out[i] = value
        self.learn()
        return out


_OWN: list[Dictionary] = []


def dictionary() -> Dictionary:
    """The worker's dictionary; kept between tasks."""
    if not _OWN:
        _OWN.append(Dictionary())
    return _OWN[0]


def words_line(raw: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A run of texts as one line of words, each between single spaces; the places of the
    spaces before them; and the number of words before each text's end."""
    n = len(offsets) - 1
    spaced = np.insert(_FOLD[raw], np.append(offsets[:-1], len(raw)) if n else [0], np.uint8(32))  # texts stand apart
    blank = spaced == 32
    keep = np.ones(len(spaced), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    line = spaced[keep]
    if len(line) == 1:
        return b"  ", np.zeros(0, np.int64), np.zeros(n, np.int64)
    starts = np.flatnonzero(line[:-1] == 32)
    ends = np.cumsum(keep)[offsets[1:] + np.arange(1, n + 1)] - 1  # where in the line each text's last space went
    return line.tobytes(), starts, np.searchsorted(starts, ends)


def _parts(raw: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """A run of texts as it is, or one long text in parts that end at delimiters; True: the text goes on."""
    if len(raw) <= most or len(offsets) != 2:
        yield raw, offsets, False
        return
    start = 0
    while start < len(raw):
        stop = min(start + most, len(raw))
        while stop < len(raw):  # to the next delimiter, which a very long word may keep away
            hit = np.flatnonzero(_FOLD[raw[stop:stop + most]] == 32)
            if len(hit):
                stop += int(hit[0])
                break
            stop = min(stop + most, len(raw))
        yield raw[start:stop], np.array([0, stop - start]), stop < len(raw)
        start = stop


def features(batch: pa.RecordBatch, words: Dictionary, n: int, buckets: int,
             most: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of the batch's texts (column ``text``): the first one's place in the batch, the
    words of each, and the text (from that place) and bucket of every feature.  A long text
    comes in several runs."""
    first = 0
    for piece in slices(batch, "text", most):
        before = np.zeros(0, np.int64)  # a cut text's last n - 1 payloads
        for raw, offsets, goes_on in _parts(*utf8(piece.column("text")), most):
            line, starts, upto = words_line(raw, offsets)
            counts = np.diff(upto, prepend=0)
            own = words.payloads(line, starts)
            text = np.repeat(np.arange(len(counts)), counts)
            both = np.concatenate([before, own])
            crc, length = (both & 0xFFFFFFFF).astype(np.uint32), both >> 32
            place = np.concatenate([np.zeros(len(before), np.int64), text])
            new = np.arange(len(both)) >= len(before)
            found = [(text, crc[new])]
            if n > 1:
                behind = joined_crc(np.full(len(crc), crc32(b" "), np.uint32), crc, length)  # of " word"
                run = crc
                for size in range(2, n + 1):
                    if len(both) < size:
                        break
                    run = joined_crc(run[:-1], behind[size - 1:], length[size - 1:] + 1)
                    whole = (place[size - 1:] == place[:len(place) - size + 1]) & new[size - 1:]
                    found.append((place[size - 1:][whole], run[whole]))
            yield (first, counts, np.concatenate([t for t, _ in found]), np.concatenate([c for _, c in found]).astype(np.int64) % buckets)
            before = both[len(both) - min(n - 1, len(both)):] if goes_on else before[:0]
        first += piece.num_rows


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, own in features(batch, dictionary(), n, buckets):
                sums += np.bincount(own, minlength=buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], names=["bucket", "n"])

    parts = texts.select(text_or_empty().alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most so many rows as there are buckets
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    buckets = len(source)
    over = (target + 1).astype(float) * float(int(source.sum()) + buckets)
    under = (source + 1).astype(float) * float(int(target.sum()) + buckets)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            words, found, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, counts, text, own in features(batch, dictionary(), n, buckets):
                at = slice(first, first + len(counts))
                words[at] += counts
                found[at] += np.bincount(text, minlength=len(counts))
                total[at] += np.bincount(text, gain[own], len(counts)).astype(np.int64)  # whole numbers, exact in doubles
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(found), pa.array(total)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, seed: str = "2024",
             least_words: int = 20, percent: int = 10) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every row of ``docs``: of those
    with ``least_words`` words, the ``percent`` with the highest scores are drawn and ranked.

    The score adds Gumbel noise from a hash of the id, so the highest scores are a draw
    without replacement in proportion to the importance weights.
    """
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = stage(weights(docs, gain, n).withColumn("score", F.col("weight") + gumbel), "scored")
    all_rows, able = scored.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("n_words") >= least_words).cast("long")), F.lit(0))).first()
    drawn = percent * able // 100

    # the drawn rows are the head of this order; the last key splits rows that are equal in all others
    order = [(F.col("n_words") >= least_words).desc(), F.col("score").desc(), F.col("doc_id").asc(),
             F.col("weight").asc(), F.col("n_features").asc(), F.col("tie").asc()]
    place = F.monotonically_increasing_id()  # partition << 33 | place within
    ranked = stage(scored.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-all_rows // RANK_ROWS)), *order).sortWithinPartitions(*order)
                   .select(*scored.columns, F.shiftright(place, 33).cast("int").alias("part"),
                           place.bitwiseAND(F.lit((1 << 33) - 1)).alias("within")), "ranked")
    before = bounds_by_range(ranked.select("part", F.lit(1).alias("one")), "one")
    rank = offset_column(before) + F.col("within") + 1
    return ranked.select(*scored.columns, F.when((F.col("n_words") >= least_words) & (rank <= drawn), rank).alias("rank"))
