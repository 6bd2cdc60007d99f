import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quality_lake.llm.open_bins import Bins, cuts, pack_open

BYTE = public_tokenizers.path("byte_bpe_50k.json")


class PlainBins:
    """The same rule by looking through a list of open bins."""

    def __init__(self, length, most):
        self.length, self.most, self.bins, self.open, self.closed = length, most, [], [], []

    def place(self, size):
        fitting = [b for b in self.open if self.bins[b] >= size] if size < self.length else []
        if fitting:
            room = min(self.bins[b] for b in fitting)
            own = [b for b in fitting if self.bins[b] == room]
        else:
            room, own = self.length, [len(self.bins)]
            self.bins.append(self.length)
            if size < self.length and len(self.open) == self.most:
                least = min(self.bins[b] for b in self.open)
                self.closed = [b for b in self.open if self.bins[b] == least]  # any one of these may close
        return room, own


@pytest.mark.parametrize("most", [1, 2, 7, 64])
def test_bins_follow_the_rule(most):
    r = random.Random(most)
    for length in (8, 100, 1024):
        bins, plain = Bins(length, most), PlainBins(length, most)
        for _ in range(2000):
            size = r.choice([r.randrange(1, length + 1), r.randrange(1, max(2, length // 4))])
            plain.closed = []
            room, own = plain.place(size)
            before = {n for ns in bins.free for n in ns}
            number, at = bins.place(size)
            after = {n for ns in bins.free for n in ns}
            assert at == length - room and number in own
            plain.bins[number] = room - size
            gone = before - after - {number}
            assert len(gone) == bool(plain.closed) and gone <= set(plain.closed)
            plain.open = sorted(after)
            assert len(after) == bins.open <= most
            assert [f for f in range(length + 1) if bins.spaces >> f & 1] == [f for f, ns in enumerate(bins.free) if ns]


def test_cuts():
    assert cuts(1024, 1024) == [1024] and cuts(5, 1024) == [5] and cuts(2100, 1024) == [52, 1024, 1024]


def check(docs, length, most=1024, excess=None):
    t = Tokenizer.from_file(BYTE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack_open(docs, BYTE, 2, length, most).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2])
    assert set(want) == set(pieces)
    total = 0
    for i, texts in want.items():
        made = Counter()
        for ids in texts:
            total += len(ids)
            start = 0
            for k, n in enumerate(cuts(len(ids), length)):
                made[k, start, tuple(ids[start:start + n])] += 1
                start += n
        assert Counter((k, s, tuple(ids)) for k, s, ids in pieces[i]) == made
    if excess is not None:
        assert len(sequences) <= excess * -(-total // length) + 1
    return len(sequences)


def test_the_given_documents(docs):
    check(docs, 1024, excess=1.02)
    assert check(docs, 1024, most=2) > check(docs, 1024)


def test_odd_and_empty_tables(odd, none):
    check(odd, 64)
    check(odd, 16, most=1)
    assert pack_open(none, BYTE).count() == 0


def test_small_partitions_are_joined(docs):
    spread = docs.repartition(40)
    assert pack_open(spread, BYTE, partitions=2).select("sequence_id").distinct().count() < \
        pack_open(spread, BYTE).select("sequence_id").distinct().count()
