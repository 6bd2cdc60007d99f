import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quality_lake.llm.packing import hilbert, pack

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, length):
    t = Tokenizer.from_file(BYTE)
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in pack(docs, BYTE, 0, length).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        total += len(ids)
    padded = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
        padded += 0 if at & (at - 1) == 0 else length - at
    assert padded <= 0.01 * total
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    assert set(want) == set(pieces)
    for i, texts in want.items():
        assert Counter(x for _, ids, _ in pieces[i] for x in ids) == Counter(x for ids in texts for x in ids)
        if len(texts) == 1:
            assert [x for _, ids, _ in sorted(pieces[i]) for x in ids] == texts[0]
            assert {n for *_, n in pieces[i]} == {len(texts[0])}


def test_every_id_is_in_one_piece(docs, odd, none):
    check(docs, 1024)
    check(odd, 64)
    assert pack(none, BYTE).count() == 0


def test_hilbert_curve_visits_every_cell_and_steps_by_one():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
