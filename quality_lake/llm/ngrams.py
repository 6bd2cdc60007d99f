"""Hashed character n-grams of whole texts (language and toxicity models)."""

from __future__ import annotations

import numpy as np

from .common import mix64, seeded

_POINT = seeded(1 << 11, 3)


def points(texts: list[str], gap: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by ``gap`` zeros (so that no n-gram
    of up to ``gap`` + 1 spans two texts), and the text number of each point."""
    if lower:
        texts = [t.lower() for t in texts]
    pad = "\0" * gap
    raw = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + gap for t in texts], np.int64)
    sizes[0] += gap
    return raw, np.repeat(np.arange(len(texts), dtype=np.int32), sizes)


def ngram_hashes(raw: np.ndarray, least: int, most: int):
    """For each n from ``least`` to ``most``, ``(n, hashes)``: the hash of the n-gram at
    each position but the last n - 1.  Every n-gram of one text gives one hash."""
    own = _POINT[raw & 0x7FF] + raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = own
    for n in range(2, most + 1):
        h = h[:-1] * np.uint64(0x100000001B3) + own[n - 1:]
        if n >= least:
            yield n, mix64(h ^ np.uint64(n))


def step_texts(texts: list[str], chars: int = 1 << 18):
    """Runs of texts of about ``chars`` characters together, with the number of texts before."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
