"""Token ids of whole texts by a ``tokenizers`` vocabulary file, with a bounded memo.

The ids are those of the ``tokenizers`` library, whatever the path, of which there are three.

* A text is cut where the pre-tokenizer always cuts: at a single space or line feed
  between two characters that are no white space.  Byte-pair encoding of a piece does not
  depend on its neighbours, so a worker keeps the ids of pieces it has met, two
  generations of at most ``MEMO_WORDS`` entries each.  Plain letters with marks behind
  them are encoded by the vocabulary's merges alone; any other piece by the library.
* A byte-level vocabulary with the usual pre-tokenizer pattern encodes a whole text
  of characters that all versions of Unicode class alike by its merges at once.
* A text with any other white space (runs, at its ends, or other characters that Python
  or Unicode counts as such) or with the strings of special tokens is encoded by
  the library.

"By its merges" is done with the ``tiktoken`` library, which takes the same vocabulary as
ranks at a third of the time.  It is used only if the file says that an id is its merge's rank, so that
both join the same pairs in the same order; a word's end is a byte of its own there.
Runs without a cutting place, which it takes quadratic time for, go to the library.
A long text is first cut at single spaces into parts of about ``PART_CHARS``, so that
memory is bounded.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

MEMO_WORDS = 250_000
PART_CHARS = 1 << 20

_MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII marks without the apostrophe, which may begin a pre-token of letters
_PLAIN = re.compile(rf"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([{_MARKS}]*)")
_ONLY_MARKS = re.compile(rf" ?[{_MARKS}]+")

# White space other than the space and the line feed, as Python sees it, and what some versions of Unicode add.
_ODD = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"] + ["\u180e", "\u200b", "\u2060", "\ufeff"]
_CUT = re.compile(r"(?<=\S) (?=\S)")

# Fixed value: the pattern that byte-level pre-tokenizers cut by.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Anything but ASCII, Latin, Greek and Cyrillic letters of Unicode 3.2, dashes, quotation marks, kana, Han and Hangul.
_UNSETTLED = re.compile("[^\t\n\r -~\xa1-\u0220\u0222-\u0233\u0388-\u038a\u038c\u038e-\u03a1\u03a3-\u03ce\u0400-\u045f"
                        "\u2010-\u2027\u20ac\u3001-\u3003\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")
_LONG_RUN = 512
_LONG_SPACE = re.compile(r"\s{%d}" % _LONG_RUN)


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def _by_merges(said: dict):
    """For a vocabulary as its file says it: what encodes a text of its pattern (None if it has another), and one
    pre-token, by its merges; (None, None) if ids are not the merges' ranks."""
    import tiktoken

    model, cuts = said["model"], said["pre_tokenizer"] or {}
    end = model.get("end_of_word_suffix") or ""
    others = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["content"] for t in said["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    first = len(vocab) - len(pairs)
    if model["type"] != "BPE" or any(model.get(k) for k in others) or any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
        return None, None
    own = {c: b for b, c in _LETTERS.items()}

    def raw(token: str) -> bytes:
        last = bool(end) and token.endswith(end)
        return bytes(own[c] for c in (token[:-len(end)] if last else token)) + b"\0" * last

    ranks = {raw(t): i for t, i in vocab.items()}
    if len(ranks) < len(vocab):
        return None, None
    one = tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= cuts.items()
    if not usual or said["normalizer"] is not None or end:
        return None, (lambda word: one(word + "\0")) if end else one
    return tiktoken.Encoding("whole", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, one


class Memo(dict):
    """Pieces of text to their ids as 16-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of 16 bits hold vocabularies of 65,536 at most")
        with open(path, encoding="utf-8") as f:
            self.text_by_merges, self.one_by_merges = _by_merges(json.load(f))
        self.lower = self.tokenizer.normalizer is not None  # a lower-casing vocabulary drops white space
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()

    def piece(self, piece: str) -> bytes:
        """A piece between cutting places, with the space before it where the vocabulary keeps that."""
        if self.one_by_merges is None or len(piece) >= _LONG_RUN:
            return self.whole(piece)
        if self.lower and piece.isalpha() and piece.isascii():
            return array("H", self.one_by_merges(piece.lower())).tobytes()
        plain = _PLAIN.fullmatch(piece)
        if plain:
            letters, marks = plain.groups()
            ids = array("H", self.one_by_merges(letters.lower() if self.lower else letters))
            if marks:
                ids.extend(self.one_by_merges(marks))
            return ids.tobytes()
        return array("H", self.one_by_merges(piece)).tobytes() if _ONLY_MARKS.fullmatch(piece) else self.whole(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.piece(piece)
        if len(self) >= MEMO_WORDS:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if len(text) <= PART_CHARS:
            return self.part(text) if text else b""
        return b"".join(map(self.part, self.parts(text)))

    def parts(self, text: str) -> Iterator[str]:
        """A long text cut before single spaces between two characters that are no white space."""
        start, cuttable = 0, "<|" not in text and "\0" not in text
        while cuttable and len(text) - start > PART_CHARS:
            cut = _CUT.search(text, start + PART_CHARS)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:]

    def part(self, text: str) -> bytes:
        """``text`` may begin with the space that it was cut before."""
        if "<|" in text or "\0" in text:
            return self.whole(text)
        words = text.split()
        if self.text_by_merges is not None and _UNSETTLED.search(text) is None and max(map(len, words), default=0) < _LONG_RUN:
            spread = len(text) - sum(map(len, words)) - len(words) >= _LONG_RUN
            if not spread or _LONG_SPACE.search(text) is None:
                return array("H", self.text_by_merges(text)).tobytes()
        if any(map(text.__contains__, _ODD)):
            return self.whole(text)
        # with no other white space: equal if and only if each space or line feed stands alone between words
        if len(words) != (text[0] != " ") + text.count(" ") + text.count("\n"):
            return self.whole(text)
        if not self.lower:
            words = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
            if text[0] == " ":
                del words[0]
        return b"".join(map(self.__getitem__, words))


_MEMOS: dict[str, Memo] = {}


def memo(path: str) -> Memo:
    """The worker's memo of one vocabulary file; kept between tasks."""
    if path not in _MEMOS:
        _MEMOS[path] = Memo(path)
    return _MEMOS[path]


def encode(texts: Iterable[str], path: str, end_id: int) -> list[np.ndarray]:
    """The ids of each text with ``end_id`` behind, as arrays of 16-bit numbers."""
    own, end = memo(path), struct.pack("<H", end_id)
    return [np.frombuffer(own.ids(t) + end, np.uint16) for t in texts]
