"""Whole-text tokenization with the public tokenizer files, memoised by text piece.

A byte-pair encoder never merges across the borders that its own pre-tokenizer
draws, so a text may be cut at borders which that pre-tokenizer certainly draws,
and each piece encoded once per Python worker.  Which cuts are safe depends on
the file and is named by ``cut``:

``"space"``
    White space is dropped by the pre-tokenizer (``word_bpe_49k.json``): every
    space and newline is a border.
``"gpt"``
    A word keeps its leading space (``byte_bpe_50k.json``).  In a text without
    two adjacent white-space characters there is a border before every space
    and on both sides of every newline.  Any other text is encoded in one call.
``None``
    No cut is known to be safe: every text is encoded in one call.

Both public files also draw a border between a run of letters and a run of
ASCII punctuation after it, so a new piece such as ``word,`` is put together
from ``word`` and ``,``.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` in all
three cases; strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os
import re

import numpy as np

ADJACENT = re.compile(r"\s\s")
#: A head and the ASCII punctuation after it; no apostrophe, which may open a contraction.
TAIL = re.compile(r"(.*[^!-/:-@\[-`{-~])([!-&(-/:-@\[-`{-~]+)", re.S)
#: Pieces kept per worker and encoder, some 300 bytes each; the memo starts afresh beyond it.  Longer pieces are not kept.
MEMO_PIECES, MEMO_CHARS = 1_500_000, 48


def public_path(name: str) -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    """text piece -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode, most: int, prefix: str = "", tails: "_Memo | None" = None, fold: bool = False):
        super().__init__()
        self.encode, self.most, self.prefix, self.tails, self.fold = encode, most, prefix, tails, fold

    def __missing__(self, piece: str) -> bytes:
        parts = TAIL.fullmatch(piece)
        if self.fold and piece.isascii() and (low := piece.lower()) != piece:
            ids = self[low]
        elif parts and parts[1].isalpha() and parts[1].lower().isalpha():
            ids = self[parts[1]] + (self if self.tails is None else self.tails)[parts[2]]
        else:
            ids = self.encode(self.prefix + piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


class TextEncoder:
    """Encodes texts into little-endian unsigned 32-bit id bytes."""

    def __init__(self, path: str, cut: str | None = None, memo: int = MEMO_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if cut not in (None, "space", "gpt"):
            raise ValueError(f"unknown cut {cut!r}")
        self.cut = cut
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.bare = _Memo(self._encode, memo, fold=cut == "space")  # that file lower-cases
        self.spaced = _Memo(self._encode, memo, " ", self.bare)

    def _encode(self, text: str) -> bytes:
        word = text.removeprefix(" ")
        if self.cut and word.isascii() and word.isalpha():  # one run of letters: the merges alone
            if self.cut == "gpt":
                run = "\u0120" + word if word is not text else word  # how the file writes a leading space
            else:
                run = word.lower()
            return np.array([t.id for t in self.tokenizer.model.tokenize(run)], "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.cut == "space":
            memo = self.bare
            return b"".join([memo[p] for p in text.replace("\n", " ").split(" ")])
        if self.cut == "gpt" and not ADJACENT.search(text):
            bare, spaced, out = self.bare, self.spaced, []
            for n, line in enumerate(text.split("\n")):
                if n:
                    out.append(bare["\n"])
                first, *rest = line.split(" ")
                out.append(bare[first])
                out += [spaced[p] for p in rest]
            return b"".join(out)
        return self._encode(text)


_encoders: dict[tuple, TextEncoder] = {}


def encoder(path: str, cut: str | None, memo: int = MEMO_PIECES) -> TextEncoder:
    """The worker's one encoder for a file; kept while the worker lives."""
    key = (path, cut, memo)
    if key not in _encoders:
        _encoders[key] = TextEncoder(*key)
    return _encoders[key]
