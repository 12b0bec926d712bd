"""Token ids of whole texts with the ``tokenizers`` library, with a bounded memory of words already seen.

For byte-level BPE without normalisation, a text's ids are those of its pieces one after another, and a piece
never spans the gap before a space that stands between two other characters. So words and the marks after them
are looked up in a bounded memo, each by itself; words of plain letters or punctuation go to the library's BPE model
directly, and anything else (other scripts, digits, runs of white space, special tokens) goes through the library's whole encoder.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"[!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]"
#: Pieces of a text that starts at a piece's start: letters, punctuation, other words, white space.
_PIECES = re.compile(rf" ?[{_LETTERS}]++(?![^\x00-\x7f])| ?{_MARKS}*+(?![^\x00-\x7f])| ?\S+|\s+(?!\S)|\s+")
_PLAIN = re.compile(rf" ?(?:[{_LETTERS}]+|{_MARKS}*)")
#: Four controls are white space to Python, but not to the tokenizer.
_CONTROLS = re.compile("[\x1c-\x1f]")


def byte_characters() -> dict[int, str]:
    """The character by which byte-level BPE writes each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Built once in a task from the tokenizer's path."""

    def __init__(self, path: str, memo: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model, self.code = self.tokenizer.model, "HI"[self.dtype.itemsize // 4]
        self.limit = memo
        #: Ids of pieces.
        self.memo = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = byte_characters()
        pre, model = type(self.tokenizer.pre_tokenizer).__name__, type(self.tokenizer.model).__name__
        #: Other kinds of tokenizers are run on whole texts.
        self.by_words = pre == "ByteLevel" and model == "BPE" and self.tokenizer.normalizer is None and not self.tokenizer.pre_tokenizer.add_prefix_space

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _plain(self, piece: str) -> bytes:
        """A piece of letters, or of punctuation, perhaps after a space."""
        spelled = piece.replace(" ", self.table[32]) if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """A piece that isn't in memory."""
        if (ids := self.memo.get(piece)) is None:
            if len(self.memo) >= self.limit:
                self.memo.clear()
            ids = self.memo[piece] = self._plain(piece) if _PLAIN.fullmatch(piece) else self._library(piece)
        return ids

    def _text(self, text: str) -> bytes:
        pieces = _PIECES.findall(text)
        ids = list(map(self.memo.get, pieces))
        for k in [k for k, x in enumerate(ids) if x is None]:
            ids[k] = self._piece(pieces[k])
        return b"".join(ids)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        if not self.by_words or any(s in text for s in self.special):
            return np.frombuffer(self._library(text), self.dtype)
        return np.frombuffer(self._library(text) if _CONTROLS.search(text) else self._text(text), self.dtype)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and path."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
