"""Token ids by the tokenizers library, one call per distinct word form.

Both vocabularies never merge across the place where white space follows a
character that is none: their own patterns put a boundary there. A text is cut
at these places, each distinct piece is encoded by the library once and kept
in a bounded memory of the worker, and the ids of a text are those of its
pieces in order. Texts with control characters on which notions of white space
differ are given to the library whole.

A plain word (Latin letters, perhaps a space before and a comma or full stop
after) is one run for the patterns, so it goes to the library's merge model
directly; all else goes through the library's whole chain.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Python calls these white space; the vocabularies' patterns may not.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85")
_MOST = 1_000_000
_LONGEST = 64

_plain = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch


def _byte_names() -> dict[int, str]:
    """Byte-level vocabularies name printable bytes by themselves and the others from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


_named = {chr(b): name for b, name in _byte_names().items()}

_coders: dict[tuple[str, bool], "PieceCoder"] = {}


class PieceCoder:
    """Encodes texts as little-endian unsigned 32-bit ids, without added special tokens."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.most = _MOST
        self.pieces = re.compile(r"\s*\S+|\s+").findall if keeps_space else str.split
        self.known: dict[str, bytes] = {}
        self.stops = {"": b""} | {c: self._library([c])[0] for c in ",."}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, new: list[str]) -> None:
        known, rest, merges = self.known, [], self.tokenizer.model.tokenize
        for piece in new:
            found = _plain(piece)
            if found is None:
                rest.append(piece)
                continue
            space, word, stop = found.groups()
            ids = known.get(space + word) if stop else None
            if ids is None:
                run = word if self.keeps_space else word.lower()
                if not run.isascii():
                    run = "".join(map(_named.__getitem__, run.encode().decode("latin-1")))
                if space:
                    run = _named[" "] + run
                ids = array("I", [t.id for t in merges(run)]).tobytes()
            known[piece] = ids + self.stops[stop]
        known.update(zip(rest, self._library(rest)))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [None if any(c in t for c in _ODD) else self.pieces(t) for t in texts]
        new = list(set().union(*(c for c in cut if c is not None)).difference(self.known))
        if len(self.known) + len(new) > self.most:
            self.known = {}
            new = list(set().union(*(c for c in cut if c is not None)))
        self._learn(new)
        known = self.known
        out = [self._library([t])[0] if c is None else b"".join(map(known.__getitem__, c)) for t, c in zip(texts, cut)]
        for piece in new:
            if len(piece) > _LONGEST:
                del known[piece]
        return out


def coder(path: str, keeps_space: bool, most: int = _MOST) -> PieceCoder:
    """One coder per worker process and vocabulary. ``keeps_space``: white space is part of the tokens.

    ``most``: pieces it remembers, some 200 bytes each.
    """
    key = (path, keeps_space)
    if key not in _coders:
        _coders[key] = PieceCoder(path, keeps_space)
    _coders[key].most = most
    return _coders[key]


def forget() -> None:
    """Free the coders of a worker and all they know: workers outlive their operators."""
    _coders.clear()


def slices(texts, size: int = 1 << 22):
    """(begin, end) of runs of rows with about ``size`` characters, one row at least."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def as_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
