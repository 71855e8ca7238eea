"""Exact token counts of every prefix of a text, for a sentencepiece BPE vocabulary.

For a vocabulary of merges the last token of the encoding of a prefix is the
one token ``t`` ending there that may follow the last token of the prefix
before ``t``, that is, the library encodes the two as these two. So counts of
all prefixes follow from left to right in one pass. The vocabulary never
merges across a space after another character; the pass therefore runs once
per distinct word form and the tables of a text's words are joined.

Counts are stored as one signed 16-bit step per code point: the count of a
prefix is the sum of the steps before its end. Truncation and budget questions
are answered from them without encoding again.

Defined cases: a null text is an empty one, with no steps and no tokens;
special strings are ordinary text; texts of any length are counted whole.
"""

from __future__ import annotations

import re
from array import array
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship
from .tokens import slices

_SPACE = "▁"
_MOST = 1_000_000
_LONGEST = 64
_words = re.compile(r" *[^ ]+| +").findall

_tables: dict[str, "PrefixTables"] = {}


class PrefixTables:
    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        model.normalizer_spec.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        pieces = [p.piece for p in model.pieces if p.type == 1]
        self.longest = max(map(len, pieces), default=1)
        #: Pieces that the library makes of their own text.
        self.pieces = {p for p, found in zip(pieces, self.bare.encode(pieces, out_type=str)) if found == [p]}
        self.follow: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def _learn_pair(self, pair: tuple[str, str]) -> bool:
        if len(self.follow) >= _MOST:
            self.follow.clear()
        found = self.follow[pair] = self.bare.encode(pair[0] + pair[1], out_type=str) == [*pair]
        return found

    def counts(self, text: str, shared: int = 0, count: list[int] | None = None, last: list[str] | None = None) -> list[int]:
        """Tokens of every prefix of ``text``, encoded without a space put before it.

        The pass depends on what lies before only: ``count`` and ``last`` of a
        text with the same first ``shared`` code points are taken over.
        """
        text = text.replace(" ", _SPACE)
        pieces, follow, longest = self.pieces, self.follow, self.longest
        count, last = ([0], [""]) if count is None else (count, last)
        del count[shared + 1 :], last[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            for begin in range(max(0, end - longest), end):
                piece = text[begin:end]
                if piece not in pieces:
                    continue
                before = last[begin]
                if before:
                    pair = (before, piece)
                    found = follow.get(pair)
                    if not (self._learn_pair(pair) if found is None else found):
                        continue
                count.append(count[begin] + 1)
                last.append(piece)
                break
            else:  # no piece of the vocabulary: one token a byte, and nothing merges with it
                count.append(count[-1] + len(text[end - 1].encode()))
                last.append("")
        return count

    def learn(self, words: set[str]) -> None:
        """Steps of new word forms in order, so that each takes over what it shares with the one before;
        the last count of each is held against the library's own."""
        new = sorted(words.difference(self.known))
        if len(self.known) + len(new) > _MOST:
            self.known.clear()
            new = sorted(words)
        count, last, before = [0], [""], ""
        for word, ids in zip(new, self.bare.encode(new)):
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            self.counts(word, shared, count, last)
            before = word
            right = count if count[-1] == len(ids) else self._plain(word)
            self.known[word] = array("h", map(sub, right[1:], right)).tobytes()

    def _plain(self, text: str) -> list[int]:
        return [len(self.bare.encode(text[:end])) for end in range(len(text) + 1)]

    def steps(self, texts: list[str]) -> list[bytes]:
        """Steps of texts as the library counts them: with a space put before a text that is not empty."""
        cut = [[] if not t else [" " + t] if _SPACE in t else _words(" " + t) for t in texts]
        self.learn(set().union(*cut))
        out = []
        for words in cut:
            if not words:
                out.append(b"")
                continue
            joined = np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype="<i2")
            first = joined[1:].copy()
            first[0] += joined[0]
            out.append(first.tobytes())
        for word in {w for words in cut for w in words if len(w) > _LONGEST}:
            self.known.pop(word, None)
        return out


def tables(path: str) -> PrefixTables:
    if path not in _tables:
        _tables[path] = PrefixTables(path)
    return _tables[path]


def prefix_count(steps: bytes, end: int) -> int:
    """Tokens of the first ``end`` code points."""
    return int(np.frombuffer(steps, dtype="<i2")[:end].sum(dtype=np.int64))


def longest_within(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix whose encoding has at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(steps, dtype="<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def _counter(path: str, keep_steps: bool, budgets: tuple[int, ...]):
    def count(batches):
        own = tables(path)
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                steps = own.steps(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(a, b - a),
                        pa.array([len(t.encode("utf-8")) for t in texts[a:b]], pa.int64()),
                        pa.array([prefix_count(s, len(s)) for s in steps], pa.int64()),
                        *(pa.array([longest_within(s, n) for s in steps], pa.int64()) for n in budgets),
                        *([pa.array(steps, pa.binary())] if keep_steps else []),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", *(f"fits_{n}" for n in budgets), *(["steps"] if keep_steps else [])],
                )

    return count


def prefix_counts(docs: DataFrame, vocabulary: str, keep_steps: bool = True, budgets: tuple[int, ...] = ()) -> DataFrame:
    """Per document its bytes, tokens, the longest prefix within each budget, and the steps of all prefixes.

    No shuffle: each partition is counted where it is read.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"
    schema += "".join(f", fits_{n} long" for n in budgets) + (", steps binary" if keep_steps else "")
    return docs.select("doc_id", "text").mapInArrow(_counter(vocabulary, keep_steps, tuple(budgets)), schema)
