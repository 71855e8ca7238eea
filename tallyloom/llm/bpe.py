"""Byte-level BPE: encoding by a queue of merge ranks, decoding by concatenation.

A run of bytes is a doubly linked list of symbols. All neighbours that the
vocabulary merges wait in a priority queue by rank, then by place; the least
is merged, its new neighbours join the queue, and entries whose symbols have
gone or changed meanwhile are skipped when they come up. The queue of a long
run is a heap, O(n log n) however long it is. Short runs are merged many at
once: their lists and queues are rows of arrays, with a slot of the queue for
every place, and each step takes the least entry of every row.

No merge crosses the place where white space follows a character that is none,
so a text is cut there, and a piece is merged once as long as the worker
remembers it. It remembers pieces of up to ``_LONGEST`` characters, two
generations of about ``_MOST`` of them: less than 100 MB whatever the texts.

Strings of added tokens inside a text become their ids, as in the library.
Decoding joins the bytes of the tokens; bytes that are no UTF-8 become U+FFFD,
ids outside the vocabulary are skipped.

Defined cases: a null text is an empty one, an empty text has no ids, null ids
decode to an empty text; repeated rows are encoded one by one; an empty table
gives no rows; a column of the name that is to be written is replaced, all
other columns are carried along, or those that ``keep`` names.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ship
from .tokens import slices

_MOST = 150_000
_LONGEST = 48
_SLICE = 1 << 20
_SHORT = (8, 16, 32)
_STOPS = (",", ".")
_NEVER = np.int32(2**31 - 1)
#: White space by its Unicode property, as the patterns of the vocabularies see it.
_WHITE = r"\t-\r \x85\xa0  -     　"
_pieces = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall
#: Fixed pattern of byte-level vocabularies: suffixes, letters, digits, others, white space.
_runs = regex.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+").findall


def byte_names() -> list[str]:
    """Byte-level vocabularies name printable bytes by themselves and the others from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(others)) for b in range(256)]


class Bpe:
    """A vocabulary file with its merges; ``encode`` gives little-endian unsigned 32-bit ids."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        vocabulary, names = model["vocab"], byte_names()
        size = 1 + max(vocabulary.values())
        self._byte_ids = np.array([vocabulary[name] for name in names], dtype=np.int32)
        #: By left symbol: rank by right symbol. The last entry is the end of a run, which merges with nothing.
        self._ranks: list[dict[int, int]] = [{} for _ in range(size + 1)]
        made, pairs = [], []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = vocabulary[left], vocabulary[right]
            self._ranks[a][b] = len(made)
            pairs.append(a << 32 | b)
            made.append(vocabulary[left + right])
        self._made = np.array(made, dtype=np.int32)
        self._pair_ranks = np.argsort(pairs).astype(np.int32)
        self._pairs = np.array(pairs, dtype=np.int64)[self._pair_ranks]
        self._added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens with conditions")
        longest = sorted(self._added, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if longest else None
        bytes_of = {name: b for b, name in enumerate(names)}
        self._tokens = [b""] * (1 + max([*vocabulary.values(), *self._added.values()]))
        for token, number in [*vocabulary.items(), *self._added.items()]:
            known = all(c in bytes_of for c in token)
            self._tokens[number] = bytes(map(bytes_of.__getitem__, token)) if known else token.encode()
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def merge(self, run: bytes) -> bytes:
        """Ids of one run of bytes, by a heap."""
        ids = self._byte_ids[np.frombuffer(run, dtype=np.uint8)].tolist()
        n = len(ids)
        ids.append(-1)  # both neighbours beyond the ends
        ranks, made, bits = self._ranks, self._made, n.bit_length()
        current = [ranks[a].get(b, -1) for a, b in zip(ids, ids[1:])]
        queue = [rank << bits | i for i, rank in enumerate(current) if rank >= 0]
        current.append(-1)
        heapify(queue)
        after, before, mask = list(range(1, n + 2)), list(range(-1, n)), (1 << bits) - 1
        while queue:
            least = heappop(queue)
            i, rank = least & mask, least >> bits
            if current[i] != rank:
                continue  # stale: one of its symbols has gone or grown
            j = after[i]
            k = after[i] = after[j]
            before[k] = i
            both = ids[i] = int(made[rank])
            ids[j] = current[j] = -1
            rank = current[i] = ranks[both].get(ids[k], -1)
            if rank >= 0:
                heappush(queue, rank << bits | i)
            h = before[i]
            rank = current[h] = ranks[ids[h]].get(both, -1)
            if rank >= 0:
                heappush(queue, rank << bits | h)
        return array("I", [x for x in ids if x >= 0]).tobytes()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where((right >= 0) & (self._pairs[at] == pair), self._pair_ranks[at], _NEVER)

    def _merge_rows(self, runs: list[bytes], width: int) -> list[bytes]:
        """Ids of runs of at most ``width`` bytes, one row each."""
        n = len(runs)
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=n)
        ids = np.full((n, width + 1), -1, dtype=np.int32)
        ids[np.arange(width + 1) < sizes[:, None]] = self._byte_ids[np.frombuffer(b"".join(runs), dtype=np.uint8)]
        after = np.tile(np.arange(1, width + 2, dtype=np.int8), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int8), (n, 1))
        queue = np.full((n, width + 1), _NEVER)
        queue[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        rows = np.arange(n)
        while len(rows):
            place = queue[rows].argmin(axis=1)
            rank = queue[rows, place]
            open_ = rank < _NEVER
            rows, place, rank = rows[open_], place[open_], rank[open_]
            queue[rows, place] = _NEVER
            live = ids[rows, place] >= 0  # stale otherwise: its symbol has gone
            r, i = rows[live], place[live]
            j = after[r, i]
            k = after[r, j]
            h = before[r, i]
            both = self._made[rank[live]]
            after[r, i], before[r, k] = k, i
            ids[r, i], ids[r, j] = both, -1
            queue[r, i] = self._rank(both, ids[r, k])
            queue[r, h] = self._rank(ids[r, h], both)
        kept = ids >= 0
        data, ends = ids[kept].tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _merged(self, runs: list[str]) -> dict[str, bytes]:
        """Ids by run."""
        coded = [r.encode() for r in runs]
        found, sizes = {}, np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        low = 0
        for high in _SHORT:
            here = np.flatnonzero((sizes > low) & (sizes <= high)).tolist()
            found.update(zip([runs[i] for i in here], self._merge_rows([coded[i] for i in here], high)))
            low = high
        for i in np.flatnonzero(sizes > low).tolist():
            found[runs[i]] = self.merge(coded[i])
        return found

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of all these pieces; each starts where no merge can reach back."""
        known, older = self._known, self._older
        words, stopped, others = [], [], {}
        for piece in pieces.difference(known):
            if piece in older:
                known[piece] = older[piece]
                continue
            body = piece[piece[0] == " " :]
            if body.isalpha():
                words.append(piece)
            elif body[-1:] in _STOPS and body[:-1].isalpha():
                stopped.append(piece)
            else:
                others[piece] = _runs(piece)
        ids = self._merged(list(set(_STOPS).union(words, [p[:-1] for p in stopped], *others.values())))
        known.update((p, ids[p]) for p in words)
        known.update((p, ids[p[:-1]] + ids[p[-1]]) for p in stopped)
        known.update((p, b"".join(map(ids.__getitem__, runs))) for p, runs in others.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > _MOST:
            self._older, self._known = self._known, {}
        split = self._split
        parts = [split(t) if split and any(a in t for a in self._added) else [t] for t in texts]
        cut = [[_pieces(p) for p in of_text[::2]] for of_text in parts]
        pieces = set().union(*(part for of_text in cut for part in of_text))
        self._learn(pieces)
        ids = self._known.__getitem__
        out = []
        for of_text, of_parts in zip(parts, cut):
            found = [b"".join(map(ids, p)) for p in of_parts]
            for k, name in enumerate(of_text[1::2]):
                found[k] += array("I", [self._added[name]]).tobytes()
            out.append(b"".join(found))
        for piece in [p for p in pieces if len(p) > _LONGEST]:
            del self._known[piece]
        return out

    def decode(self, ids: np.ndarray) -> str:
        tokens = self._tokens
        ids = ids[(ids >= 0) & (ids < len(tokens))]
        return b"".join(map(tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


_coders: dict[str, Bpe] = {}


def coder(path: str) -> Bpe:
    """One coder per worker process and vocabulary."""
    if path not in _coders:
        _coders[path] = Bpe(path)
    return _coders[path]


def forget() -> None:
    """Free what a worker remembers: workers outlive their operators."""
    _coders.clear()


def _encoder(path: str, text: str, kept: list[str]):
    def encode(batches):
        code = coder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for begin, end in slices(texts, _SLICE):
                found = code.encode(texts[begin:end])
                offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(found), dtype=np.int32))
                columns = [batch.column(name).slice(begin, end - begin) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, ids], [*kept, "ids"])

    return encode


def _decoder(path: str, ids: str, kept: list[str]):
    def decode(batches):
        code = coder(path)
        for batch in batches:
            lists = batch.column(ids)
            lists = lists if lists.null_count == 0 else pa.array([x.as_py() or [] for x in lists], lists.type)
            for begin, end in slices(lists, _SLICE):
                texts = [code.decode(np.asarray(x.values)) for x in lists.slice(begin, end - begin)]
                columns = [batch.column(name).slice(begin, end - begin) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, "text"])

    return decode


def _mapped(rows: DataFrame, make, source: str, into: str, kind: T.DataType, keep: Sequence[str] | None) -> DataFrame:
    """``rows`` with ``into`` made of ``source``; inside, columns go by number, so that no name can clash."""
    ship(rows.sparkSession)
    keep = [c for c in (rows.columns if keep is None else keep) if c.lower() != into.lower()]
    names = [f"k{i}" for i in range(len(keep))]
    plain = rows.select(*[rows[c].alias(n) for c, n in zip(keep, names)], rows[source].alias("source"))
    made = "ids" if isinstance(kind, T.ArrayType) else "text"
    schema = T.StructType([*[T.StructField(n, plain.schema[n].dataType) for n in names], T.StructField(made, kind)])
    return plain.mapInArrow(make("source", names), schema).toDF(*keep, into)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the ids of their texts as ``array<int>``."""
    return _mapped(docs, lambda s, k: _encoder(path, s, k), text, into, T.ArrayType(T.IntegerType()), keep)


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with the text that their ids spell."""
    return _mapped(rows, lambda s, k: _decoder(path, s, k), ids, into, T.StringType(), keep)
