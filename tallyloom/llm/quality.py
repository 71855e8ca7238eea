"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text is a bag of its frequent words and of shape terms: which share of its
words is upper case, carries digits or symbols, repeats the word before, which
share of its lines repeats, and so on, each share in a few steps. Weights are
(1 + log count) * idf. A truncated singular value decomposition of the
labelled texts gives the latent space; labelled vectors and the projection are
broadcast. Each block of documents takes exact cosines with all labelled
vectors, and the ``NEIGHBOURS`` nearest vote with their similarity.

The fit takes at most ``LABELLED`` labelled rows, those whose ids have the
smallest hash; vocabulary, idf and decomposition are part of the fit. The
vocabulary holds ``TERMS`` words, so what is broadcast is bounded by these
parameters. Scoring reads every text whole.

Defined cases: a null text is an empty one, with shape terms alone; labels
without a quality or without a document are left out, repeated ones averaged
(0.5 counts as 1); of documents that repeat a labelled id one text is fitted; without any labelled row, or nothing similar, the score is
the labelled mean, 0.5 if there is none; repeated rows are scored one by one;
an empty table gives no rows; further columns are kept out of the score.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens, words
from .common import release, ship, text_slices

LABELLED = 5000
TERMS = 2048
DIMENSIONS = 64
NEIGHBOURS = 15
_BLOCK = 512
#: Rows of a block whose votes are counted at once.
_VOTES = 64
#: Words that a worker remembers: some 30 MB.
_MOST = 100_000
_LONGEST = 64
_SHAPES = ("lower", "title", "upper", "digit", "symbol", "tailed", "stopped", "shout", "mixed")
_SHARES = (*_SHAPES, "again", "distinct", "lines")
_STEPS = np.array([0.0, 0.002, 0.01, 0.03, 0.08, 0.2, 0.4, 0.6, 0.8, 0.95])
_LEVELS = len(_STEPS) + 1
#: Shape terms: a level of each share, mean length of words, size in powers of two.
SHAPE_TERMS = len(_SHARES) * _LEVELS + 16 + 24
_SHAPE_WEIGHT = 3.0


def shape(word: str) -> int:
    core = word.rstrip(".,;:")
    if core.isalpha():
        if core != word:
            return 6
        return 2 if word.isupper() and len(word) > 1 else 1 if word[0].isupper() else 0
    if any(c.isdigit() for c in word):
        return 3
    if not any(c.isalpha() for c in word):
        return 4
    if word.endswith("!"):
        return 7
    return 5 if core.rstrip("#*%$&@|~^=+<>!?").isalpha() else 8


class _Codes(dict):
    """Code of a word: position in the vocabulary (0: none) and shape."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        found = self.vocabulary.get(word.strip(".,;:!?\"'()").lower(), 0) * 16 + shape(word)
        if len(word) <= _LONGEST:
            if len(self) >= _MOST:
                self.clear()
            self[word] = found
        return found


def terms(text: str, codes: _Codes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms of a text and their counts; shape terms come first, then the vocabulary."""
    words = text.split()
    n = len(words)
    code = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=n)
    lines = text.split("\n")
    share = np.empty(len(_SHARES))
    share[: len(_SHAPES)] = np.bincount(code & 15, minlength=16)[: len(_SHAPES)] / max(n, 1)
    share[-3] = sum(map(eq, words, words[1:])) / max(n - 1, 1)
    share[-2] = len(set(words)) / max(n, 1)
    share[-1] = 1 - len(set(lines)) / len(lines)
    level = np.searchsorted(_STEPS, share, side="left") + np.arange(len(_SHARES)) * _LEVELS
    length = min(int(len(text) / n) if n else 0, 15)
    extra = len(_SHARES) * _LEVELS + np.array([length, 16 + min(n.bit_length(), 23)])
    seen = code >> 4
    count = np.bincount(seen[seen > 0] - 1) if n else np.empty(0, dtype=np.int64)
    known = np.flatnonzero(count)
    return np.concatenate((level, extra, known + SHAPE_TERMS)), np.concatenate((np.ones(len(level) + 2), count[known]))


def weights(numbers: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(counts)) * idf[numbers]
    words = numbers >= SHAPE_TERMS
    norm = np.sqrt((weight[words] ** 2).sum())
    if norm:
        weight[words] /= norm
    shapes = ~words
    weight[shapes] *= _SHAPE_WEIGHT / max(np.sqrt((weight[shapes] ** 2).sum()), 1e-12)
    return weight


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def embed(self, texts: list[str], codes: _Codes) -> np.ndarray:
        out = np.zeros((len(texts), self.projection.shape[1]))
        for k, text in enumerate(texts):
            numbers, counts = terms(text, codes)
            out[k] = weights(numbers, counts, self.idf) @ self.projection[numbers]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def score(self, vectors: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors, ties by their order, for one block."""
        k = min(self.neighbours, len(self.labels))
        if not k:
            return np.full(len(vectors), self.prior)
        cosine = vectors @ self.vectors.T
        nearest = np.empty((len(vectors), k), dtype=np.int64)
        for begin in range(0, len(vectors), _VOTES):  # the order of a whole block takes twice what its cosines take
            nearest[begin : begin + _VOTES] = np.argpartition(-cosine[begin : begin + _VOTES], k - 1, axis=1)[:, :k]
        vote = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 0) ** 8
        total = vote.sum(axis=1)
        mean = (vote * self.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, mean, self.prior).clip(0, 1)


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """At most ``bound`` labelled ids outside the held-out third, with their texts."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (
        labels.where(F.col("quality").isNotNull() & (F.pmod(key, F.lit(3)) != 1))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # an id may be repeated any number of times: one text of each, by its hash
    best = F.min(F.struct(F.xxhash64("text").alias("_hash"), "text")).alias("_best")
    return texts.groupBy("doc_id", "_label").agg(best).select("doc_id", "_best.text", "_label")


def _clear() -> None:
    """Free what other operators have left in a worker, and give it back before this one takes its own."""
    tokens.forget()
    words.forget()
    release()


def _distinct_words(batches):
    _clear()
    for part in (p for batch in batches for p in text_slices(batch, 0, _BLOCK)):
        for text in part.column(0).to_pylist():
            own = {w.strip(".,;:!?\"'()").lower() for w in text.split()}
            yield pa.RecordBatch.from_arrays([pa.array([w for w in own if w], pa.string())], names=["word"])
    release()


def _term_rows(vocabulary: dict[str, int]):
    def read(batches):
        _clear()
        codes = _Codes(vocabulary)
        for part in (p for batch in batches for p in text_slices(batch, 1, _BLOCK)):
            found = [terms(t, codes) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([n for n, _ in found], pa.list_(pa.int64())), pa.array([c for _, c in found], pa.list_(pa.float64()))],
                names=["doc_id", "label", "numbers", "counts"],
            )
        codes.clear()
        release()

    return read


def decompose(matrix: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` right singular vectors, by subspace iteration from a fixed start."""
    k = min(k, *matrix.shape)
    basis = np.linalg.qr(matrix.T @ np.random.default_rng(7).standard_normal((matrix.shape[0], k + 16)))[0]
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    return basis @ np.linalg.svd(matrix @ basis, full_matrices=False)[2][:k].T


def fit(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, size: int = TERMS, k: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """The model. The driver holds at most ``bound`` rows of term counts and ``size`` words."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, bound)
    words = rows.select("text").mapInArrow(_distinct_words, "word string").groupBy("word").count()
    kept = words.where("count >= 3").orderBy(F.desc("count"), "word").limit(size).collect()
    vocabulary = {r["word"]: i + 1 for i, r in enumerate(kept)}
    found = rows.select("doc_id", "text", "_label").mapInArrow(
        _term_rows(vocabulary), "doc_id long, label int, numbers array<long>, counts array<double>"
    ).collect()
    found.sort(key=lambda r: (r["doc_id"], r["numbers"], r["counts"]))
    width, n = SHAPE_TERMS + len(vocabulary), len(found)
    frequency = np.zeros(width)
    for r in found:
        frequency[r["numbers"]] += 1
    idf = np.log((1 + n) / (1 + frequency)) + 1
    matrix = np.zeros((n, width), dtype=np.float32)
    for i, r in enumerate(found):
        numbers = np.array(r["numbers"])
        matrix[i, numbers] = weights(numbers, np.array(r["counts"]), idf)
    projection = decompose(matrix, k) if n else np.zeros((width, 1))
    vectors = (matrix @ projection).astype(float)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Model(vocabulary, idf, projection.astype(float), vectors, np.array([r["label"] for r in found], dtype=float), neighbours)


def _scorer(model):
    def score(batches):
        _clear()
        own = model.value
        codes = _Codes(own.vocabulary)
        for batch in batches:
            for part in text_slices(batch, 1, _BLOCK):
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own.score(own.embed(texts, codes)), pa.float64())], names=["doc_id", "score"]
                )
        codes.clear()
        release()

    return score


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and score of every document; no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scorer(shared), f"doc_id {kind}, score double")


def _filter(model, least: float):
    def keep(batches):
        _clear()
        own = model.value
        codes = _Codes(own.vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in text_slices(batch, at, _BLOCK):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(own.score(own.embed(texts, codes)) >= least))
        codes.clear()
        release()

    return keep


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents scored ``least`` or more, with all their columns; no shuffle."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_filter(docs.sparkSession.sparkContext.broadcast(model), least), docs.schema)
