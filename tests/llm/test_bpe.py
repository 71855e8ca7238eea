"""The merge queues against the library of the vocabulary."""

import random

import numpy as np
import pytest

from tallyloom.llm import bpe
from tallyloom.llm.queries import vocabulary

PARTS = ["<|endoftext|>", "<|endof", " ", "  ", "\n", "\t", "\x85", "\x1c", "　", "'s", "'ll", "don't", "12", "é", "漢字", "the", "ing", "🙂", "\x00", "_", "...", ",", "́"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def _texts(seed, n=4000):
    rng = random.Random(seed)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(12))) for _ in range(n)]
    return mixed + [" ".join("".join(rng.choice("etaoinshrdluéß") for _ in range(rng.randrange(1, 50))) + rng.choice(["", ",", "."]) for _ in range(6)) for _ in range(300)]


@pytest.mark.parametrize("most", [150_000, 40])
def test_ids_and_texts_are_those_of_the_library(library, monkeypatch, most):
    monkeypatch.setattr(bpe, "_MOST", most)
    code, texts = bpe.Bpe(vocabulary("byte_bpe_50k.json")), _texts(1)
    for begin in range(0, len(texts), 100):
        part = texts[begin : begin + 100]
        ids = [np.frombuffer(b, dtype="<u4").tolist() for b in code.encode(part)]
        assert ids == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [code.decode(np.array(i, dtype=np.int64)) for i in ids] == part


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 50_000, " " * 50_000, "xyzzy" * 20_000, "word and word, " * 20_000])
def test_very_long_runs(library, text):
    code = bpe.Bpe(vocabulary("byte_bpe_50k.json"))
    ids = np.frombuffer(code.encode([text])[0], dtype="<u4")
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert code.decode(ids) == text


def test_heap_and_rows_agree():
    code, rng = bpe.Bpe(vocabulary("byte_bpe_50k.json")), random.Random(4)
    runs = ["".join(rng.choice("abeginrst th") for _ in range(rng.randrange(1, 33))).encode() for _ in range(2000)]
    assert code._merge_rows(runs, 32) == [code.merge(r) for r in runs]


def test_any_ids_decode_as_in_the_library(library):
    code, rng = bpe.Bpe(vocabulary("byte_bpe_50k.json")), random.Random(2)
    for _ in range(1000):
        ids = [rng.randrange(50400) for _ in range(rng.randrange(9))]
        assert code.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_frames(spark, library):
    path = vocabulary("byte_bpe_50k.json")
    rows = [(1, None, 5), (2, "", 6), (3, "Some text, some  text.", 7), (3, "Some text, some  text.", 7), (None, "x" * 5000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source int").withColumnRenamed("source", "Ids")
    coded = bpe.encode(docs, path)
    assert coded.columns == ["doc_id", "text", "ids"]  # the column of that name is replaced
    for r in coded.collect():
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids
    back = bpe.decode(coded, path)
    assert sorted((r.doc_id or 0, r.text or "", r.decoded) for r in back.collect()) == sorted((i or 0, t or "", t or "") for i, t, _ in rows)
    assert [r.decoded for r in bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), path).collect()] == [""]
    clash = spark.createDataFrame([("a", "b", "c")], "text string, k0 string, source string")
    assert bpe.encode(clash, path).columns == ["text", "k0", "source", "ids"]
    assert bpe.encode(docs.limit(0), path).count() == 0
