"""Operators on tokens and bytes (3, 4, 7, 10) against brute force."""

import random
import zlib

import numpy as np
import pytest

from tallyloom.llm import packing, records, slots, token_counts, tokens
from tallyloom.llm.common import fresh_folder
from tallyloom.llm.queries import vocabulary

TEXTS = [
    "", None, " ", "a", " a", "a ", "one two  three   four\n\nfive\n six \t seven", "it's they'll don't 'S", "É́ naïve Ünïcode Straße ΣΑΣ ΣΣ",
    "日本語 テスト ｆｕｌｌ", "a\x1cb \x85 c\xa0 d e　 f", "x▁y ▁ z", "<s> <|endoftext|> <|startoftext|>x", "\x00 nul ​ zero",
    "1234567890 3.14 $5.00!!! ###", "word " * 50, "z" * 300, "ab" * 100 + " tail", "é ́x", "🙂🙃 👨‍👩‍👧", "line\r\nline\r\n", "\n\n  x", "é" * 70,
]


def random_texts(n):
    rng = random.Random(5)
    alphabet = "abcdeé ßx\n  '.,1#ñ日▁🙂\t\x1d\xa0"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_pieces_encode_as_whole_texts(name, keeps):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(name))
    words = ["Àé", "ß,", "ÿ.", "a b", " A", "Mot. Ça, là", "it,", "x.y", "über,,", "ñandú Ñ."]
    texts = [t or "" for t in TEXTS] + random_texts(400) + words
    got = tokens.coder(vocabulary(name), keeps).encode(texts)
    for t, ids in zip(texts, got):
        assert tokens.as_ids(ids).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_prefix_counts_are_the_librarys(spark):
    own = token_counts.tables(vocabulary("piece_bpe_32k.model"))
    texts = [t or "" for t in TEXTS] + random_texts(200)
    for t, steps in zip(texts, own.steps(texts)):
        assert len(steps) == 2 * len(t)
        for end in range(len(t) + 1):
            assert token_counts.prefix_count(steps, end) == len(own.library.encode(t[:end])), repr(t[:end])
        for budget in (0, 1, 3, 10):
            fits = [e for e in range(len(t) + 1) if len(own.library.encode(t[:e])) <= budget]
            assert token_counts.longest_within(steps, budget) == fits[-1]
    got = {r.doc_id: r for r in token_counts.prefix_counts(frame(spark, TEXTS), vocabulary("piece_bpe_32k.model"), budgets=(4,)).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].n_tokens == len(own.library.encode(t or "")) and got[i].n_bytes == len((t or "").encode())
    assert token_counts.prefix_counts(frame(spark, []), vocabulary("piece_bpe_32k.model")).count() == 0


def test_records_round_trip(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = list(range(len(TEXTS)))
    random.Random(2).shuffle(ids)
    ids[3], ids[5] = None, ids[6]
    back = records.round_trip(spark, frame(spark, TEXTS, ids), vocabulary("word_bpe_49k.json"), 2, keep_ids=True).collect()
    back.sort(key=lambda r: r.start)
    assert [r.doc_id for r in back] == [None, *sorted(i for i in ids if i is not None)]
    at = 0
    for r in back:
        want = {tuple(library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, TEXTS) if i == r.doc_id}
        assert tuple(tokens.as_ids(r.ids).tolist()) in want
        assert r.start == at and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    assert records.round_trip(spark, frame(spark, []), vocabulary("word_bpe_49k.json"), 2).count() == 0


def test_damaged_records_are_told():
    good = records.frame(records.pack(7, b"\1\0\0\0"))
    assert records.unpack(records.unframe(good)) == (7, b"\1\0\0\0")
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(bad))
    with pytest.raises(ValueError):
        records.unframe(good[:-1])


def test_index_reads_in_any_order(spark):
    folder, index = records.write_records(frame(spark, TEXTS), vocabulary("word_bpe_49k.json"), 2)
    some = index.where("doc_id in (3, 7, 8, 20)").orderBy("file", __import__("pyspark").sql.functions.desc("offset"))
    assert sorted(r.doc_id for r in records.read_records(folder, some).collect()) == [3, 7, 8, 20]


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(3)
    texts = ["x" * int(rng.paretovariate(1.1) * 30 % 3000) for _ in range(700)] + [None, "", "same"] * 20
    ids = [rng.choice([None, i, 5]) if i % 9 == 0 else i for i in range(len(texts))]
    folder = fresh_folder(spark, "slot_map")
    rows = slots.shard_by_slots(frame(spark, texts, ids), folder, 8, 512).collect()
    assert len(rows) == len(texts)
    load = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(load) - min(load) <= 0.02 * sum(load) / 8
    for s in range(8):
        assert sorted(r.position for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    sizes = sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows)
    assert sizes == sorted((i is None, i or 0, len(t or "") + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts))
    first, second = (slots.load_map(spark, folder, v).orderBy("virtual_slot").collect() for v in (1, 2))
    assert len(first) == len(second) == 512 and [r.shard for r in first] == [i % 8 for i in range(512)]
    assert slots.shard_by_slots(frame(spark, []), fresh_folder(spark, "slot_map")).count() == 0


def test_rebalancing_edits_few_slots():
    rng = np.random.default_rng(1)
    size = rng.pareto(2, 4096) * 1000
    owner = slots.rebalance(slots.even_map(4096, 24), size, 24)
    load = np.bincount(owner, weights=size, minlength=24)
    assert load.max() - load.min() < 0.001 * load.mean()
    assert (owner != slots.even_map(4096, 24)).mean() < 0.5
    grown = slots.rebalance(owner, size, 25)
    load = np.bincount(grown, weights=size, minlength=25)
    assert load.max() - load.min() < 0.001 * load.mean() and (grown != owner).mean() < 0.3


def test_pricing_is_a_knapsack():
    rng = np.random.default_rng(4)
    for _ in range(20):
        duals = np.where(rng.random(12) < 0.3, -1, rng.random(12))
        value, pattern = packing.price(duals, 12)
        assert (pattern * np.arange(1, 13)).sum() <= 12 and abs((pattern * duals).sum() - value) < 1e-9
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - w] + duals[w - 1] for w in range(1, c + 1)])
        assert abs(best[12] - value) < 1e-9


def test_plan_uses_the_demand_and_little_more_than_the_bound():
    rng = np.random.default_rng(6)
    for scale in (1, 50, 4000):
        demand = rng.poisson(scale * rng.random(64))
        chosen = packing.plan(demand, 64)
        assert (sum(n * p for p, n in chosen) == demand).all()
        assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in chosen)
        bound = (demand * np.arange(1, 65)).sum() / 64
        assert sum(n for _, n in chosen) <= 1.06 * bound + 8
    assert packing.plan(np.zeros(64, dtype=np.int64), 64) == []


def test_packing_holds_every_token_once(spark):
    from tokenizers import Tokenizer

    rng = random.Random(8)
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = TEXTS + [" ".join(rng.choice(["ab", "cde", "f"]) for _ in range(rng.randrange(1, 900))) for _ in range(150)] + ["copy of one"] * 60
    rows = packing.pack_documents(frame(spark, texts), vocabulary("byte_bpe_50k.json"), 1, 256).collect()
    for i, t in enumerate(texts):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1])
        assert sum(r.length for r in mine) == len(ids) == mine[0].doc_tokens
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1]) and sum(r.length for r in own) <= 256
    assert len(by) <= 1.06 * sum(r.length for r in rows) / 256 + 2
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0
