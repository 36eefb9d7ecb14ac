import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from gleanery.llm import packing

TEXTS = [None, "", " ", "A", "Hello, World!! don't I'LL we've 3rd a1b2 x...", "ß Straße STRASSE ÀÉ µ ªº 中文字 ﬁ Å é İstanbul ŉ Ǆ Ωσς", "a b c\x85d\x1ce", "<|endoftext|> x <|startoftext|>", "\n\n a\n b ", "no-break end.", "word " * 30]


def ids(text, tokenizer=Tokenizer.from_file(packing.public_tokenizer())):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_tokens_are_the_tokenizers(monkeypatch, block):
    monkeypatch.setattr(packing, "_BLOCK", block)
    tokens = packing.WordTokens(packing.public_tokenizer())
    for t in TEXTS:
        got = b"".join(p for _, p in packing.cut(tokens, t, 7, 1))
        assert np.frombuffer(got, "<u4").tolist() == ids(t)
        assert [s for s, _ in packing.cut(tokens, t, 7, 1)] == list(range(0, len(got) // 4, 7))


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 10)
    tokens = packing.WordTokens(packing.public_tokenizer())
    text = " ".join(f"w{i} the" for i in range(50))
    assert np.frombuffer(b"".join(p for _, p in packing.cut(tokens, text, 4096, 1)), "<u4").tolist() == ids(text) and len(tokens) <= 10


def test_plan_uses_every_piece_once():
    rng = random.Random(2)
    for cap in (10, 64, 257):
        for _ in range(20):
            counts = Counter(rng.choices(range(1, cap + 1), k=rng.randint(0, 300)))
            plan = packing.plan(dict(counts), cap)
            used = Counter()
            for lengths, times in plan:
                assert sum(lengths) <= cap and times > 0
                for k in lengths:
                    used[k] += times
            assert used == counts
            bins, least = sum(t for _, t in plan), -(-sum(k * v for k, v in counts.items()) // cap)
            assert least <= bins <= least * 1.25 + 2


def test_exact_complements_are_found():
    assert packing.plan({7: 2, 3: 2}, 10) == [([7, 3], 2)]
    assert packing.plan({6: 1, 3: 1, 1: 1}, 10) == [([6, 3, 1], 1)]
    assert packing.plan({5: 2, 2: 2, 1: 2}, 10) == [([5, 5], 1), ([2, 2, 1, 1], 1)]


def test_packed_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 3)
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "of", "the"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(60)] + [(i, "alpha beta") for i in range(100, 130)] + [(200, None), (None, "x"), (7, "repeat"), (7, "repeat")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text").selectExpr("*", "'clash' AS length", "1 AS piece")
    out = packing.pack(df, packing.public_tokenizer(), 16, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in out:
        assert crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] and r["start"] == 16 * r["piece"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_seq.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 16
    want = Counter((i, tuple(ids(t))) for i, t in rows if i not in (7, None))
    got = Counter((i, tuple(np.frombuffer(b"".join(r["ids"] for r in sorted(rs, key=lambda r: r["piece"])), "<u4").tolist())) for i, rs in by_doc.items() if i not in (7, None))
    assert got == want and len(by_doc[None]) == 1
    assert packing.pack(df.limit(0), packing.public_tokenizer()).count() == 0


def test_rows_without_an_id_are_numbered_in_parts(spark, monkeypatch):
    """10,000 equal rows without an id: many parts number them, and all have places of their own."""
    monkeypatch.setattr(packing, "NUMBERED", 500)
    df = spark.createDataFrame([(None, "one two")] * 10_000, "doc_id long, text string").repartition(4)
    out = packing.pack(df, packing.public_tokenizer())
    length = len(ids("one two"))
    assert out.select("sequence_id", "offset").distinct().count() == 10_000 and out.where(f"length <> {length}").isEmpty()
    assert out.select("sequence_id").distinct().count() == -(-10_000 // (4096 // length))
