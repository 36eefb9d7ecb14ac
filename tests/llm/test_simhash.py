import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gleanery.llm import simhash
from gleanery.llm.common import Scratch
from gleanery.llm.graph import components


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, radius):
    """Smallest position reachable, by all pairs."""
    at = list(range(len(values)))
    while True:
        new = [min(at[j] for j in range(len(values)) if (values[i] ^ values[j]).bit_count() <= radius) for i in range(len(values))]
        if new == at:
            return at
        at = new


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one TWO", "Éa b\x0bc d\x1ce  f", "a b c " * 50, "x" * 3_000_000 + " y z " + "w " * 700_000])
def test_fingerprint(text, monkeypatch):
    assert simhash.fingerprint(text) % 2**64 == plain(text)
    monkeypatch.setattr(simhash.word_blocks, "__defaults__", (7,))
    if not text or len(text) < 1000:
        assert simhash.fingerprint(text) % 2**64 == plain(text)


def test_every_pair_within_the_radius_collides():
    rng, masks = random.Random(5), simhash.covering_masks(3, 1)
    for _ in range(20_000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not diff & m % 2**64 for m in masks)
    assert len(masks) == 15


@pytest.mark.parametrize("bucket", [3, 20_000])
def test_components_against_all_pairs(spark, bucket):
    rng = random.Random(bucket)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    values = seeds + [rng.choice(seeds) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(400)]
    values = list(dict.fromkeys(values + [values[-1] ^ 1, values[-1] ^ 3, values[-1] ^ 31, values[-1] ^ (31 << 5)]))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    scratch = Scratch(spark)
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), scratch, bucket=bucket)
    roots = {r["node"]: r["root"] for r in components(edges, scratch).collect()}
    want = groups(values, 3)
    mine = {}
    for i, v in enumerate(signed):
        mine.setdefault(roots.get(v, v), []).append(i)
    theirs = {}
    for i, r in enumerate(want):
        theirs.setdefault(r, []).append(i)
    assert sorted(mine.values()) == sorted(theirs.values())


def test_rows_nulls_and_copies(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "A b  c d e"), (None, "a b c d e"), (8, None), (7, ""), (9, "x y"), (9, "q r s t"), (None, "only here"), (None, "only here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    out = simhash.near_duplicates(df).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"] or 0) for r in out) == [(False, 3, 3), (False, 5, 3), (False, 5, 3), (False, 7, 7), (False, 8, 7), (False, 9, 9), (False, 9, 9), (True, 0, 0), (True, 0, 0), (True, 0, 3)]
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(3, "A b  c d e"), (7, ""), (9, "x y"), (9, "q r s t"), (None, "only here")], key=str)
    assert simhash.keep_one(df).columns == df.columns
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_a_chain_is_one_component(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    out = components(spark.createDataFrame(rows, "a long, b long"), Scratch(spark)).collect()
    assert {r["root"] for r in out if r["node"] <= 60} == {0} and len(out) == 63


def test_a_bucket_of_far_fingerprints_is_dealt_out(spark, monkeypatch):
    """Many fingerprints that share all bits of a table: none of their links is lost."""
    rng, mask = random.Random(8), simhash.covering_masks(3, 1)[4]
    values = {rng.getrandbits(64) & ~mask % 2**64 for _ in range(600)}
    values |= {v ^ 1 << rng.choice([b for b in range(64) if not mask >> b & 1]) for v in list(values)[:50]}
    values = sorted(values)
    df = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    found = simhash.links(df, Scratch(spark), bucket=40)
    pairs = {tuple(sorted((values[i], values[j]))) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 3}
    got = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in found.collect()}
    assert pairs and {x for p in got for x in p} == {x for p in pairs for x in p}
