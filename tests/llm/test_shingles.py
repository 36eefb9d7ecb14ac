import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from gleanery.llm import shingles
from gleanery.llm.common import Scratch


def plain(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def copies(rng, words, n, low, high):
    """n texts of a similarity of low to high with words."""
    out, base = [], plain(" ".join(words))
    while len(out) < n:
        new = list(words)
        for i in rng.sample(range(len(new)), rng.randint(1, 8)):
            new[i] = f"new{rng.randrange(10**9)}"
        if low <= alike(base, plain(" ".join(new))) <= high:
            out.append(" ".join(new))
    return out


def test_planted_copies_go_from_the_stage(spark):
    rng, rows = random.Random(3), []
    for g in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        low = (0.8, 0.85, 0.9)[g % 3]
        rows.append((10 * g, " ".join(words)))
        rows += [(10 * g + 1 + i, t) for i, t in enumerate(copies(rng, words, 3, low, low + 0.05))]
        rows += [(10 * g + 5 + i, t) for i, t in enumerate(copies(rng, words, 1, 0.6, 0.75))]
    kept = {r["doc_id"] for r in P.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert kept == {i for i, _ in rows if i % 10 in (0, 5)}


def test_components_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(shingles, "MORE", 2)
    rng, texts = random.Random(4), ["", None, "Two words", "two  WORDS"]
    for n in (40, 6, 6, 6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(n):
            words = list(words)
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [t for t in rng.sample(texts[4:], 10)]
    sets, at = [plain(t or "") for t in texts], list(range(len(texts)))
    while (new := [min(at[j] for j in range(len(at)) if alike(sets[i], sets[j]) >= 0.8) for i in range(len(at))]) != at:
        at = new
    out = shingles.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert out.columns == ["doc_id", "text"] and sorted(r["doc_id"] for r in out.collect()) == sorted(set(at))
    assert shingles.keep_one(out.limit(0)).count() == 0


def groups(spark, rows, **more):
    out = defaultdict(set)
    for r in shingles.places(spark.createDataFrame(rows, "fp long, bits binary, shingles array<long>"), Scratch(spark), **more).collect():
        out[r["key"]].add(r["fp"])
    return list(out.values())


@pytest.mark.parametrize("paired", [1024, 2])
def test_simhash_covering_against_all_pairs(spark, paired):
    rng, rows = np.random.default_rng(5), []
    flip = lambda words, at, n: words.__setitem__(at, words[at] ^ np.uint32(sum(1 << int(i) for i in rng.choice(32, n, replace=False))))
    for g in range(60):
        base, part = rng.integers(0, 2**32, shingles.WORDS, dtype=np.uint32), g % shingles.WORDS
        rows.append(base)
        for _ in range(1 + g % 3):  # 3 bits in one part, at most the reach in its window, all others unlike
            new = rng.integers(0, 2**32, shingles.WORDS, dtype=np.uint32)
            for i in range(shingles.WINDOW):
                new[(part + i) % shingles.WORDS] = base[(part + i) % shingles.WORDS]
                flip(new, (part + i) % shingles.WORDS, 10 if i else 3)
            rows.append(new)
    bits = np.array(rows)
    wide, met = np.concatenate([bits, bits[:, : shingles.WINDOW - 1]], axis=1), set()
    for a in range(len(bits)):
        for part in range(shingles.WORDS):
            near = np.bitwise_count(wide[:, part : part + shingles.WINDOW] ^ wide[a, part : part + shingles.WINDOW]).sum(axis=1) <= shingles.REACH
            agree = (((bits[:, part] ^ bits[a, part])[:, None] & shingles._MASKS[part]) == 0).any(axis=1)
            met |= {(a, int(b)) for b in np.flatnonzero(near & agree) if b != a}
    assert len(met) >= 2 * 120
    found = groups(spark, [(i, bytearray(b.tobytes()), [1]) for i, b in enumerate(bits)], paired=paired)
    assert all(any({a, b} <= g for g in found) for a, b in met)
    assert all(any((a, b) in met for b in g) for g in found for a in g)


def test_similar_sets_meet_by_their_fingerprints(spark):
    rng, rows, pairs = np.random.default_rng(6), [], []
    for size, shared in ((4, 4), (8, 8), (9, 8), (45, 40), (270, 240)):
        for _ in range(400 if size < 10 else 100):
            new = rng.integers(-(2**63), 2**63 - 1, 2 * size + 2, dtype=np.int64)
            a = new[:size]
            b = np.concatenate([a[:shared], new[size : size + (shared // 4 if shared == size else size - shared)]])
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows) + i, bytearray(shingles.fingerprint(s).tobytes()), sorted(s.tolist())) for i, s in enumerate((a, b))]
    found = groups(spark, rows)
    assert all(alike(set(rows[a][2]), set(rows[b][2])) >= 0.8 for a, b in pairs)
    at = defaultdict(list)
    for g in found:
        for x in g:
            at[x].append(g)
    assert [p for p in pairs if not any(p[1] in g for g in at[p[0]])] == []


def test_rows_of_a_large_group_grow_with_its_sets(spark, monkeypatch):
    rng, kept, keep = random.Random(7), {}, Scratch.keep
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(words), *copies(rng, words, 199, 0.75, 0.95)]

    def counted(self, df, name):
        out = keep(self, df, name)
        kept[name] = max(kept.get(name, 0), out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    sets, at = [plain(t) for t in texts], list(range(len(texts)))
    while (new := [min(at[j] for j in range(len(at)) if alike(sets[i], sets[j]) >= 0.8) for i in range(len(at))]) != at:
        at = new
    out = shingles.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(at))
    assert len(set(at)) > 1 and max(kept.values()) <= 3 * len(texts), kept


def test_bounds_are_never_below_what_sets_share():
    rng, base = np.random.default_rng(8), np.random.default_rng(9).integers(-(2**63), 2**63 - 1, 9000, dtype=np.int64)
    for size, gone in ((60, 15), (400, 60), (9000, 8500)):
        centre = np.sort(base[:size])
        extra = rng.integers(-(2**63), 2**63 - 1, 12, dtype=np.int64)
        sets = [centre] + [np.sort(np.concatenate([rng.permutation(centre)[gone if size == 9000 else rng.integers(gone) :], rng.permutation(extra)[: rng.integers(12)]])) for _ in range(40)]
        names, count = np.unique(np.concatenate(sets), return_counts=True)
        x = np.zeros(len(sets), shingles._layout(("n", "i4"), ("m", "i4"), ("o", "i4"), ("centre", "i8"), ("lost", "u1", (shingles.BINS,))))
        for i, s in enumerate(sets):
            x[i]["n"], x[i]["m"] = len(s), np.isin(s, names[count > 1]).sum()
            x[i]["o"], x[i]["lost"] = len(np.intersect1d(s, centre)), shingles.lost(centre, s)
            x[i]["centre"] = i % 7 == 6
        i, j = np.triu_indices(len(sets), 1)
        real = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
        most = shingles._share_at_most(x, i, j, 0.0)
        assert (most >= real).all() and (most < np.minimum(x["m"][i], x["m"][j])).any()
