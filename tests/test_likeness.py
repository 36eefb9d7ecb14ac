from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.functions import likeness as L
from gleanery.operators import aliases

texts = st.text("ab c", max_size=9)


def lcs(a, b):
    if not a or not b:
        return 0
    return max(lcs(a[1:], b), lcs(a, b[1:]), 1 + lcs(a[1:], b[1:]) if a[0] == b[0] else 0)


def plain(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


@settings(max_examples=150, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_subsequences_and_parts(a, b):
    assert L.common(a, b) == lcs(a, b) and abs(L.ratio(a, b) - plain(a, b)) < 1e-12
    if a and b:
        short, long = sorted((a, b), key=len)
        windows = [long[i:j] for i in range(len(long)) for j in range(i + 1, len(long) + 1) if j - i == len(short) or (j - i < len(short) and (i == 0 or j == len(long)))]
        best = max(plain(short, w) for w in windows)
        if len(a) < len(b):
            assert abs(L.part_ratio(a, b) - best) < 1e-12
        assert L.part_ratio(a, b) >= best - 1e-12


@settings(max_examples=200, deadline=None)
@given(texts, texts)
def test_bounds_and_symmetry(a, b):
    s = L.weighted_ratio(a, b)
    assert 0 <= s <= 1 and abs(s - L.weighted_ratio(b, a)) < 1e-12
    assert L.weighted_ratio(a, a) == (1 if a else 0)


def test_known_ratios():
    near = lambda x, y: abs(x - y) < 0.005
    assert near(L.ratio("this is a test", "this is a test!"), 0.9655) and L.part_ratio("this is a test", "this is a test!") == 1
    assert near(L.ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear"), 0.9091) and L.words_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 1
    assert L.words_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 1
    assert near(L.weighted_ratio("year end fiscal", "fiscal year end"), 0.95) and near(L.weighted_ratio("date", "the date of the report"), 0.9)
    assert near(L.weighted_ratio("ab", "ab" + "x" * 30), 0.6) and L.weighted_ratio(None, "a") == L.weighted_ratio("", "") == 0


def test_proposals(spark):
    names = [("fye", "fiscal year end", 1), ("client", "client name", 2), ("client", "name of client", 3), ("prep", "prepared by", 4)]
    labels = ["Fiscal Year-End", "end of fiscal year", "Client  name:", "clients", "zzz", "Prepared by staff", None, "", " client name "]
    rejected = [("prepared by STAFF", "prep")]
    got = aliases.proposals(spark.createDataFrame([(x,) for x in labels + labels], "label string"), spark.createDataFrame(names, "canonical string, variant string, pos int"), spark.createDataFrame(rejected, "label string, canonical string"))
    got = {r["label"]: r.asDict() for r in got.collect()}
    want = {}
    for x in labels:
        scores = [(-L.weighted_ratio((x or "").strip().lower(), v), v, c) for c, v, _ in names]
        if -min(scores)[0] >= 0.75:
            want[x] = min(scores)
    assert {k: (r["variant"], r["canonical"], r["score"]) for k, r in got.items()} == {k: (v, c, round(-s, 4)) for k, (s, v, c) in want.items()}
    assert got["Prepared by staff"]["bucket"] == "manual_review" and got[" client name "]["bucket"] == "high_confidence"
