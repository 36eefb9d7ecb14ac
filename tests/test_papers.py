import random

from pyspark.sql import functions as F

from gleanery.operators import mining, pairs, retrieval, review
from gleanery.plans.intake import document
from gleanery.sources import files


def plain_continued(rows, labels):
    """The rows of one table, taken in order."""
    text = lambda r, i: (r[i] or "").strip() if len(r) > i else ""
    value = lambda x: x != "" and x.lower() not in labels and not x.endswith(":") and x.lower() not in ("true", "false")
    low = [(x or "").strip().lower() for x in rows[0]]
    if len(rows[0]) < 2 or {"yes", "no"} <= set(low):
        return rows
    out, i = [], 0
    while i < len(rows):
        more = i + 1 < len(rows)
        if more and text(rows[i], 0) and not text(rows[i], 1) and not text(rows[i + 1], 1) and value(text(rows[i + 1], 0)):
            out.append([rows[i][0], text(rows[i + 1], 0), *rows[i][2:]])
            i += 2
        else:
            out.append(rows[i])
            i += 1
    return out


def test_continued(spark):
    rng = random.Random(5)
    cell = lambda: rng.choice(["", "", " ", None, "name", "Name:", "acme", "true", "x"])
    tables = {i: [[cell() for _ in range(rng.choice([1, 2, 2, 2, 3]))] for _ in range(rng.randint(1, 9))] for i in range(60)}
    tables[60] = [["", "Yes", "No"], ["q1", "", ""], ["q2", "", ""]]
    rows = [(k, 0, i, r) for k, t in tables.items() for i, r in enumerate(t)]
    df = spark.createDataFrame(rows, "doc_id int, table int, row int, cells array<string>")
    got = {}
    for r in mining.continued(df, F.array(F.lit("name"))).orderBy("doc_id", "row").collect():
        got.setdefault(r["doc_id"], []).append(list(r["cells"]))
    assert got == {k: plain_continued(t, {"name"}) for k, t in tables.items()}
    assert mining.continued(df.limit(0), F.array(F.lit("name"))).count() == 0


def test_filled_forms(spark):
    template = document("H", "p", [["Is it?", ""], ["Is it?", ""], ["Other one here", ""]])
    rows = [("a", 2, "second", "is it", "no"), ("a", 1, "first", "Is it?", "yes & <so>"), ("a", 3, "third", "is it", "x"), ("a", 4, "none", "", "x"), ("b", 1, "o", "OTHER-one here", "9"), ("b", 2, "o2", None, "9"), (None, 1, "q", "q", "q"), ("c", 1, None, "q", "q")]
    made = files.filled_forms(spark.createDataFrame(rows, "form string, pos int, name string, question string, answer string"), template)
    got = {r["form"]: r for r in made.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["placements"] == {"first": "matched_row", "second": "matched_row", "third": "not_found", "none": "not_found"}
    assert got["b"]["placements"] == {"o": "not_found", "o2": "not_found"}
    cells = [b[3] for b in files.docx_blocks(got["a"]["content"]) if b[3]][0]
    assert cells == [["Is it?", "yes & <so>"], ["Is it?", "no"], ["Other one here", ""]]


def test_embedding_in_batches(spark):
    def embed(texts):
        if "bad" in texts:
            raise RuntimeError("down")
        return [[len(t)] for t in texts] if "short" not in texts else []

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, " "), (5, "short"), (6, "abc")], "chunk_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in retrieval.embedded(df, embed, batch=1).collect()}
    assert got == {1: ([1.0], None), 2: (None, "RuntimeError: down"), 3: (None, None), 4: (None, None), 5: (None, "ValueError: 0 vectors for 1 texts"), 6: ([3.0], None)}
    one = {r[0]: r[2] for r in retrieval.embedded(df.coalesce(1), embed, batch=9).collect()}
    assert {k for k, e in one.items() if e} == {1, 2, 5, 6}


def test_edits_and_signals(spark):
    queue = spark.createDataFrame([("a", "old"), ("b", None), ("c", "kept")], "pair_hash string, completion string")
    edits = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("none", 1, "w"), (None, 1, "w")], "pair_hash string, pos int, completion string")
    assert {r["pair_hash"]: (r["completion"], r["edited"]) for r in review.edited(queue, edits).collect()} == {"a": ("y", True), "b": ("z", True), "c": ("kept", False)}
    rows = [("a", True, "present", True), ("a", True, "present", None), ("a", True, None, None), ("a", True, "uncertain", True), ("a", None, "present", True), ("b", False, "absent", False)]
    out = pairs.validation_signals(spark.createDataFrame(rows, "pair_id string, canonical boolean, state string, evidence boolean"))
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {"a": (1, 1, 0.5, 0.5), "b": (0, 1, 0.0, 0.0)}


def test_aliases_in_several_arrays(spark, monkeypatch):
    from gleanery.operators import aliases, sizes

    names = spark.createDataFrame([(f"c{i % 7}", f"word{i}", i) for i in range(60)], "canonical string, variant string, pos int")
    texts = spark.createDataFrame([(i, f"has word{i} and WORD{i + 1}") for i in range(50)] + [(99, None), (98, "none")], "k int, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    one = rows(aliases.longest_contained(texts, names, "k")), rows(aliases.mentions(texts, names, "k"))
    monkeypatch.setattr(sizes.blocks, "__defaults__", (10, sizes.BYTES))
    assert len(sizes.listed(names, "variant", F.struct("variant"), "__a")) == 6
    assert (rows(aliases.longest_contained(texts, names, "k")), rows(aliases.mentions(texts, names, "k"))) == one and len(one[0]) == 50
