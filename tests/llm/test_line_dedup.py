import random

from gleanery.llm.line_dedup import deduplicated, deduplicated_documents

WORDS = 12


def brute(texts, min_words):
    """Line numbers that go, by trying every run against every earlier start."""
    seqs = [[(n, x, len(x.split())) for n, x in enumerate((t or "").split("\n")) if x.split()] for _, t in texts]
    starts = [(d, i) for d, s in enumerate(seqs) for i in range(len(s))]
    gone = [set() for _ in texts]
    for p, (d, i) in enumerate(starts):
        for e, j in starts[:p]:
            m = 0
            while i + m < len(seqs[d]) and j + m < len(seqs[e]) and seqs[d][i + m][1] == seqs[e][j + m][1]:
                m += 1
            if sum(x[2] for x in seqs[d][i : i + m]) >= min_words:
                gone[d] |= {x[0] for x in seqs[d][i : i + m]}
    return gone


def check(spark, rows, min_words=WORDS):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {(r["doc_id"], tuple(r["__gone"] or ())): r["text"] for r in deduplicated(df, min_words).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    for (i, text), gone in zip(order, brute(order, min_words)):
        kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        assert out[(i, tuple(sorted(gone)))] == kept


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(9)]
    rows = []
    for d in range(40):
        body = [rng.choice([*pool, f"own {d} {rng.random()}", ""]) for _ in range(rng.randint(1, 14))]
        if rows and rng.random() < 0.5:
            body[1:1] = rng.choice(rows)[1].split("\n")[: rng.randint(1, 20)]
        rows.append((d * 3, "\n".join(body)))
    check(spark, rows)


def test_edges(spark):
    long = " ".join(map(str, range(30)))
    check(spark, [(1, None), (2, ""), (3, long), (4, long + "\nshort"), (5, "short"), (None, long), (6, "\n\n" + long + "\n \n" + long)])


def test_one_line_over_and_over_within_a_document(spark):
    check(spark, [(1, "\n".join(["a b c"] * 40)), (2, "x\n" + "\n".join(["a b c"] * 7))])


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert deduplicated(empty).count() == 0
    text = " ".join(map(str, range(60)))
    rows = deduplicated(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"] == text) for r in rows) == [(1, True), (1, True), (2, False)]


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(1, "x " * 60, "a", 1, 2), (2, "x " * 60, "b", 3, 4)], "doc_id long, text string, o string, t int, gone int")
    out = deduplicated_documents(df)
    assert out.columns == df.columns and sorted((r["doc_id"], r["text"], r["o"], r["t"], r["gone"]) for r in out.collect()) == [(1, "x " * 60, "a", 1, 2), (2, "", "b", 3, 4)]
