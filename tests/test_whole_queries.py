"""Registered queries against brute force over every row of small tables."""

import hashlib
import random

import numpy as np

from gleanery.plans import catalogue


def test_claim_status_of_every_order(spark, tmp_path):
    rows = [(o, n, o * 3 + n, o * 5 + n * n) for o in range(1, 25) for n in range(1, 6)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")

    def status(n, p, s):
        if n == 1 or p % 3 == 2 or p % 3 == 0 and s % 2 == 0:
            return "UNANCHORED"
        return "MISANCHORED" if p % 3 == 0 else "HALLUCINATED" if n % 2 == 0 else "VALID"

    want = {o: ",".join(status(n, p, s) for k, n, p, s in rows if k == o) for o in range(1, 25)}
    assert {r["l_orderkey"]: r["statuses"] for r in catalogue.QUERIES["claim_status"](spark, str(tmp_path)).collect()} == want


def test_heading_sections_of_whole_texts(spark, tmp_path):
    rows = [(i, "\n".join("" if (i + k) % 5 == 0 else f"line {i} {k}" for k in range(n))) for i, n in enumerate((1, 9, 10, 40))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    md5, want = lambda s: hashlib.md5(s.encode()).hexdigest(), {}
    for i, text in rows:
        section, found = 0, {}
        for k, x in enumerate(text.split("\n")):
            if x.strip():
                section += k % 3 == 1
                found.setdefault(section, [[], []])[k % 3 != 1].append(x)
        want |= {(i, s): (md5("".join(h)), md5("\n".join(c))) for s, (h, c) in found.items()}
    assert {(r["doc_id"], r["section"]): (r["heading"], r["content"]) for r in catalogue.QUERIES["heading_sections"](spark, str(tmp_path)).collect()} == want


def vectors(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(450)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    return rows


def nearest(rows, query, allowed, k=5):
    a = np.array(query[1])
    score = lambda r: round(float(a @ np.array(r[1]) / np.linalg.norm(a) / np.linalg.norm(r[1])), 6)
    return [r[0] for r in sorted((r for r in rows if allowed(r)), key=lambda r: (-score(r), r[0]))[:k]]


def test_cosine_topk_of_every_hundredth_row(spark, tmp_path):
    rows = vectors(spark, tmp_path)
    want = {(q[0], n + 1): v for q in rows[::100] for n, v in enumerate(nearest(rows, q, lambda r: r[2] == q[2]))}
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in catalogue.QUERIES["cosine_topk"](spark, str(tmp_path)).collect()} == want


def test_vector_search_with_fallback_of_every_hundredth_row(spark, tmp_path):
    rows, want = vectors(spark, tmp_path), {}
    for q in rows[::100]:
        hits = nearest(rows, q, lambda r: q[0] % 3 and r[2] == q[2] and (r[0] % 4 != 1 or r[0] % 8 == q[0] % 8))
        want |= {(q[0], n + 1): (v, "filtered" if hits else "fallback") for n, v in enumerate(hits or nearest(rows, q, lambda r: True))}
    out = catalogue.QUERIES["vector_search_with_fallback"](spark, str(tmp_path)).collect()
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["strategy"]) for r in out} == want


def test_nearest_takes_any_number_of_queries(spark):
    from gleanery.operators import retrieval

    rng = random.Random(7)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)], "item_id long, vec array<double>")
    got = [sorted(map(tuple, retrieval.nearest(df.withColumnRenamed("item_id", "query_id"), df, 3, most_queries=n).collect())) for n in (7, 30)]
    assert got[0] == got[1] and len(got[0]) == 90


def test_chunk_windows_against_its_sql(spark, tmp_path):
    import duckdb

    long = " ".join(f"w{i}" for i in range(1000))
    texts = ["4703443633947811 Achverber auf der", f"Section 3.1 Bank steps\n{long}", "| a  b |", "| a | b |\n| 1 | 2 |\nend", "\x02a \x01 b", "a\x0bb c", "\x0b", "p\fq\n" * 30, "x\r\ny\u2003z\x85", long, " ", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(db.execute(catalogue.ORACLES["chunk_windows"]).fetchall())
    assert sorted(map(tuple, catalogue.QUERIES["chunk_windows"](spark, str(tmp_path)).collect())) == want and len(want) == 14
