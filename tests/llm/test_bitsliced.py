import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import bitsliced

MOST = (1 << 63) - 1


@pytest.mark.parametrize(("n", "d", "m"), [(1, 1, 1), (64, 1, 3), (130, 64, 1), (300, 5, 20), (500, 7, 1 << 23), (200, 9, 0), (100, 3, 1 << 40)])
def test_block_against_products(n, d, m):
    rng = np.random.default_rng(n)
    v, ids = rng.integers(-m, m + 1, (n, d)), np.sort(rng.integers(0, n * 2, n))
    asks = rng.choice(n, min(n, 20), replace=False)
    best = bitsliced.Best(len(asks), 10)
    for half in (slice(0, n // 2), slice(n // 2, n)):
        if len(ids[half]):
            bitsliced.block_top(bitsliced.slices_of(v[half].astype(float)), ids[half], np.zeros(len(ids[half]), bool), v[asks].astype(float), best)
    for q, (score, _, _, found) in zip(asks, best.found):
        exact = [sum(int(a) * int(b) for a, b in zip(row, v[q])) for row in v]
        want = sorted((-s, int(i)) for s, i in zip(exact, ids))[:10]
        assert [(max(-MOST - 1, min(MOST, -s)), i) for s, i in want] == list(zip(score.tolist(), found.tolist()))


def quantised(v):
    return [int(np.floor(1024 * float(np.float32(x)))) for x in v]


def plain(rows):
    """The ten best of every row with an id divisible by 100, by whole numbers of any size."""
    good = [(i, quantised(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(good):
        if q is not None and q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for m, (i, w) in enumerate(good) if m != n)[:10]
            out += [(q, r + 1, b[3], max(-MOST - 1, min(MOST, -b[0]))) for r, b in enumerate(best)]
    return sorted(out, key=str)


ODD = [(900, None), (901, [None, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (1100, []), (905, [1e9] * 6), (906, [-3e38] * 6), (907, [3e38, 1.0]), (None, [1.0] * 6), (None, [1.0] * 6), (1000, [0.5, 0.5]), (7, [9.0] * 6), (1200, [20000.0, 1.0]), (100, [0.25] * 6), (100, [0.25] * 6), (100, [-0.5] * 9)]


def test_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(bitsliced, "QUERY_BYTES", 3 * 8 * 13)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, -1.0]) for _ in range(6)]) for i in range(900)]
    df = spark.createDataFrame(rows + ODD, "vec_id long, embedding array<float>").withColumn("q", F.lit(1)).repartition(4)
    got = [tuple(r) for r in bitsliced.top_k(df, df.where("vec_id % 100 = 0")).collect()]
    assert sorted(got, key=str) == plain(rows + ODD)
    assert any(r[2] == 905 for r in got) and any(r[2] is None for r in got)
    assert bitsliced.top_k(df.limit(0), df.limit(0)).count() == 0
    assert bitsliced.top_k(df, df.limit(0)).count() == 0


def test_sql_agrees_on_large_and_empty_vectors(spark, tmp_path):
    rows = [(i, [float(i % 7), -1.0]) for i in range(90, 210)] + [r for r in ODD if r[0] not in (906, 907)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({bitsliced.OP4_SQL})").fetchall()
    got = bitsliced.op4_bitsliced(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) == plain(rows)
