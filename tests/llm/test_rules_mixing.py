import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing, rules


def plain(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    return len({i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)})


@pytest.mark.parametrize("text", [None, "", "a b c a b c d", "a a a a", "a a a", "x\na b\na b\n \n \na b", "É\x0b#|<> é f 12!", "a b c " * 700 + "d " * 5])
def test_measures(text, monkeypatch):
    got = dict(zip(rules.MEASURES, rules.measure(text)))
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words)) and got["n_repeat_words"] == plain(text)
    assert got["n_lines"] == len(lines) and got["n_dup_lines"] == len(lines) - len(set(lines))


def test_policies_and_ablations(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["ok word " + " ".join("word" + chr(97 + j // 26) + chr(97 + j % 26) for j in range(60)), "# " * 60, "few", None, "a b c " * 40])], "doc_id long, text string")
    ledger = rules.ledger(df)
    kept = {r["doc_id"]: r["kept"] for r in rules.apply_policy(ledger, rules.POLICIES["v1"]).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 4: False}
    out = {r["rule"]: (r["failing"], r["failing_alone"], r["kept_without"]) for r in rules.ablations(ledger, rules.POLICIES["v1"]).collect()}
    assert out["few_words"] == (2, 2, 3) and out["symbols"][0] == 1
    masks = [(r["failed"],) for r in ledger.collect()]
    for rule, (failing, alone, without) in out.items():
        bit = rules.bits(rule)
        assert failing == sum(m & bit > 0 for m, in masks) and alone == sum(m == bit for m, in masks) and without == sum(m & ~bit == 0 for m, in masks)


def water(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), list(names)
    while open_ and left > 1e-9:
        total, more = sum(w[n] for n in open_), 0.0
        for n in list(open_):
            target[n] += left * w[n] / total
            if target[n] >= most * sizes[n]:
                more += target[n] - most * sizes[n]
                target[n] = most * sizes[n]
                open_.remove(n)
        left = more
    return target


ROWS = [(i, "word " * (i * 7 % 13 + (500 if i == 3 else 0)), ["src1", "B", "a", None, "é", "src10"][i % 6 if i % 2 else 0]) for i in range(120)] + [(None, "x y", "B"), (5, "twin twin", "a"), (5, "twin twin", "a"), (300, None, "empty"), (301, "", "empty")]


def test_mix(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    out = mixing.mix(df).collect()
    assert len(out) == len(ROWS)
    sizes, taken, targets, biggest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
        biggest[source] = max(biggest[source], len((text or "").split()))
    want = water(sizes)
    by = {(s, round(t, 6)): n for n, (s, t) in {n: (sizes[n], want[n]) for n in want}.items()}
    for r in out:
        n = by[r["source_size"], round(r["target"], 6)]
        taken[n] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for n in want:
        assert abs(taken[n] - want[n]) <= biggest[n] / 2 + 1e-6
    again = sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in mixing.mix(df.repartition(7)).collect())
    assert again == sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in out)


def test_mixed_documents_are_the_mix(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    clashing = df.withColumn("cut_step", F.lit("mine")).withColumn("epochs", F.lit(9)).withColumn("size", F.lit("x"))
    assert mixing.mixed_documents(clashing).columns == clashing.columns and {r["cut_step"] for r in mixing.mixed_documents(clashing).collect()} == {"mine"}
    counts = Counter(r["doc_id"] for r in mixing.mixed_documents(df).collect())
    want = Counter()
    for r in mixing.mix(df).collect():
        want[r["doc_id"]] += r["taken"] // r["size"] if r["size"] else 0
    zero = {i for i, t, _ in ROWS if not (t or "").split()}
    assert {k: v for k, v in counts.items() if k not in zero} == {k: v for k, v in want.items() if v and k not in zero}
    assert mixing.mixed_documents(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_heavier_documents_come_first(spark):
    df = spark.createDataFrame([(i, "w " * 10, "s") for i in range(4000)] + [(9000, "w " * 10, "t")], "doc_id long, text string, source string")
    weight = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.25)
    taken = mixing.mix(df, weight, share=0.3).where("source_size > 10").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("n"))
    n = {r["odd"]: r["n"] for r in taken.collect()}
    assert n[0] > 2 * n[1] > 0


def test_targets_equal_sql(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    df.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    sql = sorted((r[0] or -1, r[1], r[2], round(r[3], 6), r[4]) for r in con.sql(mixing.OP3_SQL).fetchall())
    mine = sorted((r["doc_id"] or -1, r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix(df).collect())
    assert sql == mine and math.isfinite(mine[0][3])


@pytest.mark.parametrize("few", [1, 50])
def test_rows_without_an_id_do_not_fall_together(spark, monkeypatch, few):
    """10,000 rows without an id, then as many that are equal: targets are met, no step of many rows is sorted, reruns agree."""
    monkeypatch.setattr(mixing, "SORTED", few)
    rows = [(None, "w " * (1 + i % 9) + f"x{i}", "s") for i in range(10_000)] + [(7, "one and the same", "t")] * 3000 + [(i, f"other {i}", "u") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix(df, share=0.4).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in out) == [500, 3000, 10_000]
    assert all(abs(r["taken"] - r["target"]) <= 5 for r in out)
    mixed = mixing.mixed_documents(df, share=0.4)
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    targets = {10_000: "s", 500: "u"}
    assert all(abs(words[targets[r["n"]]] - r["target"]) <= 5 for r in out if r["n"] in targets)
    assert mixed.count() == mixing.mixed_documents(df, share=0.4).count()


def test_no_document_is_taken_more_often_than_allowed(spark):
    rows = [(i, "" if i % 3 == 0 else "some words here", "a") for i in range(60)] + [(100 + i, "word " * 500, "b") for i in range(20)] + [(200, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = Counter(r["doc_id"] for r in mixing.mixed_documents(df).collect())
    assert max(counts.values()) == 2 and 200 not in counts and all(counts[i] == 2 for i in range(60))
