from pyspark.sql import functions as F

from gleanery.operators import aliases, authority, facts, forms, mining, observe, pairs, retrieval, review


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols or df.columns) for r in df.collect())


def test_last_alias_holds(spark):
    names = spark.createDataFrame([("a", "X ", 1), ("b", "x", 2)], "canonical string, variant string, pos int")
    labels = spark.createDataFrame([(" x",), ("y",)], "label string")
    assert rows(aliases.resolved(labels, names), "label", "field") == [(" x", "b"), ("y", "y")]


def test_merge_rules(spark):
    assert not aliases.merge_allowed(0.9, 0.8)
    assert aliases.merge_allowed(0.7, 0.8) and aliases.merge_allowed(0.9, 0.86) and aliases.merge_allowed(0.9, 0.1, override=True)


def test_merged_aliases_and_rollback(spark):
    have = spark.createDataFrame([("a", "x", 1)], "canonical string, variant string, pos int")
    gate = spark.createDataFrame([("a", "X", 1, "pass"), ("a", "new", 2, "pass"), ("b", "bad", 3, "blocked_exact")], "canonical string, label string, pos int, gate string")
    assert rows(aliases.merged(have, gate, gate), "canonical", "variant") == [("a", "new"), ("a", "x")]
    history = spark.createDataFrame([("1.9", "a", "x", 1), ("1.10", "a", "y", 1)], "version string, canonical string, variant string, pos int")
    assert rows(aliases.rolled_back(history, "1.9")) == [("1.11", "a", "x", 1)]


def test_facts(spark):
    f = spark.createDataFrame([("a", "1", 0.5, ["s1"], "m", 1), ("a", "1", 0.9, ["s2"], "n", 2), ("b", "1", 0.5, ["s"], "m", 1), ("b", "2", 0.5, ["t"], "m", 2), ("c", None, 0.1, None, "m", 1)], "field string, value string, confidence double, sources array<string>, method string, pos int")
    out = {r["field"]: r for r in facts.merged(f).collect()}
    assert out["a"]["sources"] == ["s1", "s2"] and out["a"]["confidence"] == 0.9 and out["a"]["method"] == "multi_extractor_agreement"
    assert out["b"]["value"] == "1" and out["b"]["confidence"] == 0.4 and out["b"]["sources"] == ["s"]
    assert out["c"]["value"] is None and out["c"]["outcome"] == "single"


def test_graph_invariants(spark):
    fields = spark.createDataFrame([("x", "High", "c"), ("y", "Odd", "")], "field string, severity string, consequence string")
    classes = spark.createDataFrame([("x", "q", "", "deficiency_eligible", 1), ("x", "r", "", "fixed_administrative", 2), ("y", "s", "", "informational_only", 1)], "field string, slug string, client_type string, class string, pos int")
    standards = spark.createDataFrame([("x", "gagas", "Government Auditing Standards §3.6", 1)], "field string, family string, citation string, pos int")
    graph = authority.compiled(fields, authority.authority(classes), standards)
    assert graph.count() == 2 * 16
    assert not graph.where("field = 'x' AND allowed").count()  # the more restrictive class holds
    assert rows(graph.where("field = 'x'").select("is_gagas", F.size("citations").alias("n")).distinct()) == [(False, 0), (True, 1)]
    assert rows(authority.graph_violations(graph).select("field", "problem").distinct()) == [("y", "severity")]


def test_retrieval(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "item_id int, vec array<float>")
    q = spark.createDataFrame([(7, [2.0, 0.1])], "query_id int, vec array<float>")
    assert rows(retrieval.nearest(q, items, 5), "item_id", "rank") == [(1, 1), (2, 2)]


def test_chunks_keep_tables(spark):
    text = "Section 3.1 Bank reconciliation steps\n" + " ".join(f"w{i}" for i in range(900)) + "\n| a | b |\n| 1 | 2 |\nend"
    out = retrieval.chunks(spark.createDataFrame([("d", text)], "name string, text string"), "name").orderBy("chunk_no").collect()
    assert [r["is_table"] for r in out].count(True) == 1
    assert out[0]["workflow"] == "bank_reconciliation" and out[0]["prefix"].startswith("SOP §3.1")
    assert len({r["chunk_id"] for r in out}) == len(out)


def test_redaction(spark):
    d = spark.createDataFrame([(1, "a\nThe Fiscal Year End is x\nfiscal year end y\nb\nfiscal year end")], "doc_id int, text string")
    out = pairs.redacted(d, "fiscal_year_end", ["fiscal year end", "fye"]).first()
    assert out["text"] == "a\n[NOT DOCUMENTED: fiscal_year_end]\nb\n[NOT DOCUMENTED: fiscal_year_end]" and out["removed"] == 3


def test_deficiency_sets(spark):
    r = spark.createDataFrame([("f", "NPO", ["a", "b", "c"]), ("g", "NPO", ["c"])], "file_name string, client_type string, fields_present array<string>")
    first = rows(pairs.deficiency_sets(r, {"a": 0.7, "b": 0.7}, {"c": 0.3}))
    assert first == rows(pairs.deficiency_sets(r, {"a": 0.7, "b": 0.7}, {"c": 0.3}))
    assert first and all(n == "f" and 1 <= len(s) <= 3 and set(s) & {"a", "b"} and s == sorted(s) for n, _, _, s in first)
    assert len({tuple(s) for *_, s in first}) == len(first)


def test_queue(spark):
    e = spark.createDataFrame([("h", 1, "enqueue", None), ("h", 2, "send_for_correction", " "), ("h", 3, "reject", None), ("h", 4, "approve", None), ("i", 5, "approve", None), ("j", 6, "enqueue", None)], "pair_hash string, pos int, action string, hint string")
    e = e.withColumn("at", F.col("pos")).withColumn("reviewer", F.lit("r")).withColumn("notes", F.lit(""))
    assert rows(review.states(e), "pair_hash", "status", "refused") == [("h", "rejected", 2), ("j", "pending", 0)]


def test_balance_limit_is_strict(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 4 + [(None,)] * 3, "kind string")
    assert rows(observe.balance(df, "kind"), "value", "over") == [("(missing)", False), ("a", False), ("b", False)]


def test_drift_needs_two_windows(spark):
    df = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(10)], "pos int, kind string").withColumn("added_at", F.col("pos"))
    assert observe.drift_status(df, "kind", window=6).first()["status"] == "insufficient_data"
    assert observe.drift_status(df, "kind", window=5).first()["status"] == "drifting"


def test_checkbox_answers(spark):
    t = spark.createDataFrame([(1, 0, ["Question", "Yes", "No"], [["Is it recurring? (see x)", "☒", ""], ["Other", "", ""], ["Independence:", "", "x"]])], "doc_id int, table int, headers array<string>, rows array<array<string>>")
    names = spark.createDataFrame([("recurring", "is it recurring", 1), ("independence", "independence", 2)], "canonical string, variant string, pos int")
    assert rows(mining.checkbox_answers(t, names)) == [(1, "independence", "No"), (1, "recurring", "Yes")]


def test_decision_compares_exactly(spark):
    r = spark.createDataFrame([(1, "q4", "Yes — seen"), (2, "q9", "Yes"), (2, "q4", "No")], "engagement_id int, field_id string, value string")
    assert rows(forms.decision(r), "engagement_id", "blocker") == [(1, None), (2, "q9")]
