from gleanery.plans.review_pairs import Dimensions, review_pairs


def dimensions(spark):
    tiers = [("client_name", 1, False, "SOP §1"), ("fiscal_year_end", 1, False, "SOP §2"), ("preparer", 2, False, "x")]
    return Dimensions(
        spark.createDataFrame([("client_name", "client name", 1), ("client_name", "organization", 2), ("fiscal_year_end", "fiscal year end", 3), ("preparer", "prepared by", 4)], "canonical string, variant string, pos int"),
        spark.createDataFrame(tiers, "field string, tier int, exempt boolean, reason string"),
        spark.createDataFrame([(f, "High") for f, *_ in tiers], "field string, severity string"),
        spark.createDataFrame([("fiscal_year_end", "q2", "deficiency_eligible", "medium", "Year end", 1)], "field string, slug string, class string, severity string, label string, pos int"),
    )


def test_pairs(spark):
    full = "Client Name: Acme\nFiscal Year End: 6/30/2024\nPrepared by: me\nOther text with SSN 123-45-6789"
    docs = spark.createDataFrame([(1, "NPO-CX a.docx", full), (2, "b.docx", "nothing here")], "doc_id int, file_name string, text string")
    out = [r.asDict(recursive=True) for r in review_pairs(docs, dimensions(spark), ("NPO", "Government")).collect()]
    by = {}
    for r in out:
        by.setdefault((r["doc_id"], r["client_type"], r["pair_type"]), []).append(r)
    clean = by[1, "NPO", "clean"][0]
    assert clean["fields_missing"] == [] and clean["extraction_confidence"] == round(0.6 * 0.7 + 0.6 * 0.3, 4) and clean["gate"] == "ok"
    assert "[SSN]" in clean["messages"][1]["content"] and "No deficiencies" in clean["messages"][2]["content"]
    assert {r["gate"] for r in by[2, "NPO", "low_confidence"]} == {"extraction_gate"} and (2, "NPO", "clean") not in by
    assert 1 <= len(by[1, "NPO", "deficient"]) <= 2 and by[1, "Government", "clean"][0]["is_gagas"]
    for r in by[1, "NPO", "deficient"]:
        prompt, answer = r["messages"][1]["content"], r["messages"][2]["content"]
        assert set(r["fields_missing"]) & {"client_name", "fiscal_year_end"} and r["gate"] == "ok"
        for f, shown in (("client_name", "Acme"), ("fiscal_year_end", "2024"), ("preparer", "Prepared by: me")):
            assert (shown in prompt) != (f in r["fields_missing"]) and (f"[NOT DOCUMENTED: {f}]" in prompt) == (f in r["fields_missing"])
        assert f"{len(r['fields_missing'])} missing items" in answer
    assert len({r["pair_hash"] for r in out}) == len(out)
