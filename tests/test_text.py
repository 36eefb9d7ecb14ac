import pytest
from pyspark.sql import functions as F

from gleanery.functions import keys, redact
from gleanery.functions import text as T


def one(spark, f, *values):
    row = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    return row.select(f(*[F.col(c) for c in row.columns]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("☒ Accept  ☐ Decline", "true Accept false Decline"),
        (" Single Audit", "true Single Audit"),
        ("a b​c­", "a bc"),
        ("Accept (X)  Decline ( )", "Accept (X) Decline ( )\nengagement_decision: Accept"),
        ("(x) Yellow Book", "(x) Yellow Book\nincludes_gagas: true"),
        ("(x) Government Auditing Standards", "(x) Government Auditing Standards\nengagement_decision: Accept\nincludes_gagas: true"),  # `Go` counts as accepting
        ("x\n\n\n\ny", "x\n\ny"),
        ("", ""),
    ],
)
def test_normalised(spark, text, want):
    assert one(spark, T.normalised, text) == want


@pytest.mark.parametrize(("text", "want"), [("1/2/2020", "2020-01-02"), ("13/45/2020", "2020-13-45"), (" A  b ", "a b"), ("1/2/20", "1/2/20")])
def test_comparable(spark, text, want):
    assert one(spark, T.comparable, text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("12-3456789", "[EIN]"),
        ("123-45-6789", "[SSN]"),
        ("912-34-5678", "[SSN]"),
        ("by Green Valley Foundation today", "by [CLIENT_ENTITY] today"),
        ("account 123456789012 held", "account [ACCOUNT_NUM] held"),
        ("123456789012 is an account", "[ACCOUNT_NUM] is an account"),
        ("number 123456789012 held", "number 123456789012 held"),
        ("account" + "x" * 70 + " 123456789012", "account" + "x" * 70 + " 123456789012"),
        ("Completed by: MS1 |", "Completed by: [PREPARER] |"),
        ("  ", "  "),
    ],
)
def test_scrubbed(spark, text, want):
    assert one(spark, redact.scrubbed, text) == want


def test_redaction_counts(spark):
    assert one(spark, redact.redactions, "12-3456789 and 22-3456789, 123-45-6789") == {"EIN": 2, "SSN": 1}


def test_hashes(spark):
    import hashlib
    import json

    messages = [{"role": "user", "content": 'say "é"\n\t\\'}, {"role": "assistant", "content": ""}]
    df = spark.createDataFrame([([(m["role"], m["content"]) for m in messages],)], "m array<struct<role:string,content:string>>")
    want = hashlib.sha256(json.dumps(messages, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert df.select(keys.pair_hash(F.col("m")).alias("h")).first()["h"] == want
    assert one(spark, lambda c: keys.hash_mod(c, 100), "ENG-1") == int(hashlib.md5(b"ENG-1").hexdigest(), 16) % 100
    assert one(spark, lambda a, b: keys.seed(a, b), "f", "NPO") == int(hashlib.md5(b"f::NPO").hexdigest()[:8], 16)


def test_fingerprint_ignores_order_and_case(spark):
    fp = lambda a, b, m, p: keys.fingerprint(a, b, m, p)
    assert one(spark, fp, "NPO", "clean", ["B", "a"], ["x"]) == one(spark, fp, " npo", "Clean", ["A ", "b"], ["X"])
    assert one(spark, fp, "NPO", "clean", ["a"], ["x"]) != one(spark, fp, "NPO", "clean", ["a"], ["y"])


def test_label_units(spark):
    got = lambda s: one(spark, lambda c: T.label_units(c, {"org": "organization"}), s)
    assert got("Prepared By / Date") == ["prepared by", "date"]
    assert got("Org: & EP") == ["organization"]
    assert got("T0tal ✅ assets:") == ["total assets"]
