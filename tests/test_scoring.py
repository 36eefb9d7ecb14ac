import pytest
from pyspark.sql import functions as F

from gleanery.operators import scoring


@pytest.mark.parametrize(
    ("a", "b", "c", "want"),
    [
        ("X", "X", "X", 1.0),
        ("X", "X", "Y", 0.7),
        ("X", "Y", "Z", 0.2),
        ("X", "X", None, 0.9),
        ("X", "Y", None, 0.3),
        ("X", None, None, 0.6),
        ("", None, None, 0.0),
        (None, None, None, 0.0),
        ("NPO", "npo", "  NPO  ", 1.0),
        ("[EIN]", "[EIN]", None, 0.0),
        ("X", "", None, 0.3),
        ("", "", "X", 0.7),
        ("", "", "", 0.0),
        ("3/4/2024", "2024-03-04", None, 0.9),
    ],
)
def test_slot_score(spark, a, b, c, want):
    row = spark.createDataFrame([(a, b, c)], "a string, b string, c string")
    assert row.select(scoring.slot_score(F.col("a"), F.col("b"), F.col("c")).alias("s")).first()["s"] == want


TIERS = [(f"t{i}", 1, False) for i in range(8)] + [(f"u{i}", 2, False) for i in range(9)] + [("v", 3, False)]


def aggregate(spark, scores, tiers=TIERS):
    df = spark.createDataFrame([(1, f, float(s)) for f, s in scores.items()], "doc_id long, field string, score double")
    return scoring.record_scores(df, spark.createDataFrame(tiers, "field string, tier int, exempt boolean")).first()


def test_record_floors(spark):
    nine = lambda n: {f"t{i}": 0.9 for i in range(n)}
    assert aggregate(spark, nine(8))["aggregate"] >= 0.82
    assert aggregate(spark, nine(5))["aggregate"] >= 0.65
    assert aggregate(spark, nine(3))["aggregate"] == 0.55
    assert aggregate(spark, nine(5) | {"v": 0.0})["aggregate"] == aggregate(spark, nine(5))["aggregate"]


def test_exempt_fields_count(spark):
    tiers = [(f, t, f in ("t0", "t1")) for f, t, _ in TIERS]
    out = aggregate(spark, {"t0": 0.0, "v": 1.0}, tiers)
    assert out["t1_found"] == 2 and out["aggregate"] == round(2 / 8 * 0.7, 4)


def test_completion_score_is_bounded(spark):
    out = spark.range(1).select(scoring.completion_score(F.lit(1.0), F.lit(1.0), F.lit(50), F.lit(0), F.lit(0), F.lit(0.0), F.lit(0)).alias("s")).first()["s"]
    assert out == 0.8


def test_classified_floor(spark):
    out = spark.range(1).select(scoring.classified_score(F.lit(1.0), F.lit(1), F.lit(0), F.lit(0.0), F.lit(True)).alias("s")).first()["s"]
    assert out == 0.35
