"""Numbers of working papers: amounts, row kinds, thresholds, materiality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Federal expenditures from which a program is major, and the share of all awards that raises it.
MAJOR_PROGRAM, TYPE_A_SHARE = 750_000, 0.03
SCHEDULE_MINIMUM, LOW_RISK_AWARDS, LOW_RISK_AUDITS = 25_000, 50_000_000, 2
CURRENCY_REPORT, SUSPICIOUS = 10_000, 5_000


def amount(c: Column) -> Column:
    """`$1,234.50`, `(45,000)` and `$750K` as numbers; null for other texts."""
    plain = F.upper(F.regexp_replace(c, r"[\s$,]", ""))
    negative = plain.rlike(r"^\(.*\)$")
    body = F.regexp_replace(plain, "[()]", "")
    factor = F.when(body.endswith("K"), 1e3).when(body.endswith("M"), 1e6).when(body.endswith("B"), 1e9).otherwise(1.0)
    value = F.regexp_replace(body, "[KMB]$", "").try_cast("double") * factor
    return F.when(negative, -value).otherwise(value)


def header_name(c: Column) -> Column:
    """Lower case, words joined by underscores, anything else gone."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s_]", ""), r"[\s_]+", "_"), F.lit("_"))


def row_kind(label: Column, value: Column, subtotal: Column) -> Column:
    low = F.lower(F.trim(label))
    return F.when(subtotal, "subtotal").when(low.startswith("balance per bank"), "opening").when(low.startswith("balance per book"), "closing").when(value > 0, "addition").when(value < 0, "deduction")


def type_a_threshold(total_awards: Column) -> Column:
    return F.greatest(F.lit(float(MAJOR_PROGRAM)), total_awards * TYPE_A_SHARE)


def low_risk(clean_audits: Column, awards: Column) -> Column:
    return (clean_audits >= LOW_RISK_AUDITS) & (awards <= LOW_RISK_AWARDS)


def reportable(value: Column) -> Column:
    return F.when(value > CURRENCY_REPORT, "ctr").when(value >= SUSPICIOUS, "sar")


def materiality(base: Column, planning: float, performance: float, trivial: float) -> dict[str, Column]:
    """Planning, performance and trivial amounts from a base; the shares are the firm's and have no defaults."""
    plan = base * planning
    return {"planning": plan, "performance": plan * performance, "trivial": plan * trivial}


def anomaly(deviation: Column, material: Column) -> Column:
    """How far a deviation is to materiality, 0 to 1; null without a deviation or an amount."""
    return F.when(material > 0, F.least(F.greatest(F.abs(deviation) / material, F.lit(0.0)), F.lit(1.0)))


def row_chunks(rows: DataFrame, key: str = "sheet", size: int = 2000) -> DataFrame:
    """(key, chunk, text, n): consecutive rows(key, row, label, amount, kind) gathered while their estimated tokens fit; no row is cut; subtotals are indented."""
    from pyspark.sql import Window

    from gleanery.functions.text import token_estimate

    line = F.concat(F.when(F.col("kind") == "subtotal", "  ").otherwise(""), "label", F.lit(": "), F.col("amount").cast("string"))
    run = Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("line", line).withColumn("chunk", F.floor((F.sum(token_estimate(F.col("line"))).over(run) - 1) / size))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n")
    return out.groupBy(key, "chunk").agg(text.alias("text"), F.count("*").alias("n"))
