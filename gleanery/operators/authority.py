"""Per-field authority by client type, the compiled procedure table and citation order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Client types, and how restrictive each class of a field is.
CLIENT_TYPES = ("NPO", "Government", "Tribal", "For-Profit")
RANK = {"deficiency_eligible": 0, "fixed_administrative": 1, "informational_only": 2}


def _rank(c: Column) -> Column:
    out = F.lit(-1)
    for name, n in RANK.items():
        out = F.when(c == name, n).otherwise(out)
    return out


def authority(classes: DataFrame) -> DataFrame:
    """(field, client_type, class, slug): the most restrictive class of each field and client type of classes(field, slug, client_type, class, pos), the first among equals; client_type '' is the base."""
    best = F.max_by(F.struct("class", "slug"), F.struct(_rank(F.col("class")), F.negative("pos")))
    return classes.groupBy("field", "client_type").agg(best.alias("b")).select("field", "client_type", "b.class", "b.slug")


def for_client(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows(field, client_type, ...) with `class`, that of the client type or else the base one."""
    own = table.where("client_type <> ''").select("field", "client_type", F.col("class").alias("__own"))
    base = table.where("client_type = ''").select("field", F.col("class").alias("__base"))
    out = rows.join(F.broadcast(own), ["field", "client_type"], "left").join(F.broadcast(base), "field", "left")
    return out.withColumn("class", F.coalesce("__own", "__base")).drop("__own", "__base")


def citations(c: Column) -> dict[str, Column]:
    """layer, sort1, sort2, grp, depth and display of a raw citation, as columns."""
    s = F.trim(c)
    auc, et = r"(?i)^au-c\s+(\d+)(?:\.(\d+))?$", r"(?i)^et\s+([\d.]+)$"
    gas_section = r"(?i)government auditing standards\s*§\s*(\d+)[.\-](\d+)"
    gas_chapter = r"(?i)government auditing standards[^§\n]*?chapter\s+(\d+)"
    cfr = r"(?i)^2\s+cfr\s+200\.(\d+)([\w()\-]*)?$"
    got = lambda p, n: F.regexp_extract(s, p, n)
    num = lambda p, n: got(p, n).try_cast("int")
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    parts = F.filter(F.split(got(et, 1), r"\."), lambda x: x != "")
    chapter = s.rlike(gas_chapter) & ~s.contains("§")

    def by(a, e, g1, g2, f, other):
        return F.when(s.rlike(auc), a).when(s.rlike(et), e).when(s.rlike(gas_section), g1).when(chapter, g2).when(s.rlike(cfr), f).otherwise(other)

    para = got(auc, 2)
    return {
        "layer": by(F.lit(1), F.lit(2), F.lit(3), F.lit(3), F.lit(4), F.lit(9)),
        "sort": by(F.array(num(auc, 1), F.coalesce(num(auc, 2), F.lit(0))), F.transform(parts, lambda x: x.try_cast("int")), F.array(num(gas_section, 1), num(gas_section, 2)), F.array(num(gas_chapter, 1), F.lit(0)), F.array(num(cfr, 1)), F.array(F.lit(0))),
        "grp": by(F.concat(F.lit("auc_"), num(auc, 1).cast("string")), F.concat(F.lit("et_"), F.array_join(F.slice(parts, 1, 2), "_")), F.concat(F.lit("gas_"), num(gas_section, 1).cast("string")), F.concat(F.lit("gas_"), num(gas_chapter, 1).cast("string")), F.concat(F.lit("cfr_"), num(cfr, 1).cast("string")), F.lower(s)),
        "depth": by(F.when(para != "", 3).otherwise(2), F.size(parts) + 1, F.lit(2), F.lit(1), F.when(got(cfr, 2) != "", 3).otherwise(2), F.lit(1)),
        "display": by(
            F.concat(F.lit("AU-C "), num(auc, 1).cast("string"), F.when(para != "", F.concat(F.lit("."), F.when(F.length(para.cast("int").cast("string")) >= 2, para.cast("int").cast("string")).otherwise(two(para)))).otherwise("")),
            F.concat(F.lit("ET "), got(et, 1)),
            F.concat(F.lit("GAS §"), num(gas_section, 1).cast("string"), F.lit("."), F.when(F.length(num(gas_section, 2).cast("string")) >= 2, num(gas_section, 2).cast("string")).otherwise(two(num(gas_section, 2)))),
            F.concat(F.lit("GAS Chapter "), num(gas_chapter, 1).cast("string")),
            F.concat(F.lit("2 CFR 200."), num(cfr, 1).cast("string"), got(cfr, 2)),
            s,
        ),
    }


def resolved_citations(raw: DataFrame, key: str) -> DataFrame:
    """(key, pos, display) of raw(key, pos, citation): within a group only the deepest, each once without regard to case, in the order of layer and number."""
    parsed = raw.select(key, "pos", *[c.alias(n) for n, c in citations(F.col("citation")).items()])
    deepest = parsed.withColumn("__m", F.max("depth").over(Window.partitionBy(key, "grp"))).where("depth = __m")
    once = deepest.withColumn("__n", F.row_number().over(Window.partitionBy(key, F.lower("display")).orderBy("pos"))).where("__n = 1")
    order = Window.partitionBy(key).orderBy("layer", "sort", "pos")
    return once.withColumn("pos", F.row_number().over(order)).select(key, "pos", "display")


def compiled(fields: DataFrame, table: DataFrame, standards: DataFrame) -> DataFrame:
    """(field, client_type, is_gagas, has_single_audit, allowed, locked, informational, severity, citations): every field for every client type and context.

    fields(field, severity, consequence), table from authority(), standards(field, family, citation, pos) with family
    base, gagas or single_audit: the latter two count in their contexts only.
    """
    spark = fields.sparkSession
    contexts = spark.createDataFrame([(c, g, s) for c in CLIENT_TYPES for g in (False, True) for s in (False, True)], "client_type string, is_gagas boolean, has_single_audit boolean")
    cells = for_client(fields.join(F.broadcast(contexts)), table)  # dimension tables: some dozen fields by 16 contexts
    cells = cells.withColumn("cell", F.concat_ws("|", "field", "client_type", "is_gagas", "has_single_audit"))
    applies = (F.col("family") == "base") | ((F.col("family") == "gagas") & F.col("is_gagas")) | ((F.col("family") == "single_audit") & F.col("has_single_audit"))
    rank = F.when(F.col("family") == "base", 0).when(F.col("family") == "gagas", 1).otherwise(2)
    raw = cells.join(standards, "field").where(applies).select("cell", (rank * 1000 + F.col("pos")).alias("pos"), "citation")
    cited = resolved_citations(raw, "cell").groupBy("cell").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "display"))), lambda x: x["display"]).alias("citations"))
    out = cells.join(cited, "cell", "left")
    is_ = lambda name: (F.col("class") == name)
    return out.select("field", "client_type", "is_gagas", "has_single_audit", is_("deficiency_eligible").alias("allowed"), is_("fixed_administrative").alias("locked"), is_("informational_only").alias("informational"), "severity", "consequence", F.coalesce("citations", F.array().cast("array<string>")).alias("citations"))


def graph_violations(graph: DataFrame) -> DataFrame:
    """(field, client_type, problem): must be empty."""
    problem = F.when(F.col("allowed") & F.col("locked"), "eligible_and_locked").when(F.col("allowed") & F.col("informational"), "eligible_and_informational").when(~F.col("severity").isin("High", "Medium", "Low", "Informational"), "severity").when(F.trim("consequence") == "", "no_consequence")
    return graph.withColumn("problem", problem).where("problem IS NOT NULL").select("field", "client_type", "problem").distinct()


def exclusion(weight: Column, known: Column, locked: Column, locked_in_base: Column, informational: Column, allowed: Column) -> Column:
    """Why a present field can't be a deficiency, the first reason; null if it can."""
    return F.when(~known, "no_entry").when(weight == 0, "zero_weight").when(locked & locked_in_base, "fixed_admin").when(locked, "client_override").when(informational, "informational").when(~allowed, "no_entry")


def finding_text(consequence: Column, citations_: Column) -> Column:
    return F.when(F.size(citations_) > 0, F.concat(consequence, F.lit(" Applicable standards: "), F.array_join(citations_, "; "), F.lit("."))).otherwise(consequence)
