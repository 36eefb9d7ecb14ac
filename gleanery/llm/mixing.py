"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame operations only.

Each document gets the key -ln(u) / w, u uniform from its id and text and w its quality weight; smaller keys come first,
which samples without replacement in proportion to w. A source's target is met by complete epochs and then by the
documents whose running sum of words, in key order, stays nearest to what is left. Running sums are taken over steps of
the key, then over finer steps within the step where a budget ends, and so on, until that step holds few rows: neither
a source nor a step is sorted as a whole. What comes out is one edge a source, with which every row is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Each step of the key has so many finer ones, as a power of two.
STEP_BITS = 10
STEPS = 1 << STEP_BITS
#: A step is made finer until no source has more rows in it. Five levels tell any two keys apart, seven more any two tie-breaks.
SORTED = 100_000
LEVELS, TIE_LEVELS = 5, 7
_HEX = 13


def quality(text: Column, size: Column) -> Column:
    """A weight from 0.1 to 1: the fewer symbols to a word, the nearer to 1."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) / (F.lit(1.0) + F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1))))


def sampling_key(doc_id: Column, text: Column, weight: Column) -> Column:
    """The exponential key, from the id and the text, so that neither rows without an id nor rows that share one fall together; nulls count as empty."""
    own = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(own, 1, _HEX), 16, 10).cast("long") + 0.5) / float(16**_HEX)
    return -F.log(u) / weight


def sized(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """docs with __size (words) and __key."""
    out = docs.withColumn("__size", word_count("text"))
    return out.withColumn("__key", sampling_key(F.col("doc_id"), F.col("text"), quality(F.col("text"), F.col("__size")) if weight is None else weight))


def digits() -> list[Column]:
    """The steps of (__key, __tie): the whole thousandths of the key first, then ever finer ones, then those of the tie-break."""
    out = [F.floor(F.col("__key") * STEPS)]
    out += [F.pmod(F.floor(F.col("__key") * float(1 << STEP_BITS * n)), F.lit(STEPS)) for n in range(2, LEVELS + 1)]
    tie = F.col("__tie").bitwiseXOR(F.lit(-(1 << 63)))  # in the order of the signed number
    out += [F.shiftrightunsigned(tie, 64 - STEP_BITS * n).bitwiseAND(F.lit(STEPS - 1)) for n in range(1, TIE_LEVELS)]
    return [*out, tie.bitwiseAND(F.lit((1 << 64 - STEP_BITS * (TIE_LEVELS - 1)) - 1))]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources in code point order, null last, take `weights` in turn and share `share` times all words; a target stops
    at `most` times its source. With w the weights, the targets are least(most * size, w * level) for one level: in
    the order of most * size / w the full sources come first, and the first that isn't full gives the level. Every
    window here runs over one row a source.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "n")
    before, all_ = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    out = sizes.withColumn("w", w.cast("long")).withColumn("n", F.row_number().over(by_name)).withColumn("cap", F.col("source_size") * most)
    out = out.withColumn("ratio", F.col("cap") / F.col("w"))
    left = share * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    out = out.withColumn("level", left / (F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    out = out.withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "n", "level"))).over(all_)["level"])
    return out.select("source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")), F.col("cap").cast("double")).alias("target"))


def same_source(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    """rows joined with plan, one row a source."""
    plan = bounded(plan.withColumnRenamed("source", "__source"), n)
    return rows.join(plan, rows["source"].eqNullSafe(F.col("__source"))).drop("__source")


def edges(rows: DataFrame, scratch: Scratch, **how) -> tuple[DataFrame, int]:
    """For written rows(source, __size, __key, __tie), a row a source: (source, source_size, target, epochs, edge, with_edge), and their number. edge: the (__key, __tie) up to which a row is taken once more, itself included if with_edge; null: none is."""
    plan, n, held, written = None, 0, rows, []
    for level, digit in enumerate(digits()):
        steps = scratch.keep(held.groupBy("source", digit.alias("step")).agg(F.sum("__size").alias("words"), F.count("*").alias("n")), "steps")
        written.append(steps)
        if plan is None:
            plan = targets(steps.groupBy("source").agg(F.sum("words").alias("source_size")), **how)
            plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
            plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("before", F.lit(0).cast("long"))
            plan = scratch.keep(plan, "targets")
            n, now = plan.count(), plan.where("rest > 0").select("source", "rest", "before")
        run = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = same_source(steps.withColumn("end", F.sum("words").over(run)), now.select("source", "rest", "before"), n).withColumn("end", F.col("before") + F.col("end"))
        cut = ends.where("end >= rest").groupBy("source").agg(F.min(F.struct("step", (F.col("end") - F.col("words")).alias("before"), "n", "rest")).alias("c"))
        now = scratch.keep(cut.select("source", "c.*"), "cut")
        written.append(now)
        held = same_source(held, now.select("source", F.col("step").alias("__step")), n).where(digit == F.col("__step")).drop("__step")
        if level and (now.agg(F.max("n")).first()[0] or 0) > SORTED:  # so that finer levels read little
            held = scratch.keep(held, "step")
            written.append(held)
        elif level or not now.where(F.col("n") > SORTED).count():
            break
    # what is left of a source has few rows, or is of one key and tie-break: equal ones stand or fall together
    order = Window.partitionBy("source").orderBy("__key", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = held.groupBy("source", "__key", "__tie").agg(F.sum("__size").alias("words"))
    placed = same_source(groups.withColumn("end", F.sum("words").over(order)), now.select("source", "before", "rest"), n)
    place, taken = F.struct("__key", "__tie"), 2 * (F.col("before") + F.col("end")) - F.col("words") <= 2 * F.col("rest")
    edge = placed.groupBy("source").agg(F.max(F.when(taken, place)).alias("last"), F.min(place).alias("first"))
    edge = edge.select("source", F.coalesce("last", "first").alias("edge"), F.col("last").isNotNull().alias("with_edge"))
    out = plan.alias("p").join(edge.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left").select("p.source", "source_size", "target", "epochs", "edge", "with_edge")
    out = scratch.keep(out, "edges")
    scratch.drop(plan, *written)
    return out, n


def _more() -> Column:
    """Whether a row is taken once more than the epochs say."""
    place = F.struct("__key", "__tie")
    return F.coalesce((place < F.col("__edge")) | ((place == F.col("__edge")) & F.col("__with_edge")), F.lit(False)).cast("int")


def _private(plan: DataFrame) -> DataFrame:
    return plan.select("source", *[F.col(c).alias(f"__{c}") for c in ("source_size", "target", "epochs", "edge", "with_edge")])


def mix(docs: DataFrame, weight: Column | None = None, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of docs(doc_id, text, source); taken: the row's words times its repeats.

    Null texts have no words; a null source is a source; ids may be null. Repeated rows count each and are told apart by
    their place, so a run of them is cut anywhere; an empty table gives an empty result. Other columns play no part.
    """
    scratch = Scratch(docs.sparkSession)
    thin = scratch.keep(sized(docs, weight).select("doc_id", "source", "__size", "__key").withColumn("__tie", F.xxhash64(F.monotonically_increasing_id())), "sizes")
    plan, n = edges(thin, scratch, **how)
    return same_source(thin, _private(plan), n).select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * (F.col("__epochs") + _more())).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weight: Column | None = None, **how) -> DataFrame:
    """docs, each row as often as the mix takes it, at most `most` times; the texts are read once more and aren't shuffled.

    Rows that are equal in id and text are told apart by a hash of the other columns; rows that are equal in all of
    them are taken equally often, so a target is met to half their words. A document without a word is taken as often
    as its place says, and never if its source has no word at all. Nulls may be in any column; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession)
    hashed = [c for c, kind in docs.dtypes if "map<" not in kind]
    keyed = sized(docs, weight).withColumn("__tie", F.xxhash64(*hashed))
    thin = scratch.keep(keyed.select("source", "__size", "__key", "__tie"), "sizes")
    plan, n = edges(thin, scratch, **how)
    scratch.drop(thin)
    rows = same_source(keyed, _private(plan), n).withColumn("__times", (F.col("__epochs") + _more()).cast("int"))
    return rows.where("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(docs.columns)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))) AS own, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols FROM documents),
k AS (SELECT *, -ln((('0x' || substr(own, 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / greatest(0.1, 1.0::DOUBLE / (1.0::DOUBLE + symbols / greatest(size, 1))) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS n FROM s),
w AS (SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS w, 2 * source_size AS cap FROM n),
r AS (SELECT *, cap::DOUBLE / w AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER b, 0)::DOUBLE) / ((sum(w) OVER ()) - coalesce(sum(w) OVER b, 0))::DOUBLE AS level FROM r
    WINDOW b AS (ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap::DOUBLE, w * coalesce((SELECT arg_min(level, (ratio, n)) FROM l WHERE ratio > level), 1e300)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
c AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, 2 * sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) - k.size <= 2 * (e.target - e.epochs * e.source_size) AS more
    FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + more::INT))::BIGINT AS taken FROM c
"""
