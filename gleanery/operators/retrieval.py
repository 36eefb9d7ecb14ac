"""Chunks of procedure texts and vector search over them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.keys import chunk_id
from gleanery.functions.text import SPACE, let, section_prefix, strip, token_estimate, words
from gleanery.operators.sizes import blocks, small
from gleanery.shipping import ship

# The workflow that a passage names, the first that is found.
WORKFLOWS = {
    "bank reconciliation": "bank_reconciliation",
    "trial balance": "trial_balance",
    "financial statement": "financial_statements",
    "analytical procedure": "analytical_procedure",
    "engagement acceptance": "engagement_acceptance",
    "single audit": "single_audit",
    "compliance": "compliance",
    "internal control": "internal_control",
}
# What a source of these years counts; older ones .1.
YEAR_WEIGHTS = ((2024, 2026, 1.0), (2022, 2023, 0.85), (2020, 2021, 0.7), (2018, 2019, 0.5), (2015, 2017, 0.3))
# Size of a window of tokens and its overlap with the next.
CHUNK, OVERLAP = 400, 50


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where either vector is zero or null."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def workflow(c: Column) -> Column:
    out = F.lit("")
    for word, name in reversed(WORKFLOWS.items()):
        out = F.when(F.instr(F.lower(c), word) > 0, name).otherwise(out)
    return out


def without_margins(c: Column, share: float = 0.05) -> Column:
    """Pages (parted by form feeds) of ten lines or more without their first and last lines, one in twenty of either."""
    def page(p):
        cut = lambda n: F.greatest(F.lit(1), F.floor(n * share).cast("int"))
        return let(F.split(p, "\n"), lambda x: F.when(F.size(x) < 10, p).otherwise(F.array_join(F.slice(x, cut(F.size(x)) + 1, F.size(x) - 2 * cut(F.size(x))), "\n")))

    return F.array_join(F.transform(F.split(c, "\f"), page), "\n")


def chunks(docs: DataFrame, name: str, text: str = "text", size: int = CHUNK, overlap: int = OVERLAP, plain: bool = False, space: str = SPACE) -> DataFrame:
    """(name, chunk_no, chunk_id, prefix, content, is_table, token_count, workflow): windows of `size` words, `overlap` shared with the next; tables in pipes stay whole. A plain text has no margins, tables or headings: all of it is words, parted by `space`, and no window gets a prefix. One row a document goes in and out; nothing is shuffled."""
    body = without_margins(F.col(text))
    marked = F.regexp_replace(body, r"(?m)((?:^\|.+\|[ \t]*(?:\r?\n|\z))+)", "\x01\x02$1\x01")
    pieces = F.array(F.col(text)) if plain else F.filter(F.split(marked, "\x01"), lambda x: F.trim(x) != "")
    step = size - overlap

    def windows(piece):
        starts = lambda w: F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        parts = let(words(piece, space), lambda w: F.transform(starts(w), lambda i: F.struct(F.array_join(F.slice(w, i + 1, size), " ").alias("t"), F.lit(False).alias("is_table"))))
        return parts if plain else F.when(piece.startswith("\x02"), F.array(F.struct(F.substring(piece, F.lit(2), F.length(piece)).alias("t"), F.lit(True).alias("is_table")))).otherwise(parts)

    found = docs.select(name, F.posexplode(F.flatten(F.transform(pieces, windows))).alias("chunk_no", "p"))
    prefix = F.lit("") if plain else section_prefix(F.col("p.t"))
    content = F.concat(prefix, F.col("p.t"))
    return found.select(name, "chunk_no", chunk_id(F.col(name).cast("string"), F.col("chunk_no")).alias("chunk_id"), prefix.alias("prefix"), content.alias("content"), F.col("p.is_table").alias("is_table"), token_estimate(content).alias("token_count"), workflow(F.col("p.t")).alias("workflow"))


def matches_filter(chunk_workflow: Column, ids: Column, want_workflow: Column, want_id: Column, version: Column | None = None, want_version: Column | None = None) -> Column:
    """A chunk of the workflow (and version) that is for all forms or for the wanted one."""
    out = (chunk_workflow == want_workflow) & ((F.coalesce(F.size(ids), F.lit(0)) == 0) | F.array_contains(ids, want_id))
    return out & (version == want_version) if version is not None else out


def _vector_bytes(df: DataFrame, vec: str) -> int:
    return 8 * ((df.agg(F.max(F.size(vec))).first()[0] or 0) + 8)


def nearest(queries: DataFrame, chunks_: DataFrame, k: int, on: str | None = None, query: str = "query_id", item: str = "item_id", vec: str = "vec", most_queries: int = 20_000, where: Column | None = None) -> DataFrame:
    """(query, item, score, rank): the k chunks of highest cosine for each query, in the same partition value `on` if given, and of those that `where` lets through, a condition on the other columns of both sides; ties to the smaller item. Queries are broadcast in blocks of at most most_queries and some MB, so chunks are never shuffled, however few values `on` has. Spark keeps the top k of each task before it ranks."""
    others = [c for c in queries.columns if where is not None and c not in (query, vec, on)]
    q = queries.select(F.col(query).alias("__q"), F.col(vec).alias("__qv"), norm(F.col(vec)).alias("__qn"), *([F.col(on).alias("__on")] if on else []), *others)
    items = chunks_.withColumn("__n", norm(F.col(vec)))
    match = where if where is not None else F.lit(True)
    match = match & (F.col(on) == F.col("__on")) if on else match
    w = Window.partitionBy(query).orderBy(F.desc("score"), item)
    length = F.col("__qn") * F.col("__n")
    score = F.round(F.when(length > 0, dot(F.col("__qv"), F.col(vec)) / length), 6)
    pairs = [items.join(part, match) for part in blocks(q, "__q", _vector_bytes(queries, vec), most_queries)]
    top = [p.select(F.col("__q").alias(query), item, score.alias("score")).where("score IS NOT NULL").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) for p in pairs]
    return reduce(DataFrame.unionByName, top)


def with_fallback(queries: DataFrame, filtered: DataFrame, search: Callable[[DataFrame], DataFrame], query: str = "query_id") -> DataFrame:
    """The filtered hits, and for queries without any those of search(queries without any); `strategy` says which."""
    rest = queries.join(filtered.select(query).distinct(), query, "left_anti")
    return filtered.withColumn("strategy", F.lit("filtered")).unionByName(search(rest).withColumn("strategy", F.lit("fallback")))


def healthy(chunks_: Column, text: Column, strategy: Column) -> Column:
    """Whether a search found what a prompt can be built on: a chunk or more, with text, and not by a strategy that failed."""
    return F.coalesce((chunks_ >= 1) & (strip(text) != "") & ~strategy.isin("error", "fallback_empty"), F.lit(False))


#: Texts that an embedder takes at once.
EMBED_BATCH = 32


def embedded(chunks_: DataFrame, embed: Callable[[list[str]], list[list[float]]], key: str = "chunk_id", text: str = "text", batch: int = EMBED_BATCH) -> DataFrame:
    """(key, vector, error): what embed makes of the texts, some at a time. A batch that fails leaves an error and no vector in its rows, and the others go on; texts without a word aren't sent and have neither."""
    def run(frames):
        import pandas as pd

        for pdf in frames:
            out = [(k, None, None) for k, t in zip(pdf["k"], pdf["t"]) if not (t or "").strip()]
            sent = [(k, t) for k, t in zip(pdf["k"], pdf["t"]) if (t or "").strip()]
            for i in range(0, len(sent), batch):
                part = sent[i : i + batch]
                try:
                    vectors = embed([t for _, t in part])
                    if len(vectors) != len(part):
                        raise ValueError(f"{len(vectors)} vectors for {len(part)} texts")
                    out += [(k, [float(x) for x in v], None) for (k, _), v in zip(part, vectors)]
                except Exception as e:  # whatever a service may raise
                    out += [(k, None, f"{type(e).__name__}: {e}") for k, _ in part]
            yield pd.DataFrame(out, columns=[key, "vector", "error"])

    ship(chunks_.sparkSession)
    kind = chunks_.schema[key].dataType.simpleString()
    return chunks_.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {kind}, vector array<double>, error string")


def best_by_hint(hints: DataFrame, chunks_: DataFrame, hint: str = "hint", text: str = "text", chunk: str = "chunk_no") -> DataFrame:
    """(hint, chunk, score): the chunk that holds most distinct words of a hint, the first among equals; hints without a word in any left out. Hints meet all chunks, in blocks."""
    listed = hints.select(hint, F.array_distinct(words(F.lower(hint))).alias("__w"))
    low = chunks_.withColumn("__t", F.lower(text))
    scored = [low.join(part).withColumn("score", F.size(F.filter("__w", lambda w: F.instr(F.col("__t"), w) > 0))).where("score > 0").select(hint, chunk, "score") for part in blocks(listed, hint, 200)]
    best = F.max_by(F.struct(chunk, "score"), F.struct("score", F.negative(F.col(chunk))))
    return reduce(DataFrame.unionByName, scored).groupBy(hint).agg(best.alias("b")).select(hint, f"b.{chunk}", "b.score")


def drift_weight(year: Column, sensitive: Column, timeless: Column) -> Column:
    """How much a source of a year still counts; half for sensitive topics, whole for timeless ones."""
    w = F.lit(0.1)
    for first, last, value in YEAR_WEIGHTS:
        w = F.when(year.between(first, last), value).otherwise(w)
    return F.when(timeless, 1.0).when(sensitive, F.round(w * 0.5, 2)).otherwise(w)


def known_workflow(c: Column, table: dict[str, str]) -> Column:
    """The workflow of a form's type; an unknown type is an error."""
    mapping = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, c), F.raise_error(F.concat(F.lit("unknown form type: "), c)))


def best_above(texts: DataFrame, descriptions: DataFrame, floor: float = 0.45, key: str = "text_id", name: str = "field", vec: str = "vec") -> DataFrame:
    """(key, name, score): the description nearest to each text, from a cosine of `floor` on; the first by name among equals. Descriptions meet all texts, in blocks."""
    d = descriptions.select(F.col(name).alias("__n"), F.col(vec).alias("__v"))
    scored = [texts.join(part).select(key, "__n", cosine(F.col(vec), F.col("__v")).alias("score")).where(F.col("score") >= floor) for part in blocks(d, "__n", _vector_bytes(descriptions, vec))]
    best = F.min_by(F.struct(F.col("__n").alias(name), "score"), F.struct(F.negative("score").alias("s"), "__n"))
    return reduce(DataFrame.unionByName, scored).groupBy(key).agg(best.alias("b")).select(key, f"b.{name}", F.round("b.score", 4).alias("score"))


def in_force(cited: DataFrame, regulations: DataFrame, key: str = "doc_id") -> DataFrame:
    """cited(key, fiscal_year, regulation) with `valid`: a regulation that is known and in force by the end of that year."""
    r = regulations.select("regulation", F.col("effective_from").alias("__e"))
    out = cited.join(small(r), "regulation", "left")
    return out.withColumn("valid", F.coalesce(F.col("__e") <= F.make_date("fiscal_year", F.lit(12), F.lit(31)), F.lit(False))).select(key, "fiscal_year", "regulation", "valid")


def reranked(hits: DataFrame, k: int, query: str = "query_id", item: str = "item_id", floor: float = 0.65) -> DataFrame:
    """The k hits of each query with the highest score times weight, from those of a score of `floor` on."""
    w = Window.partitionBy(query).orderBy(F.desc("weighted"), item)
    out = hits.where(F.col("score") >= floor).withColumn("weighted", F.col("score") * F.col("weight"))
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def upserted(have: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """All rows by key, of equal keys the one of the highest version, the new one among equals."""
    both = have.withColumn("__n", F.lit(0)).unionByName(new.withColumn("__n", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc(version), F.desc("__n"))
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__n")


def inserted(have: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """have, and the rows of new whose key it lacks."""
    return have.unionByName(new.dropDuplicates([key]).join(have.select(key), key, "left_anti"))


def shingle_sets(docs: DataFrame, key: str, text: str = "text", size: int = 5) -> DataFrame:
    """(key, s): the sorted distinct hashes of the `size`-word shingles of each text; empty for a shorter one."""
    grams = let(words(F.lower(F.col(text))), lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, size), " ")))))
    return docs.select(key, F.array_sort(F.array_distinct(F.coalesce(grams, F.array().cast("array<bigint>")))).alias("s"))


def shingle_classes(docs: DataFrame, key: str, text: str = "text", size: int = 5) -> DataFrame:
    """(key, class): every text with the smallest key among those of an equal set of shingles, the representative in jaccard_pairs(); null for texts of fewer words."""
    name = shingle_sets(docs, key, text, size).select(key, F.when(F.size("s") > 0, F.sha2(F.array_join(F.transform("s", lambda x: x.cast("string")), ","), 256)).alias("h"))
    least = name.where("h IS NOT NULL").groupBy("h").agg(F.min(key).alias("class"))
    return name.join(least, "h", "left").select(key, "class")


def jaccard_pairs(docs: DataFrame, key: str, text: str = "text", size: int = 5, floor: float = 0.85) -> DataFrame:
    """(a, b, similarity) of different texts whose sets of `size`-word shingles have a Jaccard similarity of `floor` or more.

    Prefix filtering: in any one order of all shingles, two such sets of n and m share one of the first
    n - ceil(floor * n) + 1, and n and m are within the factor `floor`. The order is by frequency, rare ones first, so
    that common passages seldom are in a prefix; shingles that one text has alone are never joined on. Texts of equal
    sets meet as one, that of the smallest key; shingle_classes() tells which. Candidate pairs are verified once each.
    """
    sets = shingle_sets(docs, key, text, size).where("size(s) > 0")
    sets = sets.groupBy("s").agg(F.min(key).alias(key))
    each = sets.select(key, F.size("s").alias("n"), F.explode("s").alias("g"))
    counts = each.groupBy("g").agg(F.count("*").alias("c"))
    order = Window.partitionBy(key).orderBy("c", "g")
    prefix = each.join(counts, "g").withColumn("r", F.row_number().over(order)).where((F.col("r") <= F.col("n") - F.ceil(F.col("n") * F.lit(floor)) + 1) & (F.col("c") > 1))
    l, r = prefix.select(F.col(key).alias("a"), "g", F.col("n").alias("na")), prefix.select(F.col(key).alias("b"), "g", F.col("n").alias("nb"))
    near = (F.col("a") < F.col("b")) & (F.col("na") * F.lit(floor) <= F.col("nb")) & (F.col("nb") * F.lit(floor) <= F.col("na"))
    pairs = l.join(r, "g").where(near).select("a", "b").distinct()
    pairs = pairs.join(sets.select(F.col(key).alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col(key).alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return pairs.select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("similarity")).where(F.col("similarity") >= floor)
