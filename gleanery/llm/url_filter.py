"""URL filter: allow and block rules first, and for the other URLs a multinomial naive Bayes over words of host and path.

Names in hosts are often run together. A unigram model of the words of all pages splits them by Viterbi: the split with
the highest product of word probabilities, unknown words paying for every letter. The pages that a rule judges teach
the Bayes model, which judges the rest.

No vocabulary is capped, and none is sent to the executors. Runs of letters are split once each: their substrings are
joined with the counts of words, so that a run comes with the words that it can be made of. Likewise the odds of tokens
are joined with the distinct runs, and only the sum of a run's odds with the pages.
"""

from __future__ import annotations

from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, prepare, table, tidy

ALLOW, BLOCK = "allow", "block"
#: (verdict, host and path): a rule fits its host and all subdomains, if the path starts with the rule's; the longest wins.
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))
#: Letters of the longest word of the unigram model.
LONGEST = 24
#: Runs of letters are searched for words by windows of so many places.
WINDOW = 1000
#: A run that makes up a greater share of all runs of all pages than 1 / HEAVY is one of fewer than HEAVY, whose odds are broadcast.
HEAVY = 10_000
#: Odds are summed as whole numbers of this size, so that their order doesn't matter.
UNIT = 1e-9
_CHUNK = r"[a-z]+|[0-9]+|[^\x00-\x7f]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n) over the visible text of all pages."""
    text = F.lower(F.regexp_replace(html_col, "<[^>]*>", " "))
    return pages.select(F.explode(F.regexp_extract_all(text, F.lit(rf"(?<![a-z])[a-z]{{2,{LONGEST}}}(?![a-z])"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


class Segmenter:
    """Splits runs of letters into words."""

    def __init__(self, counts: dict[str, int], total: int):
        total = max(total, 1)
        self.cost = {w: -log(n / total) for w, n in counts.items()}
        self.unknown = -log(1 / (10.0 * total))

    def __call__(self, name: str) -> list[str]:
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            found, at = float("inf"), 0
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                cost = self.cost.get(word)
                if cost is None:
                    cost = self.unknown + 2.5 * (end - start - 1)
                if best[start] + cost < found:
                    found, at = best[start] + cost, start
            best.append(found)
            cut.append(at)
        out, end = [], len(name)
        while end:
            out.append(name[cut[end] : end])
            end = cut[end]
        out.reverse()
        return out


def split_names(names: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(name, parts) of each of names(name), distinct runs of letters: its best split by words(word, n), of `total` words in all."""
    places = names.withColumn("from", F.explode(F.sequence(F.lit(1), F.length("name"), F.lit(WINDOW))))
    places = places.select("name", F.substring("name", F.col("from"), F.lit(WINDOW + LONGEST - 1)).alias("x"))
    starts = F.sequence(F.lit(1), F.least(F.length("x"), F.lit(WINDOW)))
    at = lambda i: F.transform(F.sequence(F.lit(2), F.lit(LONGEST)), lambda n: F.when(i + n - 1 <= F.length("x"), F.substring("x", i, n)))
    pieces = places.select("name", F.explode(F.array_compact(F.array_distinct(F.flatten(F.transform(starts, at))))).alias("word"))
    known = pieces.join(words, "word").groupBy("name").agg(F.collect_set(F.struct("word", "n")).alias("x"))
    given = names.join(known, "name", "left").select("name", F.col("x.word").alias("words"), F.col("x.n").alias("ns"))

    def run(batches):
        for b in batches:
            found = [Segmenter(dict(zip(w or (), n or ())), total)(name) for name, w, n in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.record_batch([b.column(0), pa.array(found, pa.list_(pa.string()))], ["name", "parts"])

    return given.mapInArrow(tidy(run), "name string, parts array<string>")


def odds_of(counts: DataFrame) -> tuple[DataFrame, dict]:
    """(token, odds): multinomial naive Bayes with add-one smoothing over counts(token, allow, block), in UNITs."""
    size = counts.agg(F.count("*").alias("tokens"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in (ALLOW, BLOCK)]).first().asDict()
    part = lambda v: F.log((F.col(v) + 1) / F.lit(float(size[v] + size["tokens"] + 1)))
    return counts.select("token", F.round((part(BLOCK) - part(ALLOW)) / UNIT).cast("long").alias("odds")), size


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block, tokens) of every row. p_block is the Bayes model's for all of them.

    Tokens are the words of the host after h:, those of the path after p:; numbers are one token, runs of other than
    ASCII a token each. Tokens that weren't learned tell nothing. A null url or one without :// has an empty host and
    path, no rule and no token, and so the prior's verdict. If no rule judges any page, all are allowed. Ids may be
    null or repeated, urls very long; an empty table gives an empty result; other columns are ignored.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    prepare(spark)
    words = scratch.keep(word_counts(pages, html_col), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    runs = lambda mark, text: F.transform(F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0)), lambda x: F.concat(F.lit(mark), F.when(x.rlike("^[0-9]"), "0").otherwise(x)))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("verdict", verdict)
    parsed = scratch.keep(parsed.withColumn("runs", F.concat(runs("h:", F.col("host")), runs("p:", F.lower("path")))).withColumn("row", F.monotonically_increasing_id()), "urls")
    judged = {r["verdict"]: r["count"] for r in parsed.where("verdict IS NOT NULL").groupBy("verdict").count().collect()}  # two rows
    prior = log((judged.get(BLOCK, 0) + 1) / (judged.get(ALLOW, 0) + 1))

    # the distinct runs, and how often they occur in all pages and in those that a rule judges
    seen = parsed.select("verdict", F.explode("runs").alias("run")).groupBy("run").agg(F.count("*").alias("n"), *[F.count_if(F.col("verdict") == v).alias(v) for v in (ALLOW, BLOCK)])
    seen = scratch.keep(seen.withColumn("name", F.substring("run", 3, (1 << 31) - 1)), "runs")
    names = scratch.keep(split_names(seen.where("name RLIKE '^[a-z]'").select("name").distinct(), words, total), "names")
    split = seen.join(names, "name", "left").select("run", "n", ALLOW, BLOCK, F.transform(F.coalesce("parts", F.array("name")), lambda w: F.concat(F.substring("run", 1, 2), w)).alias("tokens"))
    split = scratch.keep(split, "split")
    counts = split.where(f"{ALLOW} + {BLOCK} > 0").select(F.explode("tokens").alias("token"), ALLOW, BLOCK).groupBy("token").agg(*[F.sum(v).alias(v) for v in (ALLOW, BLOCK)])
    odds, _ = odds_of(scratch.keep(counts, "counts"))
    worth = split.select("run", F.explode("tokens").alias("token")).join(odds, "token").groupBy("run").agg(F.sum("odds").alias("odds"))
    worth = scratch.keep(split.select("run", "n", "tokens").join(worth, "run", "left").select("run", "n", "tokens", F.coalesce("odds", F.lit(0)).alias("odds")), "odds")

    # runs that very many pages share are few; the others meet their pages in a shuffle
    uses = parsed.select("row", F.posexplode("runs").alias("at", "run"))
    heavy = F.col("n") * HEAVY > seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often, others = worth.where(heavy), worth.where(~heavy)
    met = uses.join(F.broadcast(often), "run").unionAll(uses.join(F.broadcast(often.select("run")), "run", "left_anti").join(others, "run").select("run", "row", "at", "n", "tokens", "odds"))
    sums = met.groupBy("row").agg(F.sum("odds").alias("odds"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "tokens"))), lambda s: s["tokens"])).alias("tokens"))
    scored = parsed.join(sums, "row", "left")
    sure = F.least(F.greatest(F.lit(prior) + F.coalesce("odds", F.lit(0)) * UNIT, F.lit(-500.0)), F.lit(500.0))
    scored = scored.withColumn("p_block", 1 / (1 + F.exp(-sure))).withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("p_block") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))).select("page_id", "host", "path", "rule", "verdict", "p_block", "tokens")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "p_block")
