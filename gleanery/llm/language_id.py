"""Language identification in two steps: the language family first, then one-versus-one linear support vector machines
between the languages of that family. Features are hashed letter n-grams of whole words.

All scores are linear in the n-gram counts of a text, divided by their number. So a word's part in every score is
computed once and remembered, and a text costs one look-up a word.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, prepare, table, tidy

#: Training rows: at most so many a language, and so many in all. Whole texts are used.
PER_LANGUAGE = 400
TRAIN_ROWS = 8000
DIMENSIONS = 1 << 12
#: Bytes of scores of words that a worker remembers, and words at most; the fewer words the more languages there are. The words of one block of text come on top.
CACHE_BYTES = 64 << 20
CACHE_WORDS = 1_000_000
UNKNOWN = "und"
#: Families of related languages by code; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "iranian": "fa ku ps tg",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt ti",
    "austronesian": "id jv mg mi ms su tl",
    "sinitic": "yue zh",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


class _Hashes(dict):
    """The feature of each n-gram seen so far."""

    def __missing__(self, gram: str) -> int:
        found = crc32(gram.encode()) % DIMENSIONS
        if len(self) < 1 << 18:
            self[gram] = found
        return found


_hashes = _Hashes()


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def grams(letters: str) -> list[int]:
    """Hashed n-grams of one to three letters of a lower-cased run of letters with its ends marked; none for an empty one."""
    if not letters:
        return []
    w = f"<{letters}>"
    n = len(w)
    return [_hashes[w[i : i + k]] for k in (1, 2, 3) for i in range(n - k + 1)]


_BLOCK = 1 << 19
_WORDS = 2000


def words_of(text: str):
    """Blocks of whole words."""
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= _BLOCK else text.find(" ", at + _BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end].lower().split()
        at = end


def vector(text: str | None) -> np.ndarray | None:
    """The shares of the hashed n-grams; None without a letter."""
    out = np.zeros(DIMENSIONS)
    for words in words_of(text or ""):
        out += np.bincount([g for w in words for g in grams(letters_of(w))], minlength=DIMENSIONS)
    return out / out.sum() if out.any() else None


def hinge(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """A linear support vector machine for y in -1, 1, by subgradients over all rows; both sides weigh alike."""
    side = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, c = np.zeros(x.shape[1]), 0.0
    past, past_c = np.full(x.shape[1], 1e-12), 1e-12
    for _ in range(rounds):
        wrong = (y * (x @ w + c) < 1) * side * y
        g, g_c = 1e-7 * w - wrong @ x, -wrong.sum()
        past, past_c = past + g * g, past_c + g_c * g_c
        w, c = w - 0.002 * g / np.sqrt(past), c - 0.02 * g_c / np.sqrt(past_c)
    return w, float(c)


@dataclass
class Model:
    """Rows of weights: one for each family against the others, then one for each pair of languages of a family."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str, str]]
    weights: np.ndarray
    constants: np.ndarray
    index: dict = field(default_factory=dict)
    parts: np.ndarray | None = None
    used: int = 0

    def __post_init__(self):
        self.weights_by_gram = np.ascontiguousarray(self.weights.T)

    @property
    def most(self) -> int:
        """Words that are remembered."""
        return min(CACHE_WORDS, CACHE_BYTES // (8 * (len(self.constants) + 1)))

    def __getstate__(self):
        return self.__dict__ | {"index": {}, "parts": None, "used": 0}

    def learn_words(self, words: list[str]) -> None:
        """Adds words to the index; those of the same letters share a row."""
        k = len(self.constants)
        if self.parts is None or len(self.index) + 2 * len(words) > self.most:
            self.index, self.used, self.parts = {}, 1, np.zeros((1024, k + 1))
            self.index[""] = 0  # no letter
        cores = {w: letters_of(w) for w in words}
        fresh = [x for x in dict.fromkeys(cores.values()) if x not in self.index]
        if fresh:
            end = self.used + len(fresh)
            if end > len(self.parts):
                self.parts = np.concatenate([self.parts, np.zeros((max(end, min(2 * len(self.parts), self.most)) - len(self.parts), k + 1))])
            for at in range(0, len(fresh), _WORDS):  # the weights of all their n-grams at once would be large
                found = [grams(x) for x in fresh[at : at + _WORDS]]
                sizes = np.array([len(g) for g in found])
                sums = np.add.reduceat(self.weights_by_gram[[g for gs in found for g in gs]], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
                here = slice(self.used + at, self.used + at + len(found))
                self.parts[here, :k], self.parts[here, k] = sums, sizes
            self.index.update(zip(fresh, range(self.used, end)))
            self.used = end
        self.index.update((w, self.index[x]) for w, x in cores.items())

    def scores(self, text: str | None) -> np.ndarray | None:
        total = np.zeros(len(self.constants) + 1)
        step = max(1000, self.most // 2)
        for block in words_of(text or ""):
            for words in (block[at : at + step] for at in range(0, len(block), step)):
                if new := [w for w in dict.fromkeys(words) if w not in self.index]:
                    self.learn_words(new)
                    if more := [w for w in dict.fromkeys(words) if w not in self.index]:  # the cache was emptied for the new ones
                        self.learn_words(more)
                total += self.parts[[self.index[w] for w in words]].sum(0)
        return total[:-1] / total[-1] + self.constants if total[-1] else None

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, and the product of the logistic margins of its family and of its nearest rival in it."""
        s = self.scores(text) if self.families else None
        if s is None:
            return UNKNOWN, 0.0
        sure, chosen = 1.0, self.families[0]
        if len(self.families) > 1:
            own = s[: len(self.families)]
            best = int(np.argmax(own))
            chosen, sure = self.families[best], _logistic(own[best] - np.delete(own, best).max())
        languages = self.members[chosen]
        if len(languages) > 1:
            wins, margin = dict.fromkeys(languages, 0), dict.fromkeys(languages, np.inf)
            total = dict.fromkeys(languages, 0.0)
            for (f, a, b), v in zip(self.pairs, s[len(self.families) :]):
                if f == chosen:
                    wins[a if v > 0 else b] += 1
                    margin[a], margin[b] = min(margin[a], v), min(margin[b], -v)
                    total[a], total[b] = total[a] + v, total[b] - v
            lang = max(languages, key=lambda x: (wins[x], total[x], x))
            return lang, sure * _logistic(margin[lang])
        return languages[0], sure


def _logistic(v: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * v, -30, 30))))


def fit_rows(vectors: np.ndarray, langs: list[str]) -> Model:
    names = sorted(set(langs))
    families = sorted({family(x) for x in names})
    members = {f: [x for x in names if family(x) == f] for f in families}
    lang = np.array(langs, object)
    fam = np.array([family(x) for x in langs], object)
    weights, constants, pairs = [], [], []
    scale = vectors.std(0) + 1e-3 if len(vectors) else np.ones(DIMENSIONS)
    x = vectors / scale
    if len(families) > 1:
        for f in families:
            w, c = hinge(x, np.where(fam == f, 1.0, -1.0))
            weights.append(w)
            constants.append(c)
    else:
        weights, constants = [np.zeros(DIMENSIONS)] * len(families), [0.0] * len(families)
    for f in families:
        for a, b in combinations(members[f], 2):
            rows = (lang == a) | (lang == b)
            w, c = hinge(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
            weights.append(w)
            constants.append(c)
            pairs.append((f, a, b))
    return Model(families, members, pairs, np.array(weights).reshape(-1, DIMENSIONS) / scale, np.array(constants))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from text and lang of docs(doc_id, text, lang): rows with an id, a language and a letter that aren't held out; of each language those with the smallest hash of id and text, at most per_language and train_rows in all. Rows equal in both teach once."""
    hashed = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("doc_id", "text")).select("lang", "h", "text")
    scratch = Scratch(docs.sparkSession)
    pool = hashed.select("lang", "h")
    counts = scratch.keep(pool.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")), "languages")
    pool = pool.join(bounded(counts, counts.count()), "lang")  # about four times as many rows as are wanted go on, whatever the size of a language
    pool = pool.where(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)) * F.col("n") < float(4 * per_language * (1 << 30))).select("lang", "h").distinct()
    ranked = pool.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= per_language)
    chosen = scratch.keep(ranked.orderBy("r", "lang", "h").limit(train_rows).select("lang", "h"), "chosen")

    def run(batches):
        for b in batches:
            found = [(vector(t), lang) for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            found = [(v.astype("<f4").tobytes(), lang) for v, lang in found if v is not None]
            yield pa.record_batch([pa.array([v for v, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], ["v", "lang"])

    prepare(docs.sparkSession)
    texts = hashed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text")).select("text", "lang")  # chosen has at most train_rows rows
    rows = sorted((r["lang"], bytes(r["v"])) for r in texts.mapInArrow(tidy(run), "v binary, lang string").collect())
    scratch.drop(chosen, counts)
    vectors = np.array([np.frombuffer(v, "<f4") for _, v in rows], float).reshape(-1, DIMENSIONS)
    return fit_rows(vectors, [x for x, _ in rows])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from the text alone. Null texts and texts without a letter, and all texts if nothing was learned, are `und` with score 0. Ids may be null or repeated; an empty table gives an empty result; other columns are ignored."""
    kind = docs.schema[id_col].dataType.simpleString()
    state = [model]

    def run(batches):
        own = state[0]
        for b in batches:
            found = [own.predict(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
