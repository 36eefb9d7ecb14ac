"""Quality classifier without labels: overlapping heuristic labellers vote on every document, expectation-maximisation
over the counts of vote patterns estimates how accurate each is, and the posterior labels train a hashed linear scorer.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, prepare, table, tidy
from gleanery.llm.rules import repeat_words, word_ids

GOOD, BAD, NONE = 1, 0, 2
#: Documents that the scorer is trained on, half from either side of the posterior as far as there are so many; the sum of their words is bounded by TRAIN_WORDS each.
TRAIN_ROWS = 3000
TRAIN_WORDS = 3000
DIMENSIONS = 1 << 16
_SHAPE = bytes.maketrans(bytes(range(256)), bytes(88 if 65 <= c <= 90 else 120 if 97 <= c <= 122 or c > 127 else 57 if 48 <= c <= 57 else c for c in range(256)))
#: Shapes of plain words: letters and digits, perhaps in quotes or brackets, with one mark at the end.
_PLAIN = re.compile(rb"[\"'(\[]?[Xx9'-]+[\"')\]]?[.,;:?!]?")
_RUNS = [(re.compile(c + b"{2,}"), c) for c in (b"x", b"X", b"9")]
_SPACES = " \t\n\x0b\x0c\r"


@dataclass
class Text:
    """What labellers see of a text."""

    n: int
    plain: int
    distinct: int
    repeated: int
    symbols: int
    upper: int
    exclamations: int
    stops: int
    lines: int
    dup_lines: int
    chars: int


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NONE


#: A vote says good where the labeller finds nothing against a text, and nothing where the text is too short to tell.
LABELLERS: dict[str, Callable[[Text], int]] = {
    "symbols": lambda x: _vote(10 * x.symbols > 3 * x.n, 50 * x.symbols < x.n),
    "plain_words": lambda x: _vote(3 * x.plain < 2 * x.n, 5 * x.plain > 4 * x.n),
    "capitals": lambda x: _vote(2 * x.upper > x.n and x.n >= 5, 5 * x.upper < x.n),
    "exclamations": lambda x: _vote(2 * x.exclamations > x.n, 10 * x.exclamations < x.n),
    "repeats": lambda x: NONE if x.n < 50 else _vote(2 * x.repeated > x.n, 5 * x.repeated < 2 * x.n),
    "vocabulary": lambda x: NONE if x.n < 50 else _vote(10 * x.distinct < x.n, 6 * x.distinct > x.n),
    "sentences": lambda x: NONE if x.n < 50 else _vote(200 * x.stops < x.n or 2 * x.stops > x.n, 100 * x.stops > x.n and 4 * x.stops < x.n),
    "lines": lambda x: NONE if x.lines < 5 else _vote(2 * x.dup_lines > x.lines, 5 * x.dup_lines < x.lines),
}

class _Shapes(dict):
    """(feature, whether it is a plain word) of each word shape seen so far."""

    def __missing__(self, shape: bytes) -> tuple[int, bool]:
        found = crc32(b"s" + shape[:64]) % DIMENSIONS, _PLAIN.fullmatch(shape) is not None
        if len(self) < 200_000:
            self[shape] = found
        return found


_shapes = _Shapes()


def shapes_of(words: list[bytes]) -> list[bytes]:
    """X, x and 9 for runs of capitals, other letters and digits; other characters as they are."""
    joined = b" ".join(words).translate(_SHAPE)
    for run, one in _RUNS:
        joined = run.sub(one, joined)
    return joined.split(b" ")


def seen(text: str) -> tuple[Text, np.ndarray, np.ndarray]:
    """The measurements of a text, the shape features of its distinct words, and how often each word occurs."""
    ids, words, upper = word_ids(text)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    stops = sum(map(text.count, (". ", ".\n", "! ", "? "))) + text.endswith((".", "!", "?"))
    chars = len(text) - sum(map(text.count, _SPACES))
    times = np.bincount(ids, minlength=len(words))
    shapes = np.array(list(map(_shapes.__getitem__, shapes_of(list(words)))) if words else [], np.int64).reshape(-1, 2)
    found = Text(len(ids), int(times @ shapes[:, 1]), len(words), repeat_words(ids, len(words)), sum(map(text.count, "#*$%&|<>")), upper, text.count("!"), stops, len(lines), len(lines) - len(set(lines)), chars)
    return found, shapes[:, 0], times


def pattern(found: Text) -> int:
    """The votes as base-3 digits."""
    return sum(vote(found) * 3**i for i, vote in enumerate(LABELLERS.values()))


def features(found: Text, shapes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features, each once: the shares of word shapes, and the tenths of the measurements. Shapes are few, so this is small beside the text."""
    n = max(found.n, 1)
    tenths = [min(10, 10 * v // n) for v in (found.plain, found.distinct, found.repeated, found.symbols, found.upper, found.exclamations, found.stops)] + [10 * found.dup_lines // max(found.lines, 1)]
    more = [crc32(b"m%d=%d" % (i, v)) % DIMENSIONS for i, v in enumerate(tenths)]
    at, where = np.unique(np.concatenate([shapes, np.array(more, np.int64)]), return_inverse=True)
    return at, np.bincount(where, np.concatenate([times / n, np.full(len(more), 0.5)]), len(at)).astype(np.float32)


def fit_votes(counts: dict[int, int], rounds: int = 60) -> tuple[float, np.ndarray, dict[int, float]]:
    """(share of good documents, accuracy of each labeller on bad and on good ones, posterior by pattern).

    counts has all documents; there are at most 3 ** labellers patterns. A labeller that abstains tells nothing. Bad
    documents differ in kind, and no labeller sees all kinds: so beside the good documents there is one kind of bad
    ones for each labeller, to which that labeller objects in most cases and any other as often as the data say. The
    priors weigh as much as a hundredth of the documents, which keeps good documents good.
    """
    m = len(LABELLERS)
    keys = np.array(sorted(counts), np.int64)
    n = np.array([counts[int(k)] for k in keys], float)
    votes = keys[:, None] // 3 ** np.arange(m) % 3
    voted, objects = votes != NONE, votes == BAD
    weight = max(1.0, n.sum() / 100) * np.array([1.0, *[1 / m] * m])
    share_prior = np.array([0.8, *[0.2 / m] * m])
    prior = np.vstack([np.full(m, 0.02), 0.25 + 0.6 * np.eye(m)])  # how often each labeller objects to the good, and to each kind
    least = np.vstack([np.zeros(m), 0.5 * np.eye(m)])
    share, rate, kinds = share_prior.copy(), prior.copy(), np.zeros((len(keys), m + 1))
    for _ in range(rounds):
        odds = np.log(share) + (objects & voted) @ np.log(rate).T + (~objects & voted) @ np.log(1 - rate).T
        kinds = np.exp(odds - odds.max(1, keepdims=True)) if len(keys) else kinds
        kinds /= np.maximum(kinds.sum(1, keepdims=True), 1e-300)
        mass = n[:, None] * kinds
        share = (mass.sum(0) + share_prior * weight[0]) / (n.sum() + weight[0])
        rate = (mass.T @ (objects & voted) + prior * weight[:, None]) / (mass.T @ voted + weight[:, None])
        rate = np.clip(np.maximum(rate, least), 0.001, 0.999)
        rate[0] = np.minimum(rate[0], 0.3)
    accuracy = np.vstack([share[1:] @ rate[1:] / share[1:].sum(), 1 - rate[0]])
    return float(share[0]), accuracy, {int(k): float(p) for k, p in zip(keys, kinds[:, 0])}


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels; the weights and the constant."""
    w, c = np.zeros(DIMENSIONS), 0.0
    if not rows:
        return w.astype(np.float32), c
    at = np.concatenate([np.full(len(i), k) for k, (i, _, _) in enumerate(rows)])
    idx, val = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    y = np.array([r[2] for r in rows])
    sides = np.where(y >= 0.5, 0.5 / max((y >= 0.5).sum(), 1), 0.5 / max((y < 0.5).sum(), 1))
    sides *= 1 / sides.sum()
    past, past_c = np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, val * w[idx], len(y)) + c, -30, 30)))
        err = (p - y) * sides
        g, g_c = np.bincount(idx, val * err[at], DIMENSIONS) + 1e-5 * w, err.sum()
        past, past_c = past + g * g, past_c + g_c * g_c
        w, c = w - 0.5 * g / np.sqrt(past), c - 0.5 * g_c / np.sqrt(past_c)
    return w.astype(np.float32), float(c)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, votes, n_words, i, v) of every row: a hash of id and text, the votes, and the features, all from one look at the text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [seen(t or "") for t in b.column(2).to_pylist()]
            cols = [features(*x) for x in found]
            yield pa.record_batch([b.column(0), b.column(1), pa.array([pattern(x[0]) for x in found], pa.int64()), pa.array([x[0].n for x in found], pa.int64()), pa.array([c[0] for c in cols], pa.list_(pa.int32())), pa.array([c[1] for c in cols], pa.list_(pa.float32()))], ["doc_id", "h", "votes", "n_words", "i", "v"])

    prepare(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"))
    return own.mapInArrow(tidy(run), f"doc_id {kind}, h long, votes long, n_words long, i array<int>, v array<float>")


@dataclass
class Model:
    share: float
    accuracy: np.ndarray
    posterior: dict[int, float]
    weights: np.ndarray
    constant: float

    def of(self, n_words: int, i: np.ndarray, v: np.ndarray) -> float:
        """The chance that a text of these features is good; 0 without a word."""
        return float(1 / (1 + np.exp(-np.clip(self.weights[i] @ v + self.constant, -30, 30)))) if n_words else 0.0

    def score(self, text: str | None) -> float:
        found, shapes, times = seen(text or "")
        return self.of(found.n, *features(found, shapes, times))


def fit_ledger(rows: DataFrame, train_rows: int = TRAIN_ROWS, train_words: int = TRAIN_WORDS) -> Model:
    """The vote model over a whole written ledger(), and the scorer from at most train_rows of its rows: half from either side of the posterior as far as it has so many, those of at most train_words words with the smallest hash of id and text; rows equal in both teach once."""
    short = F.col("n_words") <= train_words
    sums = rows.where("n_words > 0").groupBy("votes").agg(F.count("*").alias("n"), F.count_if(short).alias("short")).collect()  # at most 3 ** labellers
    share, accuracy, posterior = fit_votes({r["votes"]: r["n"] for r in sums})
    sure = rows.sparkSession.createDataFrame(sorted(posterior.items()), "votes long, posterior double")
    pool = rows.where((F.col("n_words") > 0) & short).join(F.broadcast(sure), "votes")
    half, learned = train_rows // 2, []
    for side, there in (("posterior < 0.5", [r["short"] for r in sums if posterior[r["votes"]] < 0.5]), ("posterior >= 0.5", [r["short"] for r in sums if posterior[r["votes"]] >= 0.5])):
        mine = pool.where(side)
        for times in (20, 400, None):  # rows that are equal may take up what a bound on the hash lets through
            few = mine if times is None or times * half >= sum(there) else mine.where(F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)) < int(times * half / sum(there) * (1 << 30)))
            found = few.groupBy("h").agg(F.first(F.struct("i", "v", "posterior")).alias("x")).orderBy("h").limit(half).select("x.*").collect()
            if len(found) == half or times is None or times * half >= sum(there):
                break
        learned += [(np.array(r["i"], np.int64), np.array(r["v"], float), r["posterior"]) for r in found]
    learned.sort(key=lambda r: (r[2], len(r[0]), r[0].tolist(), r[1].tolist()))
    weights, constant = fit_scorer(learned)
    return Model(share, accuracy, posterior, weights, constant + float(np.log(share / (1 - share))))  # it was trained on either side alike


def fit(docs: DataFrame, **how) -> Model:
    """fit_ledger() over docs(doc_id, text)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(ledger(docs), "ledger")
    model = fit_ledger(rows, **how)
    scratch.drop(rows)
    return model


def classify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, kept) of every row. A text is looked at once; votes and features are kept for the rest. A text without a word (null or empty) scores 0 and isn't kept; ids may be null or repeated; an empty table gives an empty result; other columns are ignored."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(ledger(docs, id_col, text_col), "ledger")
    model = model or fit_ledger(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [model.of(n, np.asarray(i.values), np.asarray(v.values)) for n, i, v in zip(b.column(1).to_pylist(), b.column(2), b.column(3))]
            yield pa.record_batch([b.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    prepare(docs.sparkSession)
    return rows.select("doc_id", "n_words", "i", "v").mapInArrow(tidy(run), f"doc_id {kind}, score double").withColumn("kept", F.col("score") >= threshold)


def accepted(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the classifier keeps, all columns as they are; nulls, repeated rows and empty tables as in classify(). The texts are streamed twice and never shuffled."""
    model = fit(docs.select("doc_id", "text"))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in texts.to_pylist()], pa.float64())

    return docs.where(score(F.col("text")) >= threshold)


def op8_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
