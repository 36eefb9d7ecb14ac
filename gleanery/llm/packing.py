"""Best-fit packing of tokenised documents into sequences, by exact-complement hashing.

Pieces are packed by length alone, so the plan is made from the counts of pieces by length: at most `capacity` numbers,
whatever the size of the corpus. The longest length left opens a bin; sums of one, two and three available lengths are
indexed, and a combination that fills the gap exactly is consumed as often as its counts allow. Where none fills it,
the longest length that fits goes in, and the search goes on with what is left of the gap. Pieces then take the plan's
places by their number among those of equal length.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice
from struct import pack as packed

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import CACHES, Scratch, bounded, prepare, table, tidy

CAPACITY = 4096
END_ID = 1
#: Tokens of so many words are remembered by a worker, from their second occurrence on; that a word has occurred is a bit of its hash.
CACHE_WORDS = 300_000
_SEEN = 1 << 22
#: Pieces of one length that one task numbers.
NUMBERED = 250_000
_BLOCK = 1 << 20


def _byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes themselves, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    more = iter(range(256, 512))
    return {b: chr(b if b in own else next(more)) for b in range(256)}


class WordTokens(dict):
    """Little-endian 32-bit ids by word, for tokenizers whose tokens never reach over white space."""

    def __init__(self, path: str, cache_words: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = CACHE_WORDS if cache_words is None else cache_words
        self.model, self.seen, self.marked = self.tokenizer.model, bytearray(_SEEN), 0
        self.alphabet = _byte_alphabet()
        self.plain = all(self.whole(w) == self.lower_letters(w) for w in ("a", "the", "straße", "éàü", "extraordinarily", "ÿžłđ".lower()))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def lower_letters(self, word: str) -> bytes:
        """The same for one run of lower-case Latin letters, which a byte-level tokenizer neither changes nor parts: its model alone."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(word)]
        return packed("<%dI" % len(ids), *ids)

    def __missing__(self, word: str) -> bytes:
        if not word:
            return b""
        if len(word) > 1 and word[-1] in ".,!?;:" and word[-2].isalpha():
            ids = self[word[:-1]] + self[word[-1]]
        elif self.plain and word.isalpha() and max(word) < "\u0180":
            ids = self.lower_letters(word) if word.islower() else self[word.lower()] if max(word) < "\u0100" and word.lower() != word else self.whole(word)
        else:
            ids = self.whole(word)
        at = hash(word) % _SEEN
        if not self.seen[at]:
            if self.marked >= _SEEN // 2:
                self.seen, self.marked = bytearray(_SEEN), 0
            self.seen[at], self.marked = 1, self.marked + 1
        elif len(word) <= 64:
            if len(self) >= self.most:  # the frequent words came first
                for k in list(islice(reversed(self), max(1, len(self) - self.most * 3 // 4))):
                    del self[k]
            self[word] = ids
        return ids

    def blocks(self, text: str):
        """The ids of a text, block by block of whole words."""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > _BLOCK:
                cuts = [c for c in (text.find(" ", at + _BLOCK), text.find("\n", at + _BLOCK)) if c >= 0]
                end = min(cuts, default=end)
            yield b"".join(map(self.__getitem__, text[at:end].replace("\n", " ").split(" ")))
            at = end


_tokens = CACHES.setdefault("packing", {})


def word_tokens(path: str, cache_words: int = CACHE_WORDS) -> WordTokens:
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    _tokens[path].most = cache_words
    return _tokens[path]


def cut(tokens: WordTokens, text: str | None, capacity: int, end_id: int):
    """(start, ids as bytes) of a document's pieces; the end id follows its tokens."""
    held, start, width = bytearray(), 0, 4 * capacity
    for ids in (*tokens.blocks(text or ""), int(end_id).to_bytes(4, "little")):
        held += ids
        while len(held) > width:
            yield start, bytes(held[:width])
            del held[:width]
            start += capacity
    yield start, bytes(held)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece. tokenizer: the path of its file on every executor; cache_words: how many words a worker remembers, some 0.25 KB each. A null text is empty, and so one piece with the end id alone."""
    from zlib import crc32

    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tokens = word_tokens(tokenizer, cache_words)
        for b in batches:
            rows = [(i, n, start, len(ids) // 4, crc32(ids), ids) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for n, (start, ids) in enumerate(cut(tokens, t, capacity, end_id))]
            cols = list(zip(*rows)) or [()] * 6
            kinds = (b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)][: 5 + with_ids], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run, "packing"), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Lengths:
    """Available lengths with an index of the sums of two and of three of them."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        for k, v in counts.items():
            self.count[k] = v
        self.stale = True

    def index(self) -> None:
        if self.stale:
            n = 1 << (3 * self.capacity).bit_length()
            has = np.fft.rfft((self.count > 0).astype(float), n)
            two = np.fft.irfft(has * has, n)[: self.capacity + 1] > 0.5
            three = np.fft.irfft(np.fft.rfft(two.astype(float), n) * has, n)[: self.capacity + 1] > 0.5
            self.two, self.three, self.stale = two, three, False

    def fits(self, used: Counter) -> int:
        """How often the combination is available."""
        return min(int(self.count[k]) // v for k, v in used.items())

    def exact(self, used: Counter, gap: int) -> list[int] | None:
        """One, two or three lengths that fill the gap beside those used, longest first."""
        self.index()
        if self.count[gap] > used[gap]:
            return [gap]
        if self.two[gap]:
            a = np.arange((gap + 1) // 2, gap)
            for x in a[(self.count[a] > 0) & (self.count[gap - a] > 0)][::-1]:
                if self.fits(used + Counter([int(x), int(gap - x)])):
                    return [int(x), int(gap - x)]
        if self.three[gap]:
            a = np.arange((gap + 2) // 3, gap - 1)
            for x in a[(self.count[a] > 0) & self.two[gap - a]][::-1]:
                if self.count[x] > used[int(x)] and (rest := self.pair(used + Counter([int(x)]), gap - int(x))):
                    return [int(x), *rest]
        return None

    def pair(self, used: Counter, gap: int) -> list[int] | None:
        a = np.arange((gap + 1) // 2, gap)
        for x in a[(self.count[a] > 0) & (self.count[gap - a] > 0)][::-1]:
            if self.fits(used + Counter([int(x), int(gap - x)])):
                return [int(x), int(gap - x)]
        return None

    def take(self, used: Counter, times: int) -> None:
        for k, v in used.items():
            self.count[k] -= v * times
            self.stale |= self.count[k] == 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, number of such sequences), all counts consumed."""
    left, out = Lengths(counts, capacity), []
    for longest in range(capacity, 0, -1):
        while left.count[longest] > 0:
            used, gap = Counter([longest]), capacity - longest
            order = [longest]
            while gap:
                found = left.exact(used, gap)
                if found is None:
                    free = left.count[1 : gap + 1].copy()
                    for k, v in used.items():
                        if k <= gap:
                            free[k - 1] -= v
                    fit = np.flatnonzero(free > 0)
                    if not len(fit):
                        break
                    found = [int(fit[-1]) + 1]
                used.update(found)
                order += found
                gap -= sum(found)
            times = left.fits(used)
            left.take(used, times)
            out.append((sorted(order, reverse=True), times))
    return out


def places(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, after, per, sequence, offset): pieces numbered first to after - 1 among those of a length go, `per` to a sequence, to the sequences from `sequence` on, the first of them at `offset`."""
    numbered, sequence, out = Counter(), 0, []
    for lengths, times in patterns:
        offset = 0
        for k, v in Counter(lengths).items():
            out.append((k, numbered[k], numbered[k] + v * times, v, sequence, offset))
            numbered[k] += v * times
            offset += k * v
        sequence += times
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every row.

    Only documents of more than `capacity` tokens are cut. Null text is empty (one piece with the end id); repeated
    rows are packed each; null ids pass through; an empty table gives an empty result; other columns are ignored.
    Pieces are numbered within their length over as many buckets as the count asks for, dealt by their row, so that no
    task numbers one very common length alone, whatever the ids.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    cuts = pieces(docs, tokenizer, capacity, end_id, with_ids, cache_words=cache_words)
    cuts = scratch.keep(cuts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = places(plan(counts, capacity))
    parts = [(k, 1 + v // NUMBERED) for k, v in counts.items()]
    slot_df = bounded(spark.createDataFrame(slots, "length long, first long, after long, per long, sequence long, at long"), len(slots))
    part_df = bounded(spark.createDataFrame(parts, "length long, parts int"), len(parts))
    dealt = cuts.join(part_df, "length").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
    if any(n > 1 for _, n in parts):
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = dealt.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
        dealt = dealt.join(bounded(sizes, sum(n for _, n in parts)), ["length", "part"])
    else:
        dealt = dealt.withColumn("before", F.lit(0).cast("long"))
    order = Window.partitionBy("length", "part").orderBy("row")
    ranked = dealt.withColumn("number", F.col("before") + F.row_number().over(order) - 1)
    slot = (ranked["length"] == slot_df["length"]) & (ranked["number"] >= slot_df["first"]) & (ranked["number"] < slot_df["after"])
    nth = F.col("number") - F.col("first")
    placed = ranked.join(slot_df, slot).select("doc_id", "piece", "start", ranked["length"], "ids_crc32", *["ids"] * with_ids, (F.col("sequence") + F.floor(nth / F.col("per"))).alias("sequence_id"), (F.col("at") + nth % F.col("per") * ranked["length"]).alias("offset"))
    return placed


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())
