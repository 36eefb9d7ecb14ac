"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to whole numbers. The index holds blocks of rows; in a block, every bit of every component is a
bitmap over the rows (a slice), with the sign as the slice of negative weight. A query's scores come as slices too:
sum over bits b of the query's components of 2 ** b times the sum of the components that have b set, all by carry-save
addition of bitmaps. The k best rows are then selected from the most significant slice downward: rows that have the bit
come before rows that don't, and where the bound of k falls among rows equal in all slices, the row ids decide.
Slices are as many as the largest number asks for, so every finite vector takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, prepare, table, tidy

SCALE = 1024
TOP = 10
#: Rows of a block and its components; queries that are scored together; bytes of queries that are sent to the executors at once.
BLOCK_ROWS = 8192
BLOCK_CELLS = 1 << 21
CHUNK = 8
QUERY_BYTES = 32 << 20
#: A row with a component beyond this goes to a block of its own kind, of fewer rows, as such a block has many slices.
WIDE = float(1 << 31)
WIDE_ROWS = 256
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(vec: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, x as double, as whole numbers in doubles; null for a vector that is null, or holds a null or a non-finite component."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    # floor() of Spark gives a long; from 2 ** 52 on a double is whole
    whole = lambda v: F.when(F.abs(v) < float(1 << 52), F.floor(v).cast("double")).otherwise(v)
    return F.when(vec.isNotNull() & F.coalesce(finite, F.lit(False)), F.transform(vec, lambda x: whole(x.cast("double") * scale)))


def pack_bits(flags: np.ndarray) -> np.ndarray:
    """Bitmaps of 64-bit words along the last axis."""
    pad = -flags.shape[-1] % 64
    return np.packbits(np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, pad)]), axis=-1, bitorder="little").view(np.uint64)


def bits_of(values: np.ndarray) -> int:
    """The bits that whole numbers in doubles need in two's complement."""
    return int(np.frexp(np.abs(values).max(initial=1))[1]) + 1


def bit(values: np.ndarray, b: int) -> np.ndarray:
    """Bit b of whole numbers in doubles, in two's complement; scaling by powers of two is exact at any size."""
    return np.mod(np.floor(np.ldexp(values, -b)), 2).astype(bool)


def slices_of(values: np.ndarray) -> np.ndarray:
    """(components, bits, words) of (rows, components), in two's complement: the last slice is the sign."""
    bits = bits_of(values)
    cols = np.ascontiguousarray(values.T)
    if bits < 63:
        whole = cols.astype(np.int64)
        return np.stack([pack_bits((whole >> b & 1).astype(bool)) for b in range(bits)], axis=1)
    return np.stack([pack_bits(bit(cols, b)) for b in range(bits)], axis=1)


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a + b of bit-sliced numbers in two's complement, slices along the first axis; one slice wider than a."""
    out = np.empty((len(a) + 1, *a.shape[1:]), np.uint64)
    carry = None
    for k in range(len(out)):
        x, y = a[min(k, len(a) - 1)], b[min(k, len(b) - 1)]  # the sign goes on
        half = x ^ y
        if carry is None:
            out[k], carry = half, x & y
        else:
            out[k] = half ^ carry
            carry = (x & y) | (half & carry)
    return out


def sums_of_fours(index: np.ndarray) -> np.ndarray:
    """(bits + 2, groups * 16, words): for each four components the sum of every subset of them. All queries share them."""
    n, bits, words = index.shape
    own = np.concatenate([index, np.zeros((-n % 4, bits, words), np.uint64)]).transpose(1, 0, 2).reshape(bits, -1, 4, words)
    out = np.zeros((bits + 2, own.shape[1], 16, words), np.uint64)
    for mask in range(1, 16):
        low = mask & -mask
        out[:, :, mask] = _sum(out[:, :, mask ^ low], own[:, :, low.bit_length() - 1])[: bits + 2]
    return out.reshape(bits + 2, -1, words)


def score_slices(fours: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """(bits, queries, words): the inner products of a block's rows with each query, sign last."""
    groups, words = fours.shape[1] // 16, fours.shape[2]
    q = np.zeros((len(queries), groups * 4))
    q[:, : queries.shape[1]] = queries
    q_bits = bits_of(q)
    bits = len(fours) + groups.bit_length() + q_bits + 1
    total = np.zeros((bits, len(q), words), np.uint64)
    for b in range(q_bits):
        masks = (bit(q, b).reshape(len(q), groups, 4) << np.arange(4)).sum(2)
        if not masks.any() and b < q_bits - 1:
            continue
        now = fours[:, np.arange(groups)[:, None] * 16 + masks.T]
        while now.shape[1] > 1:
            if now.shape[1] % 2:
                now = np.concatenate([now, np.zeros_like(now[:, :1])], axis=1)
            now = _sum(now[:, 0::2], now[:, 1::2])
        number = now[:, 0]
        carry = np.zeros((len(q), words), np.uint64)
        if b == q_bits - 1:  # the sign bit of a query counts -2 ** b: add the complement, and one
            number, carry = ~number, ~carry
        for k in range(b, bits):
            x, a = number[min(k - b, len(number) - 1)], total[k]
            half = a ^ x
            carry, total[k] = (a & x) | (half & carry), half ^ carry
    return total


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def select_top(slices: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, boundary) bitmaps: the sure rows are among the k best; the k - |sure| others are the first ones, by id, of the boundary rows, which all have one score."""
    sure, equal = np.zeros_like(valid), valid.copy()
    for n, s in enumerate(slices[::-1]):
        high = equal & ~s if n == 0 else equal & s  # the sign slice: rows without it are larger
        count = _count(sure) + _count(high)
        if count > k:
            equal = high
        else:
            sure |= high
            equal &= ~high
            if count == k:
                return sure, np.zeros_like(sure)
    return sure, equal


def rows_of(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little", count=n))


def scores_at(slices: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scores of some rows as longs, those beyond a long as the nearest one, and as doubles."""
    on = (slices[:, rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64)
    if len(slices) <= 63:
        worth = np.left_shift(np.int64(1), np.arange(len(slices)))
        worth[-1] = -worth[-1]
        exact = worth @ on
        return exact, exact.astype(float)
    worth = [1 << k for k in range(len(slices) - 1)] + [-1 << len(slices) - 1]
    exact = [sum(w for w, x in zip(worth, col) if x) for col in on.T.tolist()]
    return limited(exact)


def limited(exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of any size as the nearest longs, and as doubles."""
    as_double = lambda v: float(v) if abs(v) < 1 << 1023 else np.inf if v > 0 else -np.inf
    return np.array([min(max(v, _LEAST), _MOST) for v in exact], np.int64), np.array([as_double(v) for v in exact], float)


class Best:
    """The best rows that each query has met so far."""

    def __init__(self, queries: int, k: int):
        self.k, none = k, np.zeros(0, np.int64)
        self.found = [(none, none.astype(float), none.astype(bool), none)] * queries

    def meet(self, query: int, score: np.ndarray, size: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        score, size, nameless, ids = (np.concatenate(p) for p in zip(self.found[query], (score, size, nameless, ids)))
        by = np.lexsort((ids, nameless, -size, ~score))[: self.k]
        self.found[query] = score[by], size[by], nameless[by], ids[by]


def block_top(index: np.ndarray, ids: np.ndarray, nameless: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Adds each query's best rows of a block, whose rows are in the order of (nameless, id)."""
    n, fours = len(ids), sums_of_fours(index)
    everyone = pack_bits(np.ones(n, bool))
    for at in range(0, len(queries), CHUNK):
        scored = score_slices(fours, queries[at : at + CHUNK])
        for x in range(scored.shape[1]):
            slices = scored[:, x]
            sure, boundary = select_top(slices, everyone, best.k)
            rows = np.concatenate([rows_of(sure, n), rows_of(boundary, n)[: max(0, best.k - _count(sure))]])
            best.meet(at + x, *scores_at(slices, rows), nameless[rows], ids[rows])


def build_index(rows: DataFrame, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, dims, bits, words, ids, nameless, slices): a bit-sliced index of rows(vec_id, q), written to the shared folder. Shorter vectors are filled up with zeros; a block's size is bounded in rows and in components."""

    def run(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        held, cells = {False: [], True: []}, {False: 0, True: 0}

        def block(wide):
            nonlocal n
            vectors = sorted(held[wide], key=lambda v: (v[0] is None, v[0] or 0))
            held[wide], cells[wide] = [], 0
            values = np.zeros((len(vectors), max(1, max(len(v) for _, v in vectors))))
            for row, (_, v) in zip(values, vectors):
                row[: len(v)] = v
            index = slices_of(values)
            ids, nameless = np.array([i or 0 for i, _ in vectors], "<i8"), np.array([i is None for i, _ in vectors])
            cols = [[(part << 32) + n], [index.shape[0]], [index.shape[1]], [index.shape[2]], [ids.tobytes()], [nameless.tobytes()], [index.tobytes()]]
            n += 1
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], ["block", "dims", "bits", "words", "ids", "nameless", "slices"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                v = v.values.to_numpy(zero_copy_only=False)
                wide = bool(np.abs(v).max(initial=0) >= WIDE)
                most = max(cells[wide], len(v))
                if held[wide] and (len(held[wide]) >= (min(WIDE_ROWS, block_rows) if wide else block_rows) or most * (len(held[wide]) + 1) > BLOCK_CELLS):
                    yield block(wide)
                held[wide].append((i, v))
                cells[wide] = max(cells[wide], len(v))
        for wide in held:
            if held[wide]:
                yield block(wide)

    return scratch.keep(rows.mapInArrow(tidy(run), "block long, dims int, bits int, words int, ids binary, nameless binary, slices binary"), "index")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries, which are rows of vectors, the k other rows with the highest inner product of the quantised vectors, ties to the smaller id.

    Vectors that are null, or hold a null or non-finite component, take no part; all others do, whatever their size.
    Shorter vectors, empty ones too, are filled up with zeros. A score beyond a long is shown as the nearest long; such
    scores are ordered as doubles. Every query row asks for itself, also among rows that share an id, and meets every
    row but itself: of rows equal in id and score one is left out. Rows without an id are candidates, last among ties;
    as queries they ask too. An empty table gives an empty result; other columns are ignored. Every block meets every
    query; a task keeps k + 1 rows a query over all its blocks, so what is shuffled is small.
    """
    scratch = Scratch(vectors.sparkSession)
    prepare(vectors.sparkSession)
    thin = lambda df: df.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vec_col), scale).alias("q")).where("q IS NOT NULL")
    index = build_index(thin(vectors), scratch)
    asked = scratch.keep(thin(queries).withColumn("n", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.count("*").alias("rows"), F.coalesce(F.max(F.size("q")), F.lit(0)).alias("dims")).first()
    rounds = max(1, -(-8 * size["rows"] * (size["dims"] + 4) // QUERY_BYTES))
    parts = [scratch.keep(_meet(index, asked.where(F.pmod(F.xxhash64("n"), F.lit(rounds)) == r), k + 1), "found") for r in range(rounds)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    scratch.drop(index, asked)
    each = Window.partitionBy("n")
    ranked = found.withColumn("r", F.row_number().over(each.orderBy(F.desc("score"), F.desc("size"), F.col("vec_id").asc_nulls_last()))).where(F.col("r") <= k + 1)
    ranked = ranked.withColumn("self", F.min(F.when(F.col("own"), F.col("r"))).over(each)).where("self IS NULL OR r <> self")
    rank = F.col("r") - F.coalesce((F.col("r") > F.col("self")).cast("int"), F.lit(0))
    return ranked.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _meet(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(n, query_id, vec_id, score, size, own): the k best rows of every task for at most about QUERY_BYTES of queries, which go to every task. own: the row may be the query itself."""
    rows = sorted(((r["n"], r["vec_id"], r["q"]) for r in asked.collect()), key=lambda r: (max(map(abs, r[2]), default=0) >= WIDE, r[0]))
    numbers, ids = [r[0] for r in rows], [r[1] for r in rows]
    queries = np.zeros((len(rows), max((len(r[2]) for r in rows), default=0)))
    for row, (_, _, q) in zip(queries, rows):
        row[: len(q)] = q
    selves = limited([sum(int(x) * int(x) for x in q) for _, _, q in rows])

    def run(batches):
        best = Best(len(rows), k)
        for b in batches:
            for _, dims, bits, words, row_ids, nameless, slices in zip(*(c.to_pylist() for c in b.columns)):
                own = np.frombuffer(slices, np.uint64).reshape(dims, bits, words)
                asks = np.zeros((len(queries), max(dims, queries.shape[1])))
                asks[:, : queries.shape[1]] = queries
                if dims < asks.shape[1]:
                    own = np.concatenate([own, np.zeros((asks.shape[1] - dims, bits, words), np.uint64)])
                block_top(own, np.frombuffer(row_ids, "<i8"), np.frombuffer(nameless, bool), asks, best)
        for x, (score, size, nameless, found) in enumerate(best.found):
            if len(found):
                if ids[x] is None:
                    itself = nameless & (score == selves[0][x]) & (size == selves[1][x])
                else:
                    itself = ~nameless & (found == ids[x]) & (score == selves[0][x]) & (size == selves[1][x])
                many = len(found)
                cols = pa.array([numbers[x]] * many, pa.int64()), pa.array([ids[x]] * many, pa.int64()), pa.array(found, pa.int64(), mask=nameless), pa.array(score), pa.array(size), pa.array(itself)
                yield pa.record_batch(list(cols), ["n", "query_id", "vec_id", "score", "size", "own"])

    return index.repartition("block").mapInArrow(tidy(run), "n long, query_id long, vec_id long, score long, size double, own boolean")


def op4_bitsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 100 = 0"))


OP4_SQL = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.n, a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q, true), lambda z: z[1]::HUGEINT * z[2]::HUGEINT)), 0) AS s FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.n <> b.n),
r AS (SELECT *, (row_number() OVER (PARTITION BY n ORDER BY s DESC, vec_id ASC NULLS LAST))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, greatest(-9223372036854775808, least(9223372036854775807, s))::BIGINT AS score FROM r WHERE rank <= 10
"""
