"""Near-duplicates by the Jaccard similarity of sets of word shingles: SimHash and covering tables give candidates, exact sets decide.

This is the pipeline's form of near-duplicate removal. Fingerprints of 64 bits of two texts of a similarity of .8 differ
in some ten bits, and a covering for ten bits or more has thousands of tables. So a set gets a longer fingerprint of
WORDS parts of 32 bits, and each part the 15 covering tables for radius 3, as in simhash.py: two sets meet whenever some
part differs in 3 bits or less, and in some table mostly beyond. A bit of two sets of a similarity of .8 differs with a
chance of .15, so a part has a chance of .48 to bring them together, and all of them fail with one of 2 in a million.
Sets of four shingles and of one more differ in more bits and meet by their four as well.
Of a bucket those stay together that differ in at most REACH of the WINDOW * 32 bits from their part on, 5 standard
deviations above what sets of .8 differ in. Of what is left in a bucket the sets themselves are compared, but for pairs
that by what each shares with a common centre can't be alike enough.
"""

from __future__ import annotations

import random
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, prepare, tidy
from gleanery.llm.graph import components
from gleanery.llm.simhash import RADIUS, SEED, covering_masks, one_of_each, word_blocks

SHINGLE = 5
FLOOR = 0.8
#: Parts of a fingerprint, and how many of them, from its own on, a set shows in the buckets of a part.
WORDS, WINDOW = 20, 5
#: In how many bits of a window neighbours in a bucket differ at most.
REACH = 43
#: Tables in threes of independent vectors (by index): what all of three fix deals the sets out, so that one row serves three tables.
THREES = ((0, 1, 3), (2, 4, 7), (5, 6, 8), (9, 10, 11), (12, 13, 14))
#: Sets that are dealt out at once, and the largest bucket of which all pairs are looked at; in larger ones each set is met once.
DEALT, PAIRED = 1 << 16, 1024
#: Pairs of any two components in a bucket that are compared at first, and by what factor there are more in each next round.
PIVOTS, MORE = 1, 8
#: Rows that a task gathers from its buckets before it reduces them.
HELD = 1 << 20
#: Blocks, a power of 2, in which these rows travel to be reduced over all tasks.
PARTS = 256
#: Bins, a power of 2, in which the shingles that a set lacks of its centre are counted.
BINS = 32
_RNG = random.Random(SEED)
_FLIP = np.array([_RNG.getrandbits(64) for _ in range(WORDS // 2)], np.uint64)
_MASKS = [np.array(covering_masks(RADIUS, SEED + i, 32), np.uint32) for i in range(WORDS)]


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased word shingles; a shorter text is one shingle, one without words none."""
    import xxhash

    digest = xxhash.xxh64_digest
    parts, words = [], []
    for new in word_blocks((text or "").lower().encode("utf-8", "surrogatepass")):
        words += new
        if len(words) >= width:
            joined, ends = b" ".join(words), list(accumulate([len(w) + 1 for w in words]))
            parts.append(np.frombuffer(b"".join([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[width - 1 :])]), np.int64))
            words = words[len(words) - width + 1 :]
    if not parts and words:
        parts.append(np.frombuffer(digest(b" ".join(words), SEED), np.int64))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def name(found: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    import xxhash

    return int.from_bytes(xxhash.xxh64_digest(found.tobytes(), SEED), "big", signed=True)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(found: np.ndarray, block: int = 255) -> np.ndarray:
    """SimHash of a set of shingles, in WORDS parts: a bit is 1 if set in over half the hashes."""
    counts, x = np.zeros(WORDS * 32, np.int64), found.view(np.uint64)[:, None]
    for i in range(0, len(x), block):
        bits = np.unpackbits(_mixed(x[i : i + block] ^ _FLIP).view(np.uint8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(x)).view(np.uint32)


def prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, bits, shingles) of every row: the name of its set, its fingerprint (null for an empty set) and the set."""

    def run(batches):
        for b in batches:
            sets = [shingles(t, width) for t in b.column(1).to_pylist()]
            bits = [fingerprint(s).tobytes() if len(s) else None for s in sets]
            yield pa.record_batch([b.column(0), pa.array([name(s) for s in sets], pa.int64()), pa.array(bits, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "fp", "bits", "shingles"])

    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long, bits binary, shingles array<long>")


def _layout(*more: tuple[str, str]) -> np.dtype:
    """A row of a bucket: a set's name, its window, and numbers of its own."""
    return np.dtype([("fp", "i8"), ("window", "u4", (WINDOW,)), *more])


def _dealt(bits: np.ndarray, rows: np.ndarray):
    """(three, split, members) for every part and every three of its tables: the rows, with windows, of the sets that agree on what the three fix."""
    wide = np.concatenate([bits, bits[:, : WINDOW - 1]], axis=1)
    for word in range(WORDS):
        rows["window"] = wide[:, word : word + WINDOW]
        for i, three in enumerate(THREES):
            split = bits[:, word] & np.bitwise_and.reduce(_MASKS[word][list(three)])
            order = np.argsort(split, kind="stable")
            starts = np.flatnonzero(np.diff(split[order], prepend=split[order[0]] ^ np.uint32(1)))
            sorted_rows = rows[order]
            yield word * len(THREES) + i, split[order[starts]], [sorted_rows[s:e].tobytes() for s, e in zip(starts, [*starts[1:], len(order)])]


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=0, dtype=np.uint8) <= REACH


def _neighbours(keys: np.ndarray, windows: np.ndarray, paired: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in sorted keys that have the same components as all pairs of one key within the reach."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ np.uint32(1)))
    sizes = np.diff(starts, append=len(keys))
    ends, of = np.repeat(starts + sizes, sizes), np.repeat(sizes, sizes)
    a, b, at, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.flatnonzero((of > 1) & (of <= paired)), 1
    while len(at := at[at + step < ends[at]]):
        near = at[_near(windows[:, at], windows[:, at + step])]
        a.append(near)
        b.append(near + step)
        step += 1
    for start, size in zip(starts[sizes > paired], sizes[sizes > paired]):
        left = np.arange(start, start + size)
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                near = _near(windows[:, left], windows[:, x, None])
                found, left = left[near], left[~near]
                queue.extend(found)
                a.append(np.full(len(found), x))
                b.append(found)
    return np.concatenate(a), np.concatenate(b)


def _groups(rows: np.ndarray, three: int, paired: int):
    """(members, starts) for each of three tables where sets have neighbours: the places of these in rows, group by group, and where each group starts."""
    windows = np.ascontiguousarray(rows["window"].T)
    for table in THREES[three % len(THREES)]:
        masked = windows[0] & _MASKS[three // len(THREES)][table]
        order = np.argsort(masked, kind="stable")
        a, b = _neighbours(masked[order], windows[:, order], paired)
        if not len(a):
            continue
        root, before = np.arange(len(order)), None
        while before is None or (root != before).any():
            before, least = root.copy(), np.minimum(root[a], root[b])
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
        some = np.unique(np.concatenate([a, b]))
        some = some[np.argsort(root[some], kind="stable")]
        yield order[some], np.flatnonzero(np.diff(root[some], prepend=-1))


def _met(sets: DataFrame, parts, schema: str, reduce=None, paired: int = PAIRED) -> DataFrame:
    """The columns that parts gives for an iterator over (rows, groups) of the buckets in a task; sets(fp, bits, ...) are distinct, and what follows are columns of the rows: int, long, or binary of BINS bytes.

    With reduce, which takes and gives columns, a task tells once of what it meets in many buckets, and what several
    tasks tell of one number in the first column is reduced once more; it travels packed.
    """
    layout = _layout(*[(f.name, *{"int": ("i4",), "bigint": ("i8",), "binary": ("u1", (BINS,))}[f.dataType.simpleString()]) for f in sets.schema.fields[2:]])
    names, kinds = zip(*[c.split() for c in schema.split(", ")])
    packed = np.dtype([(c, {"long": "i8", "boolean": "?"}[k]) for c, k in zip(names, kinds)])

    def deal(batches):
        bits, rows, n = [], [], 0

        def dealt():
            for three, splits, members in _dealt(np.concatenate(bits), np.concatenate(rows)):
                yield pa.record_batch([pa.array(np.full(len(splits), three, np.int32)), pa.array(splits.astype(np.int64)), pa.array(members, pa.binary())], ["three", "split", "members"])

        for b in batches:
            if len(b):
                bits.append(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, WORDS))
                rows.append(np.zeros(len(b), layout))
                for at, column in zip(("fp", None, *layout.names[2:]), b.columns):
                    if at:
                        rows[-1][at] = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS) if layout[at].shape else column.to_numpy(zero_copy_only=False)
                n += len(b)
            if n >= DEALT:
                yield from dealt()
                bits, rows, n = [], [], 0
        if n:
            yield from dealt()

    def buckets(batches):
        for b in batches:
            for three, members in zip(b.column(0).to_pylist(), b.column(1)):
                rows = np.frombuffer(b"".join(members.values.to_pylist()), layout)
                yield rows, _groups(rows, three, paired)

    def plain(batches):
        for columns in parts(buckets(batches)):
            yield pa.record_batch([pa.array(c) for c in columns], list(names))

    def pack(batches):
        for columns in _reduced(parts(buckets(batches)), reduce):
            rows, part = np.zeros(len(columns[0]), packed), columns[0] & (PARTS - 1)
            for c, values in zip(names, columns):
                rows[c] = values
            order = np.argsort(part, kind="stable")
            part, rows = part[order], rows[order]
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            blocks = [rows[s:e].tobytes() for s, e in zip(starts, [*starts[1:], len(part)])]
            yield pa.record_batch([pa.array(part[starts].astype(np.int32)), pa.array(blocks, pa.binary())], ["part", "block"])

    def unpack(batches):
        for b in batches:
            for blocks in b.column(0):
                rows = np.frombuffer(b"".join(blocks.values.to_pylist()), packed)
                yield pa.record_batch([pa.array(c) for c in reduce(*[np.ascontiguousarray(rows[c]) for c in names])], list(names))

    lists = sets.mapInArrow(tidy(deal), "three int, split long, members binary").groupBy("three", "split").agg(F.collect_list("members").alias("members")).select("three", "members")
    if not reduce:
        return lists.mapInArrow(tidy(plain), schema)
    return lists.mapInArrow(tidy(pack), "part int, block binary").groupBy("part").agg(F.collect_list("block").alias("blocks")).select("blocks").mapInArrow(tidy(unpack), schema)


def _reduced(parts, reduce):
    """The columns of all parts, reduced whenever they are many and at the end."""
    held, n = [], 0
    for columns in parts:
        held.append(columns)
        n += len(columns[0])
        if n >= HELD:
            held = [reduce(*map(np.concatenate, zip(*held)))]
            n = len(held[0][0])
            if n >= HELD // 2:
                yield held[0]
                held, n = [], 0
    if n:
        yield reduce(*map(np.concatenate, zip(*held)))


def _last(*columns: np.ndarray, same: int) -> np.ndarray:
    """Places of the last row, in the order of all columns, of those that agree in the first `same` ones."""
    order = np.lexsort(columns[::-1])
    ends = np.zeros(len(order), bool)
    ends[-1:] = True
    for c in columns[:same]:
        ends[:-1] |= c[order[1:]] != c[order[:-1]]
    return order[ends]


def _placed(buckets):
    """(key, fp) of all groups; the key is that of the members, so groups that are found again are the same."""
    for rows, groups in buckets:
        for at, starts in groups:
            fps = rows["fp"][at]
            keys = np.add.reduceat(_mixed(fps.view(np.uint64)), starts)
            yield np.repeat(keys, np.diff(starts, append=len(at))).view(np.int64), fps


def _degrees(buckets):
    """(fp, degree) of the sets that have neighbours: how many rows their groups have in all."""
    for rows, groups in buckets:
        for at, starts in groups:
            sizes = np.diff(starts, append=len(at))
            yield rows["fp"][at], np.repeat(sizes, sizes)


def _summed(fps: np.ndarray, degrees: np.ndarray) -> list[np.ndarray]:
    some, at = np.unique(fps, return_inverse=True)
    total = np.zeros(len(some), np.int64)
    np.add.at(total, at, degrees)
    return [some, total]


def _last_of(same: int):
    """Of the rows that agree in the first `same` columns the last in the order of all."""

    def reduce(*columns):
        at = _last(*columns, same=same)
        return [c[at] for c in columns]

    return reduce


def _centres(floor: float):
    """For _met: (fp, pd, p) with the centre p of those of a set's groups, that with the highest degree pd; those that by what they share with any sets can't be alike are passed over."""

    def parts(buckets):
        for rows, groups in buckets:
            for at, starts in groups:
                sizes, x = np.diff(starts, append=len(at)), rows[at]
                group = np.repeat(np.arange(len(starts)), sizes)
                p = x[np.lexsort((x["fp"], x["degree"], group))[starts + sizes - 1]][group]
                possible = (x["fp"] != p["fp"]) & (_most(x["n"], p["n"], np.minimum(x["m"], p["m"])) >= floor)
                yield x["fp"][possible], p["degree"][possible], p["fp"][possible]

    return parts


def lost(centre: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How many shingles of its centre a set lacks in each of BINS bins, 255 at most."""
    gone = np.setdiff1d(centre, own, assume_unique=True)
    return np.minimum(np.bincount(gone & (BINS - 1), minlength=BINS), 255).astype(np.uint8)


def _share_at_most(x: np.ndarray, i: np.ndarray, j: np.ndarray, floor: float) -> np.ndarray:
    """How many shingles rows i and j of x share at most; of those that a first look rules out, by that. Of a common centre's shingles a bin of the union of what both lack has no less than either lacks."""
    n, m, o, centre = (x[c] for c in ("n", "m", "o", "centre"))
    shared = np.minimum(m[i], m[j])
    beside = np.maximum(m - o, 0)
    one = np.flatnonzero(centre[i] == centre[j])
    shared[one] = np.minimum(shared[one], np.minimum(o[i[one]], o[j[one]]) + np.minimum(beside[i[one]], beside[j[one]]))
    one = one[_most(n[i[one]], n[j[one]], shared[one]) >= floor]
    u, v = i[one], j[one]
    more = np.maximum(x["lost"][u], x["lost"][v]).sum(axis=1, dtype=np.int32) - x["lost"][u].sum(axis=1, dtype=np.int32)
    shared[one] = np.minimum(shared[one], o[u] - more + np.minimum(beside[u], beside[v]))
    return shared


def _pairs(floor: float, most: int):
    """For _met: (a, b, more) for the pairs that share a group, are of two components and may be alike enough; of two components in a bucket at most `most` pairs, the likeliest, and `more` where there are others."""

    def cut(group, low, high, bound, a, b, more):
        order = np.lexsort((b, a, -bound, high, low, group))
        group, low, high, bound, a, b, more = (c[order] for c in (group, low, high, bound, a, b, more))
        new = np.ones(len(a), bool)
        new[1:] = (group[1:] != group[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=len(a))
        rank = np.arange(len(a)) - np.repeat(starts, sizes)
        more = (np.logical_or.reduceat(more, starts) | (sizes > most)).repeat(sizes) if len(a) else more
        return [c[rank < most] for c in (group, low, high, bound, a, b, more)]

    def parts(buckets):
        for rows, groups in buckets:
            for at, starts in groups:
                x, sizes = rows[at], np.diff(starts, append=len(at))
                fp, root, n = x["fp"], x["root"], x["n"]
                group, ends = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
                i = np.flatnonzero(np.repeat(np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts), sizes))
                held, count, step = [], 0, 1
                while len(i := i[i + step < ends[i]]):
                    j = i + step
                    bound = _most(n[i], n[j], _share_at_most(x, i, j, floor))
                    fits = (root[i] != root[j]) & (bound >= floor)
                    u, v = i[fits], j[fits]
                    held.append((group[u], np.minimum(root[u], root[v]), np.maximum(root[u], root[v]), bound[fits], np.minimum(fp[u], fp[v]), np.maximum(fp[u], fp[v]), np.zeros(len(u), bool)))
                    count, step = count + len(u), step + 1
                    if count >= HELD:
                        held, count = [cut(*map(np.concatenate, zip(*held)))], 0
                if held:
                    yield cut(*map(np.concatenate, zip(*held)))[4:]

    return parts


def _few(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, four) of the sets of four shingles, and of those of five without one each."""
    few = found.where(F.size("shingles").between(4, 5)).select("fp", "shingles").distinct()
    fours = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.filter("shingles", lambda x, at: at != i))
    return few.where(F.size("shingles") == 4).select("fp", F.col("shingles").alias("four")), few.where(F.size("shingles") == 5).select("fp", F.explode(fours).alias("four"))


def places(found: DataFrame, scratch: Scratch, paired: int = PAIRED) -> DataFrame:
    """(key, fp): the groups of neighbours in the buckets of the covering tables of found(fp, bits, shingles), and those of sets of four and five shingles, as so few differ in more bits, that hold the same four. links() takes the same groups, but never row by row: near copies share up to 300 of them each."""
    distinct = scratch.keep(_distinct(found), "fingerprints")
    four, five = _few(found)
    fours = four.unionAll(five).select("fp", F.xxhash64("four").alias("key"))
    shared = fours.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    out = scratch.keep(_met(distinct, _placed, "key long, fp long", paired=paired).unionAll(fours.join(shared, "key").select("key", "fp")).distinct(), "places")
    scratch.drop(distinct)
    return out


def _distinct(found: DataFrame) -> DataFrame:
    return found.where("bits IS NOT NULL").groupBy("fp").agg(F.first("bits").alias("bits"))


def _shared_enough(sets: DataFrame, floor: float) -> DataFrame:
    """(fp, n, m) of those sets(fp, s) of n shingles of whose shingles the share `floor` or more, m of them, is in other sets too; no other one can be as alike to any."""
    each = sets.select("fp", F.size("s").alias("n"), F.explode("s").alias("g"))
    common = each.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g")
    return each.join(common, "g", "left_semi").groupBy("fp", "n").agg(F.count("*").alias("m")).where(F.col("m") >= F.col("n") * floor)


def _most(n, pn, t):
    """The highest similarity of sets of n and pn shingles that share at most t."""
    return t / (n + pn - t)


def _shares(pairs: DataFrame, sets: DataFrame, *more: Column) -> DataFrame:
    """pairs(a, b) with o, how many shingles they share, and u, how many they have together; more are columns of both sets, sa and sb."""
    both = pairs.join(sets.select(F.col("fp").alias("b"), F.col("s").alias("sb")), "b").join(sets.select(F.col("fp").alias("a"), F.col("s").alias("sa")), "a")
    o = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", o.alias("o"), (F.size("sa") + F.size("sb") - o).alias("u"), *more)


def links(found: DataFrame, scratch: Scratch, floor: float = FLOOR) -> DataFrame:
    """(a, b) between distinct sets found(fp, bits, shingles), with the same components as all pairs that share a group of places() and have a Jaccard similarity of `floor` (over 2/3) or more.

    Sets that have too much of their own to be alike to any are left out. At first each set is compared with one other:
    that of its groups' centres, the members with the most rows in their groups, which has most of all; it mostly finds
    the group of a near copy. What two sets share at most is known from what each shares with their common centre, and
    has beside it in common with any other. From then on the buckets, whose rows hold these numbers and the component,
    give the pairs of different components that may be alike enough by them: some of any two components at first, and
    more in each next round until no bucket has others. Groups are never written out, so what is shuffled and joined
    outside the buckets grows with the sets and with the pairs to be compared.
    """
    distinct = scratch.keep(_distinct(found), "fingerprints")
    nodes = scratch.keep(_met(distinct, _degrees, "fp long, degree long", _summed), "nodes")
    scratch.drop(distinct)
    chosen = found.join(bounded(nodes.select("fp"), nodes.count()), "fp", "left_semi").groupBy("fp")
    sets = scratch.keep(chosen.agg(F.first("bits").alias("bits"), F.first("shingles").alias("s")), "sets")
    numbers = nodes.join(_shared_enough(sets, floor), "fp").join(sets.select("fp", "bits"), "fp")
    able = scratch.keep(numbers.select("fp", "bits", F.col("n").cast("int").alias("n"), F.col("m").cast("int").alias("m"), "degree"), "able")
    nearest = _met(able, _centres(floor), "fp long, pd long, p long", _last_of(1)).select(F.col("fp").alias("a"), F.col("p").alias("b"))
    bins = F.arrow_udf(lambda own, centre: pa.array([lost(np.array(c), np.array(o)).tobytes() for o, c in zip(own.to_pylist(), centre.to_pylist())], pa.binary()), "binary")
    near = scratch.keep(_shares(nearest, sets, bins("sa", "sb").alias("lost")), "near")
    edges = near.where(F.col("o") / F.col("u") >= floor).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if floor <= 4 / 5:  # a set of four shingles and the same with one more
        four, five = _few(found)
        edges = edges.unionAll(five.join(four.withColumnRenamed("fp", "p"), "four").select(F.least("fp", "p").alias("a"), F.greatest("fp", "p").alias("b")))
    edges, most = scratch.keep(edges.distinct(), "links"), PIVOTS
    centred = able.join(near.select(F.col("a").alias("fp"), F.col("b").alias("centre"), "o", "lost"), "fp", "left")
    members = scratch.keep(centred.select("fp", "bits", "n", "m", F.coalesce("o", "n").alias("o"), F.coalesce("centre", "fp").alias("centre"), F.coalesce("lost", F.lit(bytes(BINS))).alias("lost")), "members")
    scratch.drop(nodes, able, near)
    while True:
        roots = components(edges, scratch).withColumnRenamed("node", "fp")
        rooted = scratch.keep(members.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
        pairs = scratch.keep(_met(rooted, _pairs(floor, most), "a long, b long, more boolean", _last_of(2)), "pairs")
        new = _shares(pairs, sets).where(F.col("o") / F.col("u") >= floor).select("a", "b")
        past, edges, most = edges, scratch.keep(edges.unionAll(new), "links"), most * MORE
        more = not pairs.where("more").isEmpty()
        scratch.drop(past, rooted, pairs)
        if not more:
            break
    scratch.drop(members, sets)
    return edges


def grouped(docs: DataFrame, scratch: Scratch, floor: float = FLOOR, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, root, component_id): root is the smallest fp of the component, component_id its smallest doc_id."""
    found = scratch.keep(prints(docs, width=width), "prints")
    near = links(found, scratch, floor)
    old, found = found, scratch.keep(found.select("doc_id", "fp"), "names")  # the sets are of no more use
    scratch.drop(old)
    roots = components(near, scratch)
    scratch.drop(near)
    classes = scratch.keep(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.select("doc_id", "fp").join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, floor: float = FLOOR, width: int = SHINGLE) -> DataFrame:
    """docs without the near-duplicates of a document with a smaller doc_id, as simhash.keep_one, but by shingle sets."""
    scratch = Scratch(docs.sparkSession)
    return one_of_each(docs, grouped(docs, scratch, floor, width), lambda t: name(shingles(t, width)), scratch)
