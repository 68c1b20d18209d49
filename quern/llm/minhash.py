"""MinHash near-duplicates by HyperMinHash registers.

A text is the set of its lower-case word ``shingle``-grams (a shorter text is one shingle of all its
words). Each shingle's hash picks one of ``REGISTERS`` buckets; a bucket keeps its least hash,
compressed to a leading-zero count (6 bits) and the ``MANTISSA`` bits after it. Registers without a
shingle are filled from the next full one, so that short texts band like long ones. Bands of
compressed registers propose; texts of a bucket are compared by the collision-corrected Jaccard
estimate over the registers that have a shingle, which for short texts is nearly the similarity itself. For it
registers travel folded to ``FOLD`` bits. What it lets through is verified by
exact Jaccard similarity of the shingle sets. First every text is verified against the least text
proposed for it; a pair whose ends were found near one text is joined already and needs no more.
Groups are connected components of verified pairs; exact copies follow their first text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import binary_array, keys_in, list_array, lower, mix, passes, plain, range_hashes, spans
from quern.runtime import Workspace, prepare

BUCKET_BITS, MANTISSA = 8, 10
REGISTERS = 192
ROWS_PER_BAND = 4
BANDS = REGISTERS // ROWS_PER_BAND
#: Texts of a bucket from which on it is compared in parts of about so many.
HOT = 16_384

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[0x80:] = True


def shingles(column: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, hashes of all shingles, shingles per row) for passes over the column.

    Words are runs of ASCII letters and digits and of bytes outside ASCII, in lower case.
    """
    for i, j, data, offsets in passes(column):
        small = lower(data)
        starts, ends, counts = spans(_WORD[small], offsets)
        words = range_hashes(small, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        grams = np.maximum(counts - shingle + 1, np.minimum(counts, 1))
        at = np.repeat(np.cumsum(counts) - counts, grams) + (np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams))
        yield i, j, range_hashes(words, at, at + np.minimum(np.repeat(counts, grams), shingle)) if len(at) else words, grams


def compress(least: np.ndarray) -> np.ndarray:
    """48-bit values to 16-bit registers: leading zeros, then the MANTISSA bits that follow the first one."""
    _, exponent = np.frexp(least.astype(np.float64))  # exact: 48 bits fit a double
    zeros = np.minimum(48 - exponent, 63)
    shift = exponent - 1 - MANTISSA
    v = least.astype(np.int64)
    mantissa = np.where(shift >= 0, v >> np.maximum(shift, 0), v << np.maximum(-shift, 0)) & ((1 << MANTISSA) - 1)
    return ((zeros << MANTISSA) | mantissa).astype(np.uint16)


def own_registers(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(compressed registers of each text, which of them have no shingle)."""
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    bucket = ((hashes >> np.uint64(48)).astype(np.int64) * REGISTERS) >> 16
    least = np.full(n * REGISTERS, 1 << 48, np.int64)
    np.minimum.at(least, row * REGISTERS + bucket, (hashes & np.uint64((1 << 48) - 1)).astype(np.int64))
    empty = (least == 1 << 48).reshape(n, REGISTERS)
    return compress(np.where(least == 1 << 48, 1, np.maximum(least, 1))).reshape(n, REGISTERS), empty


def fill(packed: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """An empty register takes the value of the next full one, round the ring, marked with the distance."""
    out, some = np.zeros(packed.shape, np.uint16), np.flatnonzero(~empty.all(axis=1))
    index = np.where(empty[some], 4 * REGISTERS, np.arange(REGISTERS))
    source = np.minimum.accumulate(np.concatenate([index, index + REGISTERS], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :REGISTERS]
    far = (source - np.arange(REGISTERS)).astype(np.uint64)
    taken = np.take_along_axis(packed[some], source % REGISTERS, axis=1)
    out[some] = np.where(far == 0, taken, (mix(taken.astype(np.uint64) + far * np.uint64(1 << 20)) & np.uint64(0xFFFF)).astype(np.uint16))
    return out


def registers(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of compressed, filled registers for each text; texts without shingles get zeros."""
    return fill(*own_registers(hashes, counts))


#: Bits of a folded register: 0 if it has no shingle, else one of KINDS others by its value.
FOLD = 4
KINDS = (1 << FOLD) - 1
FEW = 24
_ZEROS = np.array([(x < 16) + (x % 16 == 0) for x in range(256)], np.uint8)
#: Four standard deviations of an estimate by folded registers at a Jaccard similarity of 0.5, where it varies most:
#: sqrt(0.25 / 192) for texts of many shingles and less for others, whose registers are nearly their shingles; and
#: what chance agreements of folded registers add.
SLACK = 4 * math.sqrt(0.25 / REGISTERS + 0.5 / KINDS / REGISTERS) / (1 - 1 / KINDS)


def fold(packed: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Registers folded to FOLD bits, two in a byte."""
    small = (mix(packed.astype(np.uint64)) % np.uint64(KINDS)).astype(np.uint8) + 1
    small[empty] = 0
    return small[:, ::2] << 4 | small[:, 1::2]


def folded_estimates(one: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, the most that it may miss by chance): equal registers among those that either text has, less
    chance agreements.

    Where two texts have under FEW registers, one shingle that shares a register with another is a large part of
    the similarity; the second number allows for one.
    """
    lacking = lambda x: _ZEROS[x].sum(axis=-1, dtype=np.int64)
    neither = lacking(others | one)
    either = REGISTERS - neither
    both = 2 * REGISTERS - lacking(one) - lacking(others) - either
    equal = (lacking(others ^ one) - neither - both / KINDS) / (1 - 1 / KINDS)
    return np.clip(equal / np.maximum(either, 1), 0, 1), np.clip((equal + (either < FEW)) / np.maximum(either, 1), 0, 1)


def bit_planes(folded: np.ndarray) -> np.ndarray:
    """Folded registers as FOLD planes of REGISTERS bits, in as many bytes."""
    each = np.stack([folded >> 4, folded & 15], axis=2).reshape(len(folded), REGISTERS)
    return np.concatenate([np.packbits(each >> k & 1, axis=1) for k in range(FOLD)], axis=1)


class Planes:
    """Texts' folded registers by bit planes, and a plane of the registers that have a shingle: 64 registers a word, one
    column a text. Indexed like rows of registers."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns

    @classmethod
    def of(cls, planes: np.ndarray) -> "Planes":
        words = np.ascontiguousarray(planes).view(np.uint64).reshape(len(planes), FOLD, -1).transpose(1, 2, 0)
        return cls(np.concatenate([words, np.bitwise_or.reduce(words, axis=0, keepdims=True)]))

    def __getitem__(self, at: object) -> "Planes":
        return Planes(self.columns[..., at])


def plane_estimates(one: Planes, others: Planes) -> tuple[np.ndarray, np.ndarray]:
    """``folded_estimates`` of one text and others, or of texts two by two, at 64 registers an operation."""
    a, b = one.columns if one.columns.ndim == 3 else one.columns[..., None], others.columns
    count = lambda x: np.add.reduce(np.bitwise_count(x), axis=0, dtype=np.uint8).astype(np.int16)  # noqa: E731  REGISTERS at most
    differ = a[0] ^ b[0]
    for k in range(1, FOLD):
        differ |= a[k] ^ b[k]
    either = count(a[FOLD] | b[FOLD])
    both = count(a[FOLD]) + count(b[FOLD]) - either
    equal = (either - count(differ) - both / KINDS) / (1 - 1 / KINDS)
    return np.clip(equal / np.maximum(either, 1), 0, 1), np.clip((equal + (either < FEW)) / np.maximum(either, 1), 0, 1)


def bands(regs: np.ndarray) -> np.ndarray:
    """BANDS keys of 64 bits for each row."""
    n = len(regs)
    flat = np.ascontiguousarray(regs).ravel()
    at = np.arange(n * BANDS) * ROWS_PER_BAND
    return (range_hashes(flat, at, at + ROWS_PER_BAND) ^ mix(np.tile(np.arange(BANDS, dtype=np.uint64), n))).view(np.int64) if n else np.zeros(0, np.int64)


#: Chance that two unequal buckets' least values give one register: the first bits agree in zeros with
#: probability about 1/3 and in the mantissa with 2 ** -MANTISSA.
COLLISION = 1 / 3 / (1 << MANTISSA)


def estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard estimate from shares of equal registers, less what chance collisions add."""
    equal = (others == one).mean(axis=1)
    return np.clip((equal - COLLISION) / (1 - COLLISION), 0, 1)


Registers = np.ndarray | Planes
Estimates = Callable[[Registers, Registers], tuple[np.ndarray, np.ndarray]]


def _compared(ids: np.ndarray, regs: Registers, sure: float, alike_by: Estimates) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first of its group, text, other texts, their estimates): every text against all that are not yet joined to an
    earlier one by an estimate of ``sure`` or more, by indices in order of ``ids``."""
    left = np.argsort(ids, kind="stable")
    rows = regs[left]  # gathered anew only where texts leave
    while len(left):
        root, left, rows = left[0], left[1:], rows[1:]
        queue = [root]
        while queue and len(left):
            u = queue.pop()
            alike, at_most = alike_by(regs[u], rows)
            yield root, u, left, alike, at_most
            joined = alike >= sure
            if joined.any():
                queue += list(left[joined])
                left, rows = left[~joined], rows[~joined]


def _plain_estimates(one: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (estimate(one, others),) * 2


def _pairs(ids: np.ndarray, parts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return (np.zeros(0, np.int64),) * 2
    return np.concatenate([np.full(len(out), ids[u]) for u, out in parts]), ids[np.concatenate([out for _, out in parts])]


def bucket_edges(ids: np.ndarray, regs: Registers, least: float, sure: float, alike_by: Estimates = _plain_estimates) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket to verify, enough for its connected components.

    Every text is compared with all texts not yet joined to an earlier one by an estimate of
    ``sure`` or more; pairs of at least ``least`` come out. So a bucket of n alike texts gives n - 1
    pairs, and no pair is left out whose ends are not joined otherwise.
    """
    return _pairs(ids, [(u, left[at_most >= least]) for _, u, left, _, at_most in _compared(ids, regs, sure, alike_by)])


def cross_edges(ids: np.ndarray, regs: Registers, side: np.ndarray, least: float, sure: float, alike_by: Estimates = _plain_estimates) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between two parts of a bucket (by ``side``), which with ``bucket_edges`` of either part are as good as those of both
    together: of surely alike pairs one for any two groups that the parts have on their own, and all others."""
    group = np.arange(len(ids))
    for part in (np.flatnonzero(side == 0), np.flatnonzero(side == 1)):
        for root, _, left, alike, _ in _compared(ids[part], regs[part], sure, alike_by):
            group[part[left[alike >= sure]]] = part[root]
    parts, joined = [], set()
    for _, u, left, alike, at_most in _compared(ids, regs, sure, alike_by):
        over = side[left] != side[u]
        parts.append((u, left[over & (at_most >= least) & (alike < sure)]))
        strong = left[over & (alike >= sure)]
        kinds, first = np.unique(group[strong], return_index=True)
        new = [k for k, g in zip(first, kinds.tolist()) if (group[u], g) not in joined and not joined.add((group[u], g))]
        parts.append((u, strong[new]))
    return _pairs(ids, [(u, out.astype(np.int64)) for u, out in parts])


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(id, root) for every id of ``edges`` (a, b): root is the least id of its connected component.

    Alternating large-star and small-star rounds over written tables, until no edge changes. A text with
    many neighbours is never one task's: least neighbours are aggregated and joined back.
    """
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = lambda e: e.groupBy("u").agg(F.min("v").alias("m"))
    current, before = ws.save(edges.filter("a <> b").distinct(), "star-0"), None
    for k in range(1, 200):
        # large star: every larger neighbour of u joins the least of u's neighbourhood
        near = both(current)
        large = near.filter("v > u").join(least(near), "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # small star: u and its smaller neighbours join the least of them
        small = large.join(least(large), "u")
        nxt = small.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        table = ws.save(nxt, f"star-{k}")
        state = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if k > 1:
            ws.drop(f"star-{k - 2}")
        current, done = table, before == state
        before = state
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionAll(current.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.5, shingle: int = 3) -> DataFrame:
    """(doc_id, keep_id, group_size): every document that shares a group of near-duplicates with another.

    ``keep_id`` is the least doc_id of the group, the one that stays. Pairs count as near-duplicates
    at a Jaccard similarity of ``threshold``; equal texts always do. Null and empty texts and texts
    without a word resemble nothing; rows with a null doc_id are not reported; rows that repeat one
    doc_id are one document, with all their texts. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    with Workspace(spark, "minhash") as ws:
        return ws.result(_groups(ws, plain(docs, "doc_id", "text"), threshold, shingle))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (band, doc_id) in order: the rows of bands that hold two documents or more, and for each such band a row
    without doc_id whose ``who`` tells which documents those are."""
    band, last, who, several = None, None, 0, False
    row = lambda b, d, w: pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(d, pa.int64()), pa.array(w, pa.int64())], names=["band", "doc_id", "who"])
    for batch in batches:
        bands, ids = batch.column("band").to_numpy(), batch.column("doc_id").to_numpy()
        if not len(ids):
            continue
        again = np.zeros(len(ids), bool)
        again[1:] = (bands[1:] == bands[:-1]) & (ids[1:] == ids[:-1])
        again[0] = band is not None and bands[0] == band and ids[0] == last
        bands, ids = bands[~again], ids[~again]
        if not len(ids):
            continue
        head = np.flatnonzero(np.concatenate(([True], bands[1:] != bands[:-1])))
        size = np.diff(np.append(head, len(ids)))
        sums = np.add.reduceat(mix(ids.view(np.uint64)), head)
        keep = size > 1
        if band is not None:
            if bands[0] == band:  # goes on from the batch before
                sums[:1] += np.uint64(who)
                if not several:
                    yield row([band], [last], [None])
                keep[0] = True
            elif several:
                yield row([band], [None], [np.uint64(who).astype(np.int64)])
        band, last, who, several = int(bands[-1]), int(ids[-1]), int(sums[-1]), bool(keep[-1])
        whole = np.repeat(keep, size)
        yield row(bands[whole], ids[whole], pa.nulls(int(whole.sum()), pa.int64()))
        told = np.flatnonzero(keep[:-1])  # the last one may go on
        yield row(bands[head[told]], pa.nulls(len(told), pa.int64()), sums[told].view(np.int64))
    if several:
        yield row([band], [None], [np.uint64(who).astype(np.int64)])


def _groups(ws: Workspace, docs: DataFrame, threshold: float, shingle: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, counts in shingles(batch.column("text"), shingle):
                some = np.flatnonzero(counts)
                part = batch.slice(i, j - i).take(pa.array(some))
                own = own_registers(hashes, counts[some])
                folded = bit_planes(fold(*own))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("d1"), part.column("d2"), binary_array(folded, folded.shape[1]), list_array(bands(fill(*own)), np.full(len(some), BANDS))], names=["doc_id", "d1", "d2", "regs", "bands"])

    rows = docs.dropna().select("doc_id", F.xxhash64("text", F.lit(1)).alias("d1"), F.xxhash64("text", F.lit(2)).alias("d2"), "text")
    sketched = ws.save(rows.mapInArrow(sketch, "doc_id bigint, d1 bigint, d2 bigint, regs binary, bands array<bigint>"), "sketched")
    firsts = sketched.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = ws.save(sketched.select("doc_id", "d1", "d2").join(firsts, ["d1", "d2"]).select("rep", "doc_id").distinct(), "copies")
    # a later copy adds nothing but its link to the first one, unless its id has another text as well
    several = sketched.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("x"), F.max(F.struct("d1", "d2")).alias("y")).filter("x <> y").select("doc_id")
    several = ws.save(several, "several")
    later = ws.save(copies.filter("doc_id <> rep").select("doc_id").distinct().join(several, "doc_id", "left_anti"), "later")
    reps = keys_in(sketched, later, "doc_id", "left_anti")

    posted = reps.select(F.explode("bands").alias("band"), "doc_id")
    buckets = ws.save(posted.repartition("band").sortWithinPartitions("band", "doc_id").mapInArrow(_buckets, "band bigint, doc_id bigint, who bigint"), "buckets")
    # bands that hold the same texts need one comparison
    once = buckets.filter("doc_id is null").groupBy("who").agg(F.min("band").alias("band")).select("band")
    wanted = ws.save(buckets.filter("doc_id is not null").select("band", "doc_id").join(once, "band", "left_semi"), "members")
    filled = wanted.join(reps.select("doc_id", "regs"), "doc_id")
    # a bucket of many texts is compared part by part, and part against part, by as many tasks as that takes
    many = wanted.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("band", F.ceil(F.col("n") / HOT).cast("int").alias("parts"))
    filled = filled.join(many, "band", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
    filled = filled.select("band", "doc_id", "regs", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    filled = filled.select("band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "doc_id", "regs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], i: int, j: int) -> pa.RecordBatch:
            ids, part, regs = (np.concatenate(x) for x in zip(*held))
            limits, regs = (threshold - SLACK, threshold + 0.2, plane_estimates), Planes.of(regs)
            a, b = bucket_edges(ids, regs, *limits) if i == j else cross_edges(ids, regs, (part == j).astype(np.int8), *limits)
            return edges(a, b)

        def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])

        key, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "i", "j")], axis=1)
            if not len(keys):
                continue
            doc, part = batch.column("doc_id").to_numpy(), batch.column("part").to_numpy()
            data = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint8).reshape(len(keys), REGISTERS // 2)
            cut = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            # most buckets hold two texts: those that end in this batch are compared all at once
            two = (np.diff(cut) == 2) & (keys[cut[:-1], 1] == keys[cut[:-1], 2])
            two[[0, -1]] = False
            if two.any():
                at = cut[:-1][two]
                near = plane_estimates(Planes.of(data[at]), Planes.of(data[at + 1]))[1] >= threshold - SLACK
                yield edges(doc[at][near], doc[at + 1][near])
            for lo, hi in zip(cut[:-1][~two], cut[1:][~two]):
                now = tuple(keys[lo].tolist())
                if now != key:
                    if held:
                        yield flush(held, *key[1:])
                    key, held = now, []
                held.append((doc[lo:hi], part[lo:hi], data[lo:hi]))
        if held:
            yield flush(held, *key[1:])

    pairs = ws.save(filled.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(compare, "a bigint, b bigint").filter("a <> b").distinct(), "pairs")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, counts in shingles(batch.column("text"), shingle):
                row = np.repeat(np.arange(len(counts)), counts)
                small = (hashes >> np.uint64(16)).astype(np.int64)  # 48 bits
                order = np.lexsort((small, row))
                row, small = row[order], small[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (small[1:] != small[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), list_array(small[new], np.bincount(row[new], minlength=len(counts)))], names=["doc_id", "set"])

    common = F.size(F.array_intersect("sa", "sb"))

    def verified(some: DataFrame, name: str) -> DataFrame:
        """The pairs of a stored table whose Jaccard similarity reaches the threshold."""
        ends = ws.save(some.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ends")
        contents = keys_in(docs.dropna(), ends, "doc_id").select("doc_id", "text").mapInArrow(sets, "doc_id bigint, set array<bigint>")
        contents = ws.save(contents.dropDuplicates(), f"{name}-sets")
        near = some.join(contents.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")), "a").join(contents.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")), "b")
        near = ws.save(near.filter(common >= F.lit(threshold) * (F.size("sa") + F.size("sb") - common)).select("a", "b"), name)
        ws.drop(f"{name}-sets")
        return near

    first = verified(ws.save(pairs.groupBy("b").agg(F.min("a").alias("a")), "first-pairs"), "first")
    parent = first.groupBy("b").agg(F.min("a").alias("p"))
    with_parents = pairs.join(parent.select(F.col("b").alias("a"), F.col("p").alias("pa")), "a", "left").join(parent.withColumnRenamed("p", "pb"), "b", "left")
    apart = F.coalesce("pa", "a") != F.coalesce("pb", "b")
    tried = pairs.groupBy("b").agg(F.min("a").alias("a"))
    rest = ws.save(with_parents.filter(apart).select("a", "b").join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    near = first.unionAll(verified(rest, "rest"))
    roots = components(ws, near.unionAll(copies.filter("doc_id <> rep").join(several, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))))
    roots = ws.save(roots, "roots")
    held = copies.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(F.col("doc_id").alias("id"), F.coalesce("root", "rep").alias("root"))
    every = ws.save(roots.unionAll(held).distinct(), "grouped")
    sizes = every.groupBy(F.col("root").alias("keep_id")).agg(F.count("*").alias("group_size"))
    return every.select(F.col("id").alias("doc_id"), F.col("root").alias("keep_id")).join(sizes, "keep_id").select("doc_id", "keep_id", "group_size")


def keep_one(docs: DataFrame, threshold: float = 0.5, shingle: int = 3) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of the least doc_id.

    Of rows with one doc_id and one text one stays, whichever; rows of a null doc_id or text all stay.
    """
    gone = near_duplicates(docs, threshold, shingle).filter("doc_id <> keep_id").select(F.col("doc_id").alias("__gone"))
    held = docs.join(gone, F.col("doc_id").cast("bigint") == F.col("__gone"), "left_anti")
    again = docs.select(F.col("doc_id").cast("bigint").alias("__again")).dropna().groupBy("__again").count().filter("count > 1").select("__again")
    if not again.limit(1).count():
        return held
    repeated = held.join(again, F.col("doc_id").cast("bigint") == F.col("__again"), "left_semi")
    return held.join(again, F.col("doc_id").cast("bigint") == F.col("__again"), "left_anti").unionByName(repeated.filter("text is null")).unionByName(repeated.filter("text is not null").dropDuplicates(["doc_id", "text"]))
