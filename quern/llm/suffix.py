"""Suffix-array dedup: shard Burrows-Wheeler transforms merged by iterative interleave refinement.

A *window* is ``WINDOW`` consecutive words (maximal runs of bytes other than ASCII white space). Words are
compared by 64-bit hashes of their bytes, segments by such hashes of their words. A window is repeated
when it occurs in two or more documents.

1. Every window is filed under its minimizer, the least hash of its ``GRAM``-word grams. Equal
   windows have equal minimizers, so consecutive windows with one minimizer form a *segment* whose
   repeats all lie in segments of the same key: no repeat is lost, and only small numbers are
   shuffled. Keys of one document alone go. Equal segments are collapsed to one, with the documents they
   span, by aggregations that begin where the segments are: no task gets all copies of a passage.
2. Map tasks build the Burrows-Wheeler transform of each shard of the distinct segments.
3. Reduce tasks merge the shards' transforms. Rows start in shard order within their first symbol; each
   round refines the interleave by one more symbol, following every row to the row of the rest of
   its suffix, and splits blocks of rows that tie so far. A split in round h is a longest common
   prefix of h. Stretches of places whose common prefixes reach WINDOW symbols are the repeated
   intervals. No suffixes are compared or sorted again across shards.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import keys_in, passes, plain, ragged, range_hashes, trimmed, word_spans
from quern.runtime import Workspace, prepare

WINDOW = 50
GRAM = 16
#: Words that a map task gathers before it builds transforms, and words for one merge.
SHARD_WORDS, MERGE_WORDS = 600_000, 1_200_000


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.maximum(range_hashes(data, starts, ends), np.uint64(1)) if len(starts) else np.zeros(0, np.uint64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def segments(words: np.ndarray, counts: np.ndarray, window: int, gram: int):
    """(row, first word in the row, windows, key, content hash) of the segments of each row."""
    windows = np.maximum(counts - window + 1, 0)
    if not windows.sum():
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    first = np.cumsum(counts) - counts
    i = np.arange(len(words) - gram + 1)
    least = _sliding_min(range_hashes(words, i, i + gram), window - gram + 1)
    at, row = ragged(first, windows), np.repeat(np.arange(len(counts)), windows)
    key = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(at)))
    return row[head], at[head] - first[row[head]], n, key[head].view(np.int64), range_hashes(words, at[head], at[head] + n + window - 1).view(np.int64)


def transform(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of sequences, each with a terminator of its own that sorts by its number.

    Terminators show as 0. The first len(lengths) rows are those of the terminators.
    """
    n, s = len(words) + len(lengths), len(lengths)
    stops = np.cumsum(lengths + 1) - 1
    is_word = np.ones(n, bool)
    is_word[stops] = False
    text = np.zeros(n, np.uint64)
    text[is_word] = words
    rank = np.empty(n, np.int64)
    rank[stops] = np.arange(s)
    rank[is_word] = s + np.unique(words, return_inverse=True)[1]
    k = 1
    while True:
        rest = np.zeros(n, np.int64)
        rest[: n - k] = rank[k:] if k < n else 0
        both = rank * (n + 1) + rest
        order = np.argsort(both, kind="stable")
        ranked = np.concatenate(([0], np.cumsum(both[order][1:] != both[order][:-1])))
        rank[order] = ranked
        if ranked[-1] == n - 1:
            return text[order - 1]
        k *= 2


def merge(transforms: list[np.ndarray], sequences: list[int], depth: int):
    """Interleave shard transforms and refine until ``depth`` symbols are compared.

    Returns (sequence number and offset of each row, rows of repeated intervals in order, the
    interval of each of them, the common prefix of each place of the interleave with the one before, ``depth`` where
    it reaches that).
    """
    sizes = np.array([len(t) for t in transforms])
    base = np.cumsum(sizes) - sizes
    total, n_seq = int(sizes.sum()), int(sum(sequences))
    succ, symbol = np.zeros(total, np.int64), np.zeros(total, np.uint64)
    seq_of, off_of = np.zeros(total, np.int64), np.zeros(total, np.int64)
    done = 0
    for bwt, s, b in zip(transforms, sequences, base):
        order = np.argsort(bwt, kind="stable")
        symbol[b : b + len(bwt)] = bwt[order]
        succ[b : b + len(bwt)] = order + b
        # walk every sequence from its terminator to its start: which row is which suffix
        before = np.full(len(bwt), -1)
        before[order[s:]] = np.arange(s, len(bwt))
        at, who, back = np.arange(s), np.arange(s), 0
        length = np.zeros(s, np.int64)
        while len(at):
            seq_of[b + at], off_of[b + at] = who + done, back
            at = before[at]
            alive = at >= 0
            length[who[~alive]] = back
            at, who, back = at[alive], who[alive], back + 1
        mine = slice(b, b + len(bwt))
        off_of[mine] = length[seq_of[mine] - done] - off_of[mine]
        done += s
    order = np.argsort(symbol, kind="stable")
    new = np.ones(total, bool)
    new[1:] = (symbol[order][1:] != symbol[order][:-1]) | (symbol[order][1:] == 0)
    place = np.arange(total)
    block = np.empty(total, np.int64)
    block[order] = np.maximum.accumulate(np.where(new, place, 0))
    prefix = np.full(total, -1, np.int32)
    prefix[new] = 0
    active = _tied(order, new)
    for h in range(1, depth):
        if not len(active):
            break
        old = block[active]
        both = old * total + block[succ[active]]
        again = np.argsort(both, kind="stable")
        active, both, old = active[again], both[again], old[again]
        new = np.ones(len(active), bool)
        new[1:] = both[1:] != both[:-1]
        head = np.ones(len(active), bool)
        head[1:] = old[1:] != old[:-1]
        i = np.arange(len(active))
        place = old + i - np.maximum.accumulate(np.where(head, i, 0))
        block[active] = place[np.maximum.accumulate(np.where(new, i, 0))]
        prefix[place[new & ~head]] = h
        active = _tied(active, new)
    prefix[prefix < 0] = depth
    # a repeated interval is a stretch of places that share ``depth`` symbols with the place before
    far = prefix >= depth
    inside = np.flatnonzero(far | np.append(far[1:], False))
    first = np.maximum.accumulate(np.where(far, 0, np.arange(total)))
    return seq_of, off_of, np.argsort(block, kind="stable")[inside], first[inside], prefix


def _tied(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Rows of blocks of two or more."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return order[~alone]


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


META = ("key", "seg", "doc", "tag", "n", "last")


def merged_runs(shards: list[dict[str, np.ndarray]], window: int) -> dict[str, np.ndarray]:
    """Runs of repeated windows of each distinct segment, each with the first document that holds them."""
    seq_of, off_of, rows, interval, _ = merge([s["bwt"] for s in shards], [len(s["key"]) for s in shards], window)
    meta = {k: np.concatenate([s[k] for s in shards]) for k in META}
    base = np.cumsum(meta["n"]) - meta["n"]
    who = np.repeat(np.arange(len(base)), meta["n"])
    off = np.arange(len(who)) - base[who]
    f_doc, f_tag = meta["doc"][who], meta["tag"][who]
    repeated = meta["last"][who] > meta["doc"][who]
    if len(rows):
        seq, at = seq_of[rows], off_of[rows]
        doc, tag = meta["doc"][seq], meta["tag"][seq]
        by = np.lexsort((tag, doc, interval))
        seq, at, doc, tag, interval = (x[by] for x in (seq, at, doc, tag, interval))
        head = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
        size = np.diff(np.append(head, len(by)))
        across = np.repeat(np.maximum.reduceat(meta["last"][seq], head) > doc[head], size)
        first = np.repeat(head, size)
        to = base[seq] + at
        f_doc[to[across]], f_tag[to[across]] = doc[first][across], tag[first][across]
        repeated[to[across]] = True
    k = np.flatnonzero(repeated)
    if not len(k):
        return {}
    joins = (k[1:] == k[:-1] + 1) & (who[k][1:] == who[k][:-1]) & (f_doc[k][1:] == f_doc[k][:-1]) & (f_tag[k][1:] == f_tag[k][:-1])
    head = np.flatnonzero(np.concatenate(([True], ~joins)))
    size, lead = np.diff(np.append(head, len(k))), k[head]
    return {"key": meta["key"][who[lead]], "seg": meta["seg"][who[lead]], "a": off[lead], "b": off[lead] + size, "f_doc": f_doc[lead], "f_tag": f_tag[lead]}


def _tagged(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``tag`` that tells texts of one doc_id apart; 0 where an id has one row."""
    again = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("again"))
    if not again.limit(1).count():
        return docs.withColumn("tag", F.lit(0).cast("bigint"))
    return docs.join(again, "doc_id", "left").withColumn("tag", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0))).drop("again")


def _islands(df: DataFrame) -> DataFrame:
    """Unions of overlapping or touching [start, stop) ranges of each (doc_id, tag)."""
    w = Window.partitionBy("doc_id", "tag").orderBy("start", "stop")
    fresh = F.when(F.col("start") <= F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1)
    marked = df.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc_id", "tag", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def _repeats(ws: Workspace, docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Stored (doc_id, tag, start, stop, later): word ranges of repeated windows; ``later`` ones occur in an earlier document too."""

    def file_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            for i, _, data, offsets in passes(batch.column("text")):
                starts, ends, counts = word_spans(data, offsets)
                row, start, n, key, seg = segments(_words(data, starts, ends), counts, window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, seg, ids[i + row], tags[i + row], start.astype(np.int32), n.astype(np.int32))], names=["key", "seg", "doc_id", "tag", "start", "n"])

    filed = ws.save(docs.mapInArrow(file_windows, "key bigint, seg bigint, doc_id bigint, tag bigint, start int, n int"), "filed")
    across = ws.save(filed.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y").select("key"), "across")
    occ = ws.save(keys_in(filed, across, "key"), "occurrences")
    ws.drop("filed")
    place = F.struct("doc_id", "tag", "start")
    reps = ws.save(occ.groupBy("key", "seg").agg(F.min(place).alias("f"), F.min("n").alias("n"), F.max("doc_id").alias("last")).select("key", "seg", "f.*", "n", "last"), "segments")
    size = reps.agg(F.sum(F.col("n").cast("bigint") + window - 1)).first()[0] or 0
    buckets = max(1, -(-size // MERGE_WORDS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            words, lengths = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            meta = {k: np.concatenate([h[2][k] for h in held]) for k in META}
            held.clear()
            first, bucket = np.cumsum(lengths) - lengths, (meta["key"].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(bucket):
                mine = np.flatnonzero(bucket == b)
                bwt = transform(words[ragged(first[mine], lengths[mine])], lengths[mine])
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([_pack(bwt=bwt, **{k: meta[k][mine] for k in META})], pa.binary())], names=["bucket", "shard"])

        for batch in batches:
            want = batch.column("want")
            for i, j, data, offsets in passes(batch.column("text")):
                starts, ends, counts = word_spans(data, offsets)
                part = want.slice(i, j - i)
                row = np.repeat(np.arange(j - i), pc.list_value_length(part).to_numpy(zero_copy_only=False))
                flat = part.flatten()
                meta = {k: flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("key", "seg", "n", "last")}
                meta["doc"], meta["tag"] = batch.column("doc_id").to_numpy()[i + row], batch.column("tag").to_numpy()[i + row]
                lengths = meta["n"] + window - 1
                held.append((_words(data, starts, ends)[ragged((np.cumsum(counts) - counts)[row] + flat.field("start").to_numpy(zero_copy_only=False), lengths)], lengths, meta))
                if sum(len(h[0]) for h in held) >= SHARD_WORDS:
                    yield from flush()
        if held:
            yield from flush()

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "seg", "a", "b", "f_doc", "f_tag"]

        def flush(shards: list[dict]) -> Iterator[pa.RecordBatch]:
            found = merged_runs(shards, window)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found[k].astype(np.int64)) for k in names], names=names)

        bucket, shards = None, []
        for batch in batches:
            for b, shard in zip(batch.column("bucket").to_pylist(), batch.column("shard")):
                if b != bucket and shards:
                    yield from flush(shards)
                    shards = []
                bucket = b
                shards.append(dict(np.load(io.BytesIO(shard.as_py()))))
        if shards:
            yield from flush(shards)

    want = reps.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "seg", "start", "n", "last")).alias("want"))
    shards = docs.join(want, ["doc_id", "tag"]).select("doc_id", "tag", "text", "want").mapInArrow(trimmed(build), "bucket bigint, shard binary")
    runs = shards.repartition(int(min(buckets, 4096)), "bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(refine), "key bigint, seg bigint, a bigint, b bigint, f_doc bigint, f_tag bigint")
    runs = ws.save(runs, "runs")

    later = (F.col("doc_id") != F.col("f_doc")) | (F.col("tag") != F.col("f_tag"))
    ends = lambda a, b: ("doc_id", "tag", (F.col("start") + a).cast("bigint").alias("start"), (F.col("start") + b + F.lit(window - 1)).cast("bigint").alias("stop"), later.alias("later"))
    found = occ.select("key", "seg", "doc_id", "tag", "start").join(runs, ["key", "seg"])
    return ws.save(found.select(*ends(F.col("a"), F.col("b"))), "repeats")


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, start_word, n_words, cut_words): maximal passages of repeated windows of each document.

    ``start_word`` counts from 0. ``cut_words`` is how many words of the passage lie in a repeated
    window that a document of lesser doc_id holds too; cutting those leaves every passage in the
    first document that has it. Repeats inside one document alone do not count. Texts under
    ``window`` words, empty and null texts have no passage; rows with a null doc_id are not read; rows
    that repeat id and text are one document, and texts that share an id are told apart. Other
    columns are not read.
    """
    spark = prepare(docs.sparkSession)
    with Workspace(spark, "suffix") as ws:
        found = _repeats(ws, _tagged(plain(docs, "doc_id", "text").dropna()), window, gram)
        every, cut = _islands(found.drop("later").distinct()), _islands(found.filter("later").drop("later").distinct())
        inside = cut.select("doc_id", "tag", F.col("start").alias("c"), (F.col("stop") - F.col("start")).alias("words"))
        joined = every.join(inside, ["doc_id", "tag"], "left").withColumn("words", F.when((F.col("c") >= F.col("start")) & (F.col("c") < F.col("stop")), F.col("words")))
        out = joined.groupBy("doc_id", "tag", "start", "stop").agg(F.coalesce(F.sum("words"), F.lit(0)).alias("cut_words"))
        return ws.result(out.select("doc_id", F.col("start").alias("start_word"), (F.col("stop") - F.col("start")).alias("n_words"), "cut_words"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without the words of repeated windows that a document of lesser doc_id holds too.

    White space before a cut stays; a cut that reaches the end takes the white space before it too.
    ``n_chars``, if there, counts the new text. Documents of which nothing is left go; all others
    stay, also those with null or empty texts or a null doc_id. Column names may be of any letter case.
    """
    spark = prepare(docs.sparkSession)
    with Workspace(spark, "suffix-cuts") as ws:
        bare = _tagged(plain(docs, "doc_id", "text").dropna())
        cuts = _islands(_repeats(ws, bare, window, gram).filter("later").drop("later").distinct())
        cuts = ws.result(cuts.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")).withColumnRenamed("doc_id", "__id").withColumnRenamed("tag", "__tag").withColumnRenamed("cuts", "__cuts"))
    tagged = (F.col("__tag") == 0) | (F.col("__tag") == F.xxhash64(F.col("text").cast("string")))
    joined = docs.join(cuts, (F.col("doc_id").cast("bigint") == F.col("__id")) & tagged, "left").drop("__id", "__tag")
    names, kinds = docs.columns, dict(docs.dtypes)
    text_at, count_at = (next((k for k, c in enumerate(names) if c.lower() == name), None) for name in ("text", "n_chars"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("__cuts")
            text = batch.column(text_at)
            fresh: dict[int, str] = {}
            marked = np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False))
            picked = text.take(pa.array(marked))
            for i, j, data, offsets in passes(picked):
                starts, _, counts = word_spans(data, offsets)
                first = np.cumsum(counts) - counts
                for k in range(i, j):
                    keep = np.ones(offsets[k - i + 1] - offsets[k - i], bool)
                    begin, words = starts[first[k - i] : first[k - i] + counts[k - i]] - offsets[k - i], counts[k - i]
                    tail = False
                    for c in marks[int(marked[k])].as_py():
                        tail |= c["stop"] >= words
                        keep[begin[c["start"]] : begin[c["stop"]] if c["stop"] < words else len(keep)] = False
                    left = data[offsets[k - i] : offsets[k - i + 1]][keep].tobytes().decode()
                    fresh[int(marked[k])] = left.rstrip() if tail else left
            keep = np.array([not (k in fresh and not fresh[k].strip()) for k in range(len(text))], bool)
            out = []
            values = text.to_pylist() if fresh else None
            for at, name in enumerate(names):
                column = batch.column(at)
                if fresh and at == text_at:
                    column = pa.array([fresh.get(k, v) for k, v in enumerate(values)], column.type)
                elif fresh and at == count_at and kinds[name] in ("bigint", "int"):
                    column = pa.array([len(fresh[k]) if k in fresh else v for k, v in enumerate(column.to_pylist())], column.type)
                out.append(column)
            yield pa.RecordBatch.from_arrays(out, names=names).filter(pa.array(keep))

    return joined.select(*names, "__cuts").mapInArrow(cut, docs.schema)
