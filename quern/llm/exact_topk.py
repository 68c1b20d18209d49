"""Exact top-k inner products over vectors sorted by length.

Vectors are rotated onto the right singular vectors of the whole table, so that leading coordinates
hold most of an inner product, and packed into blocks by descending length. A block of queries walks
blocks of vectors in that order. It stops where the product of lengths cannot reach any query's
k-th best score; before that, partial sums over the leading coordinates plus the product of residual
lengths (Cauchy-Schwarz) bound each pair, and only pairs whose bound reaches are summed up. A first
pass over the longest vectors gives every query a score to reach; blocks of vectors that no query of a
group of blocks can need by it are not sent, and a block is sent once for a whole group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.vectors import TOP_SCHEMA, clean, group_rows, keep_best, matrix, top_batch
from quern.runtime import Workspace, prepare, shuffle_partitions

BLOCK = 2_048
#: Blocks of queries that one task holds at least, and groups of them at most.
GROUP, MAX_GROUPS = 8, 65_536


def rotation(rows: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of the table, from its Gram matrix, which executors add up in two rounds."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for batch in batches:
            x = matrix(batch.column("embedding"))
            gram += x.T @ x if len(x) else 0
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros(d * d)
        for batch in batches:
            for blob in batch.column("gram"):
                gram += np.frombuffer(blob.as_py(), np.float64)
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()]})

    parts = rows.select("embedding").mapInArrow(part, "gram binary")
    some = parts.repartition(max(1, math.isqrt(shuffle_partitions(rows.sparkSession)))).mapInArrow(add, "gram binary")
    gram = np.frombuffer(some.repartition(1).mapInArrow(add, "gram binary").first()[0], np.float64)
    _, vectors = np.linalg.eigh(gram.reshape(d, d))
    return vectors[:, ::-1].copy()


class Walk:
    """Best k of one block of queries over blocks of vectors in descending length."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, heads: tuple[int, ...], least: np.ndarray | None = None):
        self.ids, self.q, self.k, self.heads, self.on = ids, q, k, heads, True
        self.least = np.full(len(q), -np.inf) if least is None else least
        self.length = np.linalg.norm(q, axis=1)
        self.rest = [np.linalg.norm(q[:, h:], axis=1) for h in heads]
        self.best_ids, self.best = np.full((len(q), k), -1 << 62), np.full((len(q), k), -np.inf)
        self.pairs = 0

    def floor(self) -> np.ndarray:
        """What a pair must reach, less a margin for rounding; ``least`` is known to be reached by k pairs."""
        last = self.best[:, -1]
        return np.maximum(self.least, np.where(np.isfinite(last), last - 1e-9 * (1 + np.abs(last)), -np.inf))

    def add(self, ids: np.ndarray, x: np.ndarray) -> bool:
        """False once neither this block nor a later one can change anything."""
        length = np.linalg.norm(x, axis=1)
        need = self.floor()
        rows = np.flatnonzero(self.length * (length.max() if len(x) else 0) >= need)
        if not len(rows):
            return False
        cols, done, part = np.arange(len(x)), 0, np.zeros((len(rows), len(x)))
        for h, rest in zip(self.heads, self.rest):
            part += self.q[rows, done:h] @ x[cols, done:h].T
            done = h
            bound = part + rest[rows][:, None] * np.linalg.norm(x[cols, h:], axis=1)[None, :]
            alive = bound >= need[rows][:, None]
            r, c = alive.any(axis=1), alive.any(axis=0)
            rows, cols, part = rows[r], cols[c], part[np.ix_(r, c)]
            if not part.size:
                return True
        part += self.q[rows, done:] @ x[cols, done:].T
        self.pairs += part.size
        score = np.where(self.ids[rows][:, None] == ids[cols][None, :], -np.inf, part)
        both_ids = np.concatenate([self.best_ids[rows], np.broadcast_to(ids[cols], score.shape)], axis=1)
        got = keep_best(both_ids, np.concatenate([self.best[rows], score], axis=1), self.k)
        self.best_ids[rows], self.best[rows] = got
        return True


def top_inner_products(vectors: DataFrame, k: int = 10, queries: DataFrame | None = None) -> DataFrame:
    """(vec_id, neighbor_id, score, rank): for every query the k others of largest inner product, exactly.

    ``queries`` has the columns of ``vectors`` and defaults to it. Ties go to the lesser id; a row of the query's own id is
    not its neighbour. A zero vector has score 0 with all. Fewer than k others give fewer rows;
    one vector or none, no row. What counts as a vector is told by ``vectors.clean``; other columns
    are not read.
    """
    spark = prepare(vectors.sparkSession)
    with Workspace(spark, "topk") as ws:
        rows = ws.save(clean(vectors), "vectors")
        first = rows.select(F.size("embedding")).first()
        if not first:
            return spark.createDataFrame([], TOP_SCHEMA + ", rank int")
        d = first[0]
        held = spark.sparkContext.broadcast(rotation(rows, d))
        heads = tuple(sorted({max(1, d // 4), max(1, d // 2)}))
        length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, parts = [], []

            def close() -> pa.RecordBatch:
                a, x = np.concatenate(ids), np.concatenate(parts)
                ids.clear(), parts.clear()
                return pa.RecordBatch.from_pydict({"longest": [float(np.linalg.norm(x, axis=1).max())], "number": pa.array([int(a[0])], pa.int64()), "ids": [a.tobytes()], "x": [x.tobytes()]})

            for batch in batches:
                x = matrix(batch.column("embedding"))
                for a in range(0, len(x), BLOCK):
                    ids.append(batch.column("vec_id").to_numpy()[a : a + BLOCK])
                    parts.append(x[a : a + BLOCK] @ held.value)
                    if sum(map(len, ids)) >= BLOCK:
                        yield close()
            if ids and sum(map(len, ids)):
                yield close()

        def blocks(of: DataFrame, name: str) -> DataFrame:
            """(longest, number, ids, x): blocks by descending length; ``number`` is a vector's id, each block's own."""
            count = of.count()
            ranged = of.withColumn("length", length).repartitionByRange(max(1, min(shuffle_partitions(spark), -(-count // BLOCK))), F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
            return ws.save(ranged.select("vec_id", "embedding").mapInArrow(pack, "longest double, number bigint, ids binary, x binary"), name)

        items = blocks(rows, "blocks")
        asked = items if queries is None else blocks(clean(queries, d), "asked")
        n_items, n_asked = items.count(), asked.count()
        if not n_asked:
            return spark.createDataFrame([], TOP_SCHEMA + ", rank int")

        def read(ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
            return np.frombuffer(ids, np.int64), np.frombuffer(x, np.float64).reshape(-1, d)

        longest = items.orderBy(F.desc("longest"), "number").select("ids", "x").first()  # one block: BLOCK vectors
        head = spark.sparkContext.broadcast((bytes(longest.ids), bytes(longest.x)))

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    walk = Walk(*read(r["ids"], r["x"]), k, heads)
                    walk.add(*read(*head.value))
                    floor = walk.floor()
                    with np.errstate(divide="ignore", invalid="ignore"):
                        least = np.where(walk.length > 0, floor / walk.length, np.where(floor > 0, np.inf, -np.inf))
                    yield pa.RecordBatch.from_pydict({"number": pa.array([r["number"]], pa.int64()), "need": [float(least.min())], "longest": [r["longest"]], "ids": [r["ids"]], "x": [r["x"]], "least": [floor.tobytes()]})

        started = ws.save(asked.mapInArrow(start, "number bigint, need double, longest double, ids binary, x binary, least binary"), "started")
        size = max(GROUP, -(-n_asked // MAX_GROUPS))
        n_groups = -(-n_asked // size)
        # vectors' blocks are dealt out over lanes where there are few groups of queries
        lanes = max(1, min(n_items, -(-shuffle_partitions(spark) // n_groups)))
        # queries that need about the same blocks make a group
        by_need = F.row_number().over(Window.orderBy("need", "number")) - 1
        grouped = ws.save(started.select("number", "need").withColumn("group", F.floor(by_need / size).cast("long")), "groups")  # one row a block
        limits = grouped.groupBy("group").agg(F.min("need").alias("need"))  # at most MAX_GROUPS rows
        by_length = F.row_number().over(Window.orderBy(F.desc("longest"), "number")) - 1
        numbered = ws.save(items.select("number", F.pmod(by_length, F.lit(lanes)).cast("long").alias("lane")), "lanes")  # one row a block
        sent = items.join(numbered, "number").join(F.broadcast(limits), F.col("longest") >= F.col("need")).select("group", "lane", F.lit(1).alias("kind"), F.col("longest"), "number", "ids", "x", F.lit(None).cast("binary").alias("least"))
        own = started.join(grouped.select("number", "group"), "number").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).select("group", F.col("lane").cast("long").alias("lane"), F.lit(0).alias("kind"), "longest", "number", "ids", "x", "least")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, parts in group_rows(batches, "task"):
                walks: list[Walk] = []
                for part in parts:  # sorted: the queries' blocks come first, then vectors' by length
                    for r in part.to_pylist():
                        if r["least"] is not None:
                            walks.append(Walk(*read(r["ids"], r["x"]), k, heads, np.frombuffer(r["least"], np.float64)))
                            continue
                        for walk in walks:
                            walk.on = walk.on and walk.add(*read(r["ids"], r["x"]))
                for walk in walks:
                    yield top_batch(walk.ids, walk.best_ids, walk.best)

        tasks = own.unionByName(sent).withColumn("task", F.col("group") * lanes + F.col("lane")).repartition(max(1, min(1 << 16, n_groups * lanes)), "task").sortWithinPartitions("task", "kind", F.desc("longest"), "number")
        found = tasks.select("task", "ids", "x", "least").mapInArrow(search, TOP_SCHEMA)
        order = Window.partitionBy("vec_id").orderBy(F.desc("score"), "neighbor_id")
        return ws.result(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
