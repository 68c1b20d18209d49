"""Approximate nearest neighbours by cosine with a permutation index.

Each vector is represented by its nearest pivots in order. Vectors are filed in shards by their nearest
pivot, and in a shard each pivot has an inverted file of the vectors that have it among their POST nearest,
with the ranks. A query goes to the shards of its own POST nearest pivots, walks those pivots' files
there, and ranks what it meets by the footrule distance over these heads of the two orders (a pivot
missing in an order counts as rank POST). The footrule distance over PREFIX pivots orders the best of
these anew, and the best of that order are compared exactly.

For location-bounded orders the footrule distance is a constant less twice the sum, over shared
pivots, of ``prefix - max(rank, rank')``, so only files that a query shares are touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import list_array, uniform
from quern.llm.vectors import TOP_SCHEMA, clean, group_rows, keep_best, matrix, top_batch
from quern.runtime import Workspace, prepare

#: Vectors of a shard at most, but for chance; and of what a query meets there, the shares that are ranked by
#: the longer orders and that are compared exactly, and their least numbers.
SHARD = 16_384
RANKED, RERANKED = (0.12, 128), (0.03, 64)
#: Pivots grow with the root of the number of vectors, up to a set that every task can hold.
MAX_PIVOTS = 8_192
POST, PREFIX = 128, 512


def sizes(n: int) -> tuple[int, int, int]:
    """(pivots, places of a vector in inverted files, length of an order) for n vectors."""
    pivots = max(1, min(n, MAX_PIVOTS, max(512, math.ceil(4 * math.sqrt(n)))))
    return pivots, min(POST, pivots), min(PREFIX, pivots)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots, nearest first; ties by number."""
    near = x @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int16)


def place(pivots: np.ndarray, held: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, shards) of each pivot, for the numbers of vectors that are nearest to them.

    Pivots are halved along their main direction until the vectors of a part fit a shard. A pivot with
    more than that gets as many shards of its own as its vectors fill.
    """
    first, many = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    todo, shard = [np.arange(len(pivots))], 0
    while todo:
        part = todo.pop()
        total = int(held[part].sum())
        if len(part) == 1 or total <= room:
            first[part], many[part] = shard, max(1, -(-total // room))
            shard += int(many[part[0]])
            continue
        x = pivots[part] - pivots[part].mean(axis=0)
        along = np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")
        half = int(np.clip(np.searchsorted(np.cumsum(held[part[along]]), total / 2), 1, len(part) - 1))
        todo += [part[along[half:]], part[along[:half]]]
    return first, many


class Shard:
    """Inverted files of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, order: np.ndarray, pivots: int, post: int):
        self.ids, self.x, self.order, self.post = ids, x, order, min(post, order.shape[1])
        self.pivots = pivots
        flat = order[:, : self.post].ravel()
        by = np.argsort(flat, kind="stable")
        self.who = (by // self.post).astype(np.int32)
        self.weight = (self.post - by % self.post).astype(np.int16)
        self.bounds = np.searchsorted(flat[by], np.arange(pivots + 1))

    def nearest_by_footrule(self, order: np.ndarray, best: int, ranked: int) -> np.ndarray:
        """The ``best`` by footrule over whole orders among the ``ranked`` nearest by footrule over their heads."""
        n = len(self.ids)
        shared = np.zeros(n, np.int32)
        for p, w in zip(order[: self.post], range(self.post, 0, -1)):
            a, b = self.bounds[p], self.bounds[p + 1]
            shared[self.who[a:b]] += np.minimum(self.weight[a:b], w)
        some = np.argpartition(shared, n - ranked)[n - ranked :] if ranked < n else np.arange(n)
        size = self.order.shape[1]
        mine = np.zeros(self.pivots, np.int16)  # what a pivot's rank leaves of the order's length
        mine[order] = np.arange(size, 0, -1)
        whole = np.minimum(mine[self.order[some]], np.arange(size, 0, -1, dtype=np.int16)).sum(axis=1, dtype=np.int32)
        return some[np.argpartition(whole, len(some) - best)[len(some) - best :]] if best < len(some) else some

    def search(self, ids: np.ndarray, q: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Best k by cosine among the nearest by footrule, the query itself left out."""
        n = len(self.ids)
        ranked, best = (max(k + 1, least, math.ceil(share * n)) for share, least in (RANKED, RERANKED))
        out_ids, out = np.full((len(q), k), -1 << 62), np.full((len(q), k), -np.inf)
        for i in range(len(q)):
            some = self.nearest_by_footrule(order[i], best, ranked)
            some = some[self.ids[some] != ids[i]]
            if len(some):
                kept, score = keep_best(self.ids[some][None, :], (self.x[some] @ q[i])[None, :], k)
                out_ids[i, : kept.shape[1]], out[i, : kept.shape[1]] = kept, score
        return out_ids, out


def nearest(vectors: DataFrame, k: int = 10, queries: DataFrame | None = None, seed: int = 5) -> DataFrame:
    """(vec_id, neighbor_id, score, rank): for every query its k approximately nearest others by cosine.

    ``queries`` has the columns of ``vectors`` and defaults to it; every row of ``vectors`` is in the index.
    The pivots are a sample of it, by a hash of the id, whose size ``sizes`` gives; they, and how many
    vectors each has, are all that the driver gets. A zero vector has cosine 0 with all. Ties go to the
    lesser id; equal vectors under several ids are neighbours of each other, and a row of the query's own id is not its
    neighbour. Fewer than k others give fewer rows; one vector or none, no row.
    What counts as a vector is told by ``vectors.clean``; other columns are not read.
    """
    spark = prepare(vectors.sparkSession)
    with Workspace(spark, "permutation") as ws:
        rows = ws.save(clean(vectors), "vectors")
        n = rows.count()
        if not n:
            return spark.createDataFrame([], TOP_SCHEMA + ", rank int")
        m, post, prefix = sizes(n)
        picked = rows.orderBy(uniform(F.col("vec_id"), seed), "vec_id").limit(m).collect()
        pivots = unit(np.array([r.embedding for r in picked], float)).astype(np.float32)
        d = pivots.shape[1]
        held = spark.sparkContext.broadcast(pivots)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = unit(matrix(batch.column("embedding"))).astype(np.float32)
                nearest_one = (x @ held.value.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), list_array(x.ravel(), np.full(len(x), d)), pa.array(nearest_one.astype(np.int32))], names=["vec_id", "x", "pivot"])

        filed = ws.save(rows.mapInArrow(near, "vec_id bigint, x array<float>, pivot int"), "filed")
        counts = np.zeros(m, np.int64)
        for r in filed.groupBy("pivot").count().collect():  # one row a pivot
            counts[r.pivot] = r["count"]
        first, many = place(pivots, counts, SHARD)
        placed = spark.sparkContext.broadcast((first, many))
        draw = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 31))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, many = placed.value
            for batch in batches:
                pivot = batch.column("pivot").to_numpy()
                shard = first[pivot] + batch.column("draw").to_numpy() % many[pivot]
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.zeros(len(shard), np.int32)), batch.column("vec_id"), batch.column("x")], names=["shard", "asked", "vec_id", "x"])

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, many = placed.value
            for batch in batches:
                x = unit(matrix(batch.column("embedding"))).astype(np.float32)
                if not len(x):
                    continue
                order = orders(x, held.value, post)
                lists = [np.unique(np.concatenate([np.arange(first[p], first[p] + many[p]) for p in o])) for o in order]
                row = np.repeat(np.arange(len(x)), list(map(len, lists)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), pa.array(np.ones(len(row), np.int32)), batch.column("vec_id").take(pa.array(row)), list_array(x[row].ravel(), np.full(len(row), d))], names=["shard", "asked", "vec_id", "x"])

        kinds = "shard bigint, asked int, vec_id bigint, x array<float>"
        items = filed.withColumn("draw", draw).mapInArrow(route, kinds)
        sent = (rows if queries is None else clean(queries, d)).mapInArrow(ask, kinds)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, parts in group_rows(batches, "shard"):
                mine, index = [], None
                for part in parts:  # sorted: the shard's own vectors come first
                    ids, x, asked = part.column("vec_id").to_numpy(), matrix(part.column("x")), part.column("asked").to_numpy() > 0
                    if not asked.all():
                        mine.append((ids[~asked], x[~asked]))
                    if asked.any() and mine:
                        if index is None:
                            own, own_x = (np.concatenate(p) for p in zip(*mine))
                            index = Shard(own, own_x, orders(own_x, held.value, prefix), m, post)
                        yield top_batch(ids[asked], *index.search(ids[asked], x[asked], orders(x[asked], held.value, prefix), k))

        n_shards = int((first + many).max())
        found = items.unionByName(sent).repartition(min(n_shards, 1 << 16), "shard").sortWithinPartitions("shard", "asked").mapInArrow(search, TOP_SCHEMA)
        order = Window.partitionBy("vec_id").orderBy(F.desc("score"), "neighbor_id")
        return ws.result(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))
