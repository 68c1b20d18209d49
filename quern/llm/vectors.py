"""What the vector searches share: clean vectors, packed blocks and the merging of top-k lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_SCHEMA = "vec_id bigint, neighbor_id bigint, score double"


def clean(vectors: DataFrame, d: int | None = None) -> DataFrame:
    """(vec_id, embedding of doubles), one row an id.

    Rows with a null id, with a null, empty or other-sized embedding than most (or than ``d``), or with a
    null or non-finite number in it are left out; of several embeddings of one id the least stays.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).dropna()
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = rows.filter((F.size("embedding") > 0) & ~F.exists("embedding", bad))
    if d is None:
        usual = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
        d = usual[0] if usual else 0
    rows = rows.filter(F.size("embedding") == d)
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as a 2-D array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def keep_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k best columns by score, ties by lesser id, in order. Missing entries have id -1 << 62."""
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        most = int((scores >= edge[:, None]).sum(axis=1).max())
        some = np.argpartition(-scores, min(most, scores.shape[1]) - 1, axis=1)[:, :most]
        ids, scores = np.take_along_axis(ids, some, 1), np.take_along_axis(scores, some, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def top_batch(vec_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    real = np.isfinite(scores)
    rows = np.repeat(vec_ids, real.sum(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(ids[real]), pa.array(scores[real].astype(np.float64))], names=["vec_id", "neighbor_id", "score"])


def group_rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Stretches of consecutive rows with equal keys, as slices of the batches."""
    from itertools import groupby

    def slices() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            keys = batch.column(key).to_numpy()
            cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *cut], [*cut, len(keys)]):
                if b > a:
                    yield int(keys[a]), batch.slice(a, b - a)

    for value, parts in groupby(slices(), key=lambda x: x[0]):
        yield value, (part for _, part in parts)
