"""Token counts by heap-and-linked-list byte-pair merging.

A piece is a doubly linked list of byte symbols; a heap holds its mergeable adjacent pairs by rank,
then place. The lowest is popped and merged, and the pairs that arise with its neighbours are
pushed, until none is left. The count of a piece is its symbols less its merges; no ids come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.bpe import Merger, distinct_pieces, merger, piece_starts, vocabulary_path
from quern.llm.common import passes
from quern.runtime import prepare

#: Pieces whose counts a worker remembers.
CACHE_PIECES = 1_000_000


def heap_merge(symbols: list[int], pairs: dict[int, int]) -> tuple[int, list[int]]:
    """(number of merges, symbols that are left)."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = pairs.get(symbols[i] << 32 | symbols[i + 1])
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapify(heap)
    merges = 0
    while heap:
        rank, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = rank, -1
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = pairs.get(rank << 32 | symbols[k])
            if found is not None:
                heappush(heap, (found, i, rank, symbols[k]))
        p = before[i]
        if p >= 0:
            found = pairs.get(symbols[p] << 32 | rank)
            if found is not None:
                heappush(heap, (found, p, symbols[p], rank))
    return merges, [s for s in symbols if s >= 0]


def heap_count(piece: bytes, byte_ids: list[int], pairs: dict[int, int]) -> int:
    """Tokens of one piece: initial symbols minus merges."""
    return len(piece) - heap_merge([byte_ids[b] for b in piece], pairs)[0]


class Counter:
    """Counts tokens of batches, with a cache of counts by piece."""

    def __init__(self, tool: Merger):
        self.pairs, self.byte_ids = tool.pairs, tool.byte_ids.tolist()
        self.cache: dict[bytes, int] = {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        _, _, where, back = distinct_pieces(data, starts, ends)
        blob, cache, counts = data.tobytes(), self.cache, np.empty(len(where), np.int64)
        if len(cache) > CACHE_PIECES:
            cache.clear()
        for k, (a, b) in enumerate(zip(starts[where].tolist(), ends[where].tolist())):
            piece = blob[a:b]
            n = cache.get(piece)
            if n is None:
                n = heap_count(piece, self.byte_ids, self.pairs)
                if b - a <= 64:
                    cache[piece] = n
            counts[k] = n
        total = np.concatenate(([0], np.cumsum(counts[back])))
        return np.diff(total[np.searchsorted(starts, offsets)])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(merger(path))
    return _counters[path]


def count_array(column: pa.Array, tool: Counter) -> pa.Array:
    parts = [tool(data, offsets) for _, _, data, offsets in passes(column)]
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64(), mask=~column.is_valid().to_numpy(zero_copy_only=False))


def count_column(text: Column, path: str) -> Column:
    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = counter(path)
        for batch in batches:
            yield count_array(batch, tool)

    return run(text)


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each text in ``into`` (replaced if there).

    Null gives null and an empty text 0. Rows, ties and other columns stay as they are.
    """
    prepare(docs.sparkSession)
    return docs.withColumn(into, count_column(F.col(text).cast("string"), path or vocabulary_path()))
