"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are split into pieces by the vocabulary's public pattern, worked out on character classes. Every
distinct piece of a batch becomes a row of byte symbols in a matrix of its length bucket. In each
round every row merges its leftmost pair of least rank, found by hashed lookup of the pair, and the
row is compacted; rows without a pair are done. Decoding concatenates the ids' bytes.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import list_array, mix, passes, ragged
from quern.runtime import prepare

#: Rows of a matrix: length buckets end at these byte counts; longer pieces are merged by the heap.
LENGTHS = (4, 8, 12, 16, 24, 32, 64, 128, 256)
CACHE_PIECES = 400_000
#: Ids that the cache holds at most before it starts anew.
CACHE_IDS = 8 * CACHE_PIECES

PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the public vocabulary lies: QUERN_TOKENIZERS, the installed package, or /opt/tokenizers."""
    folder = os.environ.get("QUERN_TOKENIZERS")
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"
    return os.path.join(folder, name)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of their ids from a rank file."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


# ---- pieces ------------------------------------------------------------------------------------

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
_classes: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """The pattern's class of every code point."""
    if not _classes:
        import regex

        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, points):
                a, b = m.span()
                a, b = (x + 0x800 if x >= 0xD800 else x for x in (a, b))
                table[a:b] = kind
        _classes.append(table)
    return _classes[0]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which pieces start, over rows of UTF-8 text laid end to end."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)  # first bytes of characters
    if not len(at):
        return at
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = character_classes()[points]
    n = len(points)
    head = np.zeros(n + 1, bool)  # a row starts here
    head[np.searchsorted(at, offsets)] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= head[:n]
    start = change & (kind != SPACE)
    blank = points == 32
    # one space before a run of another class belongs to that run
    joined = np.flatnonzero(start[1:] & blank[:-1] & ~head[1:n]) + 1
    start[joined] = False
    start[joined - 1] = True
    space = kind == SPACE
    first_space = change & space
    # the last white space before a run stands alone unless it is the space that joined the run
    last_space = space.copy()
    last_space[:-1] &= ~space[1:] | head[1:n]
    before_run = last_space.copy()
    before_run[-1:] = False
    before_run[:-1] &= ~head[1:n]
    start |= first_space | before_run
    # contractions: a lone apostrophe at a piece start takes the letters that follow it
    quote = np.flatnonzero((points == 39) & start & change)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~head[quote + 1]]
    if len(quote):
        one = points[quote + 1]
        room = (quote + 2 < n) & ~head[np.minimum(quote + 2, n)]
        two = np.where(room, points[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 1, np.where(long, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + 1 + size
        inside = rest < n
        rest = rest[inside]
        more = (kind[rest] == LETTER) & ~head[rest]
        start[rest[more]] = True
    return at[start]


#: Bytes of a piece that is held whole in WORDS words; a longer one is told apart from others of its pass by its bytes.
SHORT = 31
WORDS = (SHORT + 1) // 8


def distinct_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each piece, their hash, one piece of each kind, the kind of each piece), by all bytes of the pieces.

    The words of a piece up to SHORT bytes are its bytes and, as the last byte, its size; those of a longer one
    are its number among such pieces and 255.
    """
    sizes = ends - starts
    padded = np.zeros(len(data) + SHORT + 1, np.uint8)
    padded[: len(data)] = data
    block = np.lib.stride_tricks.sliding_window_view(padded, SHORT + 1)[starts]
    block *= np.arange(SHORT + 1) < sizes[:, None]
    block[:, SHORT] = np.minimum(sizes, 255)
    words = block.view(np.uint64)
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        seen: dict[bytes, int] = {}
        words[long] = 0
        words[long, 0] = [seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        block[long, SHORT] = 255
    key = words[:, 0]
    for k in range(1, WORDS):
        key = mix(key) + words[:, k]
    key = mix(key)
    _, where, back = np.unique(key, return_index=True, return_inverse=True)
    if (words[where][back] != words).any():  # one hash for two pieces: then every piece is a kind of its own
        where = back = np.arange(len(starts))
    return words, key, where, back


# ---- merging -----------------------------------------------------------------------------------


class Merger:
    """Pairs of ids in an open-addressing hash table, and what is needed to encode and decode."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        known = {t: i for i, t in enumerate(tokens) if t}
        if any(bytes([b]) not in known for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.byte_ids = np.array([known[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for i, token in enumerate(tokens):
            for k in range(1, len(token)):
                a, b = known.get(token[:k]), known.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.pairs = dict(zip(keys.tolist(), merged))
        self.bits = max(10, int(np.ceil(np.log2(len(keys) * 2.5 + 1))))
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.value = np.full(1 << self.bits, len(tokens), np.int64)
        slot = self._slot(keys)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):  # each free slot takes the first key that wants it
            self.probes += 1
            free = self.keys[slot[todo]] == np.uint64(0xFFFFFFFFFFFFFFFF)
            want = todo[free]
            _, one = np.unique(slot[want], return_index=True)
            put = want[one]
            self.keys[slot[put]], self.value[slot[put]] = keys[put], np.array(merged, np.int64)[put]
            todo = np.setdiff1d(todo, put)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        sizes = np.array([len(t) for t in tokens], np.int64)
        self.token_ends = np.cumsum(sizes)
        self.token_starts = self.token_ends - sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        #: Pieces by hash: their words, where their ids start in the pool and how many they are; the pool.
        self.cache: tuple[np.ndarray, ...] = (np.zeros(0, np.uint64), np.zeros((0, WORDS), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, len(tokens) where it doesn't merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.value[slot], len(self.tokens))
        todo = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found, mine = self.keys[slot], keys[todo]
            hit = found == mine
            out[todo[hit]] = self.value[slot[hit]]
            on = ~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))
            todo, slot = todo[on], slot[on]
        return out

    def merge_matrix(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of one bucket, merged in place, and how many there are."""
        none, lengths = len(self.tokens), lengths.copy()
        columns = np.arange(symbols.shape[1] - 1)
        live = np.arange(len(symbols))
        ranks = np.full((len(symbols), symbols.shape[1] - 1), none, np.int64)
        r, c = np.nonzero(columns[None, :] < (lengths - 1)[:, None])
        ranks[r, c] = self.rank(symbols[r, c], symbols[r, c + 1])
        while len(live):
            mine = ranks[live]
            best = mine.argmin(axis=1)  # the leftmost of the least
            least = mine[np.arange(len(live)), best]
            on = least < none
            live, best, least = live[on], best[on], least[on]
            if not len(live):
                break
            # compaction: what follows the pair moves one place left
            block = symbols[live]
            source = np.arange(symbols.shape[1])[None, :] + (np.arange(symbols.shape[1])[None, :] > best[:, None])
            np.minimum(source, symbols.shape[1] - 1, out=source)
            block = np.take_along_axis(block, source, axis=1)
            i = np.arange(len(live))
            block[i, best] = least
            symbols[live] = block
            lengths[live] -= 1
            source = columns[None, :] + (columns[None, :] > best[:, None])
            np.minimum(source, len(columns) - 1, out=source)
            old = np.take_along_axis(ranks[live], source, axis=1)
            size = lengths[live]
            old[columns[None, :] >= (size - 1)[:, None]] = none
            right = best < size - 1
            old[i[right], best[right]] = self.rank(block[i[right], best[right]], block[i[right], best[right] + 1])
            left = best > 0
            old[i[left], best[left] - 1] = self.rank(block[i[left], best[left] - 1], block[i[left], best[left]])
            ranks[live] = old
        return symbols, lengths

    def merge_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces end to end, ids per piece)."""
        sizes = ends - starts
        counts, parts = np.zeros(len(starts), np.int64), {}
        low = 0
        for high in LENGTHS:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for k in range(0, len(rows), max(1, 600_000 // high)):
                some = rows[k : k + max(1, 600_000 // high)]
                matrix = np.zeros((len(some), high), np.int64)
                inside = np.arange(high)[None, :] < sizes[some][:, None]
                matrix[inside] = self.byte_ids[data[ragged(starts[some], sizes[some])]]
                matrix, n = self.merge_matrix(matrix, sizes[some]) if high > 1 else (matrix, sizes[some])
                counts[some] = n
                parts[high, k] = (some, matrix[np.arange(high)[None, :] < n[:, None]])
        for i in np.flatnonzero(sizes > LENGTHS[-1]):
            from quern.llm.token_counts import heap_merge

            ids = np.array(heap_merge(self.byte_ids[data[starts[i] : ends[i]]].tolist(), self.pairs)[1], np.int64)
            counts[i] = len(ids)
            parts[-1, int(i)] = (np.array([i]), ids)
        out, base = np.zeros(int(counts.sum()), np.int32), np.cumsum(counts) - counts
        for rows, ids in parts.values():
            out[ragged(base[rows], counts[rows])] = ids
        return out, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows end to end, ids per row)."""
        starts = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        words, key, where, back = distinct_pieces(data, starts, ends)
        words, key = words[where], key[where]
        have, have_words, have_start, have_count, have_ids = self.cache
        at = np.minimum(np.searchsorted(have, key), max(0, len(have) - 1))
        hit = (have_words[at] == words).all(axis=1) if len(have) else np.zeros(len(key), bool)
        new = np.flatnonzero(~hit)
        fresh_ids, fresh_counts = self.merge_pieces(data, starts[where[new]], ends[where[new]])
        pool = np.concatenate([have_ids, fresh_ids])
        counts_of, start_of = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        if len(have):
            counts_of[hit], start_of[hit] = have_count[at[hit]], have_start[at[hit]]
        counts_of[new], start_of[new] = fresh_counts, len(have_ids) + np.cumsum(fresh_counts) - fresh_counts
        counts = counts_of[back]
        ids = pool[ragged(start_of[back], counts)]
        self._remember(key, words, start_of, counts_of, pool, new[ends[where[new]] - starts[where[new]] <= SHORT])
        row = np.searchsorted(starts, offsets)
        total = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(total[row])

    def _remember(self, key, words, start, count, pool, new) -> None:
        """Insert new pieces by hash; ids stay where they are in the pool until the cache starts anew."""
        have, have_words, have_start, have_count, _ = self.cache
        start, count = start[new], count[new]
        if len(have) + len(new) > CACHE_PIECES or len(pool) > CACHE_IDS:
            have, have_words, have_start, have_count = have[:0], have_words[:0], have_start[:0], have_count[:0]
            pool, start = pool[ragged(start, count)], np.cumsum(count) - count
        fresh, first = np.unique(key[new], return_index=True)
        at = np.searchsorted(have, fresh)
        lacking = at == len(have)
        lacking[~lacking] = have[at[~lacking]] != fresh[~lacking]
        fresh, first, at = fresh[lacking], first[lacking], at[lacking]
        self.cache = (np.insert(have, at, fresh), np.insert(have_words, at, words[new[first]], axis=0), np.insert(have_start, at, start[first]), np.insert(have_count, at, count[first]), pool)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows end to end, bytes per row)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.tokens)):
            raise ValueError("an id is outside the vocabulary")
        starts = self.token_starts[ids]
        sizes = self.token_ends[ids] - starts
        total = np.concatenate(([0], np.cumsum(sizes)))
        rows = np.concatenate(([0], np.cumsum(counts)))
        return self.token_bytes[ragged(starts, sizes)], np.diff(total[rows])


_mergers: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    """One merger for each vocabulary and process."""
    if path not in _mergers:
        _mergers[path] = Merger(read_ranks(path))
    return _mergers[path]


def encode_array(column: pa.Array, tool: Merger) -> pa.Array:
    """Lists of ids; null for null."""
    ids, counts = [], []
    for _, _, data, offsets in passes(column):
        i, c = tool.encode(data, offsets)
        ids.append(i)
        counts.append(c)
    out = list_array(np.concatenate(ids) if ids else np.zeros(0, np.int32), np.concatenate(counts) if counts else np.zeros(0, np.int64))
    return out if not column.null_count else pa.compute.if_else(column.is_valid(), out, pa.scalar(None, out.type))


def decode_array(column: pa.Array, tool: Merger) -> pa.Array:
    """Texts; null for null. Bytes that are no UTF-8 become U+FFFD."""
    counts = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    data, sizes = tool.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    blob = data.tobytes()
    texts = [blob[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())], pa.string())


def encode_column(text: Column, path: str) -> Column:
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = merger(path)
        for batch in batches:
            yield encode_array(batch, tool)

    return run(text)


def decode_column(ids: Column, path: str) -> Column:
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = merger(path)
        for batch in batches:
            yield decode_array(batch, tool)

    return run(ids)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text in ``into`` (replaced if there).

    Null gives null and an empty text an empty list. Rows, ties and other columns stay as they are.
    """
    prepare(docs.sparkSession)
    return docs.withColumn(into, encode_column(F.col(text).cast("string"), path or vocabulary_path()))


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", into: str = "text") -> DataFrame:
    """``rows`` with the text of each list of ids in ``into`` (replaced if there); null gives null, an id outside the vocabulary fails."""
    prepare(rows.sparkSession)
    return rows.withColumn(into, decode_column(F.col(ids).cast("array<int>"), path or vocabulary_path()))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): the ids of each text, and whether decoding them gives it back.

    One Python stage encodes and decodes. Null texts have null in all but doc_id.
    """
    prepare(docs.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = merger(path)
        for batch in batches:
            for i, j, data, offsets in passes(batch.column("text")):
                ids, counts = tool.encode(data, offsets)
                back, sizes = tool.decode(ids, counts)
                same = np.zeros(len(data) + 1, np.int64)
                if len(back) == len(data):
                    np.cumsum(back != data, out=same[1:])
                exact = (sizes == np.diff(offsets)) & (same[offsets[1:]] == same[offsets[:-1]]) if len(back) == len(data) else sizes == -1
                yes = pa.array(batch.column("text").slice(i, j - i).is_valid().to_numpy(zero_copy_only=False))
                blank = lambda a: pa.compute.if_else(yes, a, pa.scalar(None, a.type))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), blank(pa.array(counts)), blank(list_array(ids, counts)), blank(pa.array(exact))], names=["doc_id", "n_tokens", "ids", "exact"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids array<int>, exact boolean")
