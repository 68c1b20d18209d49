"""Vectorised text primitives for the operators of this subpackage (numpy over Arrow buffers)."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
_R = U64(0x9E3779B97F4A7C15 | 1)
_RINV = U64(pow(int(_R), -1, 1 << 64))
#: Bytes of text that one numpy pass handles; a longer text makes a pass of its own.
PASS_BYTES = 500_000

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), _R if kind == "r" else _RINV, U64)
        out[0] = 1
        have = _powers[kind] = np.multiply.accumulate(out)
        if n > 8 * PASS_BYTES:  # don't keep what one huge text needed
            _powers.pop(kind)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on all input bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Polynomials modulo 2 ** 64 take some long ranges of two values for one another (Thue-Morse words from some
#: 1,000 values on); ranges from LONG on also count by two polynomials modulo a prime, which do not.
LONG, PRIME, BASES = 128, (1 << 31) - 1, (1_103_515_245, 998_244_353)


def _residues(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo PRIME."""
    out, have, step = np.ones(n, U64), 1, base
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * U64(step) % U64(PRIME)
        have, step = have + more, step * step % PRIME
    return out


def _prime_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62 bits by polynomials modulo PRIME for each range."""
    n, small, out = len(values), (mix(values.astype(U64) + U64(1)) >> U64(34)) + U64(1), np.zeros(len(starts), U64)
    for base in BASES:
        prefix = np.zeros(n + 1, U64)
        np.cumsum(small * _residues(base, n) % U64(PRIME), out=prefix[1:])
        back = _residues(pow(base, -1, PRIME), n + 1)[starts]
        out = out << U64(31) | (prefix[ends] - prefix[starts]) % U64(PRIME) * back % U64(PRIME)
    return out


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair, in one prefix sum; equal ranges hash alike anywhere."""
    n = len(values)
    prefix = np.zeros(n + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * _power("r", n), out=prefix[1:])
    back = _power("i", n + 1)[starts]
    sizes = ends - starts
    out = (prefix[ends] - prefix[starts]) * back + sizes.astype(U64) * U64(0xD6E8FEB86659FD93)
    long = np.flatnonzero(sizes >= LONG)
    if len(long):
        out[long] += mix(_prime_hashes(values, starts[long], ends[long]))
    return mix(out)


def passes(column: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, byte offsets of the rows) over a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True inside each row: starts, ends, runs per row."""
    n = len(member)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    edge = offsets[(offsets > 0) & (offsets < n)]
    first = member.copy()
    first[1:] &= ~member[:-1]
    first[edge] = member[edge]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last[edge - 1] = member[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are maximal runs of bytes other than ASCII white space."""
    return spans(~IS_SPACE[data], offsets)


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII and two-byte Latin-1 capitals to lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[accented] += 32
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    step = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep].astype(np.int64), lengths[keep].astype(np.int64)
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    step[0] = s[0]
    step[at[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(step)


def trimmed(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` for ``mapInArrow``; its memory goes back to the system when a task ends, for workers live on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


def binary_array(parts: np.ndarray, width: int) -> pa.Array:
    """Rows of a 2-D array as a binary column without a Python loop."""
    rows = parts.shape[0]
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(np.arange(0, (rows + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(parts).tobytes())])


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def keys_in(big: DataFrame, keys: DataFrame, on: str, how: str = "left_semi", limit: int = 200_000) -> DataFrame:
    """``big`` semi- or anti-joined with ``keys``, which must be a stored table: broadcast when it
    counts at most ``limit`` rows, else shuffled."""
    return big.join(F.broadcast(keys) if keys.count() <= limit else keys, on, how)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns (of any letter case), as long and string: other columns can't clash with an operator's own."""
    kinds = {"text": "string", "lang": "string", "source": "string"}
    return df.select(*[F.col(f"`{c}`").cast(kinds.get(c, "bigint")).alias(c) for c in columns])


def uniform(column: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed alone."""
    return (F.xxhash64(column, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")
