"""Token-ID output as wavelet matrices, one for each shard of documents.

The ids of a shard's texts, end to end, are stored as bit-planes from the highest bit down; each plane
holds the bits of the ids in the order that the stable partition by the planes above left them in. With
the running counts of ones, rank and select on the planes give access to any token, the count of a
token in any range and the place of its k-th occurrence, from one compressed file.

A file holds its planes in frames of FRAME bits, each compressed on its own, after a head with every
frame's size and the ones before it. A look-up reads the head once, and then for each rank or bit the one frame
of a plane that holds the place.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.bpe import merger, vocabulary_path
from quern.llm.common import passes, plain
from quern.runtime import prepare

MAGIC = b"WVM2"
#: Tokens after which a shard closes: with the last text of the numpy pass that reaches them.
SHARD_TOKENS = 1 << 21
#: Bits of a plane's frame, and bytes of it.
FRAME = 1 << 15
FRAME_BYTES = FRAME // 8


class BitPlane:
    """Bits with rank and select over a directory of the ones before each frame; frames are opened when needed."""

    def __init__(self, size: int, directory: np.ndarray, load: Callable[[int], bytes] | None = None, packed: np.ndarray | None = None):
        self.size, self.directory, self.load = size, directory, load
        self.ones = int(directory[-1])
        frames = len(directory) - 1
        self.packed = np.zeros(frames * FRAME_BYTES, np.uint8)
        self.before = np.zeros((frames, FRAME_BYTES), np.uint16)  # ones before each byte of its frame
        self.opened = np.zeros(frames, bool)
        if packed is not None:
            self.packed[: len(packed)] = packed
            self.load = lambda k: self.packed[k * FRAME_BYTES : (k + 1) * FRAME_BYTES].tobytes()

    @staticmethod
    def of(bits: np.ndarray) -> "BitPlane":
        packed = np.packbits(bits)
        padded = np.zeros(-(-len(packed) // FRAME_BYTES) * FRAME_BYTES, np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded.reshape(-1, FRAME_BYTES)).sum(axis=1, dtype=np.int64)
        return BitPlane(len(bits), np.concatenate(([0], np.cumsum(ones))), packed=packed)

    def _open(self, i: np.ndarray) -> None:
        for k in np.unique(i // FRAME):
            if k < len(self.opened) and not self.opened[k]:
                frame = np.frombuffer(self.load(int(k)), np.uint8)
                self.packed[k * FRAME_BYTES : k * FRAME_BYTES + len(frame)] = frame
                np.cumsum(np.bitwise_count(frame[:-1]), out=self.before[k, 1 : len(frame)], dtype=np.uint16)
                self.opened[k] = True

    def get(self, i: np.ndarray) -> np.ndarray:
        self._open(i)
        return (self.packed[i >> 3] >> (7 - (i & 7)).astype(np.uint8)) & 1

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        out = self.directory[np.minimum(i // FRAME, len(self.directory) - 1)].copy()
        inside = np.flatnonzero(i % FRAME)
        at = i[inside]
        self._open(at)
        byte = at >> 3
        head = np.bitwise_count(self.packed[byte] & (0xFF00 >> (at & 7)).astype(np.uint8))
        out[inside] += self.before.ravel()[byte].astype(np.int64) + head
        return out

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) one or zero: its frame by the directory, then binary search in that frame."""
        k = np.atleast_1d(np.asarray(k, np.int64))
        starts = np.arange(len(self.directory)) * FRAME
        upto = self.directory if bit else np.minimum(starts, self.size) - self.directory
        lo = (np.searchsorted(upto, k, "right") - 1) * FRAME
        hi = np.minimum(lo + FRAME - 1, self.size - 1)
        while (hi > lo).any():
            mid = (lo + hi) // 2
            ones = self.rank1(mid + 1)
            enough = (ones if bit else mid + 1 - ones) > k
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, np.minimum(mid + 1, hi))
        return lo


class WaveletMatrix:
    """Tokens of one shard; all look-ups take and give numpy arrays."""

    def __init__(self, planes: list[BitPlane], size: int, doc_ids: np.ndarray, lengths: np.ndarray, known: np.ndarray | None = None):
        self.planes, self.size, self.doc_ids = planes, size, doc_ids
        self.known = np.ones(len(doc_ids), bool) if known is None else known
        self.bounds = np.concatenate(([0], np.cumsum(lengths)))
        self.zeros = [size - p.ones for p in planes]

    @staticmethod
    def build(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, width: int | None = None, known: np.ndarray | None = None) -> "WaveletMatrix":
        """``known`` tells which documents have an id."""
        width = width or max(1, int(ids.max()).bit_length() if len(ids) else 1)
        now, planes = ids.astype(np.uint32 if width > 16 else np.uint16), []
        for k in range(width - 1, -1, -1):
            bits = ((now >> k) & 1).astype(bool)
            planes.append(BitPlane.of(bits))
            now = np.concatenate([now[~bits], now[bits]])
        return WaveletMatrix(planes, len(ids), np.asarray(doc_ids, np.int64), np.asarray(lengths, np.int64), known)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Tokens at these places."""
        i = np.atleast_1d(np.asarray(i, np.int64)).copy()
        if len(i) and (i.min() < 0 or i.max() >= self.size):
            raise IndexError("place outside the shard")
        out = np.zeros(len(i), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(i).astype(np.int64), plane.rank1(i)
            out = out << 1 | bit
            i = np.where(bit == 1, zeros + ones, i - ones)
        return out

    def _descend(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank1(np.array([start, stop]))
            one = token >> (len(self.planes) - 1 - k) & 1
            start, stop = (zeros + a, zeros + b) if one else (start - a, stop - b)
        return int(start), int(stop)

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token in [start, stop)."""
        a, b = self._descend(token, start, self.size if stop is None else stop)
        return b - a

    def select(self, token: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th (from 0) occurrences of a token."""
        a, b = self._descend(token, 0, self.size)
        k = np.atleast_1d(np.asarray(k, np.int64))
        if len(k) and (k.min() < 0 or k.max() >= b - a):
            raise IndexError("fewer occurrences than that")
        at = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - level) & 1
            at = self.planes[level].select(one, at - (self.zeros[level] if one else 0))
        return at

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def document(self, n: int) -> np.ndarray:
        """Ids of the shard's n-th document."""
        return self.access(np.arange(self.bounds[n], self.bounds[n + 1]))

    def names(self, documents: np.ndarray | None = None) -> pa.Array:
        """Ids of documents (all by default); null where one has none."""
        at = np.arange(len(self.doc_ids)) if documents is None else documents
        return pa.array(self.doc_ids[at], pa.int64(), mask=~self.known[at])

    def to_bytes(self, level: int = 1) -> bytes:
        """The head (counts; sizes of the frames of the documents' columns and of all planes; ones before each frame), then the frames."""
        pack = zstandard.ZstdCompressor(level=level).compress
        columns = [pack(x.tobytes()) for x in (self.doc_ids, np.diff(self.bounds), self.known)]
        frames = [pack(p.load(k)) for p in self.planes for k in range(len(p.directory) - 1)]
        sizes = np.array([len(f) for f in columns + frames], np.uint32)
        ones = np.concatenate([p.directory for p in self.planes])
        head = pack(sizes.tobytes() + ones.tobytes())
        return struct.pack("<4sIQQQ", MAGIC, len(self.planes), self.size, len(self.doc_ids), len(head)) + head + b"".join(columns + frames)

    @staticmethod
    def open(read: Callable[[int, int], bytes]) -> "WaveletMatrix":
        """Look-ups in a file of which ``read(offset, size)`` gives bytes; the planes' frames are read as they are needed."""
        start = struct.calcsize("<4sIQQQ")
        magic, width, size, documents, head_size = struct.unpack("<4sIQQQ", read(0, start))
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        unpack = zstandard.ZstdDecompressor().decompress
        head, per = unpack(read(start, head_size)), -(-size // FRAME)
        sizes = np.frombuffer(head, np.uint32, 3 + width * per).astype(np.int64)
        ones = np.frombuffer(head, np.int64, width * (per + 1), offset=4 * len(sizes)).reshape(width, per + 1)
        at = start + head_size + np.cumsum(sizes) - sizes
        frame = lambda k: unpack(read(int(at[k]), int(sizes[k])))
        planes = [BitPlane(size, ones[p], lambda k, p=p: frame(3 + p * per + k)) for p in range(width)]
        columns = [np.frombuffer(frame(k), kind) for k, kind in enumerate((np.int64, np.int64, bool))] if documents else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        return WaveletMatrix(planes, size, columns[0], columns[1], columns[2])

    @staticmethod
    def from_bytes(blob: bytes) -> "WaveletMatrix":
        return WaveletMatrix.open(lambda offset, size: blob[offset : offset + size])


SHARD_SCHEMA = "shard string, doc_ids array<bigint>, n_tokens bigint, payload binary"


def shards(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each shard: (shard, doc_ids, n_tokens, payload), the payload being the whole file.

    A shard is a run of rows of one input partition, some ``shard_tokens`` long; nothing is shuffled. Texts of null are left
    out, empty texts are documents without tokens, null ids stay null, and a text longer than
    ``shard_tokens`` makes a shard of its own length. Other columns are not read.
    """
    prepare(docs.sparkSession)
    path = path or vocabulary_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, part, done = merger(path), TaskContext.get().partitionId(), 0
        width = max(1, (len(tool.tokens) - 1).bit_length())
        ids, names, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal done, held
            doc = pa.concat_arrays(names)
            matrix = WaveletMatrix.build(np.concatenate(ids), pa.compute.fill_null(doc, 0).to_numpy(zero_copy_only=False), np.concatenate(lengths), width, doc.is_valid().to_numpy(zero_copy_only=False))
            row = {"shard": pa.array([f"{part:06d}-{done:04d}"]), "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(doc)], pa.int32()), doc), "n_tokens": pa.array([matrix.size], pa.int64()), "payload": pa.array([matrix.to_bytes()], pa.binary())}
            ids.clear(), names.clear(), lengths.clear()
            done, held = done + 1, 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            doc_ids = batch.column("doc_id")
            for i, j, data, offsets in passes(batch.column("text")):
                got, counts = tool.encode(data, offsets)
                ids.append(got), names.append(doc_ids.slice(i, j - i)), lengths.append(counts)
                held += len(got)
                if held >= shard_tokens:
                    yield close()
        if names:
            yield close()

    return plain(docs, "doc_id", "text").filter("text is not null").mapInArrow(write, SHARD_SCHEMA)


def export(shard_rows: DataFrame, folder: str) -> DataFrame:
    """Write each payload to ``folder``/<shard>.wvm on any file system pyarrow knows; gives (shard, file, bytes).

    A file is written under another name and then moved, so that a task that runs again is harmless.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
                unfinished, name = f"{root}/.{shard}-{uuid4().hex}", f"{root}/{shard}.wvm"
                with system.open_output_stream(unfinished) as out:
                    out.write(payload)
                system.move(unfinished, name)
                yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "bytes": pa.array([len(payload)], pa.int64())})

    return shard_rows.select("shard", "payload").mapInArrow(write, "shard string, file string, bytes bigint")


def occurrences(shard_rows: DataFrame, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of a token, by select on each shard."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                matrix = WaveletMatrix.from_bytes(payload.as_py())
                at = matrix.occurrences(token)
                doc = np.searchsorted(matrix.bounds, at, "right") - 1
                yield pa.RecordBatch.from_arrays([matrix.names(doc), pa.array(at - matrix.bounds[doc])], names=["doc_id", "place"])

    return shard_rows.select("payload").mapInArrow(find, "doc_id bigint, place bigint")


def count(shard_rows: DataFrame, token: int) -> DataFrame:
    """(shard, n): occurrences of a token in each shard, by rank."""

    @F.arrow_udf("bigint")
    def ranked(payloads: pa.Array) -> pa.Array:
        return pa.array([WaveletMatrix.from_bytes(p.as_py()).count(token) for p in payloads], pa.int64())

    return shard_rows.select("shard", ranked("payload").alias("n"))
