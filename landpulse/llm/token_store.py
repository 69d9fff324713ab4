"""Token ids in binary shards, each a wavelet matrix in one compressed file.

A shard holds the ids of documents in ascending order. Its ids are renamed by
falling frequency and stored as bit planes, highest bit first, each plane in
the order that the planes above it leave. Counts of ones before each block of
a plane give rank and select, and with them access to a token, the count of
an id before a position and the place of its k-th occurrence; planes are
compressed one by one, so a reader opens those it needs.

File: MAGIC, the header's length (unsigned 32-bit little-endian), a JSON
header, then the sections that it lists by offset and length, each a zstd
frame.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import check_tokenizer, library_cache, texts_of, tokenizer_path
from .common import NO_ID, keyed, table, work_path, written
from .files import read_file, read_range, write_file

MAGIC = b"LPWM1\0"
#: Bits of a plane for which the ones before are counted.
BLOCK = 4096
#: A shard is closed once it holds so many ids; a document is never split.
SHARD = 2_000_000
#: The end of a document in the query's contract.
END = 1


class WaveletMatrix:
    """A sequence of ids with access, rank, count, select and occurrences."""

    def __init__(self, n: int, names: np.ndarray, planes: Sequence[np.ndarray], zeros: list[int], ones: Sequence[np.ndarray]) -> None:
        self.n, self.names, self.planes, self.zeros, self.ones = n, names, planes, zeros, ones
        self.codes = {int(x): c for c, x in enumerate(names)}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        """ids: unsigned integers below 2^32, any number of them."""
        found, inverse, counts = _classes(ids)
        order = np.argsort(-counts, kind="stable")
        code = np.empty(len(found), np.uint16 if len(found) <= 1 << 16 else np.uint32)
        code[order] = np.arange(len(found))
        seq = code[inverse]
        planes, zeros, ones = [], [], []
        for level in range(max(len(found) - 1, 0).bit_length() - 1, -1, -1):
            bits = (seq & code.dtype.type(1 << level)) != 0
            # Taking by position is several times faster than by mask.
            low, high = seq.take(np.flatnonzero(~bits)), seq.take(np.flatnonzero(bits))
            planes.append(np.packbits(bits, bitorder="little"))
            zeros.append(len(low))
            ones.append(_ones(planes[-1]))
            seq = np.concatenate((low, high))
        return cls(len(ids), found[order].astype("<u4"), planes, zeros, ones)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits."""
        block = i // BLOCK
        part = self.planes[level][block * BLOCK // 8 : (i + 7) // 8]
        return int(self.ones[level][block]) + int(np.unpackbits(part, bitorder="little")[: i - block * BLOCK].sum(dtype=np.int64))

    def _select(self, level: int, bit: int, k: int) -> int:
        """The position of the k-th (from 0) bit of that value."""
        ones, blocks = self.ones[level], len(self.ones[level])
        before = ones if bit else np.arange(blocks) * BLOCK - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            code, i = code << 1 | bit, zeros + ones if bit else i - ones
        return int(self.names[code])

    def _range(self, code: int, i: int) -> tuple[int, int]:
        """Where the id's part begins after all planes, and ends for the first i ids, by two ranks in each plane."""
        lo, hi = 0, i
        for level, zeros in enumerate(self.zeros):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = (zeros + a, zeros + b) if code >> (len(self.zeros) - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often the id stands among the first i."""
        if token not in self.codes:
            return 0
        lo, hi = self._range(self.codes[token], min(max(i, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The position of the id's k-th occurrence, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        code = self.codes[token]
        i = self._range(code, 0)[0] + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = code >> (len(self.zeros) - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of the id, in order: its part behind all planes, taken back plane by plane, each of which is opened once."""
        if token not in self.codes:
            return np.zeros(0, np.int64)
        code = self.codes[token]
        at = np.arange(*self._range(code, self.n), dtype=np.int64)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = code >> (len(self.zeros) - 1 - level) & 1
            places = np.flatnonzero(np.unpackbits(self.planes[level], count=self.n, bitorder="little") == bit)
            at = places[at - self.zeros[level] if bit else at]
        return at

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the planes from the lowest."""
        kind = np.uint16 if len(self.names) <= 1 << 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~bits)] = seq[: self.zeros[level]]
            out[np.flatnonzero(bits)] = seq[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            seq = out
        return self.names[seq] if self.n else np.zeros(0, "<u4")


def _classes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, each position's class, and counts."""
    if len(ids) and ids.max() < 1 << 20:
        counts = np.bincount(ids)
        found = np.flatnonzero(counts)
        of = np.zeros(len(counts), np.uint32)
        of[found] = np.arange(len(found))
        return found, of[ids], counts[found]
    return np.unique(ids, return_inverse=True, return_counts=True)


def _ones(plane: np.ndarray) -> np.ndarray:
    """Ones before each block."""
    each = np.bitwise_count(np.append(plane, np.zeros(-len(plane) % (BLOCK // 8), np.uint8)).reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
    return np.concatenate(([0], np.cumsum(each))).astype("<u4")


class _Sections(Sequence):
    """A shard's planes, or the counts that go with them, each read when it is asked for; the last one is kept."""

    def __init__(self, shard: Shard, name: str, kind: str) -> None:
        self.shard, self.name, self.kind, self.last = shard, name, kind, (-1, np.zeros(0))

    def __len__(self) -> int:
        return len(self.shard.header["zeros"])

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        if self.last[0] != i:
            self.last = i, np.frombuffer(self.shard.section(f"{self.name}{i}"), self.kind)
        return self.last[1]


class Shard:
    """Keys and lengths of documents, and their ids, from a file's bytes or from read(offset, length), which is asked only for the parts needed."""

    def __init__(self, source: bytes | Callable[[int, int], bytes]) -> None:
        read = source if callable(source) else lambda offset, length: source[offset : offset + length]
        head = read(0, len(MAGIC) + 4)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        size = struct.unpack_from("<I", head, len(MAGIC))[0]
        self.read, self.at = read, len(MAGIC) + 4 + size
        self.header = json.loads(read(len(MAGIC) + 4, size))
        self.n = self.header["n"]

    @classmethod
    def at_path(cls, path: str) -> Shard:
        return cls(lambda offset, length: read_range(path, offset, length))

    def section(self, name: str) -> bytes:
        offset, length = self.header["sections"][name]
        return zstandard.decompress(self.read(self.at + offset, length))

    def keys(self) -> np.ndarray:
        return np.frombuffer(self.section("keys"), "<i8")

    def lengths(self) -> np.ndarray:
        return np.frombuffer(self.section("lengths"), "<u4")

    def matrix(self) -> WaveletMatrix:
        return WaveletMatrix(self.n, np.frombuffer(self.section("names"), "<u4"), _Sections(self, "plane", "u1"), self.header["zeros"], _Sections(self, "ones", "<u4"))

    @staticmethod
    def encode(keys: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
        m = WaveletMatrix.build(ids)
        parts = {"keys": np.array(keys, "<i8"), "lengths": np.array(lengths, "<u4"), "names": m.names}
        for i, (plane, ones) in enumerate(zip(m.planes, m.ones, strict=True)):
            parts |= {f"ones{i}": ones, f"plane{i}": plane}
        packer, body, sections, at = zstandard.ZstdCompressor(level=1), [], {}, 0
        for name, x in parts.items():
            body.append(packer.compress(x.tobytes()))
            sections[name] = (at, len(body[-1]))
            at += len(body[-1])
        header = json.dumps({"n": m.n, "zeros": m.zeros, "sections": sections}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(header)), header, *body])


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end: int | None = END, shard: int = SHARD) -> DataFrame:
    """Encodes docs into shards under folder; returns their list: part, nth, path, first (key), n_docs, n_tokens.

    The list, ordered by part and nth, is in ascending order of doc_id (null
    first; rows with one doc_id by a hash of their text), within shards too.
    A range partition and a sort within it give that order, so no task holds
    more than its range. A null text is an empty document. A repeated attempt
    of a task writes new files, and only those of the attempt that succeeded
    are in the list. Empty docs give an empty list.
    """
    check_tokenizer(tokenizer)
    schema = "part int, nth int, path string, first long, n_docs long, n_tokens long"
    tail = b"" if end is None else struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, cache = TaskContext.get().partitionId(), library_cache(tokenizer)
        keys: list[int] = []
        ids: list[bytes] = []
        nth = total = 0

        def close() -> pa.RecordBatch:
            lengths = [len(x) // 4 for x in ids]
            path = write_file(folder, ".lpwm", Shard.encode(keys, lengths, np.frombuffer(b"".join(ids), "<u4")))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "nth": pa.array([nth], pa.int32()), "path": [path], "first": pa.array([keys[0]], pa.int64()), "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([sum(lengths)], pa.int64())})

        for batch in batches:
            own, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for key, text in zip(own, texts, strict=True):
                ids.append(cache.encode(text) + tail)
                keys.append(key)
                total += len(ids[-1]) // 4
                if total >= shard:
                    yield close()
                    keys, ids, nth, total = [], [], nth + 1, 0
        if keys:
            yield close()

    ordered = keyed(docs).repartitionByRange("key", "th").sortWithinPartitions("key", "th").select("key", "text")
    return written(ordered.mapInArrow(run, schema), "token-shards")


def read_shards(shards: DataFrame, full: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), and with full their ids, from the files in the list.

    start counts the ids of all documents before it. Each file is one task's
    work at a time, read from the shared folder.
    """
    # A running sum over one row for each shard of millions of ids.
    placed = shards.withColumn("start", F.sum("n_tokens").over(Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1))).select("path", F.coalesce("start", F.lit(0)).alias("start"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = Shard(read_file(path))
                ids, lengths = s.matrix().ids(), s.lengths().astype(np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                columns = [pa.array([None if k == NO_ID else k for k in s.keys().tolist()], pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())]
                if full:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * full])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "path").mapInArrow(run, schema)


def find_tokens(shards: DataFrame, tokens: Iterable[int]) -> DataFrame:
    """(doc_id, token, n, places array<long>): how often and where in its ids each document has those tokens; no row where it hasn't.

    Counts and occurrences come from rank and select, plane by plane, without
    decoding a shard. A row's places are a document's own, at most its length.
    """
    wanted = sorted({int(t) for t in tokens})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                s = Shard.at_path(path)
                m, keys, ends = s.matrix(), s.keys(), np.cumsum(s.lengths().astype(np.int64))
                for token in wanted:
                    if not m.count(token):
                        continue
                    at = m.occurrences(token)
                    doc = np.searchsorted(ends, at, "right")
                    own, first, n = np.unique(doc, return_index=True, return_counts=True)
                    starts = np.concatenate(([0], ends))[doc]
                    places = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(at - starts))
                    yield pa.RecordBatch.from_arrays([pa.array([None if k == NO_ID else k for k in keys[own].tolist()], pa.int64()), pa.array(np.full(len(own), token)), pa.array(n), places], ["doc_id", "token", "n", "places"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("path").repartition(n, "path").mapInArrow(run, "doc_id long, token long, n long, places array<long>")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(write_shards(table(spark, sf_dir, "documents"), tokenizer_path(), work_path(spark, "tokens")))
