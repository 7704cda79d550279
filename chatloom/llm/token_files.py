"""Token-id files: bit-plane shuffled shards (operator 4) and flat ones.

A shard file holds the ids of consecutive documents::

    "PLN1" | chunk | chunk | ... | chunk index | document index | trailer

A chunk is a fixed number of ids as little-endian u32, transposed into planes:
with ``plane="bit"`` plane k has bit k of every id, with ``plane="byte"`` byte k.
Planes above the chunk's largest id are absent. Each plane is a zstandard frame
of its own. The chunk index has one record a chunk: (file offset, ids, planes)
and the frames' lengths; the document index has doc_id and number of ids, both
zstandard frames. The trailer is (offset of the chunk index, its length, length
of the document index, ids, documents, plane width in bits, "PLN1").

Shards follow one another in ascending doc_id order. Documents with the same id
are in order of their text; null ids come first; null and empty texts have just
the end id. Files are written under a temporary name and moved, so a task that
is run again leaves one whole file.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe import encoder
from .common import BYTES_PER_BATCH, bound_batches, commit_file, fresh_dir, open_store, releasing

MAGIC = b"PLN1"
BLOCK_IDS = 1 << 16
LEVEL = 1
_TRAILER = struct.Struct("<QQQQQI4s")
_CHUNK = struct.Struct("<QII")


def to_planes(ids: np.ndarray, plane: str = "byte") -> list[bytes]:
    """The planes of an array of u32, without the empty ones on top."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max(initial=0)).bit_length()
    if plane == "byte":
        rows = ids.view(np.uint8).reshape(-1, 4).T[: -(-top // 8)]
        return [np.ascontiguousarray(r).tobytes() for r in rows]
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(top)]


def from_planes(planes: list[bytes], n: int, plane: str = "byte") -> np.ndarray:
    """The ids of which ``planes`` were made."""
    wide = np.zeros((n, 4), np.uint8)
    if plane == "byte":
        for k, data in enumerate(planes):
            wide[:, k] = np.frombuffer(data, np.uint8)
    elif planes:
        bits = np.zeros((n, 32), np.uint8)
        for k, data in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(data, np.uint8), count=n)
        wide = np.packbits(bits, axis=1, bitorder="little")
    return wide.reshape(-1).view("<u4")


class PlaneWriter:
    """Streams documents into one shard, holding one block of ids at a time."""

    def __init__(self, out, plane: str = "byte", block: int = BLOCK_IDS):
        self.out, self.plane, self.block = out, plane, block
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.at = out.write(MAGIC) or len(MAGIC)
        self.index, self.keys, self.counts = [], [], []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            whole = np.concatenate(self.held)
            full = self.n_held - self.n_held % self.block
            for a in range(0, full, self.block):
                self._chunk(whole[a : a + self.block])
            self.held, self.n_held = [whole[full:]], self.n_held - full

    def _chunk(self, ids: np.ndarray) -> None:
        frames = [self.pack.compress(p) for p in to_planes(ids, self.plane)]
        self.index.append(_CHUNK.pack(self.at, len(ids), len(frames)) + struct.pack(f"<{len(frames)}I", *map(len, frames)))
        for f in frames:
            self.out.write(f)
            self.at += len(f)
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        chunks = self.pack.compress(b"".join(self.index))
        docs = self.pack.compress(known.tobytes() + keys.tobytes() + np.array(self.counts, "<u4").tobytes())
        self.out.write(chunks)
        self.out.write(docs)
        width = 8 if self.plane == "byte" else 1
        self.out.write(_TRAILER.pack(self.at, len(chunks), len(docs), self.n_ids, len(self.keys), width, MAGIC))


class PlaneReader:
    """Reads a shard: its documents in order, or any range of ids by the chunk index."""

    def __init__(self, file):
        self.file = file
        size = file.size() if callable(getattr(file, "size", None)) else file.seek(0, 2)
        at, n_chunks, n_docs, self.n_ids, count, width, magic = _TRAILER.unpack(self._at(size - _TRAILER.size, _TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        self.plane = "byte" if width == 8 else "bit"
        self.unpack = zstandard.ZstdDecompressor()
        raw, self.chunks, i = self.unpack.decompress(self._at(at, n_chunks)), [], 0
        while i < len(raw):
            offset, n, planes = _CHUNK.unpack_from(raw, i)
            i += _CHUNK.size
            self.chunks.append((offset, n, struct.unpack_from(f"<{planes}I", raw, i)))
            i += 4 * planes
        raw = self.unpack.decompress(self._at(at + n_chunks, n_docs))
        known = np.frombuffer(raw, np.uint8, count)
        keys = np.frombuffer(raw, "<i8", count, count)
        self.keys = [int(k) if ok else None for k, ok in zip(keys, known, strict=True)]
        self.counts = np.frombuffer(raw, "<u4", count, 9 * count)
        self.first = np.cumsum([0, *(n for _, n, _ in self.chunks)])

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def chunk(self, k: int) -> np.ndarray:
        offset, n, sizes = self.chunks[k]
        data, planes, i = self._at(offset, sum(sizes)), [], 0
        for s in sizes:
            planes.append(self.unpack.decompress(data[i : i + s]))
            i += s
        return from_planes(planes, n, self.plane)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the shard."""
        if not count:
            return np.zeros(0, "<u4")
        a = int(np.searchsorted(self.first, start, "right")) - 1
        b = int(np.searchsorted(self.first, start + count, "left"))
        part = np.concatenate([self.chunk(k) for k in range(a, b)])
        return part[start - self.first[a] : start - self.first[a] + count]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(key, ids) of each document, one chunk in memory besides."""
        rest, k = np.zeros(0, "<u4"), 0
        for key, n in zip(self.keys, self.counts.tolist(), strict=True):
            parts = [rest]
            have = len(rest)
            while have < n:
                parts.append(self.chunk(k))
                have += len(parts[-1])
                k += 1
            whole = np.concatenate(parts) if len(parts) > 1 else rest
            yield key, whole[:n]
            rest = whole[n:]


def shard_name(folder: str, number: int) -> str:
    return f"{folder}/shard-{number:07d}.bin"


def write_shards(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, specials: bool = True,
    plane: str = "byte", block: int = BLOCK_IDS, flat: str | None = None, ordered: bool = True,
) -> list[tuple[int, int, int]]:
    """Encode ``docs`` and write their shards; (shard, ids, documents) of each.

    With ``ordered``, ``docs`` is range-partitioned by doc_id, so shard numbers
    ascend with doc_id; else each input partition is a shard, without a shuffle.
    One small row a shard reaches the driver. ``flat`` ("<u2" or "<u4") writes bare
    ids of that type and no index at all; a file of doc_ids lies beside each shard.
    """
    bound_batches(docs.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n_docs, n_ids = TaskContext.get().partitionId(), 0, 0
        bpe = encoder(vocabulary)
        first = next(iter(batches), None)
        if first is None:
            return

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in (b for bs in ([first], batches) for b in bs):
                # a batch is bounded but for single long texts
                rows = max(1, batch.num_rows * 2 * BYTES_PER_BATCH // max(batch.nbytes, 1))
                for a in range(0, batch.num_rows, rows):
                    part = batch.slice(a, rows)
                    ids, places = bpe.encode_array(part.column(1), specials)
                    ids = np.insert(ids, places[1:], end_id)
                    places = places + np.arange(len(places))
                    for key, x, y in zip(part.column(0).to_pylist(), places[:-1].tolist(), places[1:].tolist(), strict=True):
                        yield key, ids[x:y]

        def planes(out) -> None:
            nonlocal n_docs, n_ids
            writer = PlaneWriter(out, plane, block)
            for key, ids in documents():
                writer.add(key, ids)
                n_docs, n_ids = n_docs + 1, n_ids + len(ids)
            writer.close()

        def bare(out) -> None:
            nonlocal n_docs, n_ids
            keys: list[int | None] = []
            top = np.iinfo(flat).max
            for key, ids in documents():
                if int(ids.max()) > top:
                    raise ValueError(f"an id is beyond {top}, the largest that {flat} holds")
                out.write(ids.astype(flat).tobytes())
                keys.append(key)
                n_ids += len(ids)
            n_docs = len(keys)
            known = np.array([k is not None for k in keys], np.uint8)
            data = np.array([k or 0 for k in keys], "<i8").tobytes() + known.tobytes()
            commit_file(shard_name(folder, number) + ".keys", lambda f: f.write(data))

        commit_file(shard_name(folder, number), bare if flat else planes)
        yield pa.RecordBatch.from_pydict({"shard": [number], "n_ids": [n_ids], "n_docs": [n_docs]})

    dealt = docs.select("doc_id", "text")
    if ordered:
        dealt = dealt.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = dealt.mapInArrow(releasing(write), "shard bigint, n_ids bigint, n_docs bigint").collect()
    return sorted((r.shard, r.n_ids, r.n_docs) for r in rows)


def shard_rows(spark: SparkSession, shards: list[tuple[int, int, int]]) -> DataFrame:
    """One row and one partition a shard: shard, start (ids before it), doc_no (documents before it)."""
    starts = np.cumsum([0, *(n for _, n, _ in shards)]).tolist()
    firsts = np.cumsum([0, *(n for _, _, n in shards)]).tolist()
    rows = [(s, a, n, d, k) for (s, n, k), a, d in zip(shards, starts, firsts)]
    schema = "shard bigint, start bigint, n_ids bigint, doc_no bigint, n_docs bigint"
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema)


def read_digests(spark: SparkSession, folder: str, shards: list[tuple[int, int, int]]) -> DataFrame:
    """Per document, read back from the shards: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_store(shard_name(folder, row["shard"]))
                out, at = [], row["start"]
                with fs.open_input_file(path) as f:
                    for key, ids in PlaneReader(f).documents():
                        out.append((key, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))))
                        at += len(ids)
                cols = list(zip(*out, strict=True)) or [[], [], [], []]
                names = ("doc_id", "start", "n_tokens", "ids_crc32")
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(names))

    return shard_rows(spark, shards).mapInArrow(read, schema)


def token_file_digests(docs: DataFrame, vocabulary: str, end_id: int = 0, plane: str = "byte") -> DataFrame:
    """Write ``docs`` as bit-plane shards in the shared folder and describe what is read back."""
    spark = docs.sparkSession
    folder = fresh_dir(spark, "token-planes")
    return read_digests(spark, folder, write_shards(docs, vocabulary, folder, end_id, plane=plane))


def round_trip_bytes(ids: np.ndarray, plane: str, block: int = BLOCK_IDS) -> np.ndarray:
    """Ids through a shard held in memory, for tests."""
    out = io.BytesIO()
    writer = PlaneWriter(out, plane, block)
    writer.add(0, np.asarray(ids, "<u4"))
    writer.close()
    out.seek(0)
    return PlaneReader(out).ids(0, len(ids))


