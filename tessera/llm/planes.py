"""Token ids in bit-plane shuffled files.

A shard holds the ids of a range of documents in ascending ``doc_id`` order.
Blocks of a fixed number of ids are transposed into byte (or bit) planes, each
plane is compressed with zstandard (an all-zero plane takes no bytes), and an
index at the end gives the place of every block and plane, and id and length of
every document, so that one document can be read without the rest.

Layout, little endian: magic, kind (8 or 32 planes a block by bits, 4 by bytes)
and block size; the planes; the index (zstandard over int64 arrays); lengths of
the index's parts and the magic again.

Defined results: a null or empty text is the end id alone.  Null ids come
first, rows of the same id in order of a hash of their text.  Extra columns are ignored.  An
empty table writes no shard and reads back empty.  A task that is run again
writes a file of another name; only files in the manifest count.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import doc_text, slices, write_stage
from tessera.llm.tokens import encode
from tessera.sources.sinks import scratch_path

VOCABULARY, END_ID = "word_bpe_49k.json", 1
MAGIC = b"PLANES01"
BLOCK_IDS = 1 << 16
BYTES, BITS = 4, 32
LEVEL = 3
_HEAD, _TAIL = struct.Struct("<8sII"), struct.Struct("<QQQQ8s")


def split_planes(ids: np.ndarray, planes: int) -> list[np.ndarray]:
    """Byte planes (4) or bit planes (32, padded to whole bytes) of unsigned 32-bit ids."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == BYTES:
        return [np.ascontiguousarray(p) for p in raw.T]
    return list(np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little"))


def join_planes(parts: list[np.ndarray | None], n: int) -> np.ndarray:
    if len(parts) == BYTES:
        raw = np.zeros((n, 4), np.uint8)
        for i, p in enumerate(parts):
            if p is not None:
                raw[:, i] = p
        return raw.reshape(-1).view("<u4")
    bits = np.zeros((BITS, n), np.uint8)
    for i, p in enumerate(parts):
        if p is not None:
            bits[i] = np.unpackbits(p, count=n, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Writes one shard; ids are held for one block at most."""

    def __init__(self, out, planes: int = BYTES, block_ids: int = BLOCK_IDS):
        self.out, self.planes, self.block_ids = out, planes, block_ids
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.blocks: list[list[int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.at = out.write(_HEAD.pack(MAGIC, planes, block_ids)) or _HEAD.size

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        end = len(ids) - len(ids) % self.block_ids if whole_blocks else len(ids)
        for start in range(0, end, self.block_ids):
            block = ids[start:min(start + self.block_ids, end)]
            row = [self.at, len(block)]
            for plane in split_planes(block, self.planes):
                data = self.zip.compress(plane.tobytes()) if plane.any() else b""
                self.out.write(data)
                self.at += len(data)
                row.append(len(data))
            self.blocks.append(row)
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> int:
        """Writes the index; the size of the file."""
        self._flush(whole_blocks=False)
        index = [np.array(x, "<i8").tobytes() for x in (self.blocks, self.docs)]
        index = [self.zip.compress(x) for x in index]
        for x in index:
            self.out.write(x)
        self.out.write(_TAIL.pack(len(index[0]), len(index[1]), len(self.docs), self.n_ids, MAGIC))
        return self.at + sum(map(len, index)) + _TAIL.size


class Reader:
    """Reads a shard: all documents in order, or one of them through the index."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        magic, self.planes, self.block_ids = _HEAD.unpack(source.read(_HEAD.size))
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - _TAIL.size)
        blocks, docs, n_docs, self.n_ids, end = _TAIL.unpack(source.read(_TAIL.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a plane file")
        self.unzip = zstandard.ZstdDecompressor()
        source.seek(size - _TAIL.size - docs - blocks)
        load = lambda n, width: np.frombuffer(self.unzip.decompress(source.read(n)), "<i8").reshape(-1, width)
        self.blocks, self.docs = load(blocks, 2 + self.planes), load(docs, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.docs[:, 2])))

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.blocks[k].tolist()
        self.source.seek(at)
        raw = self.source.read(sum(sizes))
        ends = np.cumsum(sizes).tolist()
        parts = [np.frombuffer(self.unzip.decompress(raw[e - s:e]), np.uint8) if s else None for s, e in zip(sizes, ends, strict=True)]
        return join_planes(parts, n)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document; reads the blocks that hold it only."""
        start, end = int(self.starts[k]), int(self.starts[k + 1])
        first = start // self.block_ids
        ids = np.concatenate([self.block(b) for b in range(first, -(-end // self.block_ids))])
        return ids[start - first * self.block_ids:end - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, start, parts of its ids) in order; a block is decoded once.  Each document's parts must be used up."""
        held, block, used = np.empty(0, np.uint32), 0, 0

        def take(n: int) -> Iterator[np.ndarray]:
            nonlocal held, block, used
            while n:
                if used == len(held):
                    held, block, used = self.block(block), block + 1, 0
                part = held[used:used + n]
                used += len(part)
                n -= len(part)
                yield part

        for (doc_id, null, n), start in zip(self.docs.tolist(), self.starts.tolist(), strict=False):
            yield None if null else doc_id, start, take(n)


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system's scheme, as pyarrow needs it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
                 planes: int = BYTES, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encodes and writes all texts below ``folder``; the manifest (file, first, n_docs, n_ids, bytes), a row a shard."""
    path = path or public_tokenizers.path(VOCABULARY)
    folder = _qualified(docs.sparkSession, folder)
    texts = doc_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, out, name, first = None, None, "", None
        for batch in slices(batches):
            ids = batch["doc_id"].to_pylist()
            texts = batch["text"].to_pylist()
            if writer is None:
                store, base = fs.FileSystem.from_uri(folder)
                store.create_dir(base, recursive=True)
                name, first = f"shard-{uuid.uuid4().hex}.planes", (ids[0], batch["tie"][0].as_py())
                out = store.open_output_stream(posixpath.join(base, name))
                writer = Writer(out, planes, block_ids)
            for doc_id, part in zip(ids, encode(path, texts, end_id), strict=True):
                writer.add(doc_id, part)
        if writer is not None:
            size = writer.close()
            out.close()
            row = [[f"{folder}/{name}"], [first[0]], [first[1]], [len(writer.docs)], [writer.n_ids], [size]]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)],
                                             ["file", "first", "first_tie", "n_docs", "n_ids", "bytes"])

    found = dealt.mapInArrow(run, "file string, first long, first_tie long, n_docs long, n_ids long, bytes long")
    return write_stage(found, "plane-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    # a row a shard: the running sum is over as many rows as there are files
    order = Window.orderBy(F.col("first").asc_nulls_first(), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = write_stage(manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("shard_start")), "shard-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["shard_start"].to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as source:
                    rows = []
                    for doc_id, start, parts in Reader(source).documents():
                        crc = n = 0
                        for part in parts:
                            crc, n = zlib.crc32(np.ascontiguousarray(part, "<u4").tobytes(), crc), n + len(part)
                        rows.append((doc_id, base + start, n, crc))
                        if len(rows) == 1 << 14:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    # the manifest is small, so its size says nothing of the work: a task a file, as far as there are so many
    return placed.repartition(max(1, manifest.count()), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32"])


def op3_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_shards(write_shards(docs, scratch_path(spark, "planes")))
