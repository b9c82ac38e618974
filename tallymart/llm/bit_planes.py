"""Token ids in files of bit planes.

A file holds the ids of a run of documents in blocks of a fixed number of ids. A block is transposed: plane k has bit k of every id, so that
the seldom set upper bits lie together; each plane is compressed with zstandard by itself. Behind the blocks come a chunk
index (where each block begins, its ids, their checksum, the bytes of each plane) and a table of documents (id and number of tokens), so
that any range of ids is read without what lies before it. All numbers are little-endian.

    blocks: the planes of each block, one after the other
    index:  zstandard frame of the arrays named in INDEX, after their lengths
    end:    begin and bytes of the index (u64), ids in a block (u32), bits of an id (u32), MAGIC

Documents are range-partitioned by doc_id, so the files in order hold them in ascending order. A task writes under a name of
its own, and a file counts only if the committed manifest names it: attempts that were lost or ran twice leave no trace in the result.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallymart.llm.common import utf8
from tallymart.llm.wordcodes import WordCoder, batches_of_bytes, led_words, loaded, with_end
from tallymart.session import new_shared_path

MAGIC = b"TMBP0001"
END = struct.Struct("<QQII8s")
BLOCK = 65_536
INDEX = (("begin", "<u8"), ("ids", "<u4"), ("crc", "<u4"), ("bytes", "<u4"), ("doc", "<i8"), ("known", "u1"), ("tokens", "<i8"))
MANIFEST = "shard long, path string, docs long, ids long, bytes long"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Plane k: bit k of each id, eight ids to a byte."""
    columns = np.ascontiguousarray(ids.view(np.uint8).reshape(len(ids), -1).T)
    return [np.packbits(column & np.uint8(1 << k), bitorder="little").tobytes() for column in columns for k in range(8)]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    columns = np.zeros((len(planes) // 8, count), np.uint8)
    for k, plane in enumerate(planes):
        columns[k // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little") << np.uint8(k % 8)
    return np.ascontiguousarray(columns.T).reshape(-1).view(kind)


class PlaneWriter:
    """Writes ids and documents to an open binary file; at most a block of ids is held."""

    def __init__(self, sink, kind: str, block: int = BLOCK, level: int = 3):
        import zstandard

        self.sink, self.kind, self.block, self.at = sink, np.dtype(kind), block, 0
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.index: dict[str, list] = {name: [] for name, _ in INDEX}

    def add(self, ids: np.ndarray, doc_ids: list, tokens: np.ndarray) -> None:
        """The ids of documents, with their doc_ids (None: unknown) and numbers of tokens."""
        self.index["doc"].append(np.array([0 if d is None else d for d in doc_ids], "<i8"))
        self.index["known"].append(np.array([d is not None for d in doc_ids], "u1"))
        self.index["tokens"].append(np.asarray(tokens, "<i8"))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = self.held - self.held % self.block
            for lo in range(0, whole, self.block):
                self._write(ids[lo:lo + self.block])
            self.waiting, self.held = [ids[whole:].copy()], self.held - whole

    def _write(self, ids: np.ndarray) -> None:
        planes = [self.compress(p) for p in to_planes(np.ascontiguousarray(ids))]
        for name, value in (("begin", self.at), ("ids", len(ids)), ("crc", zlib.crc32(ids.tobytes())), ("bytes", [len(p) for p in planes])):
            self.index[name].append(np.atleast_1d(value))
        self.sink.write(b"".join(planes))
        self.at += sum(map(len, planes))

    def close(self) -> int:
        """Writes the last block and the index; the number of bytes of the file."""
        if self.held:
            self._write(np.concatenate(self.waiting))
        arrays = [np.concatenate([np.zeros(0, kind), *self.index[name]]).astype(kind) for name, kind in INDEX]
        raw = struct.pack(f"<{len(arrays)}Q", *map(len, arrays)) + b"".join(a.tobytes() for a in arrays)
        packed = self.compress(raw)
        self.sink.write(packed + END.pack(self.at, len(packed), self.block, 8 * self.kind.itemsize, MAGIC))
        return self.at + len(packed) + END.size


class PlaneReader:
    """Reads ids and documents of an open, seekable binary file; a block is held at a time."""

    def __init__(self, source):
        import zstandard

        self.source, self.expand = source, zstandard.ZstdDecompressor().decompress
        source.seek(0, 2)
        size = source.tell()
        begin, length, self.block, self.bits, magic = END.unpack(self._bytes(size - END.size, END.size))
        if magic != MAGIC:
            raise ValueError("not a file of bit planes")
        raw, at = self.expand(self._bytes(begin, length)), 8 * len(INDEX)
        for (name, kind), n in zip(INDEX, struct.unpack(f"<{len(INDEX)}Q", raw[:at])):
            setattr(self, name, np.frombuffer(raw, kind, n, at))
            at += self.__dict__[name].nbytes
        self.bytes = self.bytes.reshape(-1, self.bits)

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids_of(self, k: int) -> np.ndarray:
        """The ids of block k."""
        count, sizes = int(self.ids[k]), self.bytes[k].astype(np.int64)
        raw, ends = self._bytes(int(self.begin[k]), int(sizes.sum())), np.cumsum(sizes)
        ids = from_planes([self.expand(raw[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())], count, f"<u{self.bits // 8}")
        if zlib.crc32(ids.tobytes()) != self.crc[k]:
            raise ValueError(f"block {k} is damaged")
        return ids

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on; only the blocks they are in are read."""
        blocks = range(start // self.block, -(-(start + count) // self.block)) if count else []
        own = [self.ids_of(k) for k in blocks]
        return np.concatenate([*own, np.zeros(0, f"<u{self.bits // 8}")])[start % self.block:][:count].astype(f"<u{self.bits // 8}")

    def documents(self):
        """doc_id (None: unknown), first id, number of tokens, crc32 of the tokens as 32-bit ids, in order."""
        ends = np.cumsum(self.tokens)
        k, held, first = -1, np.zeros(0, "<u4"), 0
        for doc, known, end, n in zip(self.doc.tolist(), self.known.tolist(), ends.tolist(), self.tokens.tolist()):
            at, crc = end - n, 0
            while at < end:
                if at >= first + len(held):
                    k, first = k + 1, first + len(held)
                    held = self.ids_of(k).astype("<u4")
                part = held[at - first:end - first]
                crc = zlib.crc32(part.data, crc)
                at += len(part)
            yield (doc if known else None, end - n, n, crc)


def filesystem(path: str):
    """The file system of a shared path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 0, block: int = BLOCK, shards: int | None = None,
          special: bool = True) -> DataFrame:
    """Encodes documents (doc_id, text) and writes them to files in ascending order of doc_id, nulls first; the manifest, one row per file.

    Each document ends with ``end_id``; a null text is empty, documents with the same doc_id are in order of a hash of their text. Other
    columns are ignored. No documents give no files. ``folder`` is one that all executors reach, a new one beside the checkpoints if not given.
    ``special``: whether the names of special tokens in a text stand for these.
    """
    spark = docs.sparkSession
    folder = folder or new_shared_path(spark, "bit_planes")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        from pyspark import TaskContext

        coder, writer, n, total = WordCoder(loaded(tokenizer_path, special), led_words, kept=(tokenizer_path, special)), None, 0, 0
        for batch in batches:
            for lo, k in batches_of_bytes(batch.column(1), 8_000_000):
                part = batch.slice(lo, k)
                if writer is None:
                    system, place = filesystem(folder)
                    system.create_dir(place, recursive=True)
                    shard = TaskContext.get().partitionId()
                    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.planes"
                    sink = system.open_output_stream(f"{place}/{name}")
                    writer = PlaneWriter(sink, coder.kind, block)
                ids, length = with_end(*coder.encode(part.column(1)), end_id)
                writer.add(ids, part.column(0).to_pylist(), length)
                n, total = n + len(length), total + len(ids)
        if writer is not None:
            size = writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (shard, f"{folder}/{name}", n, total, size), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["shard", "path", "docs", "ids", "bytes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    place = ["doc_id", F.xxhash64("text")]
    manifest = new_shared_path(spark, "bit_planes_manifest")
    rows.repartitionByRange(shards, *place).sortWithinPartitions(*place).mapInArrow(run, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def stored(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files of a manifest; ``start`` counts the ids of all files before, too."""
    files = manifest.count()
    if not files:
        return manifest.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per file.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def run(batches):
        for batch in batches:
            for path, first in zip(*(batch.column(i).to_pylist() for i in range(2))):
                system, place = filesystem(path)
                with system.open_input_file(place) as source:
                    rows = []
                    for row in PlaneReader(source).documents():
                        rows.append(row)
                        if len(rows) == 50_000:
                            yield _batch(rows, first)
                            rows = []
                    if rows:
                        yield _batch(rows, first)

    return manifest.select("path", before.cast("long").alias("first")).repartition(files).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple], first: int) -> pa.RecordBatch:
    doc, start, n, crc = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(np.array(start) + first), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(path: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from ``start`` on of one file, read by the caller."""
    system, place = filesystem(path)
    with system.open_input_file(place) as source:
        return PlaneReader(source).read(start, count)
