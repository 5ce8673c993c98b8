"""Token ids in sorted-string-table shards, with binary-search lookup.

A file holds, in this order:

    blocks   zstandard frames; inside, entries of ascending key: varints of the bytes shared with the
             key before (0 at a block's start), of the key's other bytes and of the value, then these
             other bytes and the value
    index    for each block: 4-byte length of its first key, the key, 8-byte offset, 4-byte length
    bloom    the bits of a Bloom filter over the keys
    footer   offset and length of index and bloom (8 bytes each), number of documents and of ids,
             hash functions (4), bytes of an id (4), MAGIC

A key is 0 for a null doc_id or else 1 and the doc_id plus 2**63 as 8 bytes, then 4 bytes that count
the rows of that doc_id in the shard; big-endian. A value is the document's ids, little-endian, 2 bytes each where
the vocabulary allows it and else 4. All other numbers are little-endian.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.shared import in_order, partitions, scratch
from quarry.llm.tokens import encoder

MAGIC = b"QSST0001"
FOOTER = struct.Struct("<QQQQQQII8s")
MANIFEST = "shard int, file int, path string, docs long, tokens long"


def key_of(doc_id: int | None, nth: int = 0) -> bytes:
    return (b"\0" if doc_id is None else b"\1" + (doc_id + (1 << 63)).to_bytes(8, "big")) + nth.to_bytes(4, "big")


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else int.from_bytes(key[1:9], "big") - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 128:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bits(key: bytes, size: int, hashes: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key[::-1], 0x9E3779B9) | 1
    return [(a + i * b + i * i) % size for i in range(hashes)]


class Writer:
    """Writes entries in ascending key order to a binary file object."""

    def __init__(self, out, id_bytes: int, block_bytes: int = 64 << 10, bits_per_key: int = 10, hashes: int = 7):
        self.out, self.id_bytes, self.block_bytes = out, id_bytes, block_bytes
        self.bits_per_key, self.hashes = bits_per_key, hashes
        self.at, self.docs, self.tokens = 0, 0, 0
        self.block, self.held, self.first, self.last = [], 0, b"", b""
        self.index: list[bytes] = []
        self.seen: list[bytes] = []
        self.value_bytes = 0
        self.zip = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        value = ids.astype(f"<u{self.id_bytes}").tobytes()
        if not self.block:
            self.first, shared = key, 0
        else:
            shared = next((i for i, (x, y) in enumerate(zip(key, self.last, strict=False)) if x != y), min(len(key), len(self.last)))
        entry = _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:]
        self.block += [entry, value]
        self.held += len(entry) + len(value)
        self.last = key
        self.seen.append(key)
        self.docs += 1
        self.tokens += len(ids)
        self.value_bytes += len(value)
        if self.held >= self.block_bytes:
            self._end_block()

    def _end_block(self) -> None:
        if self.block:
            data = self.zip.compress(b"".join(self.block))
            self.index.append(struct.pack("<I", len(self.first)) + self.first + struct.pack("<QI", self.at, len(data)))
            self._put(data)
            self.block, self.held = [], 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self._end_block()
        index_at, index = self.at, b"".join(self.index)
        self._put(index)
        bloom = np.zeros(max(64, len(self.seen) * self.bits_per_key + 7 & ~7), dtype=bool)
        for key in self.seen:
            bloom[_bits(key, len(bloom), self.hashes)] = True
        bloom_at, bits = self.at, np.packbits(bloom).tobytes()
        self._put(bits)
        self._put(FOOTER.pack(index_at, len(index), bloom_at, len(bits), self.docs, self.tokens, self.hashes, self.id_bytes, MAGIC))


class Reader:
    """Reads a shard from a seekable binary file object."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        index_at, index_len, bloom_at, bloom_len, self.docs, self.tokens, self.hashes, self.id_bytes, magic = FOOTER.unpack(
            self._get(size - FOOTER.size, FOOTER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        self.bloom = self._get(bloom_at, bloom_len)
        data, at = self._get(index_at, index_len), 0
        self.firsts: list[bytes] = []
        self.blocks: list[tuple[int, int]] = []
        while at < len(data):
            (n,) = struct.unpack_from("<I", data, at)
            self.firsts.append(data[at + 4 : at + 4 + n])
            self.blocks.append(struct.unpack_from("<QI", data, at + 4 + n))
            at += 16 + n
        self.unzip = zstandard.ZstdDecompressor()

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _entries(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        data, at, key = self.unzip.decompress(self._get(*self.blocks[k])), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            other, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + other]
            at += other
            yield key, np.frombuffer(data, dtype=f"<u{self.id_bytes}", count=size // self.id_bytes, offset=at).astype("<u4")
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for k in range(len(self.blocks)):
            yield from self._entries(k)

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        """The ids of the nth row of doc_id, or None: the Bloom filter, the index, then one block are asked."""
        key = key_of(doc_id, nth)
        if not all(self.bloom[b >> 3] >> (7 - (b & 7)) & 1 for b in _bits(key, len(self.bloom) * 8, self.hashes)):
            return None
        k = bisect_right(self.firsts, key) - 1
        return next((ids for found, ids in self._entries(k) if found == key), None) if k >= 0 else None


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 1,
    range_bytes: int = 16 << 20, file_bytes: int = 256 << 20, file_docs: int = 1 << 20,
) -> DataFrame:
    """Encodes all texts, appends the id `end` to each and writes them as shards under path in ascending doc_id order.

    Returns the manifest (shard, file, path, docs, tokens), itself written under path: shards are ranges
    of doc_id of about range_bytes of text, rising with the shard number. A shard's files hold about
    file_bytes of ids and file_docs documents at most, so what a task keeps of a file is bounded. Each try of a task
    writes files of its own, by other names until they are complete; what the manifest does not list
    is left from tasks that were lost.

    Null or empty text: the end id alone. Null doc_ids come first; rows of one doc_id follow one
    another as they are read. An empty table gives an empty manifest. Other columns, whatever their names, are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        fs, root = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        shard, files, last = TaskContext.get().partitionId(), 0, ()
        id_bytes = 2 if tokens.tokenizer.get_vocab_size() <= 1 << 16 else 4
        rows = ((i, t) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        row = next(rows, None)
        while row is not None:
            name = f"shard-{shard:06d}-{files:04d}-{uuid.uuid4().hex}.sst"
            with fs.open_output_stream(f"{root}/_{name}") as out:
                writer = Writer(out, id_bytes)
                while row is not None and writer.docs < file_docs and writer.value_bytes < file_bytes:
                    last = (row[0], last[1] + 1) if last and last[0] == row[0] else (row[0], 0)
                    writer.add(key_of(*last), np.frombuffer(tokens.ids(row[1].as_py(), end), dtype="<u4"))
                    row = next(rows, None)
                writer.close()
            fs.move(f"{root}/_{name}", f"{root}/{name}")
            made = [shard], [files], [f"{path}/{name}"], [writer.docs], [writer.tokens]
            kinds = pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays(list(map(pa.array, made, kinds)), names=["shard", "file", "path", "docs", "tokens"])
            files += 1

    in_order(docs, doc_id, text, range_bytes).mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """The documents in the shards of a manifest: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "start", "n_tokens", "ids_crc32")
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    rows, start = [], before
                    for key, ids in Reader(file):
                        rows.append((id_of(key), start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    # one row per file, so the running sum is over as few rows as there are files
    before = F.sum("tokens").over(Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).cast("long").alias("before"))
    files = files.repartition(partitions(manifest.sparkSession), "path")
    return files.select("path", "before").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(spark: SparkSession, docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes docs as shards to the shared folder and reads them back."""
    return read_shards(write_shards(docs, scratch(spark, "token-shards"), tokenizer, **options))
