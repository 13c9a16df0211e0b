"""Packed exchange of 64-bit keys between groups of documents and ranges of keys.

Texts are dealt to *chunks* by a hash of the row; keys made from them (hashes of windows or shingles) are dealt to
*buckets* by their top bits. What travels is one row per chunk and bucket: the chunk's distinct keys of that bucket,
sorted, as differences packed bytewise and compressed. A chunk sends a key once however often it has it, so a key that
a third of all rows share costs its bucket one entry per chunk. Answers go back the same way, and both sides work on
one chunk or one bucket at a time. Chunks and buckets grow with the square root of the total text size, so that their
number does too, up to what a Python worker can hold; only beyond does their number grow with the total.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes in a chunk, and in all chunks per bucket, of a corpus of ``EVEN`` bytes or less, and how much larger they may get.
CHUNK_BYTES, BUCKET_BYTES, EVEN, GROWTH = 6_000_000, 12_000_000, 1_000_000_000, 4

_pack, _unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


@dataclass(frozen=True)
class Layout:
    """How many chunks, and how many bits of a key name its bucket."""

    chunks: int
    bits: int
    total: int = 0  # bytes of text, where they were counted

    @property
    def buckets(self) -> int:
        return 1 << self.bits

    @property
    def rows(self) -> int:
        """No more rows than this travel one way."""
        return self.chunks * self.buckets


def sized(total: int, chunk_bytes: int | None = None, bucket_bytes: int | None = None) -> Layout:
    """Layout for ``total`` bytes of text."""
    by = min(float(GROWTH), max(1.0, (total / EVEN) ** 0.5))
    chunk, bucket = chunk_bytes or int(CHUNK_BYTES * by), bucket_bytes or int(BUCKET_BYTES * by)
    return Layout(max(1, -(-total // chunk)), max(0, (total // bucket).bit_length()), total)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one pass that only adds up lengths."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def layout(docs: DataFrame, text: str = "text") -> Layout:
    """Layout for the whole text of ``docs``.

    The defaults suit executors with half a gigabyte for a Python worker. Larger workers and corpora should set
    ``spark.tamarack.chunkBytes`` and ``spark.tamarack.bucketBytes`` higher: the exchange has at most one row per
    chunk and bucket, so rows stay well filled while chunk size x bucket size is well above the total.
    """
    conf = docs.sparkSession.conf
    return sized(text_bytes(docs, text), *(int(conf.get(f"spark.tamarack.{k}Bytes", "0")) or None for k in ("chunk", "bucket")))


def pack(sorted_keys: np.ndarray) -> bytes:
    """Sorted unsigned integers as compressed bytewise planes of their differences."""
    if not len(sorted_keys):
        return b""
    k = sorted_keys.astype(np.uint64)
    d = np.diff(k, prepend=np.uint64(0))
    planes = d.view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes.any(1)[::-1])) if planes.any() else 1
    # Low planes of hashes are noise; only the others are worth compressing.
    noise = max(0, used - 2)
    return bytes([used, noise]) + len(k).to_bytes(4, "little") + planes[:noise].tobytes() + _pack.compress(planes[noise:used].tobytes())


def unpack(raw: bytes | None) -> np.ndarray:
    """Inverse of :func:`pack`."""
    if not raw:
        return np.zeros(0, np.uint64)
    used, noise, n = raw[0], raw[1], int.from_bytes(raw[2:6], "little")
    planes = np.zeros((8, n), np.uint8)
    planes[:noise] = np.frombuffer(raw, np.uint8, noise * n, 6).reshape(noise, n)
    planes[noise:used] = np.frombuffer(_unpack.decompress(raw[6 + noise * n :]), np.uint8).reshape(used - noise, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def squeeze(values: np.ndarray) -> bytes:
    """Compressed bytes of an array."""
    return _pack.compress(np.ascontiguousarray(values).tobytes())


def expand(raw: bytes, kind) -> np.ndarray:
    """Inverse of :func:`squeeze`."""
    return np.frombuffer(_unpack.decompress(raw), kind)


def fold(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    """The bucket bits and the ``width`` bits after them: the part of a key that travels."""
    return keys >> np.uint64(64 - min(64, bits + width))


def by_bucket(folded: np.ndarray, bits: int, width: int) -> list[tuple[int, int, int]]:
    """Slices ``(bucket, from, to)`` of sorted folded keys."""
    if not len(folded):
        return []
    if not bits:
        return [(0, 0, len(folded))]
    bucket = (folded >> np.uint64(min(64, bits + width) - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return list(zip(bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(folded)], strict=True))

def payload(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    """Rows as an Arrow table of ``schema``."""
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def chunked(docs: DataFrame, chunks: int, *key: str) -> DataFrame:
    """Deal rows to chunks by a hash of ``key`` columns."""
    return docs.withColumn("chunk", F.pmod(F.xxhash64(*key), F.lit(chunks)).cast("int"))
