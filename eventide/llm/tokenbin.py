"""Token ids in fixed-width bit-packed files (operator 9).

A corpus becomes a folder of segment rows in ascending ``doc_id`` order.  A
segment holds whole documents, about ``segment_ids`` ids, and its payload is
self-describing::

    b"TBP1"  u32 bits  u32 block  u32 blocks  u64 ids  u64 offset[blocks]  blocks...

Every id takes ``bits`` = the fewest bits that hold the vocabulary, least
significant bit first; a block of ``block`` ids starts at its own byte
offset, so any range is unpacked from its blocks alone.  Segments are rows
of a Parquet table because Spark's committed writers reach every store and
survive lost executors; the payload column is stored uncompressed.

Defined cases: a null or empty text is the end id alone; rows with a null
``doc_id`` come first; repeated ids and repeated rows are documents of their
own, in the order of (doc_id, text); an empty table gives an empty folder.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path

from .common import forget, map_batches, map_stream, partitions, text_col
from .tokens import default_tokenizer, encoder, load, text_slices

MAGIC = b"TBP1"
BLOCK = 8192
# Bytes of pieces and ids a worker keeps while it encodes.
CACHE = 64 << 20


def width(vocab_size: int) -> int:
    """Fewest bits that hold ids 0 .. vocab_size - 1."""
    return max(1, int(vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits an id, least significant first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].reshape(-1),
                       bitorder="little").tobytes()


def unpack_bits(buf, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(buf, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(buf, np.uint8), bitorder="little")[:n * bits].reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = flat
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(n)


def encode_segment(ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    parts = [pack_bits(ids[i:i + block], bits) for i in range(0, len(ids), block)]
    sizes = np.cumsum([0, *map(len, parts)])[:-1] if parts else np.zeros(0)
    head = MAGIC + struct.pack("<IIIQ", bits, block, len(parts), len(ids))
    base = len(head) + 8 * len(parts)
    return head + (sizes + base).astype("<u8").tobytes() + b"".join(parts)


def decode_range(buf: bytes, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Ids lo .. hi - 1, unpacking only the blocks that hold them."""
    if bytes(buf[:4]) != MAGIC:
        raise ValueError("not a token segment")
    bits, block, blocks, n = struct.unpack_from("<IIIQ", buf, 4)
    hi = n if hi is None else min(hi, n)
    if lo >= hi:
        return np.zeros(0, np.uint32)
    offset = np.frombuffer(buf, "<u8", blocks, 24)
    view = memoryview(buf)
    first, last = lo // block, (hi - 1) // block
    out = []
    for b in range(first, last + 1):
        end = int(offset[b + 1]) if b + 1 < blocks else len(buf)
        out.append(unpack_bits(view[int(offset[b]):end], min(block, n - b * block), bits))
    return np.concatenate(out)[lo - first * block:hi - first * block]


SEGMENTS = ("shard int, segment int, first_id long, n_ids long, bits int, payload binary, "
            "doc_ids array<long>, doc_lengths array<long>")


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text: str = "text",
                      segment_ids: int = 1 << 16) -> str:
    """Tokenise every document and write the segments under ``path``; returns ``path``."""
    tokenizer = tokenizer or default_tokenizer()
    bits = width(max(load(tokenizer).get_vocab_size(), end_id + 1))
    n = partitions(docs.sparkSession)
    rows = (docs.select(F.col(id_col).cast("long").alias("d"), text_col(text).alias("t"))
            .repartitionByRange(n, "d").sortWithinPartitions("d", "t"))

    def segments(batches):
        shard, seg, first = TaskContext.get().partitionId(), 0, 0
        enc, end = encoder(tokenizer, CACHE), np.uint32(end_id).tobytes()
        ids, raw, held = [], [], 0

        def flush():
            nonlocal seg, first, ids, raw, held
            flat = np.frombuffer(b"".join(raw), "<u4")
            out = {"shard": [shard], "segment": [seg], "first_id": [first], "n_ids": [len(flat)],
                   "bits": [bits], "payload": [encode_segment(flat, bits)],
                   "doc_ids": [ids], "doc_lengths": [[len(r) // 4 for r in raw]]}
            seg, first = seg + 1, first + len(flat)
            ids, raw, held = [], [], 0
            return out

        for b in batches:
            for part in text_slices(b, 1):
                for key, r in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    r += end
                    if held and held + len(r) > 4 * segment_ids:
                        yield flush()
                    ids.append(key)
                    raw.append(r)
                    held += len(r)
        if raw:
            yield flush()

    (map_stream(rows, segments, SEGMENTS).write.option("compression", "none")
     .option("parquet.block.size", 4 << 20).parquet(path))
    return path


def binary_values(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The documents' ids, which lie end to end in ``flat``, as one little-endian binary value each.

    Arrow takes the memory as it is.  It must not be given memoryviews: it
    keeps a reference to each, so a worker would hold all ids it ever read.
    """
    data = np.ascontiguousarray(flat, "<u4")
    offsets = 4 * np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends),
                                            [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token folder: doc_id, shard, start (ids of all documents before it), ids.

    ``ids`` is little-endian unsigned 32-bit.  Only one row per shard reaches
    the driver, to add up the shards' lengths.
    """
    segs = spark.read.schema(SEGMENTS).parquet(path)
    sizes = segs.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    base, total = {}, 0
    for r in sizes:
        base[r.shard] = total
        total += r.n

    def unpack(b):
        forget()
        shards, firsts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for k, (shard, first) in enumerate(zip(shards, firsts)):
            flat = decode_range(b.column(2)[k].as_buffer())
            ids, lens = b.column(3)[k].as_py(), b.column(4)[k].as_py()
            ends = np.cumsum(np.asarray(lens, np.int64))
            start = base[shard] + first + ends - np.asarray(lens, np.int64)
            yield {"doc_id": ids, "shard": [shard] * len(ids), "start": start, "n_tokens": lens,
                   "ids": binary_values(flat, ends)}

    cols = segs.select("shard", "first_id", "payload", "doc_ids", "doc_lengths")
    return map_batches(cols, unpack, "doc_id long, shard int, start long, n_tokens long, ids binary", 8)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None,
                end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and read every document's ids back."""
    path = scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    return read_token_files(spark, write_token_files(docs, path, tokenizer, end_id))


def crc32_of(col: str = "ids"):
    """Unsigned crc32 of a binary column (Spark's own, as a long)."""
    return F.crc32(F.col(col))


def plain_crc32(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
