"""Token ids in files of fixed-width bit-packed blocks.

Each id takes the fewest bits that hold every id of the vocabulary. A file is the Parquet table of its blocks, so
it lies wherever Spark can write; documents follow each other in ascending doc_id, in shards (ranges of doc_id)
that are written side by side. A block is self-contained:

    4 bytes "GLB1", u8 bits per id, 3 bytes 0, u32 documents, u32 ids, u64 ids of the shard before it,
    documents x (i64 doc_id, u32 ids before it in the block), then the ids, little-endian bits

so numpy unpacks a block, one document or any run of ids without reading the rest. A document is never
split; a block is closed at BLOCK_IDS ids or more.

Defined cases: a null or empty text has only the end id; a null doc_id comes first and is kept
as null (the least 64-bit integer stands for it in a block); rows with equal doc_id follow each
other in the order of their ids; an empty table makes an empty file; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.encoding import encoder, public_path
from gaugelake.llm.shared import Scratch, documents, range_bounds, range_of, ranges_for, text_batches

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408  # fixed: ids of the tokenizer
END_ID = 2  # fixed: appended to each document
BLOCK_IDS = 1 << 17

HEADER = struct.Struct("<4sB3xIIQ")
ENTRY = np.dtype([("doc_id", "<i8"), ("start", "<u4")])
NO_ID = -(2**63)  # stands for null in a block


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` on; only their bytes are touched."""
    lo, hi = start * bits // 8, -(-(start + count) * bits // 8)
    raw = np.frombuffer(packed, np.uint8)[lo:hi]
    if bits in (8, 16, 32):
        return raw.view(f"<u{bits // 8}").astype(np.uint32)
    skip = start * bits - lo * 8
    planes = np.unpackbits(raw, bitorder="little")[skip: skip + count * bits].reshape(count, bits)
    return planes.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def make_block(docs: list[tuple[int | None, np.ndarray]], before: int, bits: int) -> bytes:
    lengths = [len(ids) for _, ids in docs]
    index = np.empty(len(docs), ENTRY)
    index["doc_id"] = [NO_ID if d is None else d for d, _ in docs]
    index["start"] = np.cumsum([0, *lengths[:-1]])
    ids = np.concatenate([i for _, i in docs])
    return HEADER.pack(b"GLB1", bits, len(docs), len(ids), before) + index.tobytes() + pack(ids, bits)


def block_index(block: bytes) -> tuple[int, int, np.ndarray, np.ndarray, memoryview]:
    """Bits, ids of the shard before the block, doc_ids, bounds of the documents, packed ids."""
    magic, bits, n_docs, n_ids, before = HEADER.unpack_from(block)
    if magic != b"GLB1":
        raise ValueError("not a block of token ids")
    index = np.frombuffer(block, ENTRY, n_docs, HEADER.size)
    bounds = np.append(index["start"].astype(np.int64), n_ids)
    return bits, before, index["doc_id"], bounds, memoryview(block)[HEADER.size + n_docs * ENTRY.itemsize:]


def read_document(block: bytes, place: int) -> np.ndarray:
    """The ids of one document of a block."""
    bits, _, _, bounds, packed = block_index(block)
    return unpack(packed, bits, int(bounds[place]), int(bounds[place + 1] - bounds[place]))


def encode_documents(docs: DataFrame, path: str, kind: str, end_id: int, bits: int) -> DataFrame:
    """doc_id and its ids as little-endian bytes of 2 or 4 each.

    Idle workers stay beside those of later stages, so a worker gives back what it no longer uses after each batch of
    texts, and keeps no words once its task is done.
    """
    wide = "<u2" if bits <= 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pool = encoder(path, kind), pa.default_memory_pool()
        for whole in batches:
            for batch in text_batches(whole, "text"):
                ids = [np.append(found, np.uint32(end_id)).astype(wide).tobytes()
                       for found in own.encode_all(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard"), batch.column("doc_id"), pa.array(ids, pa.binary())],
                    ["shard", "doc_id", "ids"])
                pool.release_unused()
        own.forget()
        pool.release_unused()

    return docs.select("shard", "doc_id", "text").mapInArrow(encode, "shard int, doc_id long, ids binary")


def write_blocks(docs: DataFrame, path: str, kind: str = "word", vocabulary: int = VOCABULARY,
                 end_id: int = END_ID) -> DataFrame:
    """shard, block, its number of ids and its bytes, documents in ascending doc_id."""
    spark = docs.sparkSession
    bits = bits_for(vocabulary)
    wide = "<u2" if bits <= 16 else "<u4"
    bounds = range_bounds(docs, "doc_id", 2 * ranges_for(spark))
    encoded = encode_documents(docs.withColumn("shard", range_of("doc_id", bounds)), path, kind, end_id, bits)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before, held, n = None, 0, 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([n], pa.int64()), pa.array([make_block(held, before, bits)], pa.binary())],
                ["shard", "block", "n_ids", "data"])

        for batch in batches:
            for s, doc_id, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids")), strict=True):
                if held and (s != shard or n >= BLOCK_IDS):
                    yield close()
                    number, before, held, n = number + 1, before + n, [], 0
                if s != shard:
                    shard, number, before = s, 0, 0
                ids = np.frombuffer(raw, wide)
                held.append((doc_id, ids))
                n += len(ids)
        if held:
            yield close()

    return (encoded.repartition(F.col("shard"))
            .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
            .mapInArrow(blocks, "shard int, block int, n_ids long, data binary"))


def read_index(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and checksum of every document, decoded from the blocks.

    ``start`` counts the ids of all documents before: those of the shards before (summed up over the totals, one row
    per shard), and those of the shard, which the block holds.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("data"), strict=True):
                data = data.as_py()
                bits, before, doc_ids, bounds, packed = block_index(data)
                ids = unpack(packed, bits, 0, int(bounds[-1])).astype("<u4")
                crcs = [zlib.crc32(ids[lo:hi]) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(doc_ids), pa.int32()), pa.array(doc_ids, mask=doc_ids == NO_ID),
                     pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())],
                    ["shard", "doc_id", "start_in_shard", "n_tokens", "ids_crc32"])

    rows = blocks.select("shard", "data").mapInArrow(
        decode, "shard int, doc_id long, start_in_shard long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select(
        "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    return rows.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")


def op6_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Scratch(spark, "token-files")
    blocks = files.save(write_blocks(documents(spark, sf_dir), public_path(TOKENIZER)), "blocks")
    return read_index(blocks)
