"""Training-order materialisation: every sequence gets a global slot by a keyed
permutation, and range partitions of the slots write fixed-stride shards.

1. Every text becomes ids with an end id, cut into sequences of at most
   ``seq_len`` ids.  A sequence is one record: its length and its ids as
   little-endian unsigned 16-bit numbers, padded with zeros to a fixed size.
2. Sequences are numbered 0 .. n-1 by input partition and place in it; a rerun
   over the same files with the same split size gives the same numbers.
3. slot = a keyed Feistel permutation of the number over the smallest domain
   4^k >= n, walking its cycle until it falls below n: a bijection of 0 .. n-1
   that needs no table.
4. Ranges of ``per_shard`` slots are partitions, and each writes a shard.  A shard is one
   file by Spark's text writer, a record and a line feed at a time, so every
   record takes ``stride`` bytes: slot s lies at byte ``(s % per_shard) * stride``
   of shard ``s // per_shard``.  ``read_slots`` resumes at any slot and reads on in order.

Result: a row per sequence with ``doc_id, start, length, ids_crc32, sequence,
slot, shard, byte_offset``.  Null texts are empty: one sequence with the end id.
Rows that share a doc_id (null too) are documents of their own.  An empty table gives
no rows and no shards.  Extra columns are ignored.  Vocabularies of more than
65,536 ids are refused."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import matches
from .common import map_arrow, shared_folder, small, stored, stream_arrow, table, text_of
from .packing import cut_ids
from .tokens import default_vocabulary, encoder

SEQ_LEN = 256
#: Records of a shard, 135 MB at 256 ids each.
PER_SHARD = 262_144
KEY = 0x5EED
ROUNDS = 6


def stride(seq_len: int) -> int:
    """Bytes of a record in a shard: its length, its ids and a line feed."""
    return 2 * (seq_len + 1) + 1


def records(docs: DataFrame, vocabulary: str, seq_len: int) -> DataFrame:
    """``doc_id, start, length, ids_crc32, part, pos, record``: record ``pos`` of input partition ``part``, not padded yet."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        part, pos = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi, ids, offsets in encoder(vocabulary).batches(b.column("text")):
                if len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("records hold ids of 16 bits")
                doc, start, length = cut_ids(offsets, seq_len)
                at = offsets[doc] + start
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[4 * x:4 * (x + n)]) for x, n in zip(at.tolist(), length.tolist())]
                # every sequence's length, then its ids
                body = np.empty(len(ids) + len(at), "<u2")
                head = at + np.arange(len(at))
                body[head] = length
                body[np.arange(len(ids)) + np.repeat(np.arange(len(at)), length) + 1] = ids
                record = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(2 * head, 2 * len(body))), pa.py_buffer(body)])
                yield [b.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), start, length, crc, np.full(len(at), part),
                       np.arange(pos, pos + len(at)), record]
                pos += len(at)

    return stream_arrow(docs.select("doc_id", text_of().alias("text")), run,
                        f"doc_id {kind}, start long, length long, ids_crc32 long, part int, pos long, record binary")


def feistel_width(n: int) -> int:
    """Bits of a half: the domain 4^k covers n."""
    k = 1
    while 4 ** k < n:
        k += 1
    return k


def feistel(x: int, n: int, key: int = KEY) -> int:
    """The permutation on plain numbers; the reference for the column form."""
    k = feistel_width(n)
    mask = (1 << k) - 1
    while True:
        left, right = x >> k, x & mask
        for r in range(ROUNDS):
            f = (right * 0x2545F491 + (key ^ (r * 0x9E3779B1))) & 0x7FFFFFFF
            f = ((f ^ (f >> 15)) * 0x2C1B3C6D) & 0x7FFFFFFFFFFFFFFF
            f = (f ^ (f >> 21)) & mask
            left, right = right, left ^ f
        x = left << k | right
        if x < n:
            return x


def feistel_array(x: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """``feistel`` on an array of numbers below n; the walk goes on for those still outside."""
    k = feistel_width(n)
    kk, mask = np.uint64(k), np.uint64((1 << k) - 1)
    x = x.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        v = x[todo]
        left, right = v >> kk, v & mask
        for r in range(ROUNDS):
            f = (right * np.uint64(0x2545F491) + np.uint64(key ^ (r * 0x9E3779B1))) & np.uint64(0x7FFFFFFF)
            f = ((f ^ (f >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & np.uint64(0x7FFFFFFFFFFFFFFF)
            f = (f ^ (f >> np.uint64(21))) & mask
            left, right = right, left ^ f
        x[todo] = left << kk | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def materialise(docs: DataFrame, path: str, vocabulary: str | None = None, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD,
                key: int = KEY) -> DataFrame:
    """Write the shards below ``path`` and return the index rows."""
    rec = stored(records(docs, vocabulary or default_vocabulary(), seq_len), "records")
    parts = rec.groupBy("part").count().checkpoint()
    n = parts.agg(F.sum("count")).first()[0] or 0
    base = parts.select(F.col("part").alias("_p"), F.coalesce(
        F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    numbered = rec.join(small(base), F.col("part") == F.col("_p")).withColumn("sequence", F.col("_base") + F.col("pos")).drop("_p", "_base", "part", "pos")
    slot = _slots(n, key)
    # a slot names its shard, and the shard its partition: nothing is sampled
    shards = max(1, -(-n // per_shard))
    sent = bundles(numbered.select("sequence", "record"), n, per_shard, key).repartitionById(shards, "shard")
    lines = unbundled(sent, seq_len).sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("compression", "none").text(path)
    return (numbered.drop("record").withColumn("slot", slot(F.col("sequence"))).withColumn("shard", F.expr(f"slot div {per_shard}"))
            .withColumn("byte_offset", F.expr(f"slot % {per_shard} * {stride(seq_len)}")))


def bundles(numbered: DataFrame, n: int, per_shard: int, key: int) -> DataFrame:
    """``shard, records``: the records of an Arrow batch that go to one shard, with their slots, compressed together."""
    def run(b: pa.RecordBatch) -> list[tuple]:
        slots = feistel_array(b.column("sequence").to_numpy(), n, key)
        by = np.argsort(slots, kind="stable")
        slots, records = slots[by], b.column("record").take(pa.array(by)).cast(pa.large_binary()).to_pylist()
        first = np.flatnonzero(np.diff(slots // per_shard, prepend=-1)).tolist()
        out = []
        for lo, hi in zip(first, [*first[1:], len(slots)]):
            size = np.array([len(r) for r in records[lo:hi]], np.int32)
            raw = b"".join([(hi - lo).to_bytes(8, "little"), slots[lo:hi].tobytes(), size.tobytes(), *records[lo:hi]])
            out.append((int(slots[lo] // per_shard), len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)))
        return out

    return map_arrow(numbered, run, "shard int, records binary")


def unbundled(sent: DataFrame, seq_len: int) -> DataFrame:
    """``shard, slot, record``: the records, padded with zeros to one size."""
    width = stride(seq_len) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in batches:
            for shard, z in zip(b.column("shard").to_pylist(), b.column("records").to_pylist()):
                raw = pa.Codec("zstd").decompress(z[8:], int.from_bytes(z[:8], "little"), asbytes=True)
                n = int.from_bytes(raw[:8], "little")
                slots = np.frombuffer(raw, np.int64, n, 8)
                size = np.frombuffer(raw, np.int32, n, 8 + 8 * n).astype(np.int64)
                out = np.zeros(n * width, np.uint8)
                at = np.repeat(np.arange(n) * width - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                out[at] = np.frombuffer(raw, np.uint8, offset=8 + 12 * n)
                body = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.arange(n + 1) * width), pa.py_buffer(out)])
                yield [np.full(n, shard, np.int32), slots, body]

    return stream_arrow(sent, run, "shard int, slot long, record binary")


def _slots(n: int, key: int):
    """``feistel_array`` as an Arrow-batched function of a column."""
    @F.arrow_udf("long")
    def slot(x: pa.Array) -> pa.Array:
        return pa.array(feistel_array(x.to_numpy(zero_copy_only=False), n, key))
    return slot


def read_slots(spark: SparkSession, path: str, first: int, count: int, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD) -> DataFrame:
    """``slot, ids`` of ``count`` slots from ``first`` on: only the shards of the range are read, each row by its byte offset."""
    size, last = stride(seq_len), first + count - 1
    if not matches(spark, path + "/shard=*"):  # nothing was written
        return spark.createDataFrame([], "slot long, ids array<int>")
    files = spark.read.format("binaryFile").option("basePath", path).load(path + "/shard=*")
    f = files.where(F.col("shard").between(first // per_shard, last // per_shard))
    f = f.select(F.col("shard").cast("long").alias("shard"), "content", F.expr(f"explode(sequence(0L, length div {size} - 1))").alias("k"))
    f = f.withColumn("slot", F.col("shard") * per_shard + F.col("k")).where(F.col("slot").between(first, last))
    rec = f.select("slot", F.expr(f"substring(content, cast(k * {size} + 1 as int), {size - 1})").alias("r"))
    def decode(b: pa.RecordBatch) -> list:
        out = []
        for r in b.column("r").to_pylist():
            v = np.frombuffer(r, "<u2")
            out.append(v[1:1 + v[0]].tolist())
        return [b.column("slot"), out]

    return map_arrow(rec, decode, "slot long, ids array<int>")


def op1(spark, sf_dir: str) -> DataFrame:
    return materialise(table(spark, sf_dir, "documents"), shared_folder(spark, "training-order"))
