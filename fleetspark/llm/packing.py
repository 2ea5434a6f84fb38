"""Packing: shortest-pack-first over the length histogram.

1. Every text becomes ids with an end id and is cut into pieces of at most
   ``max_len`` ids: full pieces, then the rest.
2. The histogram of piece lengths (at most ``max_len`` rows) goes to the driver.
   Lengths are placed longest first into the open packing pattern with the
   fewest ids in which they still fit; patterns carry counts, and a pattern is
   split when only a part of its packs takes the length.
3. Patterns are joined back to the pieces by rank: a piece's rank among those
   of its length picks the pattern, the pack and the offset.  Ranks come from
   counts per (length, bucket) and row numbers inside them, so a length that a
   third of all documents have is no hot group.

Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
(and ``ids`` on request).  Null texts are empty: one piece with the end id
alone.  Rows that share a doc_id (null too) are packed as documents of their own;
equal rows are told apart by their order only, which does not change the
result.  An empty table gives no pieces.  Extra columns are ignored."""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, stored, stream_arrow, table, text_of
from .tokens import default_vocabulary, encoder

MAX_LEN = 2048
#: Pieces of one length that a task ranks, on average.
BUCKET_ROWS = 50_000


def pieces(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, on request, ``ids``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in batches:
            for lo, hi, ids, offsets in encoder(vocabulary).batches(b.column("text")):
                doc, start, length = cut_ids(offsets, max_len)
                at = offsets[doc] + start
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crc = [zlib.crc32(raw[4 * x:4 * (x + n)]) for x, n in zip(at.tolist(), length.tolist())]
                cols = [b.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), start, length, crc, np.diff(offsets)[doc]]
                if with_ids:  # pieces lie one after another
                    cols.append(pa.LargeListArray.from_arrays(np.append(at, len(ids)), ids.astype(np.int64)).cast(pa.list_(pa.int64())))
                yield cols

    ddl = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return stream_arrow(docs.select("doc_id", text_of().alias("text")), run, ddl)


def cut_ids(offsets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length)`` of the pieces of at most ``most`` ids, in order."""
    n = np.diff(offsets)
    count = -(-n // most)
    doc = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * most
    return doc, start, np.minimum(most, n[doc] - start)


def shortest_pack_first(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(packs, [(length, times), ...])`` patterns, longest lengths first.

    Open patterns are kept by their free space; the shortest pack is the one
    with the most.  Every step places as many pieces of a length as the pattern
    holds in one go, so the work follows the number of lengths, not of pieces."""
    free: dict[int, list[tuple[int, list]]] = {}
    spaces: list[int] = []
    done: list[tuple[int, list]] = []

    def put(packs: int, pattern: list, space: int) -> None:
        if not packs:
            return
        if not space:
            done.append((packs, pattern))
            return
        if space not in free:
            free[space] = []
            insort(spaces, space)
        free[space].append((packs, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if spaces and spaces[-1] >= length:
                space = spaces[-1]
                packs, pattern = free[space].pop()
                if not free[space]:
                    del free[space]
                    spaces.pop()
                take = min(packs, left)
                put(packs - take, pattern, space)
                times = max(1, min(space // length, left // take)) if take == packs else 1
                # one piece for each pack at a time; all packs of the pattern stay equal
                times = 1 if any(s >= length for s in spaces) else times
                put(take, [*pattern, (length, times)], space - times * length)
                left -= take * times
            else:
                times = min(left, max_len // length)
                packs = left // times
                put(packs, [(length, times)], max_len - times * length)
                left -= packs * times
    return done + [p for s in spaces for p in free[s]]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length rows ``(first rank, first sequence, times, offset)``, ordered by first rank.
    A slot serves ``packs * times`` ranks: rank r goes to sequence first + (r - rank) // times."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    seq = 0
    for packs, pattern in patterns:
        offset = 0
        for length, times in pattern:
            r = ranks.get(length, 0)
            out.setdefault(length, []).append((r, seq, times, offset))
            ranks[length] = r + packs * times
            offset += length * times
        seq += packs
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def ranked(p: DataFrame, buckets: int) -> DataFrame:
    """``rank``: 0, 1, ... among the pieces of a length; ``buckets`` grow with the most frequent length."""
    p = p.withColumn("_b", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = p.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    w = W.partitionBy("length").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(F.col("length").alias("_l"), F.col("_b").alias("_k"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    inner = W.partitionBy("length", "_b").orderBy("doc_id", "start", "ids_crc32")
    return (p.withColumn("_r", F.row_number().over(inner) - 1).join(base, (F.col("length") == F.col("_l")) & (F.col("_b") == F.col("_k")))
            .withColumn("rank", F.col("_base") + F.col("_r")).drop("_b", "_l", "_k", "_r", "_base"))


def pack(docs: DataFrame, vocabulary: str | None = None, max_len: int = MAX_LEN, with_ids: bool = False) -> DataFrame:
    vocabulary = vocabulary or default_vocabulary()
    p = stored(pieces(docs, vocabulary, max_len, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in p.groupBy("length").count().collect()}  # max_len rows at most
    where, cols = slots(shortest_pack_first(histogram, max_len)), p.columns

    def place(b: pa.RecordBatch) -> list:
        length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            at = length == n
            t = where[int(n)]
            s = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
            k = rank[at] - s[:, 0]
            seq[at] = s[:, 1] + k // s[:, 2]
            off[at] = s[:, 3] + k % s[:, 2] * n
        return [*(b.column(c) for c in cols), seq, off]

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in p.schema)
    return map_arrow(ranked(p, 1 + max(histogram.values(), default=0) // BUCKET_ROWS), place, f"{ddl}, sequence_id long, offset long")


def op2(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
