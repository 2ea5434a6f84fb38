"""Ranked lexical search with hashed max-sketches.

Index.  Documents are cut into blocks of about ``BLOCK_BYTES`` bytes; a block keeps
the terms of its documents as sorted postings (document, term, occurrences) and
a dictionary of its terms.  A document's impacts ``(10^9 tf) div (1000 tf + 12 m)``
fold into a sketch: each term hashes to a coordinate, which keeps the largest
impact that falls on it.  The width is a power of two, at least twice the number of
the document's terms (``WIDTHS`` at least and at most); a coordinate is one byte, the
impact rounded up to the next of 255 steps.

Search.  Queries come in batches of ``BATCH`` items.  For a block, one lookup of all
terms of the batch in its sketches gives an upper bound of every score: weight
times the coordinate, summed over the item's terms.  For each item, documents are
then scored exactly from the postings in descending order of their bounds, until
the bound falls below the ``top``-th best score that the partition has found so
far for the item.  A bound never lies below its score, so the result is exact.
Each partition gives its best ``top`` documents for each item, and Spark takes the
best of those.

Weights need N, L and the documents of each query term; all are summed by Spark
over the blocks' dictionaries.  All sums and scores are 64-bit integers.

Result: per item the ``top`` documents with the highest scores above 0, then by
doc_id: ``item_id, rank, doc_id, score``.  Null texts have no terms; such documents
count for nothing and such items give no rows.  Rows that share a doc_id are
documents of their own; a null doc_id comes last among equal scores.  Repeated
rows (same id and text) of the items are answered once.  Ids are integers.  Empty
tables give no rows.  Extra columns are ignored.  Of an item, all terms go to the
driver, a batch at a time; documents never do."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from .common import discard, stored, stream_arrow, table, text_of
from .flat import FlatWords, byte_classes, cuts, pack, text_bytes, unpack

TOP = 20
BATCH = 256
BLOCK_BYTES = 4 << 20
WIDTHS = (64, 16384)
#: Documents scored between two looks at the threshold.
CHUNK = 32
#: Parts of an item's candidates for the first round of ranking.
RANK_PARTS = 64
TERMS_OF = byte_classes(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: ``0-9``, ``a-z`` and all bytes of other characters stay; A-Z are lower-cased before.
TERMS_OF[ord("A"):ord("Z") + 1] = 0
#: The steps of a coordinate: impacts are at most 10^6.
STEPS = np.concatenate([[0], np.unique(np.ceil(np.geomspace(1, 1_000_000, 255)).astype(np.int64))])
_LAST = np.iinfo(np.int64).max


def term_hashes(terms: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(t.encode()) for t in terms.to_pylist()), np.uint32, len(terms))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m)


def postings(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks: ``doc_ids``, ``n`` (terms of each document), ``terms``, ``df`` (documents of the
    block with each), and the packed columns ``owner, code, tf`` sorted by document and term."""
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text")
            for lo, hi in cuts(text_bytes(texts), block_bytes):
                f = FlatWords(texts.slice(lo, hi - lo), TERMS_OF)
                if not len(f.codes):
                    continue
                n = np.bincount(f.doc, minlength=hi - lo)
                have = np.flatnonzero(n)
                place = np.zeros(hi - lo, np.int64)
                place[have] = np.arange(len(have))
                key, tf = np.unique(place[f.doc] << 32 | f.codes, return_counts=True)
                code = (key & 0xFFFFFFFF).astype(np.int32)
                yield [pa.array([number]), one(ids.slice(lo, hi - lo).take(pa.array(have))), one(pa.array(n[have].astype(np.int64))),
                       one(f.words.cast(pa.string())), one(pa.array(np.bincount(code, minlength=len(f.words)).astype(np.int64))),
                       pa.array([pack((key >> 32).astype(np.int32))]), pa.array([pack(code)]), pa.array([pack(tf.astype(np.int32))])]
                number += 1

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return stream_arrow(d, run, "block long, doc_ids array<long>, n array<long>, terms array<string>, df array<long>, owner binary, code binary, tf binary")


def sketch(owner: np.ndarray, slot: np.ndarray, impact: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """``widths`` of the documents and their sketches one after another."""
    terms = np.bincount(owner, minlength=docs)
    widths = np.clip(1 << np.ceil(np.log2(np.maximum(1, 2 * terms))).astype(np.int64), *WIDTHS)
    start = np.concatenate([[0], np.cumsum(widths)])
    out = np.zeros(start[-1], np.uint8)
    at = start[owner] + (slot & (widths[owner] - 1))
    np.maximum.at(out, at, np.searchsorted(STEPS, impact).astype(np.uint8))
    return widths, out


def sketched(blocks: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: blocks with ``m`` and the sketches of their documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in batches:
            for i in range(b.num_rows):
                n = b.column("n")[i].values.to_numpy()
                m = np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
                owner, code, tf = (unpack(b.column(c)[i].as_py(), np.int32) for c in ("owner", "code", "tf"))
                slots = term_hashes(b.column("terms")[i].values).astype(np.int64)
                widths, s = sketch(owner, slots[code], impacts(tf, m[owner]), len(n))
                yield [*(b.column(c).slice(i, 1) for c in ("block", "doc_ids", "terms", "owner", "code", "tf")),
                       pa.array([pack(m)]), pa.array([pack(widths)]), pa.array([pack(s)])]

    return stream_arrow(blocks.select("block", "doc_ids", "n", "terms", "owner", "code", "tf"), run,
                        "block long, doc_ids array<long>, terms array<string>, owner binary, code binary, tf binary, m binary, widths binary, sketches binary")


class Batch:
    """Items of one pass: for each the places of its terms in ``terms`` and their weights."""

    def __init__(self, items: list[tuple[int, list[str], list[int]]]):
        self.keys = [k for k, _, _ in items]
        self.terms = pa.array(sorted({t for _, ts, _ in items for t in ts}), pa.string())
        place = {t: i for i, t in enumerate(self.terms.to_pylist())}
        self.places = [np.array([place[t] for t in ts], np.int64) for _, ts, _ in items]
        self.weights = [np.array(ws, np.int64) for _, _, ws in items]
        self.slots = term_hashes(self.terms).astype(np.int64)
        self.flat = np.concatenate(self.places)
        self.flat_weights = np.concatenate(self.weights)
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in self.places])[:-1]])

    def bounds(self, widths: np.ndarray, sketches: np.ndarray) -> np.ndarray:
        """Documents x items: no score lies above."""
        out = np.empty((len(widths), len(self.keys)), np.int64)
        start = np.concatenate([[0], np.cumsum(widths)])
        for w in np.unique(widths):
            docs = np.flatnonzero(widths == w)
            slots = (self.slots & (w - 1))[self.flat]
            some = max(1, (4 << 20) // (len(self.flat) + int(w)))
            for lo in range(0, len(docs), some):
                d = docs[lo:lo + some]
                rows = sketches[start[d][:, None] + np.arange(w)]
                out[d] = np.add.reduceat(STEPS[rows[:, slots]] * self.flat_weights, self.starts, axis=1)
        return out


class Best:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top = top
        self.score = self.doc = np.empty(0, np.int64)

    @property
    def threshold(self) -> int:
        """A score that a document must reach to count."""
        return max(1, int(self.score[-1])) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        by = np.lexsort([doc, -score])
        by = by[score[by] > 0][:self.top]
        self.score, self.doc = score[by], doc[by]


def search_block(batch: Batch, best: list[Best], doc_ids: np.ndarray, terms: pa.Array, owner: np.ndarray, code: np.ndarray, tf: np.ndarray,
                 m: np.ndarray, widths: np.ndarray, sketches: np.ndarray) -> int:
    """Bring ``best`` up to date with a block's documents; gives the number of exact scores."""
    bound = batch.bounds(widths, sketches)
    codes = pc.fill_null(pc.index_in(batch.terms, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    keys = owner.astype(np.int64) << 32 | code
    scored = 0
    for k, top in enumerate(best):
        c, w = codes[batch.places[k]], batch.weights[k]
        c, w = c[c >= 0], w[c >= 0]
        if not len(c):
            continue  # none of the item's terms is in the block: all its scores are 0
        ub = bound[:, k]
        can = np.flatnonzero(ub >= top.threshold)
        can = can[np.argsort(-ub[can], kind="stable")]
        for lo in range(0, len(can), CHUNK):
            if ub[can[lo]] < top.threshold:
                break
            d = can[lo:lo + CHUNK]
            want = d[:, None] << 32 | c
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            f = np.where(keys[at] == want, tf[at], 0)
            top.add((impacts(f, m[d][:, None]) * w).sum(1), doc_ids[d])
            scored += len(d)
    return scored


def search_batch(index: DataFrame, batch: Batch, top: int) -> DataFrame:
    """``q, doc_id, score``: each partition's best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        best = [Best(top) for _ in batch.keys]
        for b in batches:
            for i in range(b.num_rows):
                ids = pc.fill_null(b.column("doc_ids")[i].values, _LAST).to_numpy()
                owner, code, tf = (unpack(b.column(c)[i].as_py(), np.int32) for c in ("owner", "code", "tf"))
                m, widths = (unpack(b.column(c)[i].as_py(), np.int64) for c in ("m", "widths"))
                search_block(batch, best, ids, b.column("terms")[i].values, owner, code, tf, m, widths, unpack(b.column("sketches")[i].as_py(), np.uint8))
        q = np.concatenate([np.full(len(x.score), k, np.int64) for k, x in zip(batch.keys, best)])
        if len(q):
            doc = np.concatenate([x.doc for x in best])
            yield [q, pa.array(doc, pa.int64(), mask=doc == _LAST), np.concatenate([x.score for x in best])]

    return stream_arrow(index, run, "q long, doc_id long, score long")


def queries_of(items: DataFrame) -> DataFrame:
    """``q, item_id, term, qtf``: the numbered items' terms."""
    def run(b: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for x in b:
            f = FlatWords(x.column("text"), TERMS_OF)
            key, n = np.unique(f.doc.astype(np.int64) << 32 | f.codes, return_counts=True)
            rows = pa.array(key >> 32)
            yield [x.column("q").take(rows), x.column("item_id").take(rows), f.words.take(pa.array(key & 0xFFFFFFFF)), n]

    d = global_row_number(items.select("item_id", text_of().alias("text")).distinct(), ["item_id"], "q")
    kind = items.schema["item_id"].dataType.simpleString()
    return stream_arrow(d.select("q", "item_id", "text"), run, f"q long, item_id {kind}, term string, qtf long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, batch: int = BATCH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    kind, own = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType
    blocks = stored(postings(docs, block_bytes), "postings")
    n_docs, n_terms = blocks.agg(F.sum(F.size("doc_ids")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    query = stored(queries_of(items), "query-terms")
    last = query.agg(F.max("q")).first()[0]
    spark = docs.sparkSession
    if not n_docs or last is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {own.simpleString()}, score long")
    df = blocks.select(F.inline(F.arrays_zip("terms", "df"))).join(query.select(F.col("term").alias("terms")).distinct(), "terms").groupBy(
        F.col("terms").alias("term")).agg(F.sum("df").alias("df"))
    query = stored(query.join(df, "term"), "query-weights")  # terms of no document add nothing
    index = stored(sketched(blocks, n_docs, n_terms), "sketches")
    discard(blocks)
    found = []
    for lo in range(1, last + 1, batch):
        part: dict[int, tuple[list, list]] = {}
        for r in query.where(F.col("q").between(lo, lo + batch - 1)).orderBy("q", "term").toLocalIterator():
            ts, ws = part.setdefault(r.q, ([], []))
            ts.append(r.term)
            ws.append(r.qtf * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))))
        if part:
            found.append(stored(search_batch(index, Batch([(q, *x) for q, x in part.items()]), top), "found"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {own.simpleString()}, score long")
    got = found[0]
    for x in found[1:]:
        got = got.union(x)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(RANK_PARTS))
    got = got.withColumn("rank", F.row_number().over(W.partitionBy("q", part).orderBy(*order))).where(F.col("rank") <= top)
    got = got.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(*order))).where(F.col("rank") <= top)
    names = query.select("q", "item_id").distinct()
    return got.join(names, "q").select("item_id", "rank", F.col("doc_id").cast(own).alias("doc_id"), "score")


def op13(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS (SELECT row, doc_id, len(ts) AS n, term, count(*) AS tf FROM (SELECT row, doc_id, ts, unnest(ts) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark WHERE text IS NOT NULL),
qt AS (SELECT item_id, term, count(*) AS qtf FROM q GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, size WHERE term IN (SELECT term FROM qt) GROUP BY term, n_docs),
s AS (SELECT item_id, row, doc_id,
             sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM qt JOIN w USING (term) JOIN tf USING (term), size GROUP BY item_id, row, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
"""
