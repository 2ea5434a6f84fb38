"""Phrase collocations by SETM: relational mining with sorted merge-joins.

Occurrences.  Texts are lower-cased (A-Z), split into pieces and words, and kept
as a persisted relation sorted by piece and position.  A row of the stored table
is a block: consecutive texts of one language with about ``BLOCK_BYTES`` bytes,
its columns packed arrays.  A piece never crosses a block.

Level k.  R(k) holds for each position the frequent phrase of k words that
starts there.  R(k) is merge-joined with itself on equal piece and adjacent
position; each match is an occurrence of a phrase of k + 1 words whose two
parts of k words are frequent.  Occurrences are counted within the block, the
counts of all blocks are summed by Spark, and phrases with at least
``min_count`` are the next level's frequent groups.  They get numbers, and a
semi-join takes them back to the blocks where they occur; R(k + 1) is what it
leaves.  Level 1 starts from the words in the same way.  Counts are summed
before they are shuffled, so a phrase has a row for each block at most; nothing
is broadcast by us, and no group is held in one task.

Scores.  With a = f(phrase) and a cut after j words, l = f(first j words) and
r = f(rest); score = floor(1000000 a a / (l r)), in decimals of 38 digits.  The
cut with the lowest score counts, then the smallest j.  A phrase goes if a longer
candidate that holds its words in a row has ``100 f >= keep_percent a`` (it is
enough to look at candidates with one word more).

Result: per language (null: ``und``) the first ``top`` phrases by score and a
descending, then phrase in byte order: ``lang, rank, phrase, a, l, r, n, score,
n_words``; n counts all words of the language.  Null and empty texts and texts of
separators have no words; an empty table gives no rows.  Repeated rows and rows
without an id count like any other.  Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from .common import discard, enter, give_back, stored, stream_arrow, table, text_of
from .flat import FlatWords, byte_classes, cuts, pack, text_bytes, unpack

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
KEEP_PERCENT = 50
BLOCK_BYTES = 4 << 20
#: Texts of several languages wait for their blocks within so many bytes.
WAITING_BYTES = 24 << 20
#: Parts of a language for the first round of ranking.
RANK_PARTS = 256
CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
MAX_ID = (1 << 31) - 1


def occurrences(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The relation as blocks: ``block, lang, n, words`` (distinct ones), ``counts`` (of
    each), ``items`` (per position the index of its word) and ``joined`` (whether the next position is of the same piece)."""
    def block(texts: pa.Array, number: int, lang: str) -> list:
        f = FlatWords(texts, CLASSES)
        counts = np.bincount(f.codes, minlength=len(f.words)).astype(np.int64)
        joined = np.packbits(f.piece[1:] == f.piece[:-1])
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return [pa.array([number], pa.int64()), pa.array([lang]), pa.array([len(f.codes)], pa.int64()), one(f.words.cast(pa.string())),
                one(pa.array(counts)), pa.array([pack(f.codes)]), pa.array([pack(joined)])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        wait: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                texts = b.column("text").take(pa.array(np.flatnonzero(codes == k)))
                wait.setdefault(lang, []).append(texts)
                size[lang] = size.get(lang, 0) + int(text_bytes(texts).sum())
            full = [x for x in wait if size[x] >= block_bytes]
            for lang in (list(wait) if sum(size.values()) > WAITING_BYTES else full):
                number, out = yield from emit(wait.pop(lang), size.pop(lang), lang, number, lang not in full)
                if out is not None:
                    wait[lang], size[lang] = [out], int(text_bytes(out).sum())
        for lang, texts in wait.items():
            number, _ = yield from emit(texts, 0, lang, number, True)

    def emit(texts: list[pa.Array], _size: int, lang: str, number: int, last: bool):
        """Blocks of the waiting texts; unless ``last``, the short rest goes on waiting."""
        whole = pa.concat_arrays([x.cast(pa.large_string()) for x in texts])
        spans = list(cuts(text_bytes(whole), block_bytes))
        rest = None
        if not last and len(spans) > 1:
            lo, hi = spans.pop()
            rest = whole.slice(lo, hi - lo).cast(pa.string())
        for lo, hi in spans:
            yield block(whole.slice(lo, hi - lo), number, lang)
            number += 1
        return number, rest

    d = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    return stream_arrow(d, run, "block long, lang string, n long, words array<string>, counts array<long>, items binary, joined binary")


def numbered(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Frequent groups with ``id`` from 0, the most frequent first: small numbers pack well."""
    out = global_row_number(groups.withColumn("_o", -F.col("a")), ["_o", *keys], "id").drop("_o").withColumn("id", F.col("id") - 1)
    return out.withColumn("id", F.when(F.col("id") <= MAX_ID, F.col("id")).otherwise(F.raise_error(F.lit("too many frequent phrases")).cast("long")))


def filtered(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """Semi-join of a relation with the frequent groups in its blocks.  ``marks``: ``block,
    key, id``, a row for each frequent group that a block holds; ``key`` is the index of the
    word at level 1, else the packed key of ``extend``."""
    def take(key: tuple, rel: pa.Table, got: pa.Table) -> pa.Table:
        enter(__name__)
        if not rel.num_rows or not got.num_rows:
            return RELATION.empty_table()
        k, items = rel.column("k")[0].as_py(), unpack(rel.column("items")[0].as_py(), np.int32)
        keys, ids = got.column("key").to_numpy(), got.column("id").to_numpy()
        by = np.argsort(keys)
        keys, ids = keys[by], ids[by]
        if k:
            words = unpack(rel.column("words")[0].as_py(), np.int32)
            at, found = extend(items, words, unpack(rel.column("joined")[0].as_py(), np.uint8), k)
        else:
            at, found = np.arange(len(items)), items.astype(np.int64)
        pos = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        new = np.full(len(items), -1, np.int32)
        hit = keys[pos] == found
        new[at[hit]] = ids[pos[hit]]
        del at, found, pos, hit
        give_back()
        return pa.table([rel.column("block"), pa.array([k + 1], pa.int32()), pa.array([pack(new)]), pa.array([pack(words if k else new)]),
                         rel.column("joined")], schema=RELATION)

    marks = marks.select(F.col("block").alias("at"), "key", "id")  # another column, as both sides stem from one table
    return blocks.groupBy("block").cogroup(marks.groupBy("at")).applyInArrow(
        take, "block long, k int, items binary, words binary, joined binary")


RELATION = pa.schema([("block", pa.int64()), ("k", pa.int32()), ("items", pa.binary()), ("words", pa.binary()), ("joined", pa.binary())])


def extend(items: np.ndarray, words: np.ndarray, joined: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of R(k) with itself at adjacent positions of a piece: the positions where
    phrases of k + 1 words start, and their keys (number of the first k words, number of the last word)."""
    if len(items) <= k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    same = np.unpackbits(joined, count=len(items) - 1).view(bool)
    at = np.flatnonzero((items[:-1] >= 0) & (items[1:] >= 0) & same)
    return at, items[at].astype(np.int64) << 32 | words[at + k]


def pair_counts(rel: DataFrame) -> DataFrame:
    """``block, key, n``: the phrases of one word more, counted within each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in batches:
            for i in range(b.num_rows):
                items, words, joined = (unpack(b.column(c)[i].as_py(), t) for c, t in (("items", np.int32), ("words", np.int32), ("joined", np.uint8)))
                _, keys = extend(items, words, joined, b.column("k")[i].as_py())
                keys, n = np.unique(keys, return_counts=True)
                for lo in range(0, len(keys), 1 << 18):
                    part = slice(lo, lo + (1 << 18))
                    yield [pa.array(np.full(len(keys[part]), b.column("block")[i].as_py())), pa.array(keys[part]), pa.array(n[part])]

    return stream_arrow(rel.select("block", "k", "items", "words", "joined"), run, "block long, key long, n long")


def levels(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[DataFrame]]:
    """``(lang, n)`` and a table per length of the frequent phrases: ``id, lang, phrase, a,
    prev`` and ``suf`` (ids of the phrase without its last and its first word) and the
    counts ``l``, ``r`` of its cuts (arrays)."""
    if max_words < 1 or min_count < 1:
        raise ValueError("max_words and min_count must be 1 at least")
    occ = stored(occurrences(docs, block_bytes), "occurrences")
    total = stored(occ.groupBy("lang").agg(F.sum("n").alias("n")), "words-of-lang")
    in_block = occ.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "block", "lang", F.col("pos").cast("long").alias("key"), F.col("col.words").alias("phrase"), F.col("col.counts").alias("n"))
    f = in_block.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
    f = stored(numbered(f, ["lang", "phrase"]), "phrases-1")
    marks = in_block.join(f, ["lang", "phrase"]).select("block", "key", "id")
    rel = stored(filtered(occ.select("block", F.lit(0).alias("k"), "items", F.lit(None).cast("binary").alias("words"), "joined"), marks), "relation-1")
    discard(occ)
    none = F.array().cast("array<bigint>")
    out = [f.select("id", "lang", "phrase", "a", F.lit(None).cast("long").alias("prev"), F.lit(None).cast("long").alias("suf"), none.alias("l"), none.alias("r"))]
    for k in range(2, max_words + 1):
        counts = pair_counts(rel)
        g = counts.groupBy("key").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
        if k < max_words:
            g = stored(numbered(g, ["key"]), f"groups-{k}")
            new = stored(filtered(rel, counts.join(g, "key").select("block", "key", "id")), f"relation-{k}")
            discard(rel)
            rel = new
        else:
            g = stored(g.withColumn("id", F.monotonically_increasing_id()), f"groups-{k}")
            discard(rel)
        out.append(stored(described(g, out[-1], out[0], k), f"phrases-{k}"))
    return total, out


def described(groups: DataFrame, before: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Text, parts and cut counts of phrases from those of the length before."""
    g = groups.select("id", "a", F.shiftright("key", 32).alias("prev"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("last"))
    first = before.select(F.col("id").alias("prev"), "lang", F.col("phrase").alias("p"), F.col("a").alias("pa"), F.col("l").alias("pl"), F.col("suf").alias("psuf"))
    last = words.select(F.col("id").alias("last"), F.col("phrase").alias("w"))
    g = g.join(first, "prev").join(last, "last")
    rest = before.select(F.col("id").alias("suf"), F.col("a").alias("sa"), F.col("r").alias("sr"), *([] if k == 2 else [
        F.col("prev").alias("psuf"), F.col("_last").alias("last")]))
    g = g.withColumn("suf", F.col("last")).join(rest, "suf") if k == 2 else g.join(rest, ["psuf", "last"])
    return g.select("id", "lang", F.concat_ws(" ", "p", "w").alias("phrase"), "a", "prev", "suf", F.concat("pl", F.array("pa")).alias("l"),
                    F.concat(F.array("sa"), "sr").alias("r"), F.col("last").alias("_last"))


#: exact: 10^6 a a and l r stay below 10^38 while a is below 10^15; beyond it Spark raises an error
SCORE = "cast((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(x.l as decimal(19,0)) * cast(x.r as decimal(19,0))) as bigint)"


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 keep_percent: int = KEEP_PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    total, tables = levels(docs, min_count, max_words, block_bytes)
    kept = []
    for k, t in enumerate(tables[1:], 2):
        cuts_of = F.expr(f"transform(arrays_zip(l, r), (x, i) -> struct({SCORE} as score, i as j, x.l as l, x.r as r))")
        c = t.select("id", "lang", "phrase", "a", F.array_min(cuts_of).alias("c"), F.lit(k).alias("n_words"))
        if k < max_words:
            inside = tables[k].select(F.col("prev").alias("id"), F.col("a").alias("more")).union(tables[k].select("suf", "a"))
            inside = inside.groupBy("id").agg(F.max("more").alias("more"))
            c = c.join(inside, "id", "left").where(F.col("more").isNull() | (100 * F.col("more") < keep_percent * F.col("a")))
        kept.append(c.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"), "n_words"))
    if not kept:
        raise ValueError("phrases have two words at least")
    c = kept[0]
    for x in kept[1:]:
        c = c.union(x)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the first of each part, then the first of those: no language is ranked whole in one task
    part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    c = c.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    c = c.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return c.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "n_words")


def op11(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL11 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
o AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
n AS (SELECT lang, count(*) AS n FROM o GROUP BY lang),
f1 AS (SELECT lang, ws[i] AS x, count(*) AS a FROM o GROUP BY ALL),
f2 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, count(*) AS a FROM o WHERE i + 1 <= len(ws) GROUP BY ALL),
f3 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, count(*) AS a FROM o WHERE i + 2 <= len(ws)
       GROUP BY ALL HAVING count(*) >= 10),
c2 AS (SELECT f2.*, p.a AS l, q.a AS r, (1000000::HUGEINT * f2.a * f2.a) // (p.a::HUGEINT * q.a) AS score
       FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.x = f2.x JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y WHERE f2.a >= 10),
c3 AS (SELECT f3.*, p1.a AS l1, q1.a AS r1, p2.a AS l2, q2.a AS r2,
              (1000000::HUGEINT * f3.a * f3.a) // (p1.a::HUGEINT * q1.a) AS s1,
              (1000000::HUGEINT * f3.a * f3.a) // (p2.a::HUGEINT * q2.a) AS s2
       FROM f3 JOIN f1 p1 ON p1.lang = f3.lang AND p1.x = f3.x JOIN f2 q1 ON q1.lang = f3.lang AND q1.x = f3.y AND q1.y = f3.z
       JOIN f2 p2 ON p2.lang = f3.lang AND p2.x = f3.x AND p2.y = f3.y JOIN f1 q2 ON q2.lang = f3.lang AND q2.x = f3.z),
longer AS (SELECT lang, x, y, max(a) AS m FROM (SELECT lang, x, y, a FROM f3 UNION ALL SELECT lang, y, z, a FROM f3) GROUP BY ALL),
c AS (SELECT c2.lang, c2.x || ' ' || c2.y AS phrase, c2.a, l, r, score, 2 AS n_words
      FROM c2 LEFT JOIN longer g ON g.lang = c2.lang AND g.x = c2.x AND g.y = c2.y WHERE g.m IS NULL OR 100 * g.m < 50 * c2.a
      UNION ALL
      SELECT lang, x || ' ' || y || ' ' || z, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END,
             least(s1, s2), 3 FROM c3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank::INT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score::BIGINT AS score, n_words
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
