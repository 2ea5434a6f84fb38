"""Mixing sources to target weights: exact word quotas per source, dealt to
output shards by a multivariate-hypergeometric splitting tree.

Native: DataFrame and SQL functions only.

1. ``size`` is the number of words of a text (null or blank: 0).
2. Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating;
   together they get 100 % of all words.  A target stops at ``max_repeat`` times
   its source's words; the excess is shared again by weight until none is above.
3. Every source's documents lie on a line in a keyed random order.  The source's
   stream runs over that line once per epoch and ends at the rounded target.
   The stream is cut into blocks of ``total / (shards * blocks_per_shard)`` words
   (the last block of a stream may be shorter), which gives the block quotas.
4. Splitting tree: the root holds all block quotas; a node deals half of its
   blocks to its left child, taking from each source a hypergeometric number,
   down to the shards.  Quotas are exact at every node.
5. Each source's blocks are permuted by key and cut by those quotas, so shards
   hold disjoint blocks; inside a shard a keyed hash gives the reading order.

Edge cases: null texts and texts without a word have size 0 and take nothing;
documents of a null source form one source; repeated rows (same id and text)
are documents of their own, side by side on the line; empty tables give empty results; extra columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, running_start, shielded, small, table, text_of

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SHARDS = 64
BLOCKS_PER_SHARD = 64


def word_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, _key, _row, copies``: equal rows as one with their number.  The
    md5 key orders a source's line; documents without an id are spread by their text."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_of().cast("binary")))
    return docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
                       F.md5(F.concat_ws("|", own, F.coalesce("source", F.lit(""))).cast("binary")).alias("_key"),
                       F.xxhash64(*docs.columns).alias("_row")).groupBy("doc_id", "source", "size", "_key", "_row").agg(F.count("*").alias("copies"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Sharing the excess again until none is above ends at a common level v with
    target = min(cap, v * weight): sources below their cap are those whose
    cap / weight exceeds v, found by one ordered pass over the sources."""
    s = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    pos = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pos % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    by = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, rest = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("_lv", level)
    ok = F.when(F.col("_lv") * F.col("weight") <= F.col("cap"), F.col("_lv"))
    # the first source whose share stays below its cap fixes the level for all after it
    v = F.first(ok, ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
    return s.select("source", "source_size", "weight",
                    F.coalesce(F.least(F.col("cap"), v * F.col("weight")), F.col("cap")).alias("target"))


def _hypergeometric(n_all: str, n_good: str, n_draw: str, u: str) -> str:
    """SQL for a hypergeometric draw by inversion: log weights by the ratio of
    neighbours over the support, scaled by their maximum."""
    lo, hi = f"greatest(0L, {n_draw} + {n_good} - {n_all})", f"least({n_good}, {n_draw})"
    logs = (f"aggregate(sequence({lo}, {hi}), array(0D), (lw, kk) -> if(kk = {lo}, lw, concat(lw, array(element_at(lw, -1) "
            f"+ ln(({n_good} - kk + 1) * ({n_draw} - kk + 1D)) - ln(kk * ({n_all} - {n_good} - {n_draw} + kk + 0D))))))")
    probs = f"transform(array({logs}), lv -> transform(lv, x -> exp(x - array_max(lv))))[0]"
    count = ("size(filter(aggregate(pr, array(0D), (cs, x) -> concat(cs, array(element_at(cs, -1) + x))), "
             f"y -> y <= {u} * aggregate(pr, 0D, (tt, x) -> tt + x))) - 1")
    return f"least({hi}, {lo} + transform(array({probs}), pr -> {count})[0])"


def shard_quotas(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard, source, first, quota`` from ``source, n_blocks``: the splitting tree.
    A node is one row with an array of block counts (one entry per source)."""
    nodes = blocks.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("z"), F.col("source").alias("s"),
                                                                      F.col("n_blocks").cast("long").alias("n")))).alias("q"))
    nodes = nodes.select(F.lit(0).cast("long").alias("shard"), "q")
    draw = _hypergeometric("a.left_all", "e.n", "a.left_draw",
                           f"((xxhash64({seed}, lvl, shard, e.z, e.s) & {(1 << 52) - 1}L) / {float(1 << 52)}D)")
    depth, level = max(0, (shards - 1).bit_length()), 0
    while level < depth:
        split = F.expr(
            "aggregate(q, named_struct('left_all', aggregate(q, 0L, (t, e) -> t + e.n), "
            "'left_draw', aggregate(q, 0L, (t, e) -> t + e.n) div 2 + "
            "(aggregate(q, 0L, (t, e) -> t + e.n) % 2) * (abs(xxhash64(lvl, shard)) % 2), 'l', cast(array() as array<bigint>)), "
            f"(a, e) -> named_struct('left_all', a.left_all - e.n, 'left_draw', a.left_draw - {draw}, "
            f"'l', concat(a.l, array({draw}))))")
        nodes = nodes.withColumn("lvl", F.lit(level)).withColumn("l", split["l"])
        nodes = nodes.select(F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.expr("zip_with(q, l, (e, n) -> named_struct('z', e.z, 's', e.s, 'n', n))").alias("q")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), F.expr("zip_with(q, l, (e, n) -> named_struct('z', e.z, 's', e.s, 'n', e.n - n))").alias("q")),
        )).alias("x")).select("x.*")
        level += 1
        if level % 2 == 0 or level == depth:
            nodes = nodes.checkpoint()
    leaf = nodes.select("shard", F.explode("q").alias("e")).select("shard", F.col("e.s").alias("source"), F.col("e.n").alias("quota"))
    w = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return leaf.withColumn("first", F.coalesce(F.sum("quota").over(w), F.lit(0)))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, shards: int = SHARDS,
        blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """``(placed, segments)``.

    ``placed``: a row per document with ``doc_id, source, size, source_size, target,
    start`` (its place on the source's line).  ``segments``: a row per run of words
    taken, ``doc_id, source, start, epoch, from_word, n_words, block, shard, shard_key``;
    a shard is read in the order of ``shard_key``.  ``shards`` is a power of two."""
    sizes = word_sizes(docs).checkpoint()
    targets = source_targets(sizes, weights, max_repeat).checkpoint()
    line = running_start(sizes, ["source"], [F.col("_key"), F.col("doc_id"), F.col("_row")], F.substring("_key", 1, 3),
                         F.col("size") * F.col("copies"), "start")
    line = line.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    line = line.withColumn("start", F.col("start") + F.col("_i") * F.col("size")).drop("_i", "copies")
    placed = line.join(small(targets).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = placed.withColumn("stream", F.round("target").cast("long")).drop("_key").checkpoint()

    words = targets.agg(F.sum("source_size")).first()[0] or 0
    width = max(1, -(-words // (shards * blocks_per_shard)))
    block = F.lit(width).cast("long")
    seg = (placed.where("size > 0")
           .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
           .withColumn("x", F.col("start") + F.col("epoch") * F.col("source_size"))
           .withColumn("y", F.least(F.col("x") + F.col("size"), F.col("stream"))).where("x < y")
           .withColumn("block", F.explode(F.expr(f"sequence(x div {width}, (y - 1) div {width})")))
           .withColumn("u", F.greatest("x", F.col("block") * block))
           .withColumn("n_words", F.least("y", (F.col("block") + 1) * block) - F.col("u"))
           .select("doc_id", "source", "start", "epoch", (F.col("u") - F.col("x")).alias("from_word"), "n_words", "block"))

    n_blocks = targets.select("source", F.ceil(F.round("target") / block).cast("long").alias("n_blocks"))
    quotas = shard_quotas(n_blocks, shards, seed)
    perm = (n_blocks.where("n_blocks > 0").select("source", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("block"))
            .withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block")) - 1))
    # ranks cut by the quotas: the last shard that starts at or before a rank owns it
    marks = (quotas.where("quota > 0").select("source", F.col("first").alias("rank"), "shard", F.lit(None).cast("long").alias("block"))
             .unionByName(perm.select("source", "rank", F.lit(None).cast("long").alias("shard"), "block")))
    w = W.partitionBy("source").orderBy("rank", F.col("block").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    dealt = (marks.withColumn("shard", F.last("shard", ignorenulls=True).over(w)).where("block is not null")
             .select(F.col("source").alias("_s"), F.col("block").alias("_bl"), "shard")).checkpoint()
    segments = (seg.join(small(dealt), F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_bl"))).drop("_s", "_bl")
                .withColumn("shard_key", F.xxhash64(F.lit(seed), "shard", "block", "epoch", "start", "from_word")))
    return placed, segments


def taken(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the segments take of each document."""
    return _taken(docs, **kw).select("doc_id", "size", "source_size", "target", "taken")


def _taken(docs: DataFrame, **kw) -> DataFrame:
    """``taken`` with ``source`` and the hash ``_row`` of the row.
    A document with words is told from others of its source by its place on the line."""
    placed, segments = mix(docs, **kw)
    got = segments.groupBy(F.col("source").alias("_s"), F.col("start").alias("_p")).agg(F.sum("n_words").alias("_n"))
    j = placed.join(got, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_p")), "left")
    return j.select("doc_id", "source", "_row", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("_n", F.lit(0))).otherwise(0).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """Pipeline form: each document as often as the mix takes it, ``round(taken / size)`` whole copies.
    Documents without a word have nothing to mix and leave."""
    d, back = shielded(docs, ("doc_id", "text", "source"))
    copies = F.round(F.col("taken") / F.col("size")).cast("long")
    # rows equal in every column are one row with the copies of all
    t = _taken(d, **kw).where("size > 0").groupBy(F.col("_row").alias("_r")).agg(F.sum(copies).alias("_c")).where("_c > 0")
    once = d.withColumn("_r", F.xxhash64(*d.columns)).groupBy("_r").agg(*[F.first(c).alias(c) for c in d.columns])
    return back(once.join(t, "_r").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c")))))


def write_shards(docs: DataFrame, path: str, **kw) -> DataFrame:
    """Write the mix below ``path``, a folder ``shard=K`` each, its runs of words in the order of
    ``shard_key``; returns the segments.  A run is words ``from_word`` to ``from_word + n_words`` of its text, joined by spaces."""
    d, _ = shielded(docs, ("doc_id", "text", "source"))
    placed, segments = mix(d, **kw)
    place = placed.where("size > 0").select(F.col("source").alias("_s"), F.col("start").alias("_p"), F.col("_row").alias("_r"))
    texts = d.withColumn("_r", F.xxhash64(*d.columns)).groupBy("_r").agg(F.first("text").alias("text"))
    rows = segments.join(place, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_p"))).join(texts, "_r")
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    rows = rows.select("shard", "shard_key", "doc_id", "source", "epoch", "from_word", "n_words",
                       F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")), " ").alias("text"))
    rows.repartition("shard").sortWithinPartitions("shard", "shard_key", "doc_id", "epoch", "from_word").write.partitionBy("shard").parquet(path)
    return segments


def op10(spark, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


SQL10 = r"""
with d as (select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) :: bigint size,
           md5(coalesce(doc_id :: varchar, md5(coalesce(text, ''))) || '|' || coalesce(source, '')) k from documents),
 s0 as (select source, sum(size) :: bigint source_size from d group by source),
 s1 as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source is null, source) - 1) % 3 + 1) :: int] :: double w,
               (3 * source_size) :: double cap from s0),
 s2 as (select *, ((sum(source_size) over ()) :: double - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
               / sum(w) over (o rows between current row and unbounded following) lv from s1
        window o as (order by cap / w, source is null, source)),
 s3 as (select *, first_value(case when lv * w <= cap then lv end ignore nulls) over
               (order by cap / w, source is null, source rows between unbounded preceding and current row) v from s2),
 t as (select source, source_size, coalesce(least(cap, v * w), cap) target from s3),
 p as (select d.*, t.source_size, t.target, round(t.target) :: bigint stream,
              coalesce(sum(size) over (partition by d.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) :: bigint st
       from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (greatest(0, least(st + size, stream) - st) + greatest(0, least(st + source_size + size, stream) - st - source_size)
        + greatest(0, least(st + 2 * source_size + size, stream) - st - 2 * source_size)) :: bigint taken
from p
"""
