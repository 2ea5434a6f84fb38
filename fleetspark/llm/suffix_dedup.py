"""Suffix-array dedup: every byte covered by a ``length``-byte string that also
starts earlier (smaller doc_id, or the same document and an earlier start) goes.

Distribution.  Every ``length``-byte window is dealt by its minimiser, the smallest
hash among its ``GRAM``-byte strings (leftmost of equals).  Equal windows have
the same minimiser at the same place in them, so they meet in one bucket.
Windows in a row with the same minimiser form a segment, and whole segments are dealt.

1. Count segments per minimiser over all documents.  Minimisers that occur once
   hold no repeat.  Those that recur are kept as a bit table of bounded size
   (``BITS`` at most); a fuller table lets more rows through, never fewer.
2. Segments of recurring minimisers: equal ones (128-bit hash) are summed up
   to their first occurrence before they meet; all later ones are removed whole.
3. Buckets that still hold several different segments get a suffix array
   by two-stage sorting over the texts of the first occurrences: suffixes
   smaller than their successors are sorted directly (to the depth that counts), all others are
   induced by scanning the character buckets in order.  Common prefixes of
   neighbours give the windows that are equal; all but the first are removed.
4. A bucket with more than ``SPLIT`` different segments (a common line in many
   contexts) is dealt out again by the minimiser of longer strings (``FINER``) and goes through
   2 and 3 once more, at last by single windows, of which equal ones are
   summed up: no task gets an unbounded bucket.

Result of ``dedup``: a row per input row with ``doc_id, rest`` (what is left, as
bytes), ``n_bytes, n_removed, n_spans, kept_sha256``.  Null texts are empty.  Rows
that share doc_id and text are one document (nothing is removed from a row for
being repeated); rows that share a doc_id with different texts are documents
ordered by the hash of their text; null doc_ids come last.  Empty tables give
no rows; extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, shielded, stored, stream_arrow, table, text_of, worker_table

LENGTH = 100
GRAM = 40
SPLIT = 256
#: Longer strings by which crowded buckets are dealt again; with the last, a segment is one window.
FINER = (80, 94, 10**9)
BITS = 1 << 28
BLOCK = 1 << 16
CHUNK = 1 << 20

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = worker_table(__name__)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << (n - 1).bit_length()
        for name, b in (("up", _BASE), ("down", _INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hashed:
    """Hashes of any byte range of a buffer from one prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])

    def ranges(self, start: np.ndarray, size) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[start + size] - self.sums[start]) * self.down[start]

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(start, windows, minimiser, content hash)`` of the segments of texts laid end to end
    (``ends``: where each text ends)."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    hashed = Hashed(data)
    value = mix64(hashed.every(gram))
    best, where = value.copy(), np.arange(len(value))
    width, want = 1, length - gram + 1
    while width < want:  # leftmost minimum over growing windows
        step = min(width, want - width)
        left, right = best[:-step], best[step:]
        keep = left <= right
        best = np.where(keep, left, right)
        where = np.where(keep, where[:-step], where[step:])
        width += step
    starts = np.arange(len(where))
    room = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[:len(where)] - starts  # bytes left in the own text
    ok = room >= length
    new = ok.copy()
    new[1:] &= (where[1:] != where[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    group = np.cumsum(new) - 1
    n = np.bincount(group[ok], minlength=len(first))
    content = mix64(hashed.ranges(first, n + length - 1) + n.astype(np.uint64) * _BASE)
    return first, n, value[where[first]], content


def two_stage_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (small non-negative integers) in the order of the suffixes' first ``depth`` values."""
    n = len(text)
    t = text.astype(np.int64)
    if n < 2:
        return np.arange(n)
    # a suffix is 'up' if it is smaller than its successor; equal neighbours have the type of the run's end
    ends = np.flatnonzero(np.append(t[1:] != t[:-1], True))
    up_at_end = np.append(t[ends[:-1]] < t[ends[:-1] + 1], False)
    up = np.repeat(up_at_end, np.diff(np.concatenate([[-1], ends])))
    # stage 1: sort the 'up' suffixes directly, eight bytes a round, only where ties are left
    words = _words(text)
    pos = np.flatnonzero(up)
    order = pos[np.argsort(words[pos], kind="stable")]
    key = words[order]
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) if len(order) else np.empty(0, np.int64)
    for d in range(8, depth, 8):
        if not len(order):
            break
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        sub = order[tied]
        w = words[np.minimum(sub + d, n)]
        by = np.lexsort([w, group[tied]])
        order[tied] = sub[by]
        g, w = group[tied][by], w[by]
        cut = np.append(True, (g[1:] != g[:-1]) | (w[1:] != w[:-1]))
        fresh = np.zeros(len(order), bool)
        fresh[np.flatnonzero(np.append(True, group[1:] != group[:-1]))] = True
        fresh[tied] |= cut
        group = np.cumsum(fresh)
    # stage 2: scan the character buckets in order and put each predecessor that is not 'up' at the head of its bucket
    top = int(t.max()) + 1
    head = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=top))]).astype(np.int64)
    sa = np.full(n, -1, np.int64)
    up_first = t[order]
    up_count = np.bincount(up_first, minlength=top)
    up_from = np.concatenate([[0], np.cumsum(up_count)])
    at = head[:-1].copy()

    def induce(i: np.ndarray) -> None:
        j = i[i > 0] - 1
        j = j[~up[j]]
        if len(j):
            c = t[j]
            by = np.argsort(c, kind="stable")
            j, c = j[by], c[by]
            begin = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            inside = np.arange(len(c)) - np.repeat(begin, np.diff(np.append(begin, len(c))))
            sa[at[c] + inside] = j
            at[c[begin]] += np.diff(np.append(begin, len(c)))

    induce(np.array([n]))  # the end of the text comes first
    for c in np.flatnonzero(np.bincount(t, minlength=top)):
        done = head[c]
        while done < at[c]:  # runs of one character add to their own bucket
            upto = at[c]
            induce(sa[done:upto])
            done = upto
        mine = order[up_from[c]:up_from[c + 1]]
        sa[at[c]:at[c] + len(mine)] = mine
        induce(mine)
    return sa


def _words(text: np.ndarray) -> np.ndarray:
    """Eight values from each position on as one number; past the end zeros, one more entry for the end itself."""
    p = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    w = np.zeros(len(text) + 1, np.uint64)
    for i in range(8):
        w = w << np.uint64(8) | p[i:i + len(w)]
    return w


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, up to ``depth``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(0, depth, 8):
        x = words[np.minimum(a[live] + d, len(words) - 1)] ^ words[np.minimum(b[live] + d, len(words) - 1)]
        same = x == 0
        part = live[~same]
        if len(part):  # leading equal bytes of the word that differs
            out[part] += sum((x[~same] < np.uint64(1 << 64 - 8 * k)).astype(np.int64) for k in range(1, 8))
        out[live[same]] += 8
        live = live[same]
        if not len(live):
            break
    return np.minimum(out, depth)


def repeated_windows(texts: list[bytes], rank: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Per text the starts of windows that are equal to a window of a lower rank (``rank``: of each window start)."""
    # a gap byte between texts may equal a byte of a text: windows never reach it, so it only orders suffixes that do not count
    body = b"\0".join(texts) + b"\0"
    raw = np.frombuffer(body, np.uint8)
    sizes = np.array([len(x) for x in texts])
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    sa = two_stage_suffix_array(raw, length)
    words = _words(raw)
    starts = np.concatenate([f + np.arange(len(r)) for f, r in zip(first, rank)])
    ranks = np.full(len(raw), -1, np.int64)
    ranks[starts] = np.concatenate(rank)
    sa = sa[ranks[sa] >= 0]
    same = common_prefix(words, sa[:-1], sa[1:], length) >= length
    cut = np.flatnonzero(np.append(True, ~same))
    low = np.repeat(np.minimum.reduceat(ranks[sa], cut), np.diff(np.append(cut, len(sa))))
    hit = np.zeros(len(raw), bool)
    hit[sa] = ranks[sa] != low
    return [np.flatnonzero(hit[f:f + len(r)]) for f, r in zip(first, rank)]


def _texts(b: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column laid end to end and where each text ends."""
    a = b.column(column).cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and off[-1] else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off[1:] - off[0]


def _groups(ends: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    i = 0
    while i < len(ends):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield i, j
        i = j


def _segment_rows(b: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(row, start in its text, windows, minimiser, content)`` for groups of texts of a batch."""
    data, ends = _texts(b, "text")
    for i, j in _groups(ends):
        base = ends[i - 1] if i else 0
        mine = ends[i:j] - base
        start, n, h, c = segments(data[base:ends[j - 1]], mine, length, gram)
        if len(start):
            row = np.searchsorted(mine, start, side="right")
            yield i + row, start - np.concatenate([[0], mine[:-1]])[row], n, h, c


def _keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``doc, th, text`` and the kept columns as ``k0, k1, ...``: th tells texts apart where rows share a doc_id."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), text_of().alias("text"),
                    *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    again = d.groupBy("doc").count().where("count > 1").isEmpty()
    return d.withColumn("th", F.lit(0).cast("long") if again else F.xxhash64("text"))


def recurring(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``h``: minimisers with more than one segment."""
    def run(b: pa.RecordBatch) -> list:
        got = [x[3] for x in _segment_rows(b, length, gram)]
        h, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.empty(0, np.uint64), np.empty(0, np.int64))
        return [h.view(np.int64), n.astype(np.int32)]

    return map_arrow(docs.select("text"), run, "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def bit_table(h: DataFrame, bits_limit: int = BITS) -> np.ndarray:
    """The hashes as a table of bits: 16 bits a hash, ``bits_limit`` (32 MB) at most."""
    h = stored(h, "recurring")
    bits = max(BLOCK, min(bits_limit, 1 << (max(1, 16 * h.count()) - 1).bit_length()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        blocks: dict[int, np.ndarray] = {}
        for b in batches:  # a partition holds whole blocks; each is of fixed size
            blk, at = b.column("blk").to_numpy(), b.column("at").to_numpy()
            for k in np.unique(blk):
                blocks.setdefault(int(k), np.zeros(BLOCK, bool))[at[blk == k]] = True
        yield [list(blocks), [np.packbits(x).tobytes() for x in blocks.values()]]

    at = h.select(F.expr(f"h & {bits - 1}").alias("x")).distinct()
    at = at.select(F.expr(f"x div {BLOCK}").cast("int").alias("blk"), F.expr(f"x % {BLOCK}").cast("int").alias("at")).repartition("blk")
    table_ = np.zeros(bits // 8, np.uint8)
    for r in stream_arrow(at, pack, "blk int, bits binary").toLocalIterator():
        table_[r.blk * BLOCK // 8:(r.blk + 1) * BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return table_


def removed_spans(d: DataFrame, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """``doc, th, s, e``: byte ranges to remove (they may overlap) of the keyed documents."""
    spark = d.sparkSession
    shared = spark.sparkContext.broadcast(bit_table(recurring(d, length, gram)))

    def keep(b: pa.RecordBatch) -> list:
        bits, out = shared.value, []
        mask = np.uint64(len(bits) * 8 - 1)
        for row, s, n, h, c in _segment_rows(b, length, gram):
            x = (h & mask).astype(np.int64)
            at = (bits[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & 1 > 0
            out.append((row[at], s[at], n[at], h[at], c[at]))
        if not out:
            return []
        row, s, n, h, c = (np.concatenate(x) for x in zip(*out))
        doc, th = b.column("doc").to_numpy(), b.column("th").to_numpy()
        return [h.view(np.int64), c.view(np.int64), doc[row], th[row], s.astype(np.int32), n.astype(np.int32)]

    occ = stored(map_arrow(d.select("doc", "th", "text"), keep, "h long, c long, doc long, th long, s int, n int"), "segments")
    # equal segments: the first occurrence stays for now, later ones go whole
    one = occ.groupBy("h", "c").agg(F.min(F.struct("doc", "th", "s", "n")).alias("f"), F.count("*").alias("k")).where("k > 0")
    one = stored(one, "first")
    again = one.where("k > 1").select(F.col("h").alias("_h"), F.col("c").alias("_c"), "f")
    later = (occ.join(again, (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")))
             .where("doc <> f.doc or th <> f.th or s <> f.s").select("doc", "th", "s", F.expr(f"s + n + {length - 1}").alias("e")))
    # buckets with different segments
    kinds = one.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    want = (one.join(kinds, "h").select("h", "f.*", "kinds").groupBy("doc", "th")
            .agg(F.collect_list(F.struct("h", "s", "n", "kinds")).alias("w")))

    def cut(b: pa.RecordBatch) -> list[tuple]:
        out = []
        for doc, th, text, w in zip(*(b.column(x).to_pylist() for x in ("doc", "th", "text", "w"))):
            raw = text.encode()
            out += [(x["h"], x["kinds"], doc, th, x["s"], raw[x["s"]:x["s"] + x["n"] + length - 1]) for x in w]
        return out

    bodies = stored(map_arrow(d.select("doc", "th", "text").join(want, ["doc", "th"]).select("doc", "th", "text", "w"), cut,
                              "h long, kinds long, doc long, th long, s int, body binary").dropDuplicates(["h", "doc", "th", "s"]), "bodies")

    def flush(rows: list[tuple]) -> list[tuple]:
        where = sorted((doc, th, s, k) for k, (_, doc, th, s, _) in enumerate(rows))
        base = dict.fromkeys(range(len(rows)), 0)
        at = 0
        place: dict[tuple, int] = {}
        # ranks follow (doc, th, start of the window); windows of overlapping segments of a document interleave
        for doc, th, s, k in where:
            if (doc, th) not in place:
                at += 1 << 32
                place[(doc, th)] = at
            base[k] = place[(doc, th)] + s
        ranks = [base[k] + np.arange(len(r[4]) - length + 1) for k, r in enumerate(rows)]
        out = []
        for (_, doc, th, s, _), hits in zip(rows, repeated_windows([r[4] for r in rows], ranks, length)):
            if len(hits):
                first = np.flatnonzero(np.append(True, np.diff(hits) > 1))
                last = np.append(first[1:], len(hits)) - 1
                out += [(doc, th, int(s + hits[i]), int(s + hits[j] + length)) for i, j in zip(first, last)]
        return out

    def suffix_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for r in zip(*(b.column(x).to_pylist() for x in ("h", "doc", "th", "s", "body"))):
                if size >= CHUNK and r[0] != rows[-1][0]:  # whole buckets only
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
        if rows:
            yield flush(rows)

    spans = later
    for finer in FINER:
        few = bodies.where(F.col("kinds") <= split).select("h", "doc", "th", "s", "body").repartition("h").sortWithinPartitions("h")
        spans = spans.union(stream_arrow(few, suffix_arrays, "doc long, th long, s int, e int"))
        many = bodies.where(F.col("kinds") > split)
        if many.isEmpty():
            return spans
        later, bodies = _dealt_finer(many, length, min(length, finer))
        spans = spans.union(later)
    return spans


def _dealt_finer(many: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The segments of crowded buckets, dealt again by the minimiser of longer strings:
    ``(spans of later occurrences, bodies of buckets that still hold different segments)``."""
    def run(b: pa.RecordBatch) -> list:
        data, ends = _texts(b, "body")
        first = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        start, n, h, c = segments(data, ends, length, gram)
        row = np.searchsorted(ends, start, side="right")
        s = b.column("s").to_numpy()[row] + start - first[row]
        raw = data.tobytes()
        return [h.view(np.int64), c.view(np.int64), b.column("doc").to_numpy()[row], b.column("th").to_numpy()[row], s, n,
                [raw[i:i + k + length - 1] for i, k in zip(start.tolist(), n.tolist())]]

    occ = stored(map_arrow(many.select("doc", "th", "s", "body"), run, "h long, c long, doc long, th long, s int, n int, body binary"), "finer")
    one = occ.groupBy("h", "c").agg(F.min(F.struct("doc", "th", "s", "n", "body")).alias("f"), F.count("*").alias("k"))
    one = stored(one, "first")
    again = one.where("k > 1").select("h", "c", F.struct("f.doc", "f.th", "f.s").alias("f"))
    later = (occ.drop("body").join(again, ["h", "c"]).where("doc <> f.doc or th <> f.th or s <> f.s")
             .select("doc", "th", "s", F.expr(f"s + n + {length - 1}").alias("e")))
    kinds = one.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return later, one.join(kinds, "h").select("h", "kinds", "f.doc", "f.th", "f.s", "f.body")


def dedup(docs: DataFrame, keep: list[str] | None = None, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT, as_text: bool = False) -> DataFrame:
    """The columns ``keep`` (default: doc_id) and ``rest`` (the remaining bytes; with ``as_text`` a string
    without the bytes of a character that was cut), ``n_bytes, n_removed, n_spans, kept_sha256``."""
    keep = keep or ["doc_id"]
    d = _keyed(docs, keep)
    spans = removed_spans(d, length, gram, split).groupBy("doc", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("x"))
    n_keep = len(keep)

    def run(b: pa.RecordBatch) -> list:
        out = []
        for text, spans_ in zip(b.column("text").to_pylist(), b.column("x").to_pylist()):
            raw, kept, removed, runs = text.encode(), [], 0, 0
            end = 0  # of the run that is open
            for x in spans_ or ():
                s, e = x["s"], x["e"]
                if s > end or not runs:
                    kept.append(raw[end:s])
                    runs += 1
                    removed += e - s
                    end = e
                elif e > end:
                    removed += e - end
                    end = e
            kept.append(raw[end:])
            left = b"".join(kept)
            out.append((left.decode("utf-8", "ignore") if as_text else left, len(raw), removed, runs, hashlib.sha256(left).hexdigest()))
        return [*(b.column(f"k{i}") for i in range(n_keep)), *zip(*out)]

    j = d.join(spans, ["doc", "th"], "left").select(*[f"k{i}" for i in range(n_keep)], "text", "x")
    kinds = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    got = map_arrow(j, run, f"{kinds}, rest {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return got.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "rest", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def deduped_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: all columns, with the remaining text (the bytes of a character that was cut go) and its n_chars.

    The text is decoded where it is put together: a second Python step behind it would run in a worker
    of its own, and both workers of a task stay with the executor for the stages that follow."""
    d, back = shielded(docs, ("doc_id", "text", "n_chars"))
    got = dedup(d, [c for c in d.columns if c not in ("text", "n_chars")], as_text=True)
    return back(got.withColumn("text", F.col("rest")).withColumn("n_chars", F.length("text").cast("long")))


def op6(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("rest")
