"""Approximate nearest neighbours by a hierarchical k-means tree.

1. Equal vectors form a class with its smallest ids (one more than the
   neighbours asked for), so a vector that a third of all rows share is one point.
2. The tree is fitted on a bounded sample (``SAMPLE`` classes by hash order) and has
   at most ``MAX_LEAVES`` leaves; every class is dealt to the leaf its vector descends to.
3. A query walks the tree best bin first: a priority queue holds branches by the
   distance to their centroid; leaves are visited in the order they come off it.
4. Calibration: for ``CALIBRATION`` queries the true neighbours are found among all
   classes (in blocks), and the number of leaf visits doubles until at least
   ``TARGET`` of them lie in visited leaves; with all leaves the search is exact.
   Every query also goes on until its leaves hold enough classes.
5. Queries meet the vectors of a leaf in chunks of at most ``CHUNK`` on average.  A chunk of
   more than ``SUBTREE`` vectors that many queries visit gets a tree of its own, fitted on all its
   vectors inside the task and calibrated to ``SUB_TARGET`` on its first queries, so the work of a
   query does not grow with the leaf.  Distances are Euclidean in double precision on the original vectors.

Result: ``query_id, rank, vec_id, score``, nearest first, ties to the smaller vec_id.
Vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do rows with a null vec_id or with another dimension than most rows have.
Ids are integers.  Repeated rows (same id and vector) count once.  Empty tables and tables without
a query give no rows; with fewer candidates all of them are returned.  Extra
columns are ignored."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, ship, small, stored, table

SAMPLE = 20_000
MAX_LEAVES = 1024
LEAF = 64
BRANCH = 8
CALIBRATION = 64
TARGET = 0.97
CHUNK = 16_384
SUBTREE = 2048
SUB_TARGET = 0.995
SUB_CALIBRATION = 32


class Tree:
    """Centroids of the nodes; ``children[i]`` are the nodes below node i, ``leaf[i]`` its leaf number or -1."""

    def __init__(self, x: np.ndarray, max_leaves: int = MAX_LEAVES, leaf: int = LEAF, branch: int = BRANCH):
        self.centre: list[np.ndarray] = [x.mean(0) if len(x) else np.zeros(x.shape[1])]
        self.children: list[np.ndarray] = [np.empty(0, np.int64)]
        rng = np.random.default_rng(11)
        open_ = [(-len(x), 0, x)]
        n_leaves = 1
        while open_ and n_leaves + branch - 1 <= max_leaves:
            size, node, pts = heapq.heappop(open_)
            if -size <= leaf:
                break
            c, label = _kmeans(pts, branch, rng)
            parts = [(k, pts[label == k]) for k in range(len(c)) if (label == k).any()]
            if len(parts) < 2:
                continue
            ids = []
            for k, part in parts:
                ids.append(len(self.centre))
                self.centre.append(c[k])
                self.children.append(np.empty(0, np.int64))
                heapq.heappush(open_, (-len(part), ids[-1], part))
            self.children[node] = np.array(ids)
            n_leaves += len(parts) - 1
        self.centre = np.array(self.centre)
        self.leaf = np.full(len(self.centre), -1)
        ends = [i for i, c in enumerate(self.children) if not len(c)]
        self.leaf[ends] = np.arange(len(ends))
        self.leaves = len(ends)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            kids = self.children[node]
            if not len(kids):
                out[at] = self.leaf[node]
                continue
            near = _nearest(x[at], self.centre[kids])
            todo += [(kids[k], at[near == k]) for k in range(len(kids)) if (near == k).any()]
        return out

    def visits(self, q: np.ndarray):
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not len(kids):
                yield int(self.leaf[node])
                continue
            for k, d in zip(kids, ((self.centre[kids] - q) ** 2).sum(1)):
                heapq.heappush(queue, (float(d), int(k)))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)


def _kmeans(x: np.ndarray, k: int, rng, steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    label = _nearest(x, c)
    for _ in range(steps):
        for j in range(len(c)):
            mine = x[label == j]
            if len(mine):
                c[j] = mine.mean(0)
        label = _nearest(x, c)
    return c, label


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, v, h1, h2`` of the rows that take part."""
    d = df.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = d.where(~odd & F.exists("v", lambda x: x != 0))
    dims = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    d = d.where(F.size("v") == (dims.n if dims else 0)).withColumn("v", F.col("v").cast("array<double>"))
    return d.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(5), "v"))


def _matrix(b: pa.RecordBatch, column: str = "v") -> np.ndarray:
    a = b.column(column)
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1) if len(a) else np.empty((0, 0))


def search(df: DataFrame, is_query, k: int = 10, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (a column) marks."""
    spark = df.sparkSession
    ship(spark)
    d = usable(df)
    # classes of equal vectors with their k + 1 smallest ids: the limit is applied before the shuffle
    w = W.partitionBy("h1", "h2").orderBy("vec_id")
    ids = d.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= k + 1)
    classes = ids.groupBy("h1", "h2").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("v").alias("v"))
    classes = stored(classes, "classes")
    queries = d.where(is_query).select("vec_id", "h1", "h2").distinct()
    wanted = queries.select("h1", "h2").distinct()
    asked = stored(classes.join(small(wanted), ["h1", "h2"], "left_semi"), "queries")

    fit = classes.orderBy(F.xxhash64("h1"), "h1", "h2").limit(SAMPLE).select("v").toArrow()
    if not fit.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = _matrix(fit.combine_chunks().to_batches()[0])
    tree = Tree(x)

    def place(b: pa.RecordBatch) -> list:
        return [tree.assign(_matrix(b)), b.column("h1"), b.column("h2"), b.column("ids"), b.column("v")]

    dealt = stored(map_arrow(classes.select("h1", "h2", "ids", "v"), place, "leaf long, h1 long, h2 long, ids array<long>, v array<double>"), "leaves")
    counts = np.zeros(tree.leaves, np.int64)
    for r in dealt.groupBy("leaf").count().collect():  # MAX_LEAVES rows at most
        counts[r.leaf] = r["count"]
    n_visits = calibrate(asked, dealt, tree, k, target)

    def route(b: pa.RecordBatch) -> list[tuple]:
        out = []
        for h1, h2, v in zip(b.column("h1").to_pylist(), b.column("h2").to_pylist(), b.column("v").to_pylist()):
            seen = got = 0
            for leaf in tree.visits(np.array(v)):
                if seen >= n_visits and got >= k + 1:
                    break
                seen, got = seen + 1, got + int(counts[leaf])
                if counts[leaf]:
                    out += [(leaf, c, h1, h2, v) for c in range(-(-int(counts[leaf]) // CHUNK))]
        return out

    routed = map_arrow(asked.select("h1", "h2", "v"), route, "leaf long, chunk long, h1 long, h2 long, v array<double>")
    chunk_of = F.create_map(*[F.lit(int(x)) for i in np.flatnonzero(counts > CHUNK) for x in (i, -(-counts[i] // CHUNK))]) if (counts > CHUNK).any() else None
    n_chunks = F.coalesce(F.element_at(chunk_of, F.col("leaf")), F.lit(1)) if chunk_of is not None else F.lit(1)
    vectors = dealt.withColumn("chunk", F.pmod(F.xxhash64("h1", "h2"), n_chunks).cast("long"))

    def near(_, q: pa.Table, x: pa.Table) -> pa.Table:
        rows: list[list] = [[], [], [], []]
        if q.num_rows and x.num_rows:
            # in a fixed order, so that a tree over them is the same in every run
            x, q = (t.sort_by([("h1", "ascending"), ("h2", "ascending")]).combine_chunks() for t in (x, q))
            owners = x.column("ids").to_pylist()
            found = nearest_in(_matrix(x.to_batches()[0]), _matrix(q.to_batches()[0]), k + 1)
            for h1, h2, (at, dist) in zip(q.column("h1").to_pylist(), q.column("h2").to_pylist(), found):
                best = sorted((float(d), o) for i, d in zip(at.tolist(), dist.tolist()) for o in owners[i])[:k + 1]
                for col, val in zip(rows, ([h1] * len(best), [h2] * len(best), [b[1] for b in best], [b[0] for b in best])):
                    col += val
        return pa.table([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["h1", "h2", "vec_id", "score"])

    found = routed.groupBy("leaf", "chunk").cogroup(vectors.groupBy("leaf", "chunk")).applyInArrow(near, "h1 long, h2 long, vec_id long, score double")
    w = W.partitionBy("h1", "h2").orderBy("score", "vec_id")
    top = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    out = queries.withColumnRenamed("vec_id", "query_id").join(top, ["h1", "h2"])
    out = out.select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "n"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))


def visits_needed(orders: list[list[int]], leaves: np.ndarray, target: float) -> int:
    """Leaf visits, doubled until ``target`` of the neighbours lie in visited leaves.  ``orders``: the leaves of each
    query in the order of their visits; ``leaves``: rows (query, leaf) of the true neighbours."""
    place = [{leaf: p for p, leaf in enumerate(o)} for o in orders]
    at = np.array([place[q][leaf] for q, leaf in leaves.tolist()])
    n, most = 1, max(map(len, orders), default=1)
    while n < most and (at < n).mean() < target:
        n *= 2
    return min(n, most)


def nearest_in(m: np.ndarray, queries: np.ndarray, k: int, subtree: int = SUBTREE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its k nearest rows of ``m`` and of those as near as the last, with their distances."""
    def scan(q: np.ndarray, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        dist = np.sqrt((((m if rows is None else m[rows]) - q) ** 2).sum(1))
        cut = np.partition(dist, k - 1)[k - 1] if len(dist) > k else np.inf
        near = np.flatnonzero(dist <= cut)
        return (near if rows is None else rows[near]), dist[near]

    if len(m) <= subtree or len(queries) <= 2 * SUB_CALIBRATION:
        return [scan(q, None) for q in queries]
    tree = Tree(m, max_leaves=max(BRANCH, len(m) // LEAF), leaf=LEAF)
    leaf = tree.assign(m)
    by = np.argsort(leaf, kind="stable")
    start = np.searchsorted(leaf[by], np.arange(tree.leaves + 1))
    first = [scan(q, None) for q in queries[:SUB_CALIBRATION]]
    true = np.array([(i, leaf[j]) for i, (near, _) in enumerate(first) for j in near])
    n = visits_needed([list(tree.visits(q)) for q in queries[:SUB_CALIBRATION]], true, SUB_TARGET)
    out = list(first)
    for q in queries[SUB_CALIBRATION:]:
        rows, seen, got = [], 0, 0
        for x in tree.visits(q):
            if seen >= n and got >= k:
                break
            rows.append(by[start[x]:start[x + 1]])
            seen, got = seen + 1, got + len(rows[-1])
        out.append(scan(q, np.concatenate(rows)))
    return out


def calibrate(asked: DataFrame, dealt: DataFrame, tree: Tree, k: int, target: float) -> int:
    """The number of leaf visits, doubled until ``target`` of the true neighbours of ``CALIBRATION`` queries lie in visited leaves."""
    sample = [np.array(r.v) for r in asked.orderBy(F.xxhash64("h1", F.lit(3)), "h1", "h2").limit(CALIBRATION).select("v").collect()]
    if not sample:
        return 1

    def best(b: pa.RecordBatch) -> list[tuple]:
        m, leaf, out = _matrix(b), b.column("leaf").to_numpy(), []
        for i, q in enumerate(sample):
            dist = ((m - q) ** 2).sum(1)
            for j in np.argsort(dist, kind="stable")[:k + 1]:
                out.append((i, float(dist[j]), int(leaf[j])))
        return out

    near = map_arrow(dealt.select("leaf", "v"), best, "q int, d double, leaf long")
    w = W.partitionBy("q").orderBy("d", "leaf")
    rows = near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).select("q", "leaf").collect()
    return visits_needed([list(tree.visits(q)) for q in sample], np.array([(r.q, r.leaf) for r in rows]), target)


def op3(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
