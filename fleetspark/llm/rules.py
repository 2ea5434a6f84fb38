"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics.  ``STATISTICS`` are computed for every whole text in Arrow batches, from
flat byte and word arrays.

Rules.  A random forest of shallow trees (Spark ML, seeded) is grown on labelled
rows.  Every path from a root to a node below it is a conjunction of bounds on
statistics, a rule; bounds on one statistic are merged, equal rules kept once, and of
a root's two branches one.

Weights.  A logistic regression with a lasso penalty (Spark ML) is fitted to the
rules' 0/1 values; rules that get no weight are dropped.  The others are compiled
into one Spark column expression, which scores all rows without Python.

The fit takes about ``max_rows`` labelled rows at most, chosen by a hash of the
id (a documented bound); rows with ``crc32(doc_id as text) mod 4 = 2`` are held
out and never train.  Labels, lang, source and doc_id are no inputs of a score.

Result: a row per document with ``doc_id, held_out, score, predicted``; score is
the probability that ``quality`` is 1, rounded to six digits, predicted is 1 from
``KEEP_AT`` on.  Null and empty texts have all statistics 0 and are scored like
others.  Rows that share a doc_id give a row each; an id with several label rows
trains with the largest label.  A null doc_id is not held out and trains
nothing.  Without training rows of both kinds there are no rules: every score is
1.0, or 0.0 if all labels are 0.  An empty table gives no rows.  Extra columns
are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, stream_arrow, table, text_of
from .flat import FlatWords, byte_classes, cuts, text_bytes

STATISTICS = ["n_words", "word_bytes", "upper_share", "symbols_per_word", "bangs_per_word", "bars_per_word", "digit_share",
              "stops_per_word", "commas_per_word", "other_letters_share", "distinct_share", "top_word_share", "run_share",
              "dup_line_share", "words_per_line", "short_share"]
MAX_ROWS = 30_000
TREES = 30
DEPTH = 3
LASSO = 0.001
SEED = 12
KEEP_AT = 0.7
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096
WORDS_OF = byte_classes(b" \t\n\x0b\x0c\r")
LINES_OF = byte_classes(b"\n")


def text_statistics(texts: pa.Array) -> list[np.ndarray]:
    """One array per statistic."""
    n = len(texts)
    f, lines = FlatWords(texts, WORDS_OF, lower=False), FlatWords(texts, LINES_OF, lower=False)
    doc_of = np.repeat(np.arange(n, dtype=np.int32) << 8, text_bytes(texts))
    byte = np.bincount(doc_of | f.raw, minlength=n << 8).reshape(n, 256)
    words = np.bincount(f.doc, minlength=n)

    def chars(these: bytes) -> np.ndarray:
        return byte[:, list(these)].sum(1)

    def share(a, b) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(n), where=b > 0)

    upper, lower = byte[:, 65:91].sum(1), byte[:, 97:123].sum(1)
    other = byte[:, 0xC0:].sum(1)  # first bytes of characters outside ASCII
    total = byte.sum(1)
    pairs, times = np.unique(f.doc.astype(np.int64) << 32 | f.codes, return_counts=True)
    owner = (pairs >> 32).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    top = np.zeros(n)
    if len(first):
        top[owner[first]] = np.maximum.reduceat(times, first)
    run = (f.codes[1:] == f.codes[:-1]) & (f.doc[1:] == f.doc[:-1])
    one = np.unique(lines.doc.astype(np.int64) << 32 | lines.codes)
    n_lines = np.bincount(lines.doc, minlength=n)
    return [words.astype(float), share(np.bincount(f.doc, weights=f.lengths, minlength=n), words), share(upper, upper + lower),
            share(chars(b"#*$%&<>"), words), share(chars(b"!?"), words), share(chars(b"|"), words), share(byte[:, 48:58].sum(1), total), share(chars(b"."), words), share(chars(b",;:"), words),
            share(other, upper + lower + other), share(np.bincount(owner, minlength=n), words), share(top, words),
            share(np.bincount(f.doc[1:][run], minlength=n), words), share(n_lines - np.bincount(one >> 32, minlength=n), n_lines),
            share(words, n_lines), share(np.bincount(f.doc[f.lengths <= 2], minlength=n), words)]


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row's text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for b in batches:
            for r in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(r, SLICE_ROWS)
                for lo, hi in cuts(text_bytes(part.column("text")), SLICE_BYTES):
                    yield [part.column("doc_id").slice(lo, hi - lo), *text_statistics(part.column("text").slice(lo, hi - lo))]

    return stream_arrow(docs.select("doc_id", text_of().alias("text")), run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, float, float], ...]  # (statistic, above, up to), sorted


def tree_rules(text: str) -> list[Rule]:
    """The paths of all trees of a forest's ``toDebugString``."""
    line = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[int, str, float]]] = []  # (indent, condition)
    for raw in text.splitlines():
        m = line.match(raw.strip())
        indent = len(raw) - len(raw.lstrip())
        if not m:
            if raw.strip().startswith("Tree"):
                path = []
            continue
        path = [p for p in path if p[0] < indent]
        path.append((indent, (int(m[2]), m[3], float(m[4]))))
        box: dict[int, tuple[float, float]] = {}
        for _, (s, op, t) in path:
            lo, hi = box.get(s, (-np.inf, np.inf))
            box[s] = (lo, min(hi, t)) if op == "<=" else (max(lo, t), hi)
        if len(path) == 1 and m[3] == ">":
            continue  # the rule of the left branch says the same
        found[tuple(sorted((s, lo, hi) for s, (lo, hi) in box.items()))] = None
    return list(found)


def rule_column(rule: Rule) -> Column:
    """1.0 where the rule holds, else 0.0."""
    bounds = []
    for s, lo, hi in rule:
        if lo > -np.inf:
            bounds.append(F.col(STATISTICS[s]) > F.lit(float(lo)))
        if hi < np.inf:
            bounds.append(F.col(STATISTICS[s]) <= F.lit(float(hi)))
    return reduce(lambda a, b: a & b, bounds).cast("double")


class RuleEnsemble:
    """Weighted rules and an intercept; ``score`` is a column over ``STATISTICS``."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self) -> Column:
        z = reduce(lambda a, b: a + b, [F.lit(w) * rule_column(r) for r, w in self.rules], F.lit(self.intercept))
        return F.round(1 / (1 + F.exp(-z)), 6)

    def describe(self) -> list[tuple[str, float]]:
        """The rules in words, the heaviest first."""
        def words(r: Rule) -> str:
            return " and ".join(f"{'' if lo == -np.inf else f'{lo:.6g} < '}{STATISTICS[s]}{'' if hi == np.inf else f' <= {hi:.6g}'}" for s, lo, hi in r)
        return sorted(((words(r), w) for r, w in self.rules), key=lambda x: -abs(x[1]))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    lab = labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id").agg(
        F.max((F.col("quality") > 0).cast("double")).alias("label"))
    known = stats.join(lab, "doc_id")
    n, ones = known.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        return RuleEnsemble([], -30.0 if n and not ones else 30.0)
    # a share of the ids by hash: no task sorts or holds all labelled rows
    keep = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, max_rows / n) * (1 << 30))
    rows = known.where(keep).repartition(4, "doc_id").sortWithinPartitions("doc_id", *STATISTICS)
    rows = stored(VectorAssembler(inputCols=STATISTICS, outputCol="x").transform(rows).select(*STATISTICS, "x", "label"), "rule-rows")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird",
                                    subsamplingRate=0.7, maxBins=64, minInstancesPerNode=5, seed=SEED).fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble([], float(np.log(ones / (n - ones))))
    wide = rows.select("label", array_to_vector(F.array(*[rule_column(r) for r in rules])).alias("r"))
    fit = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60, tol=1e-7).fit(wide)
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, fit.coefficients.toArray()) if w], float(fit.intercept))


def scored(stats: DataFrame, model: RuleEnsemble, keep_at: float = KEEP_AT) -> DataFrame:
    return stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= keep_at).cast("int"))


def op12(spark, sf_dir: str) -> DataFrame:
    stats = stored(statistics(table(spark, sf_dir, "documents")), "text-statistics")
    return scored(stats, train(stats, table(spark, sf_dir, "labels")))
