"""Quality rules: hashed word and character n-gram logistic regression, with
base counts and fixed thresholds.

Features of a text: words, word pairs and character trigrams (UTF-8 bytes), each
family hashed to ``DIMS`` bins; the value of a bin is the square root of its
share of the family.  A logistic regression is trained on labelled rows (at
most ``max_rows`` by hash of the id, a documented bound), and its logit is
calibrated by Platt's method on a fifth of those rows that took no part in the
fit.  All rows are scored in Arrow batches with the calibrated probability that
``quality`` is 1; a row is kept if that is at least ``KEEP_AT``.

Base rules: ``base_failed`` is n_words < 50 or 100 * n_repeat_words > 50 * n_words.

Result per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
n_repeat_words, base_failed, kept, p_quality``.  Null and empty texts have zero
counts and fail the base rules.  Rows that share a doc_id give a row each.
Without labelled rows of both kinds no model is fitted: p_quality is 1.0 (or 0.0
if all labels are 0).  Rows with a null doc_id or label train nothing.  Extra
columns are ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, map_arrow, table, worker_table

DIMS = 2048
MAX_ROWS = 6_000
KEEP_AT = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = re.compile(r"[#*$%&|<>]")

_BINS: dict[str, int] = worker_table(__name__)


def _bins(words: list[str]) -> np.ndarray:
    """Hash of each word, kept per worker in a bounded table."""
    if len(_BINS) > 300_000:
        _BINS.clear()
    for w in set(words):
        if w not in _BINS:
            _BINS[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_BINS.__getitem__, words), dtype=np.uint32, count=len(words))


def _share(bins: np.ndarray) -> np.ndarray:
    c = np.bincount(bins & np.uint32(DIMS - 1), minlength=DIMS)
    return np.sqrt(c / max(1, len(bins))).astype(np.float32)


def features(text: str, words: list[str]) -> np.ndarray:
    h = _bins(words)
    with np.errstate(over="ignore"):
        pairs = (h[:-1] * np.uint32(0x9E3779B1) + h[1:]) * np.uint32(0x85EBCA6B) >> np.uint32(15)
        b = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
        tri = ((b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(18)
    return np.concatenate([_share(h), _share(pairs), _share(tri)])


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    dup = len(lines) - len(set(lines))
    n = len(words)
    repeat = 0
    if n > 3:
        tri = list(zip(words, words[1:], words[2:]))
        if len(set(tri)) < len(tri):
            many = {t for t, c in Counter(tri).items() if c > 1}
            last = -1  # last word counted
            for i, t in enumerate(tri):
                if t in many:
                    repeat += i + 2 - max(last, i - 1)
                    last = i + 2
    return n, sum(map(len, words)), len(SYMBOLS.findall(text)), dup, repeat


class QualityModel:
    def __init__(self, w: np.ndarray, b: float, a: float, c: float):
        self.w, self.b, self.a, self.c = w, b, a, c

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.a * (x @ self.w + self.b) + self.c
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, l2: float = 2e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent for logistic regression; classes weigh the same."""
    n, d = x.shape
    pos = max(y.mean(), 1e-6)
    sw = np.where(y > 0, 0.5 / pos, 0.5 / max(1 - pos, 1e-6)) / n
    step = 1.0 / (0.25 * 4 * max(1.0, float((sw * n).max())) + l2)  # rows have a squared norm of at most 3, and 1 for the intercept
    w, v, b, vb = np.zeros(d, np.float32), np.zeros(d, np.float32), 0.0, 0.0
    for k in range(steps):
        mom = k / (k + 3)
        u, ub = w + mom * v, b + mom * vb
        r = (sw * (1 / (1 + np.exp(-(x @ u + ub))) - y)).astype(np.float32)
        nw, nb = u - step * (x.T @ r + l2 * u), ub - step * float(r.sum())
        v, vb, w, b = nw - w, nb - b, nw, nb
    return w, float(b)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for ``sigmoid(a z + c)`` with Platt's smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    f, th = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ th, -30, 30)))
        h = (f * (p * (1 - p) + 1e-6)[:, None]).T @ f + 1e-6 * np.eye(2)
        d = np.linalg.solve(h, f.T @ (p - t))
        th = th - d * min(1.0, 4 / (np.abs(d).max() + 1e-12))
    return (float(th[0]), float(th[1])) if th[0] > 0 else (1.0, 0.0)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> QualityModel:
    lab = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    lab = lab.orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(lab, "doc_id")

    def feats(b: pa.RecordBatch) -> list[tuple]:
        out = []
        for i, t, y in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("y").to_pylist()):
            out.append((zlib.crc32(str(i).encode()) % 5 == 0, int(y > 0), features(t, WORDS(t)).astype(np.float16).tobytes()))
        return out

    got = map_arrow(rows, feats, "cal boolean, y int, f binary").collect()  # max_rows rows of fixed size
    y = np.array([r.y for r in got], dtype=np.float64)
    none = np.zeros(3 * DIMS, np.float32)
    if len(set(y)) < 2:
        return QualityModel(none, 0.0 if len(y) and y[0] == 0 else 60.0, 1.0, -30.0)
    x = np.stack([np.frombuffer(r.f, np.float16) for r in got]).astype(np.float32)
    order = np.lexsort([x[:, 0], x[:, 1], y])  # rows arrive in any order; sums should not depend on it
    cal = np.array([r.cal for r in got])[order]
    x, y = x[order], y[order]
    if len(set(y[~cal])) < 2 or len(set(y[cal])) < 2:
        cal = np.zeros(len(y), bool)
        w, b = _fit(x, y)
        a, c = _platt(x @ w + b, y)
    else:
        w, b = _fit(x[~cal], y[~cal])
        a, c = _platt(x[cal] @ w + b, y[cal])
    return QualityModel(w, b, a, c)


def score(docs: DataFrame, model: QualityModel, keep_at: float = KEEP_AT) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> list:
        texts = b.column("text").to_pylist()
        counts, p = [], []
        for t in texts:
            ws = WORDS(t)
            counts.append(base_counts(t, ws))
            p.append(features(t, ws))
        prob = model.probability(np.stack(p))
        c = np.array(counts, dtype=np.int64)
        failed = (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * c[:, 0])
        return [b.column("doc_id"), *(c[:, i] for i in range(5)), failed, ~failed & (prob >= keep_at), prob]

    def small_batches(b: pa.RecordBatch) -> list:
        parts = [run(b.slice(i, 512)) for i in range(0, b.num_rows, 512)]  # 512 dense rows at a time
        return [pa.chunked_array([x[0] for x in parts]), *(np.concatenate([x[j] for x in parts]) for j in range(1, 9))]

    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(d, small_batches, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                       "n_repeat_words long, base_failed boolean, kept boolean, p_quality double")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
