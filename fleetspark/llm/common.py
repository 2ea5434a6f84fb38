"""Helpers shared by the corpus operators: text rules, Arrow mapping, shared
storage, distributed prefix sums and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ensure_checkpoint_dir
from ..sources.sinks import remove

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_FIND_WORDS = re.compile(WORD).findall
#: white space of str.split() beyond the six characters of the rule
_OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]").search


def WORDS(text: str) -> list[str]:
    """The words of a text; str.split() is the fast way where it keeps to the rule."""
    return _FIND_WORDS(text) if _OTHER_SPACE(text) else text.split()


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="fleetspark-py-")) / f"{root.name}.zip"  # on the driver; Spark sends it
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], list[tuple] | list], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch.  It gives the columns of ``schema`` in order as a
    list of arrays, or the rows as a list of tuples."""
    return stream_arrow(df, lambda batches: (fn(b) for b in batches if b.num_rows), schema, fn.__module__)


#: Tables that modules keep in a worker process between tasks, by module.
WORKER_TABLES: dict[str, dict] = {}
_AT_WORK: list[str] = []


def worker_table(module: str) -> dict:
    """A table that lasts as long as the worker runs streams of ``module``."""
    return WORKER_TABLES.setdefault(module, {})


def give_back() -> None:
    """Return the freed memory of a worker to the system: workers outlive their tasks, and
    what one keeps counts against its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def enter(module: str) -> None:
    """A worker turns to streams of ``module``: the tables of others go."""
    if _AT_WORK != [module]:
        _AT_WORK[:] = [module]
        for name, t in WORKER_TABLES.items():
            if name != module:
                t.clear()
        give_back()


def stream_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: str, module: str | None = None) -> DataFrame:
    """As ``map_arrow``, over the stream of a partition's batches."""
    module = module or fn.__module__
    target = to_arrow_schema(T._parse_datatype_string(schema))
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(module)
        for out in fn(batches):
            if not len(out):
                continue
            cols = list(zip(*out)) if isinstance(out[0], tuple) else out
            made = [x.cast(f.type) if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for x, f in zip(cols, target, strict=True)]
            yield from pa.table(made, schema=target).to_batches()
            del out, cols, made
        give_back()

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Folders of ``stored`` tables that have not been deleted.
STORED: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts
    the lineage and keeps narrow, columnar copies that survive lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    STORED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    delete_stored(df.sparkSession, [df.stored_at])


def delete_stored(spark: SparkSession, paths: list[str]) -> None:
    for p in list(paths):
        remove(spark, p)
        if p in STORED:
            STORED.remove(p)


def shielded(docs: DataFrame, used: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns that an operator does not use under names that it does
    not use either, and the way back to all columns in their order."""
    names = {c: c if c in used else f"_extra{i}_" for i, c in enumerate(docs.columns)}
    back = [F.col(n).alias(c) for c, n in names.items()]
    return docs.select(*[F.col(c).alias(n) for c, n in names.items()]), lambda df: df.select(*back)


#: A join side of at most so many narrow rows is broadcast; a larger one is shuffled.
SMALL_ROWS = 400_000


#: and of at most so many bytes, by what its strings and binaries hold.
SMALL_BYTES = 16 << 20


def few(df: DataFrame) -> bool:
    """Whether the rows of ``df`` are few and short enough to be sent to every task."""
    long = [F.length(f.name) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum([F.coalesce(x, F.lit(0)) for x in long], F.lit(16 * len(df.columns)))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return n <= SMALL_ROWS and (total or 0) <= SMALL_BYTES


def small(df: DataFrame) -> DataFrame:
    """``df``, a table of columns of plain types, marked for broadcast if a count of its rows
    and bytes shows that it is small, else as it is."""
    return F.broadcast(df) if few(df) else df


def running_start(df: DataFrame, keys: list[str], order: list[Column], bucket: Column, value: Column, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` per ``keys`` along ``(bucket, *order)``.

    Only ``(keys, bucket)`` groups meet in one task, so a key that holds a third
    of all rows still spreads over its buckets.  ``bucket`` must sort before
    ``order``.  Sums per bucket are pre-aggregated before they are shuffled."""
    from pyspark.sql import Window as W
    d = df.withColumn("_b", bucket).withColumn("_v", value)
    per = d.groupBy(*keys, "_b").agg(F.sum("_v").alias("_bs"))
    w = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    base = per.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_kb"),
                      F.coalesce(F.sum("_bs").over(w), F.lit(0)).alias("_base"))
    cond = F.col("_b").eqNullSafe(F.col("_kb"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inner = W.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (d.withColumn("_in", F.coalesce(F.sum("_v").over(inner), F.lit(0)))
            .join(base, cond)
            .withColumn(out, F.col("_base") + F.col("_in"))
            .drop("_b", "_v", "_in", "_base", "_kb", *[f"_k_{k}" for k in keys]))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges``: one row ``(id, component)`` for each end
    point, ``component`` the smallest id reachable.

    Min-label rounds: every node takes the smallest label next to it, then the
    label of its label (pointer jump), until nothing changes.  Labels live in
    Spark; each round's table is written to the shared folder, and the
    minimum is pre-aggregated before it is shuffled, so a hub is no hot group.
    Labels are broadcast while they are few; else the joins shuffle them."""
    e = edges.select(F.col(a).alias("s"), F.col(b).alias("d")).where("s <> d")
    both = stored(e.union(e.select("d", "s")).distinct(), "edges")
    lab = stored(both.groupBy(F.col("s").alias("id")).agg(F.least(F.min("d"), F.min("s")).alias("component")), "labels")
    mark = F.broadcast if few(lab) else lambda df: df
    while True:
        near = both.join(mark(lab.select(F.col("id").alias("d"), "component")), "d").groupBy(F.col("s").alias("id")).agg(
            F.min("component").alias("m"))
        step = near.join(mark(lab), "id").select("id", F.least("component", "m").alias("c"), F.col("component").alias("was"))
        up = lab.select(F.col("id").alias("c"), F.col("component").alias("cc"))
        new = stored(step.join(mark(up), "c", "left").select("id", F.least(F.col("c"), F.coalesce("cc", "c")).alias("component"), "was"), "labels")
        done = new.where("component <> was").isEmpty()
        discard(lab)
        lab = new
        if done:
            discard(both)
            return lab.select("id", "component")


_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= _MULT
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x
