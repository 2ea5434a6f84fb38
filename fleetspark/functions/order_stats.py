"""Exact order statistics and dense codes per group without a task that holds a
group.

Values are first counted (partial aggregation), then sorted once by (group,
value) over range partitions.  A small table with one row per group and
partition gives every partition's first rank in its group; the ranks asked for
fall into known partitions, and only those are searched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import global_row_number, sorted_partitions


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> list:
    return [a[k].eqNullSafe(b[f"_g_{k}"]) for k in keys]


def _right(df: DataFrame, keys: list[str], *cols) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *cols)


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Exact quantiles of ``value`` per group with linear interpolation between
    neighbours (pandas, numpy).  One row ``(*keys, n, p, quantile)`` for each
    group with a value and each probability.  NULL values are left out; NULL
    keys are a group; NaN counts as the largest value."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    placed = sorted_partitions(counts, [*keys, "_x"]).drop("_pos")
    # one row per group and partition that holds some of it
    spans = placed.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_m"))
    w = Window.partitionBy(*keys).orderBy("_pid")
    spans = spans.withColumn("_to", F.sum("_m").over(w)).withColumn("_from", F.col("_to") - F.col("_m")).checkpoint()
    total = _right(spans.groupBy(*keys).agg(F.max("_to").alias("n")), keys, "n")
    asked = total.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
    at = F.col("p") * (F.col("n") - 1)
    asked = asked.select("*", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("_rank"))
    here = (F.col("_from") <= F.col("_rank")) & (F.col("_rank") < F.col("_to"))
    hits = spans.join(asked, _same(spans, asked, keys) + [here]).select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], F.col("_pid").alias("_hit"), "n", "p", "_rank", "_from").checkpoint()
    # the partitions that hold an asked rank; the rest of the values are not looked at again
    wanted = hits.groupBy(*[f"_g_{k}" for k in keys], "_hit").agg(F.max("_from").alias("_base"))
    inside = placed.join(wanted, _same(placed, wanted, keys) + [F.col("_pid") == F.col("_hit")]).select(*keys, "_pid", "_x", "_c", "_base")
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_pid").orderBy("_x")) + F.col("_base")
    inside = inside.withColumn("_end", upto).withColumn("_begin", F.col("_end") - F.col("_c"))
    found = inside.join(hits, _same(inside, hits, keys) + [F.col("_pid") == F.col("_hit"), F.col("_begin") <= F.col("_rank"),
                                                          F.col("_rank") < F.col("_end")])
    low = F.min_by("_x", "_rank")
    frac = F.max(F.col("p") * (F.col("n") - 1)) - F.min("_rank")
    return found.groupBy(*keys, "n", "p").agg((low + (F.max_by("_x", "_rank") - low) * frac).alias("quantile"))


def medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(*keys, n, median)`` for each group with a value."""
    return quantiles(df, keys, value, [0.5]).select(*keys, "n", F.col("quantile").alias("median"))


def dense_codes(df: DataFrame, key: str, value: str, name: str = "code") -> DataFrame:
    """0-based place of each distinct ``value`` in its group's sorted values:
    numbers of one global sort, less the first of the group."""
    rows = global_row_number(df.select(key, value).distinct(), [key, value], "_rn")
    first = _right(rows.groupBy(key).agg(F.min("_rn").alias("_first")), [key], "_first")
    return rows.join(first, _same(rows, first, [key])).select(key, value, (F.col("_rn") - F.col("_first")).cast("int").alias(name))
