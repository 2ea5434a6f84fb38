"""Distributed global row numbering.

``row_number() over (order by ...)`` without a partition moves every row into
one task.  Here the sort is range-partitioned, each row gets its position
inside its partition, and partition offsets come from a table with one row per
partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW = (1 << 33) - 1


def sorted_partitions(df: DataFrame, order_cols: list) -> DataFrame:
    """Rows with the number ``_pid`` of their range partition along
    ``order_cols`` and their 0-based position ``_pos`` in it, from one
    materialised sort: planned twice, its sampled range bounds may differ."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    return (ordered.withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW))).drop("_mid"))


def global_row_number(df: DataFrame, order_cols: list, name: str = "rn") -> DataFrame:
    """Adds a 1-based ``name`` following ``order_cols`` (ties broken by the
    remaining columns so the numbering is deterministic)."""
    tie = [c for c in df.columns if c not in order_cols]
    ordered = sorted_partitions(df, [*order_cols, *sorted(tie)])
    # the offsets window runs on one row per partition only
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = ordered.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("bigint")).drop("_pid", "_pos", "_off")
