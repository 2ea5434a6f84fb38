"""Ordered per-vehicle passes that do not put a whole vehicle in one task.

Every "previous row" operator of the reference (lag/diff/shift over a vehicle
sorted by time) is computed in windows partitioned by ``(key, time bucket)``.
The row just before a bucket lives in an earlier bucket; it is found on a small
table with one row per ``(key, bucket)`` and added to the bucket as a
pseudo-row before the window, then dropped.  Running "last non-null" values
are carried the same way.  Results are identical for any bucket width, so one
vehicle holding a third of all pings still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("ts_us", "ping_id")


def bucket_of(ts_us: Column | str, bucket_s: int) -> Column:
    ts = F.col(ts_us) if isinstance(ts_us, str) else ts_us
    return F.floor(ts / F.lit(bucket_s * 1_000_000)).cast("bigint")


def ordered_pass(df: DataFrame, key: str, bucket_s: int, lags: list[str],
                 running_last: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``prev_<c>`` (value on the previous row of the same ``key`` in
    ``(ts_us, ping_id)`` order, NULL on the first row) for every column in
    ``lags`` plus ``prev_ts_us``, and for each ``name -> expr`` of
    ``running_last`` the last non-null ``expr`` up to and including the row.
    Keeps a ``_bkt`` column (the time bucket) for later bucket-local passes.
    """
    running_last = running_last or {}
    lag_cols = list(dict.fromkeys(list(lags) + ["ts_us"]))
    d = df.withColumn("_bkt", bucket_of("ts_us", bucket_s))
    for name, e in running_last.items():
        d = d.withColumn(f"_v_{name}", e)
    order = F.struct(*ORDER)

    # one row per (key, bucket): the bucket's last row and last non-null values
    aggs = [F.max_by(F.struct(*[F.col(c) for c in lag_cols], F.col("ping_id")), order).alias("_last")]
    aggs += [F.max_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), order)).alias(f"_b_{n}")
             for n in running_last]
    per_bucket = d.groupBy(key, "_bkt").agg(*aggs)
    wb = Window.partitionBy(key).orderBy("_bkt")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        key, "_bkt", F.lag("_last").over(wb).alias("_prev"),
        *[F.last(f"_b_{n}", ignorenulls=True).over(before).alias(f"_v_{n}") for n in running_last],
    ).where(F.col("_prev").isNotNull())
    pseudo = carry.select(
        key, "_bkt",
        *[F.col(f"_prev.{c}").alias(c) for c in lag_cols],
        F.col("_prev.ping_id").alias("ping_id"),
        *[F.col(f"_v_{n}") for n in running_last],
        F.lit(True).alias("_carry"),
    )
    u = d.withColumn("_carry", F.lit(False)).unionByName(pseudo, allowMissingColumns=True)

    w = Window.partitionBy(key, "_bkt").orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = u.select(
        "*",
        *[F.lag(c).over(w).alias(f"prev_{c}") for c in lag_cols],
        *[F.last(f"_v_{n}", ignorenulls=True).over(upto).alias(n) for n in running_last],
        # one long that follows (ts_us, ping_id) within a key: bucket, then row
        # inside the bucket; lets "first in time order" be a hash aggregate
        (F.col("_bkt") * F.lit(1 << 32) + F.row_number().over(w)).alias("_ord"),
    )
    return out.where(~F.col("_carry")).drop("_carry", *[f"_v_{n}" for n in running_last])


def shift_scoped_fill(df: DataFrame, key_cols: list[str], vehicle: str, value: str, out: str,
                      prev_out: str) -> DataFrame:
    """Forward fill of ``value`` inside each ``key_cols`` group (a shift), in
    time order, leading NULL -> 0, plus the previous row's filled value
    (``prev_out``, 0 on the group's first row).

    Windows are partitioned by ``(vehicle, _bkt, key_cols)``; a shift that
    spans buckets gets its last non-null value from earlier buckets through a
    small ``(vehicle, _bkt)`` table joined on the partitioning columns, so the
    ping table is not shuffled again.
    """
    order = F.struct(*ORDER)
    kkey = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key_cols])
    per = (df.groupBy(vehicle, "_bkt", *key_cols)
           .agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), order)).alias("_lf")))
    wk = Window.partitionBy(vehicle, *key_cols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carried = (per.withColumn("_cf", F.last("_lf", ignorenulls=True).over(wk))
               .where(F.col("_cf").isNotNull())
               .groupBy(vehicle, "_bkt")
               .agg(F.map_from_entries(F.collect_list(F.struct(kkey.alias("k"), F.col("_cf").alias("v")))).alias("_kc")))
    j = df.join(carried, [vehicle, "_bkt"], "left")
    cf = F.element_at(F.col("_kc"), kkey)
    w = Window.partitionBy(vehicle, "_bkt", *key_cols).orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(upto), cf, F.lit(0.0)))
    j = j.withColumn(prev_out, F.coalesce(F.lag(out).over(w), cf, F.lit(0.0)))
    return j.drop("_kc")


def shift_positions(df: DataFrame, key_cols: list[str], vehicle: str) -> DataFrame:
    """Adds ``_pos`` (0-based index of the row inside its ``key_cols`` group,
    in time order) and ``_n`` (rows in the group).  Bucket-local row numbers
    plus per-bucket offsets from a small ``(vehicle, _bkt)`` table joined on
    the partitioning columns; no group is gathered into one task."""
    kkey = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in key_cols])
    per = df.groupBy(vehicle, "_bkt", *key_cols).agg(F.count(F.lit(1)).alias("_c"))
    wk = Window.partitionBy(vehicle, *key_cols)
    per = per.select(vehicle, "_bkt", kkey.alias("k"),
                     F.coalesce(F.sum("_c").over(wk.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("off"),
                     F.sum("_c").over(wk).alias("n"))
    m = per.groupBy(vehicle, "_bkt").agg(
        F.map_from_entries(F.collect_list(F.struct("k", F.struct("off", "n").alias("v")))).alias("_pm"))
    j = df.join(m, [vehicle, "_bkt"], "left")
    w = Window.partitionBy(vehicle, "_bkt", *key_cols).orderBy(*ORDER)
    e = F.element_at(F.col("_pm"), kkey)
    j = j.withColumns({"_pos": e["off"] + F.row_number().over(w) - 1, "_n": e["n"]})
    return j.drop("_pm")
