"""Event-proximity marks (F4): a ping is marked when an event time lies
within the tolerance (5 s, inclusive).

Bins are one tolerance wide, so an event in a ping's own bin always marks it; of
the bin before only the last event can, of the bin after only the first.  One
row per bin holds these three primitives per kind, however many events there
are; pings look up their own bin with an equi-join, without row fan-out.  The
bin table is broadcast when its size in bytes (rows of fixed size, counted on a
checkpointed copy) is under a bound; otherwise the join shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import Params


#: Bytes of a bin row in a broadcast table: its columns with their overhead, and a vehicle id.
BIN_BYTES = 160
KINDS = ("load", "dump")


def event_bins(events: DataFrame, p: Params) -> DataFrame:
    """``events(kind, ts_us[, vehicle])`` -> one row per bin (and vehicle for
    ``event_scope='vehicle'``) with ``<kind>_here`` (an event in the bin),
    ``<kind>_before`` (last event of the bin before) and ``<kind>_after`` (first of the bin after)."""
    tol = p.mark_tolerance_s * 1_000_000
    b = F.floor(F.col("ts_us") / F.lit(tol)).cast("bigint")
    keys = ["_bin"] + (["vehicle"] if p.event_scope == "vehicle" else [])
    e = events.select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_off")).withColumn("_bin", b + F.col("_off"))
    ts = lambda kind, off: F.when((F.col("kind") == kind) & (F.col("_off") == off), F.col("ts_us"))
    return e.groupBy(*keys).agg(*[c for k in KINDS for c in (
        F.max(ts(k, 0).isNotNull()).alias(f"{k}_here"), F.max(ts(k, 1)).alias(f"{k}_before"), F.min(ts(k, -1)).alias(f"{k}_after"))])


def mark_pings(pings: DataFrame, bins: DataFrame, p: Params, bins_rows: int | None = None) -> DataFrame:
    """Adds ``ev_flag``: 1 near a load event, else 0 near a dump event, else
    NULL (C9 input)."""
    tol = p.mark_tolerance_s * 1_000_000
    keys = ["_bin"] + (["vehicle"] if p.event_scope == "vehicle" else [])
    if bins_rows is not None and bins_rows * BIN_BYTES <= p.max_broadcast_bytes:
        bins = F.broadcast(bins)
    d = pings.withColumn("_bin", F.floor(F.col("ts_us") / F.lit(tol)).cast("bigint"))
    d = d.join(bins, keys, "left")
    no = F.lit(False)
    near = lambda k: (F.coalesce(f"{k}_here", no) | F.coalesce(F.col("ts_us") - F.col(f"{k}_before") <= tol, no)
                      | F.coalesce(F.col(f"{k}_after") - F.col("ts_us") <= tol, no))
    d = d.withColumn("load_mark", near("load")).withColumn("dump_mark", near("dump"))
    d = d.withColumn("ev_flag", F.when(F.col("load_mark"), F.lit(1.0)).when(F.col("dump_mark"), F.lit(0.0)))
    return d.drop("_bin", *[c for c in bins.columns if c not in keys])
