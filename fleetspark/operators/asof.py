"""Nearest-in-time as-of join with an inclusive tolerance (F2).

Spark has no as-of join; a bare range condition would plan a nested-loop
join.  Every right row is the nearest of its group for one span of time: from
the middle between it and the row before to the middle to the row after, a
tolerance to either side at most.  The spans of a group do not overlap, so a
left row meets the one right row of a group whose span holds its time, and the
join gives the result as it is: nothing is gathered per (left row, right group)
behind it, and its rows stream into what the caller does with them.  Time is
cut into bins; a right row goes to the bins of its span, a left row to its own.

``closest_loaders`` finds the loaders at a stop run's smallest distance, with
the grid cells of the distance limit as further keys of the join: what it
shuffles grows with stops and loader pings, not with their pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import Params
from .assemble import join_key
from .stops import STOP_KEY

#: What one load is confirmed for: a stop run, whose shifts are stops of their own.
RUN = ["vehicle", "run_us", "run_pid"]


def dedupe_ties(right: DataFrame, group: str, t: str, tie: str, values: list[str]) -> DataFrame:
    """One row per (group, time): the values of the first and of the last row
    among rows sharing a timestamp (``first_<v>``, ``last_<v>`` by ``tie``),
    and their number ``_n``."""
    return right.groupBy(group, t).agg(
        *[F.min_by(v, tie).alias(f"first_{v}") for v in values],
        *[F.max_by(v, tie).alias(f"last_{v}") for v in values],
        F.count(F.lit(1)).alias("_n"),
    )


def nearest_spans(right: DataFrame, group: str, t: str, tie: str, tolerance_us: int, values: list[str]) -> DataFrame:
    """``group``, ``t``, ``values`` and the span ``_lo`` to ``_hi`` (twice the
    time, both inclusive) for which this row is the nearest of its group.  Rows
    sharing a time come twice: the first ends before their time, the last begins there.

    A row further away than twice the tolerance does not bound a span, so the
    window runs inside stretches of 64 tolerances; rows near the end of a
    stretch are also shown to the next one."""
    one = dedupe_ties(right.where(F.col(t).isNotNull()), group, t, tie, values)
    stretch = lambda c: F.floor(c / F.lit(64 * tolerance_us)).cast("bigint")
    tt, far = F.col(t), F.lit(2 * tolerance_us)
    one = one.withColumn("_str", F.explode(F.sequence(stretch(tt - far), stretch(tt + far))))
    w = Window.partitionBy(group, "_str").orderBy(t)
    one = one.withColumns({"_before": F.lag(t).over(w), "_after": F.lead(t).over(w)}).where(F.col("_str") == stretch(tt))
    # equal distance goes to the earlier row
    lo, hi = F.greatest(tt * 2 - far, tt + F.col("_before") + 1), F.least(tt * 2 + far, tt + F.col("_after"))
    part = lambda a, b, side: F.struct(a.alias("_lo"), b.alias("_hi"), *[F.col(f"{side}_{v}").alias(v) for v in values])
    both = F.array(part(lo, tt * 2 - 1, "first"), part(tt * 2, hi, "last"))
    parts = F.when(F.col("_n") == 1, F.array(part(lo, hi, "last"))).otherwise(both)
    return one.select(group, t, F.inline(parts)).where(F.col("_lo") <= F.col("_hi"))


def asof_nearest(left: DataFrame, left_key: list[str], left_t2: str, right: DataFrame, right_group: str,
                 right_t: str, right_tie: str, tolerance_us: int, values: list[str],
                 cells: list[tuple[str, str]] = (), cell_width: float = 0.0, within: str | None = None) -> DataFrame:
    """For every left row and every ``right_group`` value, the right row
    nearest in time within ``tolerance_us`` (inclusive).

    ``left_t2`` is twice the left time (exact half-microsecond midpoints).
    Ties follow ``pandas.merge_asof(direction='nearest')``: equal distance ->
    the earlier row; equal times at or before the left time -> the last row
    (highest ``right_tie``), after it -> the first (lowest ``right_tie``).
    A left side that has a ``right_group`` column meets only that group.
    ``cells`` names coordinates (left column, value of the right row): of the
    result only rows are promised that differ in each by no more than the left
    column ``within``.  They are found over grid cells of ``cell_width``.
    Returns ``left_key + [right_group, right_t] + values``.
    """
    left_key = list(dict.fromkeys(list(left_key) + [left_t2]))
    paired = [right_group] if right_group in left.columns else []
    # a quarter of the tolerance: sparse rows go to few bins, dense ones meet few left rows beside their span
    a_bin = lambda c: F.floor(F.col(c) / F.lit(max(1, tolerance_us // 2))).cast("bigint")
    cell = lambda c: F.floor(c / F.lit(cell_width)).cast("bigint")
    lx = left.select(*left_key, *paired, a_bin(left_t2).alias("_bin"))
    rx = nearest_spans(right, right_group, right_t, right_tie, tolerance_us, values)
    rx = rx.withColumn("_bin", F.explode(F.sequence(a_bin("_lo"), a_bin("_hi"))))
    keys = ["_bin"] + paired
    for i, (a, b) in enumerate(cells):
        reach = F.col(within) + 1.0  # a metre more than the distance, which is a rounded one
        lx = lx.withColumn(f"_c{i}", F.explode(F.sequence(cell(F.col(a) - reach), cell(F.col(a) + reach))))
        rx = rx.withColumn(f"_c{i}", cell(F.col(b)))
        keys.append(f"_c{i}")
    j = lx.join(rx, keys).where(F.col(left_t2).between(F.col("_lo"), F.col("_hi")))
    return j.select(*left_key, right_group, right_t, *values)


def close_pairs(cands: DataFrame, loaders: DataFrame, p: Params) -> DataFrame:
    """The load candidates, each with every loader (``l_id``) that has any ping
    within the time tolerance and the distance limit: a loader whose nearest
    ping passes the limit is among them.

    An equi-join on time bin and grid cell (bins one tolerance wide, cells a little
    more than the limit) finds them, with the neighbours on the stops' side."""
    tol = p.asof_tolerance_s * 1_000_000
    cell = lambda c: F.floor(F.col(c) / F.lit(p.loader_max_dist_m + 1.0)).cast("bigint")
    around = lambda c: F.explode(F.array(c - 1, c, c + 1))
    seen = loaders.select("l_id", F.col("ts_us").alias("_l_us"), "l_x", "l_y", F.floor(F.col("ts_us") / F.lit(tol)).cast("bigint").alias("_bin"),
                          cell("l_x").alias("_cx"), cell("l_y").alias("_cy"))
    c = cands.select("*", around(F.floor(F.col("mid2_us") / F.lit(2 * tol)).cast("bigint")).alias("_bin"))
    c = c.select("*", around(cell("d_utm_x")).alias("_cx"))
    c = c.select("*", around(cell("d_utm_y")).alias("_cy"))
    dx, dy = F.col("d_utm_x") - F.col("l_x"), F.col("d_utm_y") - F.col("l_y")
    near = (F.abs(F.col("_l_us") * 2 - F.col("mid2_us")) <= 2 * tol) & (F.sqrt(dx * dx + dy * dy) <= p.loader_max_dist_m)
    return c.join(seen, ["_bin", "_cx", "_cy"]).where(near).select(*cands.columns, "l_id").distinct()


def nearest_loaders(cands: DataFrame, loaders: DataFrame, p: Params, within: str | None = None) -> DataFrame:
    """Per (load candidate, loader): the loader ping nearest to the stop's
    midpoint within the tolerance, with 2-D distance and altitude gap.  With
    the output of ``close_pairs`` only those pairs are matched; with ``within``,
    a distance in each candidate of no more than the limit, only loaders whose
    nearest ping is that near."""
    left_key = STOP_KEY + ["start_us", "start_pid", "end_us", "dur_sec", "mid2_us", "d_utm_x", "d_utm_y", "d_alt"] + ([within] if within else [])
    near = {"cells": [("d_utm_x", "l_x"), ("d_utm_y", "l_y")], "cell_width": p.loader_max_dist_m + 1.0, "within": within} if within else {}
    m = asof_nearest(cands, left_key, "mid2_us", loaders, "l_id", "ts_us", "ping_id",
                     p.asof_tolerance_s * 1_000_000, ["l_x", "l_y", "l_alt"], **near)
    dx = F.col("d_utm_x") - F.col("l_x")
    dy = F.col("d_utm_y") - F.col("l_y")
    m = (m.withColumnRenamed("ts_us", "l_ts_us")
          .withColumn("d2d", F.sqrt(dx * dx + dy * dy))
          .withColumn("dz", F.abs(F.col("d_alt") - F.col("l_alt"))))
    return m.where(F.col("d2d") <= F.col(within)).drop(within) if within else m


def closest_loaders(cands: DataFrame, loaders: DataFrame, p: Params) -> DataFrame:
    """The rows of ``nearest_loaders`` at the smallest distance of their stop
    run, if it is within the limit: the only ones that can confirm a load.

    The pairs within the limit are walked through for the smallest distance,
    one number a run, and a second time for the rows at it; they are never
    shuffled or sorted, which would take disk by their number."""
    limit = cands.withColumn("_within", F.lit(float(p.loader_max_dist_m)))
    smallest = nearest_loaders(limit, loaders, p, "_within").groupBy(*RUN).agg(F.min("d2d").alias("_within"))
    return nearest_loaders(join_key(cands, smallest, "inner", RUN), loaders, p, "_within")


def confirmed_loads(near: DataFrame, p: Params) -> DataFrame:
    """Nearest loader per stop run (d2d ascending, NULL last, then loader id),
    *then* the 50 m / 15 m test, as the reference orders them.

    Rows with d2d above the limit are dropped before the top-1: if the
    nearest loader is within the limit it survives the filter and stays
    nearest; if not, the stop has no confirmed load either way.  The top-1
    therefore runs on a small input."""
    near = near.where(F.col("d2d") <= p.loader_max_dist_m)
    keep = [c for c in near.columns if c not in RUN]
    best = F.min_by(F.struct(*[F.col(c) for c in keep]),
                    F.struct(F.col("d2d"), F.col("l_id"), F.col("start_us"), F.col("start_pid")))
    top = near.groupBy(*RUN).agg(best.alias("_b"))
    top = top.select(*RUN, *[F.col(f"_b.{c}").alias(c) for c in keep])
    return top.where(F.col("dz") <= p.loader_max_dz_m)
