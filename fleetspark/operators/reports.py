"""Reports on predictions.

Every report takes a predictions table ``(dumper_id, date_dpr, shift,
pred_route, pred_full)``: from the cross-validated models (M5/M6) in the
pipeline, or from the rate models below, which are plain aggregates and so
can be checked against SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import r4, round_np
from ..functions.ranking import global_row_number
from ..params import TARGET
from .assemble import join_key

KEY = ["dumper_id", "date_dpr", "shift"]


def rate_predictions(train: DataFrame, target_rows: DataFrame) -> DataFrame:
    """Litres per engine-hour models fitted on the train labels: ``pred_route``
    uses the fleet rate, ``pred_full`` the vehicle's own rate (fleet rate for
    vehicles without labelled hours)."""
    lab = train.where(F.col(TARGET).isNotNull() & (F.col("engine_on_hrs") > 0))
    fleet = lab.agg((F.sum(TARGET) / F.sum("engine_on_hrs")).alias("_fr"))
    veh = lab.groupBy("dumper_id").agg((F.sum(TARGET) / F.sum("engine_on_hrs")).alias("_vr"))
    fr = fleet.first()["_fr"] or 0.0
    t = target_rows.select(*KEY, "engine_on_hrs").join(veh, "dumper_id", "left")
    return t.select(*KEY,
                    r4(F.col("engine_on_hrs") * F.lit(fr)).alias("pred_route"),
                    r4(F.col("engine_on_hrs") * F.coalesce(F.col("_vr"), F.lit(fr))).alias("pred_full"))


def efficiency_delta(train: DataFrame, preds: DataFrame) -> DataFrame:
    """Per train shift, label, both predictions and full - route."""
    j = join_key(train.select(*KEY, TARGET), preds, "inner")
    return j.withColumn("efficiency_delta", r4(F.col("pred_full") - F.col("pred_route")))


def daily_consistency(labels: DataFrame, train_preds: DataFrame) -> DataFrame:
    """E16 + F11 + N3: actual vs predicted litres per vehicle-day (inner join)
    with absolute and percentage error."""
    actual = labels.groupBy(F.col("dumper_id"), F.col("date_dpr")).agg(F.sum(TARGET).alias("actual_daily_L"))
    pred = train_preds.groupBy("dumper_id", "date_dpr").agg(F.sum("pred_full").alias("pred_daily_L"))
    d = join_key(actual, pred, "inner", ["dumper_id", "date_dpr"])
    err = F.abs(F.col("pred_daily_L") - F.col("actual_daily_L"))
    return d.select("dumper_id", "date_dpr", r4("actual_daily_L").alias("actual_daily_L"),
                    r4("pred_daily_L").alias("pred_daily_L"), r4(err).alias("abs_error"),
                    r4(err / (F.col("actual_daily_L") + 1e-6) * 100).alias("pct_error"))


def daily_summary(daily: DataFrame) -> DataFrame:
    """N3 summary: Pearson correlation, mean absolute error, mean % error."""
    return daily.agg(F.count(F.lit(1)).alias("n_days"),
                     r4(F.corr("pred_daily_L", "actual_daily_L")).alias("corr"),
                     r4(F.avg("abs_error")).alias("mae"), r4(F.avg("pct_error")).alias("mape"))


def vehicle_ranking(delta: DataFrame, n_show: int = 15) -> DataFrame:
    """E17 + J6 + N5: mean efficiency delta per vehicle; the ``n_show``
    highest and the ``n_show`` lowest (one row per vehicle, ranks NULL where a
    vehicle is not in that list) with the sign of the delta.  Each list is a
    distributed top-k (``orderBy().limit()``); only the k kept rows are
    numbered."""
    v = delta.groupBy("dumper_id").agg(F.avg("efficiency_delta").alias("mean_delta"))

    def top(order, name):
        t = v.orderBy(*order).limit(n_show)
        return (t.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
                .select("dumper_id", "mean_delta", name))

    hi = top([F.desc("mean_delta"), F.asc("dumper_id")], "rank_high")
    lo = top([F.asc("mean_delta"), F.desc("dumper_id")], "rank_low")
    u = hi.unionByName(lo, allowMissingColumns=True)
    r = u.groupBy("dumper_id").agg(F.first("mean_delta").alias("mean_delta"), F.max("rank_high").alias("rank_high"),
                                   F.max("rank_low").alias("rank_low"))
    return r.select("dumper_id", r4("mean_delta").alias("mean_delta"), "rank_high", "rank_low",
                    F.when(F.col("mean_delta") > 0, "above_route").otherwise("at_or_below_route").alias("sign"))


def daily_series(daily: DataFrame, max_points: int = 30) -> DataFrame:
    """E18 + J8 + N6: fleet actual vs predicted per date, thinned to every
    n-th date (n = days // max_points) when there are more than max_points."""
    s = daily.groupBy("date_dpr").agg(r4(F.sum("actual_daily_L")).alias("actual"),
                                      r4(F.sum("pred_daily_L")).alias("predicted"))
    s = global_row_number(s, ["date_dpr"], name="_rn")
    n = s.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    step = max(1, n // max_points) if n > max_points else 1
    return s.where((F.col("_rn") - 1) % step == 0).select("date_dpr", "actual", "predicted")


def submission(id_mapping: DataFrame, test_preds: DataFrame, train: DataFrame, pred_col: str = "pred_full") -> DataFrame:
    """N1 + F10 + J9: id, Predicted (missing -> mean train label), by id."""
    mean_label = train.agg(F.avg(TARGET).alias("m")).first()["m"]
    m = id_mapping.select("id", F.col("vehicle").alias("dumper_id"), F.col("date").alias("date_dpr"),
                          F.trim(F.col("shift")).alias("shift"))
    j = join_key(m, test_preds.select(*KEY, pred_col))
    return j.select("id", r4(F.coalesce(F.col(pred_col), F.lit(mean_label))).alias("Predicted")).orderBy("id")


def scatter_sample(delta: DataFrame, seed: int = 42, n: int = 500) -> DataFrame:
    """N4 + J7: a seeded sample of at most ``n`` train shifts (deterministic
    hash order; the sample size is the feature) with the axis limits."""
    s = delta.orderBy(F.xxhash64(*KEY, F.lit(seed)), *KEY).limit(n)
    lim = s.agg((F.least(F.min(TARGET), F.min("pred_route"), F.min("pred_full")) * 0.95).alias("axis_min"),
                (F.greatest(F.max(TARGET), F.max("pred_route"), F.max("pred_full")) * 1.05).alias("axis_max")).first()
    return s.select(*KEY, TARGET, "pred_route", "pred_full",
                    F.lit(lim["axis_min"]).alias("axis_min"), F.lit(lim["axis_max"]).alias("axis_max"))


def summary(scores: DataFrame, daily_sum: DataFrame, ranking: DataFrame) -> DataFrame:
    """One row with RMSEs, their difference and % improvement, daily
    correlation and MAPE, and the 3 least / most efficient vehicles.  Facts of
    the three reports become rows of one narrow table, which one aggregate folds."""
    oof = F.col("fold") == "oof"
    facts = [scores.where(oof & (F.col("model") == m)).select(F.lit(f"rmse_{m}").alias("fact"), F.col("rmse").alias("number")) for m in ("route", "full")]
    facts += [daily_sum.select(F.lit(c).alias("fact"), F.col(c).alias("number")) for c in ("corr", "mape")]
    facts += [ranking.where(F.col(r) <= 3).select(F.lit(r).alias("fact"), F.col(r).cast("double").alias("number"), F.col("dumper_id").alias("name"))
              for r in ("rank_high", "rank_low")]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)
    number = lambda f: F.max(F.when(F.col("fact") == f, F.col("number")))

    def names(fact: str, sign: int) -> Column:
        each = F.when(F.col("fact") == fact, F.struct((sign * F.col("number")).alias("k"), F.col("name").alias("v")))
        return F.concat_ws(",", F.transform(F.array_sort(F.collect_list(each)), lambda x: x["v"]))

    one = rows.agg(number("rmse_route").alias("rmse_route"), number("rmse_full").alias("rmse_full"), number("corr").alias("daily_corr"),
                   number("mape").alias("daily_mape"), names("rank_high", 1).alias("least_efficient"), names("rank_low", -1).alias("most_efficient"))
    gain = F.col("rmse_route") - F.col("rmse_full")
    return one.select("rmse_route", "rmse_full", r4(gain).alias("rmse_delta"),
                      round_np(F.try_divide(100 * gain, F.nullif(F.col("rmse_route"), F.lit(0.0))), 1).alias("improvement_pct"),
                      "daily_corr", "daily_mape", "least_efficient", "most_efficient")
