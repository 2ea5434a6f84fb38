"""Order statistics, dense codes and folds against numpy and pandas, and their plans."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.functions.order_stats import dense_codes, medians, quantiles
from fleetspark.operators.assemble import agreement_report
from fleetspark.operators import model
from fleetspark.operators.model import assign_folds, category_codes, median_stats, scale_stats
from fleetspark.params import Params


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(0)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["b", "c", None]), None if rng.random() < 0.1 else float(np.round(rng.normal(), 2)))
            for _ in range(5000)]
    return spark.createDataFrame(rows + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)], "g string, v double").repartition(6)


def test_quantiles(values):
    got = {(r.g, r.p): (r.n, r.quantile) for r in quantiles(values, ["g"], "v", [0, 0.25, 0.5, 0.9, 1]).collect()}
    groups: dict = {}
    for r in values.collect():
        if r.v is not None:
            groups.setdefault(r.g, []).append(r.v)
    assert set(got) == {(g, p) for g in groups for p in (0, 0.25, 0.5, 0.9, 1)}
    for (g, p), (n, x) in got.items():
        assert n == len(groups[g]) and x == pytest.approx(np.quantile(groups[g], p), abs=1e-12)


def test_quantiles_of_nothing(values):
    assert medians(values.where("false"), ["g"], "v").isEmpty()
    assert medians(values.where("g = 'none'"), ["g"], "v").isEmpty()
    with pytest.raises(ValueError):
        quantiles(values, ["g"], "v", [1.5])


def test_codes(values):
    got = dense_codes(values.select("g", F.coalesce(F.col("v").cast("string"), F.lit("Missing")).alias("v")), "g", "v").collect()
    for g in {r.g for r in got}:
        own = sorted(((r.v, r.code) for r in got if r.g == g), key=lambda x: x[1])
        assert [c for _, c in own] == list(range(len(own))) and [v for v, _ in own] == sorted(v for v, _ in own)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_node_gathers_a_column(spark, values):
    wide = values.select(F.col("v").alias("a"), (F.col("v") * 2).alias("b"), "g")
    shift = values.select(F.col("v").alias("prod_hrs"), (F.col("v") + 1).alias("prod_hr_dpr"))
    for df in (median_stats(wide, ["a", "b"]), agreement_report(shift), category_codes(wide, wide, ["g"])):
        p = plan(df)
        assert "percentile" not in p and "median" not in p.replace("AS median", "").replace("median#", "")
        # windows run over one row per partition, or inside (group, partition)
        for line in p.splitlines():
            if "Window [" in line and "dense_rank" in line:
                raise AssertionError(line)


@pytest.mark.parametrize("n", [3, 23, 25])
def test_folds_are_equal_and_shuffled(spark, n):
    rows = spark.range(n).select(F.when(F.col("id") > 1, F.concat(F.lit("Dump"), "id")).alias("dumper_id"),
                                 F.lit(None).cast("date").alias("date_dpr"), F.lit("A").alias("shift"), F.col("id").cast("double").alias("x"))
    a, b = (assign_folds(rows.repartition(k), 5, 42).collect() for k in (1, 4))
    sizes = sorted((sum(r.fold == f for r in a) for f in range(5)), reverse=True)
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert {(r.x, r.fold) for r in a} == {(r.x, r.fold) for r in b}
    if n > 20:
        by_id = [r.fold for r in sorted(a, key=lambda r: r.x)]
        assert by_id != [i % 5 for i in range(n)]
        other = {(r.x, r.fold) for r in assign_folds(rows, 5, 7).collect()}
        assert other != {(r.x, r.fold) for r in a}


def test_scale_stats_aggregate_rows_of_values(spark):
    rows = [(float(i), 3.0, i % 7 / 3) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    stats = scale_stats(df, ["a", "b", "c"])
    got = {r.feature: (r["mean"], r["std"]) for r in stats.collect()}
    for i, c in enumerate("abc"):
        x = np.array([r[i] for r in rows])
        assert got[c] == (pytest.approx(x.mean()), pytest.approx(x.std() or 1.0))
    # the aggregate does not grow with the columns
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("stddev_pop(") == 1
    assert [tuple(r) for r in scale_stats(df.limit(0), ["a"]).collect()] == [("a", None, None)]


def test_both_models_go_side_by_side(spark, monkeypatch):
    together = threading.Barrier(2, timeout=60)

    def fit(train, test, p, exclude_ids, tag):
        together.wait()
        return tag, exclude_ids

    monkeypatch.setattr(model, "cv_regression", fit)
    none = spark.range(0)
    assert model.both_models(none, none, Params()) == {"route": ("route", True), "full": ("full", False)}
