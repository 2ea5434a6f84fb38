"""Model preparation and cross-validated regression.

Features are selected by Spark ML gradient-boosted trees, and the regressor is
a Spark ML random forest.  Statistics (medians, means, standard deviations, category codes) are
computed by Spark aggregates; only their one-row results reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import round_np
from ..functions.order_stats import dense_codes, medians
from ..functions.ranking import global_row_number
from ..params import CAT_FEATURES, TARGET, Params

KEY = ["dumper_id", "date_dpr", "shift"]
DROP = {TARGET, "had_refill", "runhrs", "lph", "initlev", "endlev", "date_dpr", "id"}
ID_COLS = ("dumper_id", "operator_id")
EMB_PREFIX = "seq_"


def model_rows(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Haulers only; train rows need a label."""
    dump = F.coalesce(F.col("dumper_id").startswith("Dump"), F.lit(False))
    return train.where(dump & F.col(TARGET).isNotNull()), test.where(dump)


def feature_columns(train: DataFrame, test: DataFrame, exclude_ids: bool = False) -> tuple[list, list]:
    """Columns present in both splits minus targets/ids/dates, in train
    order; returns (categorical, numeric)."""
    feats = [c for c in train.columns if c in test.columns and c not in DROP]
    if exclude_ids:
        feats = [c for c in feats if c not in ID_COLS]
    cats = [c for c in CAT_FEATURES if c in feats]
    return cats, [c for c in feats if c not in cats]


def median_stats(train: DataFrame, nums: list[str]) -> DataFrame:
    """M1: exact train median of every numeric feature, as (feature, median);
    NULL for a feature without values.  All features go through one
    distributed rank search; no task holds a column."""
    long = train.select(*[F.col(c).cast("double").alias(c) for c in nums]).unpivot([], nums, "feature", "value")
    every = train.sparkSession.createDataFrame([(c,) for c in nums], "feature string")
    return every.join(medians(long, ["feature"], "value").select("feature", "median"), "feature", "left")


def impute(df: DataFrame, medians: dict, nums: list[str]) -> DataFrame:
    """Fill with the train median (0 when the median is NULL)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c) or 0.0)))
                           for c in nums})


def scale_stats(train_imp: DataFrame, nums: list[str]) -> DataFrame:
    """M2: mean and population std on train (zero std -> 1).  The mean comes
    from an exact decimal sum, so it does not depend on how rows are split
    across partitions."""
    value = F.col("value")
    exact_mean = F.sum(value.cast("decimal(38,10)")).cast("double") / F.count("value")
    # a row per value: one aggregate over all columns at once outgrows what the JVM compiles
    long = train_imp.select(*[F.col(c).cast("double").alias(c) for c in nums]).unpivot([], nums, "feature", "value")
    found = long.groupBy("feature").agg(exact_mean.alias("mean"), F.stddev_pop("value").alias("std"))
    every = train_imp.sparkSession.createDataFrame([(c,) for c in nums], "feature string")
    return every.join(found, "feature", "left").select("feature", "mean", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("std"))


def category_codes(train: DataFrame, test: DataFrame, cats: list[str]) -> DataFrame:
    """M3: 0-based code of each category value in sorted order over
    train ∪ test; NULL becomes the text 'Missing'."""
    def values(df):
        parts = [df.select(F.lit(c).alias("feature"),
                           F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("value")) for c in cats]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out
    return dense_codes(values(train).unionByName(values(test)), "feature", "value")


def code_column(feature: str) -> str:
    return f"{feature}_code"


def encode(df: DataFrame, codes: DataFrame, cats: list[str]) -> DataFrame:
    """Add the code of each categorical column as ``<column>_code`` (small code
    table joined per feature); the columns themselves stay, as some are keys."""
    for c in cats:
        m = codes.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"),
                                                      F.col("code").cast("double").alias(code_column(c)))
        df = (df.withColumn(f"_v_{c}", F.coalesce(F.col(c).cast("string"), F.lit("Missing")))
              .join(m, f"_v_{c}", "left").drop(f"_v_{c}"))
    return df


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list


def prepare(train: DataFrame, test: DataFrame, exclude_ids: bool = False, features: list | None = None) -> Prepared:
    """M1–M3 applied to both splits, plus a ``features`` vector column."""
    cats, nums = feature_columns(train, test, exclude_ids)
    if features is not None:
        cats = [c for c in CAT_FEATURES if c in features]
        nums = [c for c in features if c not in cats]
    med = {r["feature"]: r["median"] for r in median_stats(train, nums).collect()}
    tr, te = impute(train, med, nums), impute(test, med, nums)
    sc = {r["feature"]: (r["mean"], r["std"]) for r in scale_stats(tr, nums).collect()}
    z = lambda df: df.withColumns({c: (F.col(c) - F.lit(sc[c][0] or 0.0)) / F.lit(sc[c][1] or 1.0) for c in nums})
    tr, te = z(tr), z(te)
    codes = category_codes(train, test, cats)
    tr, te = encode(tr, codes, cats), encode(te, codes, cats)
    va = VectorAssembler(inputCols=nums + [code_column(c) for c in cats], outputCol="features")
    # cut the lineage before iterative fitting (small, shift-level tables)
    return Prepared(va.transform(tr).checkpoint(eager=True), va.transform(te).checkpoint(eager=True), nums + cats)


def _forest(p: Params) -> RandomForestRegressor:
    """The regressor of the cross-validation: a seeded random forest (trees
    of one level are grown in one pass over the data)."""
    return RandomForestRegressor(featuresCol="features", labelCol=TARGET, numTrees=60, maxDepth=6, seed=p.seed)


def split_counts(trees: str, features: list[str]) -> dict[str, int]:
    """How often each feature splits a node, from ``toDebugString``."""
    n = Counter(int(i) for i in re.findall(r"If \(feature (\d+) ", trees))
    return {f: n.get(i, 0) for i, f in enumerate(features)}


def feature_scout(train: DataFrame, test: DataFrame, p: Params, exclude_ids: bool = False) -> DataFrame:
    """M4: gradient-boosted trees on all candidate features; importance is the
    number of splits a feature decides.  Kept are the top ``scout_top_k``
    features that are no embedding column, every embedding column, and the
    categoricals.  The fit sees its rows in a fixed order and seed, so a
    rerun gives the same table."""
    prep = prepare(train, test, exclude_ids)
    rows = prep.train.select(*KEY, TARGET, "features").repartition(*KEY).sortWithinPartitions(*KEY, TARGET).checkpoint()
    model = GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=p.scout_rounds, maxDepth=5, stepSize=0.1, maxBins=64,
                         seed=p.seed).fit(rows)
    imp = split_counts(model.toDebugString, prep.features)
    spark = train.sparkSession
    found = spark.createDataFrame([(f, float(v)) for f, v in imp.items()], "feature string, importance double")
    emb = F.col("feature").startswith(EMB_PREFIX)
    # one row per feature: the window holds the column list, not data
    rank = F.row_number().over(Window.partitionBy(emb).orderBy(F.desc("importance"), "feature"))
    cats = [c for c in CAT_FEATURES if c in prep.features]
    sel = emb | (~emb & (rank <= p.scout_top_k)) | F.col("feature").isin(cats)
    return found.withColumn("selected", sel)


def assign_folds(rows: DataFrame, folds: int, seed: int) -> DataFrame:
    """M5: ``fold`` of every row.  The rows are put in the order of a keyed hash
    of their shift key (a distributed sort, ties by the key and then the other
    columns) and dealt out in turn, so fold sizes differ by one at most and the
    first folds are the larger ones; rows with NULL keys are dealt like others."""
    order = rows.withColumn("_h", F.xxhash64(*KEY, F.lit(seed)))
    return global_row_number(order, ["_h", *KEY], "_rn").withColumn("fold", ((F.col("_rn") - 1) % folds).cast("int")).drop("_h", "_rn")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def cv_regression(train: DataFrame, test: DataFrame, p: Params, exclude_ids: bool = False, tag: str = "full"):
    """M5: ``folds``-fold CV with shuffled, seeded folds of equal size, fitted
    side by side; out-of-fold predictions for train with their fold,
    fold-averaged predictions for test (both clipped at 0; RMSE on the unclipped
    values).  Returns (oof, test_pred, scores); scores has a row per fold, one
    over all rows (``oof``) and the spread of the fold scores (``std``)."""
    scout = feature_scout(train, test, p, exclude_ids)
    feats = [r["feature"] for r in scout.where("selected").orderBy("feature").collect()]
    prep = prepare(assign_folds(train, p.folds, p.seed), test, exclude_ids, features=feats)
    tr = prep.train

    def fit(i: int):
        m = _forest(p).fit(tr.where(F.col("fold") != i))
        return (m.transform(tr.where(F.col("fold") == i)).select(*KEY, TARGET, "fold", F.col("prediction").alias("_p")),
                m.transform(prep.test).select(*KEY, F.col("prediction").alias("_p")))

    with ThreadPoolExecutor(p.folds) as pool:
        done = list(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(p.folds)))
    # predictions are kept: the scores and both reports read them
    u = union_all([o for o, _ in done]).checkpoint()
    t = union_all([x for _, x in done]).groupBy(*KEY).agg(F.avg("_p").alias("_p"))
    rmse = F.sqrt(F.avg((F.col("_p") - F.col(TARGET)) ** 2)).alias("rmse")
    by_fold = u.groupBy(F.col("fold").cast("string").alias("fold")).agg(rmse)
    spread = by_fold.agg(F.lit("std").alias("fold"), F.stddev_pop("rmse").alias("rmse"))
    scores = union_all([by_fold, u.agg(F.lit("oof").alias("fold"), rmse), spread]).select(
        F.lit(tag).alias("model"), "fold", round_np("rmse", 4).alias("rmse"))
    clip0 = lambda c: F.greatest(F.col(c), F.lit(0.0))
    return (u.select(*KEY, "fold", clip0("_p").alias(f"pred_{tag}")), t.select(*KEY, clip0("_p").alias(f"pred_{tag}")), scores)


def both_models(train: DataFrame, test: DataFrame, p: Params) -> dict:
    """``cv_regression`` by tag: the route model (no ids) and the full one.  They go side by side: a
    boosting round is a short job for each level of its tree, which leaves most cores waiting."""
    def one(tag: str):
        return cv_regression(train, test, p, exclude_ids=(tag == "route"), tag=tag)

    tags = ("route", "full")
    with ThreadPoolExecutor(len(tags)) as pool:
        return dict(zip(tags, pool.map(inheritable_thread_target(train.sparkSession)(one), tags)))


def both_predictions(route: DataFrame, full: DataFrame) -> DataFrame:
    """M6: route and full predictions of the same shifts; keys may be NULL.
    Out-of-fold predictions carry the fold, which both models share."""
    f = full.select(*[F.col(k).alias(f"_{k}") for k in KEY], "pred_full")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    return route.join(f, same).select(*KEY, *[c for c in ("fold",) if c in route.columns], "pred_route", "pred_full")
