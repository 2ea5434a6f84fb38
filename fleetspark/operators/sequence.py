"""Per-shift ping sequences (L1–L3) and the sequence embedding.

The reference trains an LSTM on the sequences; here the sequence is summarised
by Spark ML instead: 16 equal time slices x mean of the 8 features -> scaled ->
PCA(16) fitted on the train split, and a Huber linear head predicts fuel out of
fold.  Everything runs as DataFrame/ML stages; no sequence leaves Spark.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import flag, r4, round_np
from ..params import SEQ_FEATURES, TARGET, Params
from .assemble import join_key
from .sequential import shift_positions

KEY = ["vehicle", "date_dpr", "shift_dpr"]
SLICES = 16


def sequence_features(pings: DataFrame, p: Params) -> DataFrame:
    """L1: the 8 ping features, in the reference's order; ``is_moving`` and
    ``spd_x_dt`` use the speed before normalisation."""
    return pings.select(
        *KEY, "_bkt", "ts_us", "ping_id",
        (F.col("speed") / 60.0).alias("speed"),
        ((F.col("altitude") - 500) / 300.0).alias("altitude"),
        F.col("ignition").cast("double").alias("ignition"),
        F.col("gps_ok").cast("double").alias("gps_ok"),
        F.log1p("dt_sec").alias("log_dt"),
        flag((F.col("speed") >= p.moving_speed) & (F.col("ignition") == 1)).cast("double").alias("is_moving"),
        (F.col("adiff") / 10.0).alias("adiff_norm"),
        (F.col("speed") * F.col("dt_sec") / 3600).alias("spd_x_dt"),
    )


def sequence_rows(pings: DataFrame, p: Params, max_len: int | None = None, min_len: int | None = None) -> DataFrame:
    """L2: one row per kept ping with its step ``pos``.  A shift with more than
    ``max_len`` pings keeps rows ``floor(k * ((n-1)/(max_len-1)))`` for
    k < max_len-1 and the last row (numpy ``linspace(..., dtype=int)``);
    shifts with fewer than ``min_len`` pings are dropped."""
    m = max_len or p.seq_max_len
    lo = min_len or p.seq_min_len
    f = shift_positions(sequence_features(pings, p), ["date_dpr", "shift_dpr"], "vehicle")
    f = f.where(F.col("_n") >= lo)
    r, n = F.col("_pos"), F.col("_n")
    step = (n - 1).cast("double") / float(m - 1)
    kc = F.ceil(r / step)
    cands = F.array(kc - 1, kc, kc + 1)
    hit = F.filter(cands, lambda k: (k >= 0) & (k <= m - 1) & F.when(k == m - 1, r == n - 1)
                   .otherwise(F.floor(k * step) == r))
    pos = F.when(n <= m, r).otherwise(F.try_element_at(hit, F.lit(1)))
    f = f.withColumn("pos", pos).where(F.col("pos").isNotNull())
    return f.select(*KEY, "pos", F.least(n, F.lit(m)).alias("seq_len"), *SEQ_FEATURES)


def attach_labels(seq_keys: DataFrame, labels: DataFrame) -> DataFrame:
    """Label lookup keyed by vehicle, date and *trimmed* shift."""
    lab = labels.select(F.col("dumper_id").alias("vehicle"), F.col("date_dpr"),
                        F.trim(F.col("shift")).alias("_tshift"), F.col(TARGET).alias("label"))
    k = seq_keys.withColumn("_tshift", F.trim(F.col("shift_dpr")))
    return k.join(lab, (k["vehicle"].eqNullSafe(lab["vehicle"])) & (k["date_dpr"].eqNullSafe(lab["date_dpr"]))
                  & (k["_tshift"].eqNullSafe(lab["_tshift"])), "left").select(k["*"], "label").drop("_tshift")


def label_stats(seq_labels: DataFrame) -> DataFrame:
    """L4: mean and population std of the positive labels."""
    v = seq_labels.where(F.col("label") > 0)
    return v.agg(F.count(F.lit(1)).alias("n_labelled"), r4(F.avg("label")).alias("fuel_mean"),
                 r4(F.stddev_pop("label")).alias("fuel_std"))


def slice_matrix(rows: DataFrame):
    """16 slices x 8 feature means per shift (slices of an empty span -> 0)."""
    sl = F.floor(F.col("pos") * SLICES / F.col("seq_len")).cast("int")
    g = rows.withColumn("_sl", sl).groupBy(*KEY, "_sl").agg(*[F.avg(c).alias(c) for c in SEQ_FEATURES])
    wide = g.groupBy(*KEY).pivot("_sl", list(range(SLICES))).agg(*[F.first(c).alias(c) for c in SEQ_FEATURES])
    cols = [c for c in wide.columns if c not in KEY]
    return wide.fillna(0.0, subset=cols), cols


def embed(train_rows: DataFrame, test_rows: DataFrame, p: Params):
    """Scaled slice matrix -> PCA(embed_dim) fitted on train."""
    tr, cols = slice_matrix(train_rows)
    te, _ = slice_matrix(test_rows)
    # shift-level matrices: materialised once before the ML fits
    tr, te = tr.checkpoint(eager=True), te.checkpoint(eager=True)
    for c in cols:
        if c not in te.columns:
            te = te.withColumn(c, F.lit(0.0))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=cols, outputCol="_x"),
        StandardScaler(inputCol="_x", outputCol="_xs", withMean=True, withStd=True),
        PCA(k=p.embed_dim, inputCol="_xs", outputCol="_pc"),
    ]).fit(tr)
    def out(df):
        t = pipe.transform(df).select(*KEY, vector_to_array("_pc").alias("_a"))
        return t.select(*KEY, *[round_np(F.col("_a")[i], 6).alias(f"seq_h{i:02d}") for i in range(p.embed_dim)])
    return out(tr), out(te)


def fuel_head(emb_train: DataFrame, emb_test: DataFrame, seq_labels: DataFrame, p: Params):
    """Huber linear regression on the embedding, standardised label as in
    the reference; train predictions are out of fold (the reference scores
    its own training rows, Q17), test predictions average the fold models."""
    emb_cols = [c for c in emb_train.columns if c.startswith("seq_h")]
    st = label_stats(seq_labels).first()
    mean, std = (st["fuel_mean"] or 0.0), (st["fuel_std"] or 0.0)
    lab = seq_labels.select(*KEY, "label")
    d = emb_train.join(lab, KEY, "left")
    d = d.withColumn("_fold", F.pmod(F.xxhash64(*KEY, F.lit(p.seed)), F.lit(p.folds)))
    va = VectorAssembler(inputCols=emb_cols, outputCol="_x")
    d = va.transform(d).checkpoint(eager=True)
    te = va.transform(emb_test).checkpoint(eager=True)
    fit_rows = d.where(F.col("label") > 0).withColumn("_y", (F.col("label") - mean) / (std + 1e-6))
    oof, tests = [], []
    for i in range(p.folds):
        part = fit_rows.where(F.col("_fold") != i)
        model = LinearRegression(featuresCol="_x", labelCol="_y", loss="huber", maxIter=50).fit(part)
        oof.append(model.transform(d.where(F.col("_fold") == i)).select(*KEY, F.col("prediction").alias("_p")))
        tests.append(model.transform(te).select(*KEY, F.col("prediction").alias("_p")))
    def denorm(parts, avg):
        u = parts[0]
        for x in parts[1:]:
            u = u.unionByName(x)
        if avg:
            u = u.groupBy(*KEY).agg(F.avg("_p").alias("_p"))
        return u.select(*KEY, r4(F.col("_p") * std + mean).alias("seq_fuel_pred"))
    return denorm(oof, False), denorm(tests, True)


def train_mae(pred_train: DataFrame, seq_labels: DataFrame) -> DataFrame:
    """MAE over labelled shifts (label > 0)."""
    j = pred_train.join(seq_labels.select(*KEY, "label"), KEY).where(F.col("label") > 0)
    return j.agg(F.count(F.lit(1)).alias("n"), r4(F.avg(F.abs(F.col("seq_fuel_pred") - F.col("label")))).alias("mae"))


def merge_embedding(final: DataFrame, emb: DataFrame, mark: str | None = None) -> DataFrame:
    """Drop existing embedding columns, left-join, unmatched -> 0.
    ``mark`` names a column that tells the matched rows."""
    cols = [c for c in emb.columns if c not in KEY]
    f = final.drop(*[c for c in cols if c in final.columns])
    e = emb.select(F.col("vehicle").alias("dumper_id"), "date_dpr", F.col("shift_dpr").alias("shift"), *cols,
                   *([F.lit(True).alias(mark)] if mark else []))
    out = join_key(f, e).fillna(0.0, subset=cols)
    return out.withColumn(mark, F.coalesce(mark, F.lit(False))) if mark else out
