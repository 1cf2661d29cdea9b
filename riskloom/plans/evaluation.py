"""Queries on model evaluation."""

from __future__ import annotations

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl, round_up
from riskloom.operators import evaluation as E
from riskloom.operators import learning as ML
from riskloom.operators import portfolio as A
from riskloom.operators.scoring import linear_model, prediction_table, robust_scale, true_risk_score
from riskloom.plans.registry import query
from riskloom.plans.scoring import RUN_TS, SCALED_CTE
from riskloom.plans.sqltext import WIDE, bucket, d, r
from riskloom.sources import proxies as P
from riskloom.sources.models import ModelStore
from riskloom.sources.store import materialise, materialise_counted, scratch_path
from riskloom.sources.tables import read

PAY, INC, RES = K.FEATURES

EV_CTE = WIDE + SCALED_CTE + f""",
ev AS (SELECT customer_id, risk_score / {d(100)} AS truth, predicted, CASE WHEN risk_score / {d(100)} > {d(0.5)} THEN 1 ELSE 0 END AS true_label,
  CASE WHEN predicted > (SELECT median(predicted) FROM sc) THEN 1 ELSE 0 END AS pred_label, {bucket('customer_id', 5)} = 0 AS is_test FROM sc),
te AS (SELECT * FROM ev WHERE is_test)
"""


def evaluation_frame(spark, sf):
    """Truth (0..1), robustly scaled prediction, split and labels: projections of one stored frame."""
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES, "risk_score")
    raw = materialise(wide.withColumn("raw_score", linear_model(wide)))
    scaled = robust_scale(raw, "raw_score", "predicted").select(
        "customer_id", (F.col("risk_score") / dbl(100.0)).alias("truth"), "predicted"
    )
    return E.with_labels(E.with_split(scaled), "truth", "predicted")


def holdout(spark, sf):
    return evaluation_frame(spark, sf).where("is_test")


@query("score_column_pick", WIDE + "SELECT customer_id, risk_score AS score FROM ec")
def score_column_pick(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", "risk_score")
    return wide.select("customer_id", F.col(E.pick_score_column(wide)).alias("score"))


@query("labels", EV_CTE + "SELECT customer_id, true_label, pred_label FROM ev")
def labels(spark, sf):
    return evaluation_frame(spark, sf).select("customer_id", "true_label", "pred_label")


@query("holdout_split", f"SELECT c_custkey AS customer_id, {bucket('c_custkey', 5)} = 0 AS is_test FROM customer")
def holdout_split(spark, sf):
    return E.with_split(read(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "customer_id"))


@query(
    "confusion_matrix",
    EV_CTE + """SELECT t AS true_label, p AS pred_label, (SELECT count(*) FROM te WHERE true_label = t AND pred_label = p) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS v(t, p)""",
)
def confusion_matrix(spark, sf):
    return E.confusion_matrix(holdout(spark, sf))


_COUNTS = """, cm AS (SELECT CAST(count(*) FILTER (WHERE true_label = 1 AND pred_label = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE true_label = 0 AND pred_label = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE true_label = 1 AND pred_label = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE true_label = 0 AND pred_label = 0) AS DOUBLE) AS tn FROM te)"""
_CLS = {
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
}


@query(
    "classification_metrics",
    EV_CTE + _COUNTS + "SELECT " + ", ".join(f'{r(e, 9)} AS "{n}"' for n, e in _CLS.items()) + " FROM cm",
)
def classification_metrics(spark, sf):
    out = E.classification_metrics(holdout(spark, sf))
    return out.select(*[round_up(F.col(c), 9).alias(c) for c in out.columns])


_REG = {
    "mae": "avg(abs(predicted - truth))",
    "rmse": "sqrt(avg((predicted - truth) * (predicted - truth)))",
    "r2": "1 - avg((predicted - truth) * (predicted - truth)) / var_pop(truth)",
}


@query("regression_metrics", EV_CTE + "SELECT " + ", ".join(f"{r(e, 6)} AS {n}" for n, e in _REG.items()) + " FROM te")
def regression_metrics(spark, sf):
    out = E.regression_metrics(holdout(spark, sf), "truth", "predicted")
    return out.select(*[round_up(F.col(c), 6).alias(c) for c in out.columns])


_BIN = "(" + " + ".join(f"CASE WHEN predicted > {d(i * (1.0 / 10))} THEN 1 ELSE 0 END" for i in range(1, 10)) + ")"


@query(
    "calibration_curve",
    EV_CTE + f"SELECT {_BIN} AS bin, {r('avg(true_label)', 9)} AS prob_true, {r('avg(predicted)', 9)} AS prob_pred FROM te GROUP BY 1",
)
def calibration_curve(spark, sf):
    out = E.calibration_curve(holdout(spark, sf), "true_label", "predicted")
    return out.select("bin", round_up(F.col("prob_true"), 9).alias("prob_true"), round_up(F.col("prob_pred"), 9).alias("prob_pred"))


_SWEEP_CTE = EV_CTE + f""", th(threshold) AS (VALUES {', '.join(f'({d(t)})' for t in E.THRESHOLDS)}),
sw AS (SELECT threshold, count(*) FILTER (WHERE true_label = 1 AND predicted > threshold) AS tp, count(*) FILTER (WHERE true_label = 0 AND predicted > threshold) AS fp,
  count(*) FILTER (WHERE true_label = 1 AND NOT predicted > threshold) AS fn FROM ev CROSS JOIN th GROUP BY threshold),
sf AS (SELECT *, coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM sw)
"""


@query("threshold_sweep", _SWEEP_CTE + f"SELECT threshold, tp, fp, fn, {r('f1', 9)} AS f1 FROM sf")
def threshold_sweep(spark, sf):
    out = E.threshold_sweep(evaluation_frame(spark, sf), "true_label", "predicted")
    return out.withColumn("f1", round_up(F.col("f1"), 9))


@query(
    "best_threshold",
    _SWEEP_CTE + f"""SELECT CASE WHEN max(f1) > 0 THEN min(threshold) FILTER (WHERE f1 = (SELECT max(f1) FROM sf)) ELSE {d(0.1)} END AS threshold,
  {r('max(f1)', 9)} AS f1 FROM sf""",
)
def best_threshold(spark, sf):
    out = E.best_threshold(E.threshold_sweep(evaluation_frame(spark, sf), "true_label", "predicted"))
    return out.withColumn("f1", round_up(F.col("f1"), 9))


@query("prediction_bias", EV_CTE + f"SELECT customer_id, {r('predicted - truth', 9)} AS bias FROM te")
def prediction_bias(spark, sf):
    out = E.prediction_bias(holdout(spark, sf), "truth", "predicted")
    return out.select("customer_id", round_up(F.col("bias"), 9).alias("bias"))


@query(
    "bias_histogram",
    EV_CTE + f""", bs AS (SELECT {r('predicted - truth', 9)} AS x FROM te WHERE truth IS NOT NULL), bd AS (SELECT min(x) AS lo, max(x) AS hi FROM bs)
SELECT CAST(least(19, floor((x - lo) / (hi - lo) * {d(20)})) AS INTEGER) AS bin, count(*) AS n FROM bs, bd GROUP BY 1""",
)
def bias_histogram(spark, sf):
    biased = E.prediction_bias(holdout(spark, sf), "truth", "predicted")
    return A.histogram(biased.select(round_up(F.col("bias"), 9).alias("bias")), "bias", 20)


_REPORT = {
    "Accuracy": f"(SELECT {_CLS['accuracy']} FROM cm)", "Precision": f"(SELECT {_CLS['precision']} FROM cm)",
    "Recall": f"(SELECT {_CLS['recall']} FROM cm)", "F1 Score": f"(SELECT {_CLS['f1']} FROM cm)",
    "MAE": f"(SELECT {_REG['mae']} FROM te)", "RMSE": f"(SELECT {_REG['rmse']} FROM te)", "R2 Score": f"(SELECT {_REG['r2']} FROM te)",
    "Threshold": "(SELECT median(predicted) FROM ev)",
}


@query(
    "evaluation_report",
    EV_CTE + _COUNTS + " UNION ALL ".join(f"SELECT '{n}' AS \"Metric\", {r(e, 6)} AS \"Value\"" for n, e in _REPORT.items()),
)
def evaluation_report(spark, sf):
    whole = evaluation_frame(spark, sf)
    out = E.evaluation_report(whole.where("is_test"), whole, "truth", "predicted")
    return out.withColumn("Value", round_up(F.col("Value"), 6))


def _features(spark, sf, *extra):
    return materialise(P.wide_customers(spark, sf, "customer_id", *K.FEATURES, *extra))


@query("model_predict")
def model_predict(spark, sf):
    rows = _features(spark, sf, "risk_score").withColumn("target", F.col("risk_score") / dbl(100.0))
    split = E.with_split(rows)
    out = ML.model_predict(split.where(~F.col("is_test")), split, "target")
    return out.select("customer_id", "target", "ml_score", "is_test")


def _trained(spark, sf, learner=None):
    """Whole table of features and target, the rows to learn from, their number, and the pipeline fitted to them."""
    rows = E.with_split(_features(spark, sf, "risk_score").withColumn("target", F.col("risk_score") / dbl(100.0)))
    train, n = materialise_counted(rows.where(~F.col("is_test") & F.col("target").isNotNull()), "training")
    return rows, n, ML.fit_pipeline(train, "target", learner)


def _differing(rows, model, score):
    """Rows, and those where the expression is not what the pipeline itself says."""
    both = model.transform(rows).select("ml_score", score(rows).alias("expression"))
    apart = F.abs(F.col("ml_score") - F.col("expression"))
    return both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(~(F.coalesce(apart, F.lit(1.0)) <= 1e-9)).alias("differing"))


@query(
    "trees_as_expressions",
    WIDE + "SELECT model_type, count(*) AS scored, 0 AS differing FROM ec, (VALUES ('GBTRegressionModel'), ('RandomForestRegressionModel')) AS t(model_type) GROUP BY 1",
)
def trees_as_expressions(spark, sf):
    """Boosted trees and a forest scored as column expressions, against the models' own scores on every row."""
    out = None
    for learner in (None, RandomForestRegressor(numTrees=100, maxDepth=5, seed=42)):
        rows, _, model = _trained(spark, sf, learner)
        found = _differing(rows, model, ML.compiled(model)).select(F.lit(type(model.stages[-1]).__name__).alias("model_type"), "scored", "differing")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "stored_model_scores",
    WIDE + f"""SELECT 'v3.0' AS model_version, 'GBTRegressionModel' AS model_type, count(*) FILTER (WHERE {bucket('customer_id', 5)} <> 0 AND risk_score IS NOT NULL) AS training_rows,
  count(*) AS scored, 0 AS differing FROM ec""",
)
def stored_model_scores(spark, sf):
    """A model fitted, stored and registered, then loaded by another session, which scores the same to the last digit."""
    rows, n, model = _trained(spark, sf)
    path = scratch_path(spark, "model_store")
    ModelStore(spark, path).save(model, "v3.0", K.FEATURES, RUN_TS, n)
    loaded, row = ModelStore(spark.newSession(), path).load()
    out = _differing(rows, model, ML.compiled(loaded))
    return out.select(F.lit(row.model_version).alias("model_version"), F.lit(row.model_type).alias("model_type"), F.lit(row.training_rows).alias("training_rows"), "scored", "differing")


@query("prediction_table_trained")
def prediction_table_trained(spark, sf):
    """The complete prediction table by the stored, trained model, stamped with its digest and version."""
    rows, n, model = _trained(spark, sf)
    store = ModelStore(spark, scratch_path(spark, "model_store"))
    store.save(model, "v3.0", K.FEATURES, RUN_TS, n)
    loaded, row = store.load()
    return prediction_table(rows.select("customer_id", *K.FEATURES), row.model_hash, row.model_version, ML.compiled(loaded))


@query(
    "prediction_table_trained_check",
    WIDE + """SELECT count(*) AS n, true AS in_range, true AS centred, true AS one_model, true AS close, true AS bands FROM ec""",
)
def prediction_table_trained_check(spark, sf):
    """Every customer is there once, scores lie between 0 and 1, biases add up to nothing, and the scores follow the true ones."""
    table = materialise(prediction_table_trained(spark, sf))
    truth = _features(spark, sf, "risk_score").select("customer_id", "risk_score")
    score = F.col("predicted_risk_score")
    return table.join(truth, "customer_id").agg(
        F.count_distinct("customer_id").alias("n"),
        F.bool_and(score.between(0.0, 1.0) & F.col("risk_percentile").between(0.0, 1.0)).alias("in_range"),
        (F.abs(F.sum("bias_delta")) < 1e-6).alias("centred"),
        ((F.count_distinct("model_hash") == 1) & (F.min("model_version") == "v3.0")).alias("one_model"),
        (F.corr(score, F.col("risk_score")) > 0.9).alias("close"),
        F.bool_and(F.upper("predicted_band").isin("LOW", "MEDIUM", "HIGH")).alias("bands"),
    )


@query("forest_regression")
def forest_regression(spark, sf):
    rows = E.with_split(true_risk_score(_features(spark, sf)))
    out = ML.forest_regression(rows.where(~F.col("is_test")), rows, "true_risk_score")
    return out.select("customer_id", "true_risk_score", "regression_score", "is_test")


@query("platt_calibration")
def platt_calibration(spark, sf):
    rows, n = materialise_counted(evaluation_frame(spark, sf))
    out = ML.platt_calibration(rows, "predicted", "true_label", n)
    return out.select("customer_id", "predicted", "calibrated_score")


@query("validation_report")
def validation_report(spark, sf):
    wide = P.wide_customers(spark, sf, "customer_id", *K.FEATURES)
    scaled = robust_scale(materialise(wide.withColumn("raw_score", linear_model(wide))), "raw_score", "predicted_risk_score")
    return ML.validation_report(materialise(scaled.drop("raw_score")))


def _sides(df, target: str, score: str, error: float):
    """Per side of the split: rows, whether all scores lie in the range of the target, and whether the mean error is small."""
    ends = df.agg(F.min(target).alias("low"), F.max(target).alias("high")).first()
    inside = F.col(score).between(ends.low - error, ends.high + error)
    return df.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(inside).alias("in_range"), (F.avg(F.abs(F.col(score) - F.col(target))) <= error).alias("close")
    )


_SIDES_SQL = f"SELECT {bucket('customer_id', 5)} = 0 AS is_test, count(*) AS n, true AS in_range, true AS close FROM ec GROUP BY 1"


@query("model_predict_check", WIDE + _SIDES_SQL)
def model_predict_check(spark, sf):
    return _sides(materialise(model_predict(spark, sf)), "target", "ml_score", 0.03)


@query("forest_regression_check", WIDE + _SIDES_SQL)
def forest_regression_check(spark, sf):
    return _sides(materialise(forest_regression(spark, sf)), "true_risk_score", "regression_score", 0.05)


@query("platt_calibration_check", EV_CTE + f"SELECT count(*) AS n, {r('avg(true_label)', 3)} AS mean, true AS ordered FROM ev")
def platt_calibration_check(spark, sf):
    """Calibrated on all rows, the mean probability is the mean label; a probability never falls as the score grows."""
    out = materialise(platt_calibration(spark, sf).where("predicted is not null"))
    ends = out.groupBy(F.floor(F.col("predicted") * 50)).agg(F.min("calibrated_score").alias("low"), F.max("calibrated_score").alias("high"), F.min("predicted").alias("at"))
    bins = ends.orderBy("at").collect()  # at most 51 rows
    ordered = all(a.high <= b.low + 1e-12 for a, b in zip(bins, bins[1:]))
    return out.agg(F.count(F.lit(1)).alias("n"), round_up(F.avg("calibrated_score"), 3).alias("mean")).withColumn("ordered", F.lit(ordered))


@query("validation_report_check", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in ("MAE", "RMSE", "R2 Score", "Accuracy", "Precision", "Recall", "F1 Score", "Threshold")) + ") AS t(\"Metric\", plausible)")
def validation_report_check(spark, sf):
    """Every figure of the run is there and plausible: errors small, shares between 0 and 1 and better than a coin."""
    value = F.col("Value")
    small = F.col("Metric").isin("MAE", "RMSE")
    return validation_report(spark, sf).select("Metric", F.when(small, value.between(0.0, 0.1)).when(F.col("Metric") == "Threshold", value.between(0.1, 0.9)).otherwise(value.between(0.5, 1.0)).alias("plausible"))
