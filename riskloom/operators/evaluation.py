"""Model evaluation: labels, split, classification and regression metrics, calibration, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import at_most_count, dbl, hash_bucket
from riskloom.operators.quantiles import exact_quantiles

SCORE_CANDIDATES = ["risk_score", "risk", "predicted_risk_score", "score"]
THRESHOLDS = [0.01 + i * 0.01 for i in range(50)]
DEFAULT_THRESHOLD = 0.1
HOLDOUT_FIFTHS = 5


def pick_score_column(df: DataFrame) -> str:
    """First of the known score columns that the frame has."""
    for c in SCORE_CANDIDATES:
        if c in df.columns:
            return c
    raise ValueError("no score column found")


def with_labels(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """True label: score above one half. Predicted label: prediction above the median prediction."""
    median = exact_quantiles(df, {"m": (predicted, 0.5)})["m"]
    return df.withColumns(
        {
            "true_label": F.when(F.col(truth) > 0.5, 1).otherwise(0),
            "pred_label": F.when(F.col(predicted) > median, 1).otherwise(0),
        }
    )


def with_split(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """One fifth of the keys, chosen by hash, is the test side; a key is always on the same side."""
    return df.withColumn("is_test", hash_bucket(F.col(key), HOLDOUT_FIFTHS) == 0)


def confusion_counts() -> dict[str, Column]:
    t, p = F.col("true_label"), F.col("pred_label")
    return {
        "tn": F.count_if((t == 0) & (p == 0)),
        "fp": F.count_if((t == 0) & (p == 1)),
        "fn": F.count_if((t == 1) & (p == 0)),
        "tp": F.count_if((t == 1) & (p == 1)),
    }


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Four rows (true, predicted, count), zeros included."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counted = df.agg(*[c.alias(n) for n, c in confusion_counts().items()])
    rows = [
        F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("pred_label"), F.col(n).alias("n")) for n, (t, p) in cells.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), dbl(0.0))


def classification_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; a division by zero gives 0."""
    c = df.agg(*[v.alias(n) for n, v in confusion_counts().items()])
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 (undefined for a constant truth); the total sum is centred on the mean first."""
    t, p = F.col(truth), F.col(predicted)
    complete = df.where(t.isNotNull() & p.isNotNull())
    sums = complete.agg(
        F.avg(F.abs(p - t)).alias("mae"),
        F.avg((p - t) * (p - t)).alias("mse"),
        F.var_pop(t).alias("spread"),
    )
    return sums.select(
        "mae", F.sqrt("mse").alias("rmse"), (dbl(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2")
    )


def calibration_curve(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean label and mean score per right-closed uniform bin that has rows."""
    place = at_most_count(F.col(score), [i * (1.0 / bins) for i in range(1, bins)])
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.avg(label).alias("prob_true"), F.avg(score).alias("prob_pred"))
    )


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """F1 at every threshold, from one pass.

    A row is positive for the first ``k`` thresholds, where ``k`` is the number of
    thresholds below its score. Rows are counted per ``k`` (at most 51 groups), and
    only those groups are spread over the thresholds they are positive for.
    """
    groups = (
        df.groupBy(at_most_count(F.col(score), THRESHOLDS).alias("k"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    cells = [F.struct(F.lit(i).alias("i"), dbl(t).alias("threshold")) for i, t in enumerate(THRESHOLDS)]
    spread = groups.select("k", "pos", "neg", F.inline(F.array(*cells)))
    above = F.col("i") < F.col("k")
    counts = spread.groupBy("threshold").agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(above, 0).otherwise(F.col("pos"))).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumn("f1", _ratio(tp * 2, tp * 2 + fp + fn))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Lowest threshold of the highest F1, or the default when no threshold finds a positive."""
    best = sweep.agg(F.max(F.struct("f1", (-F.col("threshold")).alias("t"))).alias("b"))
    found = F.col("b.f1") > 0.0
    return best.select(
        F.when(found, -F.col("b.t")).otherwise(dbl(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce(F.col("b.f1"), dbl(0.0)).alias("f1"),
    )


def prediction_bias(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.withColumn("bias", F.col(predicted) - F.col(truth))


def evaluation_report(test: DataFrame, whole: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(Metric, Value) rows of the holdout, with the label threshold of the whole frame."""
    c = classification_metrics(test).select(F.struct("accuracy", "precision", "recall", "f1")).scalar()
    reg = regression_metrics(test, truth, predicted)
    threshold = exact_quantiles(whole, {"m": (predicted, 0.5)})["m"]
    values = {
        "Accuracy": c.getField("accuracy"),
        "Precision": c.getField("precision"),
        "Recall": c.getField("recall"),
        "F1 Score": c.getField("f1"),
        "MAE": F.col("mae"),
        "RMSE": F.col("rmse"),
        "R2 Score": F.col("r2"),
        "Threshold": threshold,
    }
    wide = reg.select(*[v.alias(f"m{i}") for i, v in enumerate(values.values())])
    rows = [F.struct(F.lit(n).alias("Metric"), F.col(f"m{i}").alias("Value")) for i, n in enumerate(values)]
    return wide.select(F.inline(F.array(*rows)))
