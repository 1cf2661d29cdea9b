"""Models trained with Spark ML: boosted trees, forest, logistic calibration, and the validation run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl, inf_to_null, null_to_zero
from riskloom.functions.trees import Ensemble, from_rows
from riskloom.operators import evaluation as E
from riskloom.operators.features import validate_features
from riskloom.operators.scoring import true_risk_score
from riskloom.sources.store import materialise, materialise_counted, scratch_path


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    filled = df.select("*", *[null_to_zero(F.col(c)).alias(f"_x_{c}") for c in columns])
    out = VectorAssembler(inputCols=[f"_x_{c}" for c in columns], outputCol="_features").transform(filled)
    return out.drop(*[f"_x_{c}" for c in columns])


def model_predict(train: DataFrame, rows: DataFrame, target: str, iterations: int = 20, depth: int = 3, seed: int = 42) -> DataFrame:
    """Boosted trees over the three features, trained on one frame, applied to another."""
    learner = GBTRegressor(
        featuresCol="_features", labelCol=target, predictionCol="ml_score", maxIter=iterations, maxDepth=depth, seed=seed
    )
    model = learner.fit(assemble(train.where(F.col(target).isNotNull()), K.FEATURES))
    return model.transform(assemble(rows, K.FEATURES)).drop("_features")


def fit_pipeline(train: DataFrame, target: str, learner: GBTRegressor | RandomForestRegressor | None = None, features: Sequence[str] = K.FEATURES) -> PipelineModel:
    """Missing and infinite features as 0, the scaler and the trees fitted on one frame, as one pipeline that can be stored.

    Rows without a target teach nothing. ``learner`` names no columns; by default it is boosted trees.
    """
    known = train.where(F.col(target).isNotNull()).select(target, *features)
    filled = ", ".join(f"CASE WHEN abs({c}) < CAST('Infinity' AS DOUBLE) THEN CAST({c} AS DOUBLE) ELSE 0D END AS _x_{c}" for c in features)
    fill = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    gather = VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True)
    learner = learner or GBTRegressor(maxIter=20, maxDepth=3, seed=42)
    trees = learner.copy().setFeaturesCol("_features").setLabelCol(target).setPredictionCol("ml_score")
    ready = gather.transform(fill.transform(known))
    scaling = scaler.fit(ready)
    return PipelineModel([fill, gather, scaling, trees.fit(scaling.transform(ready))])


def ensemble_of(model: GBTRegressionModel | RandomForestRegressionModel, spark: SparkSession) -> Ensemble:
    """The trees of a fitted Spark ML regression forest or boosted model, from its stored form."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold"
    )
    share = 1.0 if isinstance(model, GBTRegressionModel) else 1.0 / len(model.treeWeights)
    # A model has at most two to the power of its depth leaves a tree.
    return from_rows(model.numFeatures, [tuple(r) for r in nodes.collect()], [w * share for w in model.treeWeights])


def compiled(model: PipelineModel, features: Sequence[str] = K.FEATURES) -> Callable[[DataFrame], Column]:
    """A pipeline of ``fit_pipeline`` as a function from a frame with the features to its score: columns only, no vectors."""
    scaling = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    ensemble = ensemble_of(model.stages[-1], SparkSession.active())
    mean, std = scaling.mean.toArray().tolist(), scaling.std.toArray().tolist()

    def score(_: DataFrame) -> Column:
        # Spark multiplies by the reciprocal; dividing instead could move a value across a threshold.
        scaled = [(null_to_zero(inf_to_null(F.col(c))) - dbl(m)) * dbl(1.0 / s if s else 0.0) for c, m, s in zip(features, mean, std)]
        return ensemble.column(scaled)

    return score


def forest_regression(train: DataFrame, rows: DataFrame, target: str, trees: int = 100, depth: int = 5, seed: int = 42) -> DataFrame:
    learner = RandomForestRegressor(
        featuresCol="_features", labelCol=target, predictionCol="regression_score", numTrees=trees, maxDepth=depth, seed=seed
    )
    model = learner.fit(assemble(train, K.FEATURES))
    return model.transform(assemble(rows, K.FEATURES)).drop("_features")


def platt_calibration(df: DataFrame, score: str, label: str, rows: int, iterations: int = 1000) -> DataFrame:
    """Probability of the label given the score: logistic regression with unit L2 penalty over the whole sum of ``rows`` rows."""
    learner = LogisticRegression(
        featuresCol="_features", labelCol=label, maxIter=iterations, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False,
    )
    ready = assemble(df, [score])
    model = learner.fit(ready)
    margin = null_to_zero(F.col(score)) * dbl(float(model.coefficients[0])) + dbl(float(model.intercept))
    # As a column: a fitted model holds its session, which tasks cannot take once it has observed anything.
    return df.withColumn("calibrated_score", dbl(1.0) - dbl(1.0) / (dbl(1.0) + F.exp(margin)))


def validation_report(df: DataFrame, trees: int = 100) -> DataFrame:
    """The whole validation run on a stored frame of features and predicted score: (Metric, Value) rows."""
    target, rows = materialise_counted(true_risk_score(validate_features(df)), "validation")
    split = E.with_split(target)
    forest = forest_regression(split.where(~F.col("is_test")), split, "true_risk_score", trees)
    calibrated = materialise(platt_calibration(forest, "predicted_risk_score", "true_risk_label", rows), "calibrated")
    sweep = E.threshold_sweep(calibrated, "true_risk_label", "calibrated_score")
    edge = E.best_threshold(sweep).select("threshold").scalar()
    labelled = calibrated.withColumns(
        {
            "pred_label": F.when(F.col("calibrated_score") > edge, 1).otherwise(0),
            "true_label": F.col("true_risk_label"),
        }
    )
    test = labelled.where("is_test")
    c = E.classification_metrics(test).select(F.struct("accuracy", "precision", "recall", "f1")).scalar()
    reg = E.regression_metrics(test, "true_risk_score", "regression_score")
    values = {
        "MAE": F.col("mae"),
        "RMSE": F.col("rmse"),
        "R2 Score": F.col("r2"),
        "Accuracy": c.getField("accuracy"),
        "Precision": c.getField("precision"),
        "Recall": c.getField("recall"),
        "F1 Score": c.getField("f1"),
        "Threshold": edge,
    }
    wide = reg.select(*[v.alias(f"m{i}") for i, v in enumerate(values.values())])
    rows = [F.struct(F.lit(n).alias("Metric"), F.col(f"m{i}").alias("Value")) for i, n in enumerate(values)]
    return wide.select(F.inline(F.array(*rows)))
