"""Survey analytics: answers to points, metrics of the form, the terminal survey and both together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl, round_up
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.setops import drop_all_null, union_frames
from riskloom.sources.store import materialise

MEASURES = list(K.SURVEY_WEIGHTS)


def answer_points(answer: Column, points: dict[str, float], default: float | None = None) -> Column:
    """Points of an answer; an answer outside the map gets the default, or NULL."""
    out = F.lit(None if default is None else float(default)).cast("double")
    for text, value in points.items():
        out = F.when(answer == text, dbl(value)).otherwise(out)
    return out


def rating_points(rating: Column) -> Column:
    """Rating text 1..5 on the 10-point scale; text that is no number is NULL."""
    return F.trim(rating.cast("string")).try_cast("double") * dbl(2.0)


def agreement_points(answer: Column, model_band: Column) -> Column:
    return F.when(answer == model_band, 10.0).otherwise(5.0)


def form_metrics(df: DataFrame) -> DataFrame:
    """Four form metrics and their mean, in one pass.

    Understanding uses every answer; the others only rows whose rating is a number.
    """
    rated = rating_points(F.col("rating")).isNotNull()
    medium = F.when(F.upper("prediction") == "MEDIUM", 10.0).otherwise(0.0)
    out = df.agg(
        F.avg(answer_points(F.col("understood"), K.ANSWERS_UNDERSTOOD_FORM)).alias("understanding"),
        F.avg(rating_points(F.col("rating"))).alias("explanation"),
        F.avg(F.when(rated, medium)).alias("trust"),
        F.avg(F.when(rated, answer_points(F.col("decision"), K.ANSWERS_DECISION_FORM))).alias("decision"),
    )
    names = ["understanding", "explanation", "trust", "decision"]
    return out.withColumn("overall", sum((F.col(n) for n in names), dbl(0.0)) / dbl(4.0))


def form_scores(df: DataFrame) -> DataFrame:
    """Form answers as points, with the decision map of the combined analysis."""
    scored = df.select(
        answer_points(F.col("understood"), K.ANSWERS_UNDERSTOOD_FORM).alias("understanding_score"),
        rating_points(F.col("rating")).alias("usability_score"),
        rating_points(F.col("trust")).alias("trust_score"),
        answer_points(F.col("decision"), K.ANSWERS_DECISION_COMBINED).alias("decision_score"),
        "prediction",
    )
    return drop_all_null(scored)


def terminal_scores(df: DataFrame) -> DataFrame:
    """Terminal answers in the stored result form."""
    return df.select(
        "understood",
        answer_points(F.col("understood"), K.ANSWERS_UNDERSTOOD_TERMINAL, K.ANSWER_TERMINAL_DEFAULT).alias(
            "understanding_score"
        ),
        rating_points(F.col("rating")).alias("usability_score"),
        (F.col("trust") * dbl(2.0)).alias("trust_score"),
        "decision",
        answer_points(F.col("decision"), K.ANSWERS_DECISION_TERMINAL, K.ANSWER_TERMINAL_DEFAULT).alias("decision_score"),
        "prediction",
        agreement_points(F.col("prediction"), F.col("model_band")).alias("prediction_score"),
    )


def _weighted(columns: dict[str, Column]) -> Column:
    out = dbl(0.0)
    for c, weight in K.SURVEY_WEIGHTS.items():
        out = out + dbl(weight) * F.coalesce(columns[c], dbl(0.0))
    return out


def combined_metrics(form: DataFrame, terminal: DataFrame) -> DataFrame:
    """Both surveys together: medians for missing points, five means, weighted final score.

    The answers are read once: equal answer rows are counted first, and medians and
    means are taken from the counts.
    """
    both = drop_all_null(union_frames(form, terminal))
    points = both.select(
        *[(F.col(c) if c in both.columns else F.lit(None)).cast("double").alias(c) for c in MEASURES]
    )
    counted = materialise(points.groupBy(*MEASURES).agg(F.count(F.lit(1)).alias("n")), "answers")
    medians = exact_quantiles(counted, {c: (c, 0.5) for c in MEASURES}, weight="n")
    n = F.col("n")
    value = {c: F.coalesce(F.col(c), medians[c]) for c in MEASURES}
    means = counted.agg(
        *[F.try_divide(F.sum(v * n), F.sum(F.when(v.isNotNull(), n)).cast("double")).alias(c) for c, v in value.items()]
    )
    return means.withColumn("final_score", _weighted({c: F.col(c) for c in MEASURES}))


def _clean_terminal(df: DataFrame, columns: list[str]) -> DataFrame:
    """Points as numbers, rows without understanding dropped, other gaps as 0."""
    numbers = df.select(
        *[(F.trim(F.col(c).cast("string")).try_cast("double") if c in df.columns else F.lit(None).cast("double")).alias(c) for c in columns]
    )
    return numbers.where(F.col("understanding_score").isNotNull()).fillna(0.0)


def terminal_metrics(df: DataFrame) -> DataFrame:
    """(Metric, Value) rows of the terminal survey, final score last."""
    means = _clean_terminal(df, MEASURES).agg(*[F.avg(c).alias(c) for c in MEASURES])
    final = means.withColumn("final", _weighted({c: F.col(c) for c in MEASURES}))
    rows = [F.struct(F.lit(name).alias("Metric"), F.col(c).alias("Value")) for c, name in K.SURVEY_METRIC_NAMES.items()]
    return final.select(F.inline(F.array(*rows)))


def terminal_summary(df: DataFrame) -> DataFrame:
    columns = ["understanding_score", "usability_score", "trust_score", "decision_score"]
    return _clean_terminal(df, columns).agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("users"))


def understood_share(df: DataFrame) -> DataFrame:
    """Percent of each answer among the given answers, two digits; the window sees one row per answer only."""
    counts = df.where(F.col("understood").isNotNull()).groupBy("understood").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("understood", round_up(F.col("n") / total.cast("double") * dbl(100.0), 2).alias("percent"))


def prediction_agreement(df: DataFrame) -> DataFrame:
    """Mean agreement points and percent of MEDIUM answers."""
    return df.agg(
        F.avg(agreement_points(F.col("prediction"), F.col("model_band"))).alias("agreement"),
        (F.avg(F.when(F.col("prediction") == "MEDIUM", 1.0).otherwise(0.0)) * 100.0).alias("medium_percent"),
    )


def adaptive_metrics(df: DataFrame) -> DataFrame:
    """Whichever of understanding, trust and usability the columns of the frame allow."""
    out: list[Column] = []
    for c in ("score", "understanding_score"):
        if c in df.columns:
            out.append(F.avg(F.col(c)).alias("understanding"))
            break
    if "prediction_score" in df.columns:
        out.append(F.avg("prediction_score").alias("trust"))
    elif "prediction" in df.columns:
        out.append((F.avg(F.when(F.col("prediction") == "MEDIUM", 1.0).otherwise(0.0)) * 10.0).alias("trust"))
    if "usability_score" in df.columns:
        out.append(F.avg("usability_score").alias("usability"))
    if not out:
        raise ValueError("no survey column found")
    return df.agg(*out)
