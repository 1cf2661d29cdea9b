"""Feature engineering: scores, imputation, scaling and generated customers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import clip, dbl, inf_to_null, normal, round_up, uniform, zero_to_null
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.scalars import constants


def payment_discipline(delay: Column | None = None, missed: Column | None = None) -> Column:
    delay = F.col("bill_payment_delay_avg") if delay is None else delay
    missed = F.col("missed_payments_6m") if missed is None else missed
    return clip(dbl(100.0) - delay * dbl(5.0) - missed * dbl(10.0), 0.0, 100.0)


def income_stability(variance: Column | None = None) -> Column:
    variance = F.col("income_variance") if variance is None else variance
    return clip((dbl(1.0) - variance) * dbl(100.0), 0.0, 100.0)


def financial_resilience() -> Column:
    """50 points of savings, 30 of unspent income, 20 of punctuality; between 5 and 100."""
    points = (
        F.col("savings_rate") * dbl(50.0)
        + (dbl(1.0) - F.col("spending_ratio")) * dbl(30.0)
        + (dbl(1.0) - F.least(F.col("missed_payments_6m").cast("double"), dbl(5.0)) / dbl(5.0)) * dbl(20.0)
    )
    return clip(points, 5.0, 100.0)


def synth_risk_score() -> Column:
    """Risk score 0..100; a customer without savings data counts as saving nothing."""
    return clip(
        F.col("missed_payments_6m") * dbl(12.0)
        + F.col("bill_payment_delay_avg") * dbl(1.5)
        + F.col("spending_ratio") * dbl(20.0)
        - F.coalesce(F.col("savings_rate"), dbl(0.0)) * dbl(30.0)
        - F.col("employment_duration_months") / dbl(12.0),
        0.0,
        100.0,
    )


def synth_resilience_points() -> Column:
    return (
        F.coalesce(F.col("savings_rate"), dbl(0.0)) * dbl(100.0)
        + F.col("employment_duration_months") / dbl(12.0) * dbl(5.0)
        + F.col("account_age_months") / dbl(24.0) * dbl(3.0)
        - F.col("missed_payments_6m") * dbl(8.0)
        - F.col("bill_payment_delay_avg") * dbl(2.0)
    )


def min_max_percent(df: DataFrame, column: str, out: str) -> DataFrame:
    """Column rescaled to 0..100 over the whole table, two digits."""
    bounds = constants(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    lo, hi = bounds["lo"], bounds["hi"]
    return df.withColumn(out, round_up((F.col(column) - lo) / (hi - lo + dbl(1e-9)) * dbl(100.0), 2))


def with_scores(df: DataFrame) -> DataFrame:
    """Raw attributes plus the three feature scores."""
    return df.withColumns(
        {
            "payment_discipline_score": payment_discipline(),
            "income_stability_index": income_stability(),
            "financial_resilience_score": financial_resilience(),
        }
    )


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values replaced by the exact median of their column.

    ``df`` is read more than once; pass a stored frame when it is costly to make.
    """
    medians = exact_quantiles(df, {c: (c, 0.5) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), medians[c]) for c in columns})


def zero_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def zero_as_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zeros become missing, then get the median of the non-zero values."""
    return median_impute(df.withColumns({c: zero_to_null(F.col(c)) for c in columns}), columns)


def bounds_clip(df: DataFrame, columns: list[str], low: float = 0.0, high: float = 100.0) -> DataFrame:
    return df.withColumns({c: clip(F.col(c).cast("double"), low, high) for c in columns})


def normalise_score_global(df: DataFrame, column: str) -> DataFrame:
    """0..100 clip, then division by 100 if the largest value of the whole column exceeds 1."""
    clipped = df.withColumn(column, clip(F.col(column), 0.0, 100.0))
    top = clipped.agg(F.max(column)).scalar()
    return clipped.withColumn(column, F.when(top > 1.0, F.col(column) / dbl(100.0)).otherwise(F.col(column)))


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns, or an error that lists the absent ones."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return df.select(*columns)


def validate_features(df: DataFrame) -> DataFrame:
    """Feature frame with a predicted score: kept, taken from the risk score, or 0."""
    if df.isEmpty():
        raise ValueError("dataset is empty")
    if "predicted_risk_score" not in df.columns:
        source = F.col("risk_score") if "risk_score" in df.columns else dbl(0.0)
        df = df.withColumn("predicted_risk_score", source.cast("double"))
    require_columns(df, K.FEATURES)
    return df


def describe_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, exact quartiles, max, values outside 0..100."""
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quartiles = exact_quantiles(df, {f"{c}_{m}": (c, p) for c in columns for m, p in marks.items()})
    aggs, parts = [], []
    for c in columns:
        v = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
                F.count_if((v < 0.0) | (v > 100.0)).alias("out_of_range"),
            ).alias(c)
        )
        parts.append(
            F.struct(
                F.lit(c).alias("feature"),
                *[F.col(c).getField(f).alias(f) for f in ("count", "mean", "std", "min", "max", "out_of_range")],
                *[quartiles[f"{c}_{m}"].alias(m) for m in marks],
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*parts)))


def zero_ratio(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(F.when(F.col(column) == 0.0, 1.0).otherwise(0.0)).alias("zero_ratio"))


def engineer(df: DataFrame) -> DataFrame:
    """The whole feature step: scores, infinities out, medians in, zeros elsewhere."""
    scored = with_scores(df)
    scored = scored.withColumns({c: inf_to_null(F.col(c)) for c in K.FEATURES})
    filled = median_impute(scored, K.FEATURES)
    filled = bounds_clip(filled, ["financial_resilience_score"])
    others = [c for c, t in filled.dtypes if c not in K.FEATURES and t in ("int", "bigint", "double", "float")]
    return zero_impute(filled, others)


def generate_customers(keys: DataFrame, key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Synthetic attributes for every key of a frame.

    Normal, uniform, exponential, Poisson and integer draws, each fixed by
    (key, draw, seed), so a rerun on any partitioning gives the same customers.
    """
    k = F.col(key)
    drawn = keys.select(
        k,
        clip(dbl(30000.0) + dbl(9000.0) * normal(k, 0, seed), 12000.0, 120000.0).alias("income"),
        (dbl(0.05) + dbl(0.35) * uniform(k, 2, seed)).alias("variance"),
        uniform(k, 3, seed).alias("u_delay"),
        uniform(k, 4, seed).alias("u_missed"),
        (dbl(0.3) + dbl(0.8) * uniform(k, 5, seed)).alias("spend"),
        normal(k, 3, seed).alias("z_save"),
        uniform(k, 8, seed).alias("u_employed"),
        uniform(k, 9, seed).alias("u_account"),
    )
    drawn = drawn.withColumn(
        "delay", clip(-(dbl(2.0) + F.col("variance") * dbl(5.0)) * F.log(F.col("u_delay")), 0.0, 30.0)
    )
    raw = drawn.select(
        k,
        round_up(F.col("income"), 2).alias("monthly_income"),
        round_up(F.col("variance"), 3).alias("income_variance"),
        round_up(F.col("delay"), 2).alias("bill_payment_delay_avg"),
        F.least(F.lit(6), F.floor(F.col("delay") / dbl(5.0) + poisson(F.col("u_missed"), 0.8)).cast("int")).alias(
            "missed_payments_6m"
        ),
        round_up(F.col("spend"), 2).alias("spending_ratio"),
        round_up(clip(dbl(1.0) - F.col("spend") + dbl(0.05) * F.col("z_save"), 0.0, 0.4), 2).alias("savings_rate"),
        (F.lit(3) + F.floor(F.col("u_employed") * dbl(297.0)).cast("int")).alias("employment_duration_months"),
        (F.lit(6) + F.floor(F.col("u_account") * dbl(234.0)).cast("int")).alias("account_age_months"),
    )
    return raw


def poisson(u: Column, rate: float, terms: int = 12) -> Column:
    """Poisson draw from a uniform one: how many cumulative probabilities lie at or below it."""
    edges, total = [], 0.0
    for k in range(terms):
        total += math.exp(-rate) * rate**k / math.factorial(k)
        edges.append(total)
    count = F.lit(0)
    for e in edges:
        count = count + F.when(u >= dbl(e), 1).otherwise(0)
    return count
