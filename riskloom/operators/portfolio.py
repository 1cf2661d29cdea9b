"""Portfolio reports: grouped counts, averages, shares, histograms and constraint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.bands import risk_category, risk_zone, spending_segment
from riskloom.operators.scalars import constants
from riskloom.operators.scoring import behaviour_score

PAYMENT, INCOME, RESILIENCE = K.FEATURES


def total_customers(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_customers"))


def risk_distribution(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(risk_category(F.col("risk_score")).alias("risk_category"))
    return grouped.agg(F.count(F.lit(1)).alias("customer_count")).orderBy(F.desc("customer_count"), "risk_category")


def income_by_risk(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(risk_category(F.col("risk_score")).alias("risk_category"))
    return grouped.agg(F.avg("monthly_income").alias("average_income")).orderBy(F.desc_nulls_first("average_income"))


def payment_behaviour(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("bill_payment_delay_avg").alias("average_payment_delay"),
        F.avg("missed_payments_6m").alias("average_missed_payments"),
    )


def spending_segments(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(spending_segment(F.col("spending_ratio")).alias("spending_segment"))
    return grouped.agg(F.count(F.lit(1)).alias("customer_count")).orderBy(F.desc("customer_count"), "spending_segment")


def feature_averages(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg(PAYMENT).alias("avg_payment_discipline"),
        F.avg(INCOME).alias("avg_income_stability"),
        F.avg(RESILIENCE).alias("avg_financial_resilience"),
    )


def risk_by_missed(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("missed_payments_6m")
        .agg(F.avg("risk_score").alias("average_risk_score"))
        .orderBy(F.asc_nulls_last("missed_payments_6m"))
    )


def model_validation(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("risk_score").alias("original_avg_risk_score"), F.avg(behaviour_score()).alias("predicted_avg_risk_score")
    )


def reconstruction_error(df: DataFrame) -> DataFrame:
    both = df.agg(F.avg("risk_score").alias("original_avg"), F.avg(behaviour_score()).alias("predicted_avg"))
    return both.withColumn("difference", F.abs(F.col("original_avg") - F.col("predicted_avg")))


def portfolio_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_band").agg(F.count(F.lit(1)).alias("customer_count"), F.avg("risk_score").alias("avg_risk_score"))


def zone_shares(df: DataFrame) -> DataFrame:
    """Share of customers per zone in percent, and the mean behaviour score."""
    scored = df.select(behaviour_score().alias("score")).withColumn("zone", risk_zone(F.col("score")))

    def share(zone: str) -> Column:
        return F.avg(F.when(F.col("zone") == zone, 1.0).otherwise(0.0)) * 100.0

    return scored.agg(
        share("High").alias("high_pct"),
        share("Medium").alias("medium_pct"),
        share("Low").alias("low_pct"),
        F.avg("score").alias("mean_score"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    bounds = constants(values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    lo, hi = bounds["lo"], bounds["hi"]
    place = F.floor(F.try_divide(F.col("v") - lo, hi - lo) * float(bins)).cast("int")
    return (
        values.groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def high_risk(df: DataFrame) -> DataFrame:
    """Customers of the high band, highest score first."""
    return df.where(F.col("risk_band") == "High").orderBy(F.desc_nulls_first("risk_score"), "customer_id")


def band_share(df: DataFrame) -> DataFrame:
    """Percent of customers per band; the window sees one row per band only."""
    counts = df.groupBy("risk_band").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("risk_band", (F.col("n") * 100.0 / total).alias("percentage"))


def top_rows(df: DataFrame, column: str, columns: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows by a column, highest first: every task keeps its own ``n`` rows, then they are merged."""
    return df.select(*columns).orderBy(F.desc_nulls_first(column), "customer_id").limit(n)


def constraint_violations(df: DataFrame, key: str, not_null: list[str], ranges: dict[str, tuple[float, float]], enums: dict[str, list[str]]) -> DataFrame:
    """One row per declared constraint with the number of rows that break it."""
    checks: dict[str, Column] = {}
    for c in not_null:
        checks[f"not_null:{c}"] = F.count_if(F.col(c).isNull())
    for c, (lo, hi) in ranges.items():
        checks[f"range:{c}"] = F.count_if(~F.col(c).between(lo, hi))
    for c, allowed in enums.items():
        checks[f"enum:{c}"] = F.count_if(~F.col(c).isin(allowed))
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(checks)])
    counted = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks.values())]).select(F.inline(rows))
    # Keys are counted per key first, so a key repeated in a third of the rows stays one row per task.
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    unique = repeated.agg(
        F.lit(f"unique:{key}").alias("rule"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")
    )
    return counted.unionByName(unique)


def schema_listing(df: DataFrame, required: list[str]) -> DataFrame:
    """Name, type, required mark and number of missing values of every column."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.lit(name in required).alias("required"),
            F.col(f"n{i}").alias("missing_values"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]).select(
        F.inline(F.array(*rows))
    )
