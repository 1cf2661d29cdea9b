"""Scores, blended responses and prediction tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.bands import band_api, band_cut
from riskloom.functions.linear import BoundedLine
from riskloom.functions.numeric import (
    clamp01, dbl, inf_to_null, null_to_zero, percent_to_unit, present, round_even, round_up,
)
from riskloom.operators.explain import explanation_summary, feature_explanations
from riskloom.operators.quantiles import (
    Positions, column_positions, exact_quantiles, interpolated, places, values_at, with_percent_rank,
)
from riskloom.operators.rules import rule_hits, rule_score
from riskloom.operators.scalars import constants
from riskloom.sources.store import materialise

PAYMENT, INCOME, RESILIENCE = K.FEATURES



def behaviour_score(unit: bool = False) -> Column:
    """Weighted feature score, 0..100 or (``unit``) 0..1; higher is better."""
    w = K.BEHAVIOUR_WEIGHTS
    if unit:
        return (
            F.col(PAYMENT) / dbl(100.0) * dbl(w[PAYMENT])
            + F.col(INCOME) / dbl(100.0) * dbl(w[INCOME])
            + F.col(RESILIENCE) / dbl(100.0) * dbl(w[RESILIENCE])
        )
    return dbl(w[PAYMENT]) * F.col(PAYMENT) + dbl(w[INCOME]) * F.col(INCOME) + dbl(w[RESILIENCE]) * F.col(RESILIENCE)


def target_score(payment: Column, income: Column, resilience: Column) -> Column:
    """Linear risk target of three 0..1 features; higher is worse."""
    w = K.TARGET_WEIGHTS
    return clamp01(
        dbl(w[INCOME]) * (dbl(1.0) - income)
        + dbl(w[PAYMENT]) * (dbl(1.0) - payment)
        + dbl(w[RESILIENCE]) * (dbl(1.0) - resilience)
    )


def _linear_target(df: DataFrame) -> Column:
    unit = {c: null_to_zero(inf_to_null(F.col(c))) / dbl(100.0) for c in K.FEATURES}
    return target_score(unit[PAYMENT], unit[INCOME], unit[RESILIENCE])


#: Stand-in model: the linear target of the features, missing ones as 0.
linear_model = BoundedLine(_linear_target, sum(K.TARGET_WEIGHTS.values()), {c: -K.TARGET_WEIGHTS[c] / 100.0 for c in K.FEATURES})


def true_risk_score(df: DataFrame) -> DataFrame:
    """Adds ``true_risk_score`` and ``true_risk_label`` (above the 70th percentile); zeros count as missing.

    ``df`` is read more than once; pass a stored frame when it is costly to make.
    """
    present = df.withColumns({c: F.nullif(F.col(c), dbl(0.0)) for c in K.FEATURES})
    medians = exact_quantiles(present, {c: (c, 0.5) for c in K.FEATURES})
    unit = {c: F.coalesce(F.col(c), medians[c]) / dbl(100.0) for c in K.FEATURES}
    scored = present.withColumns({c: F.coalesce(F.col(c), medians[c]) for c in K.FEATURES}).withColumn(
        "true_risk_score", target_score(F.col(PAYMENT) / 100.0, F.col(INCOME) / 100.0, F.col(RESILIENCE) / 100.0)
    )
    edge = exact_quantiles(scored, {"edge": ("true_risk_score", 0.7)})["edge"]
    return scored.withColumn("true_risk_label", F.when(F.col("true_risk_score") > edge, 1).otherwise(0))


def robust_scale(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Score stretched between its 5th and 95th percentile and clipped to 0..1."""
    q = exact_quantiles(df, {"p5": (raw, 0.05), "p95": (raw, 0.95)})
    return df.withColumn(out, clamp01((F.col(raw) - q["p5"]) / (q["p95"] - q["p5"] + dbl(1e-6))))


def fixed_scale(raw: Column) -> Column:
    return clamp01(raw / dbl(25.0))


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column is only centred."""
    aggregates = [F.avg(c).alias(f"{c}_m") for c in columns]
    aggregates += [F.coalesce(F.nullif(F.stddev_pop(c), dbl(0.0)), dbl(1.0)).alias(f"{c}_s") for c in columns]
    stats = constants(df.agg(*aggregates))
    return df.withColumns({f"{c}_scaled": (F.col(c) - stats[f"{c}_m"]) / stats[f"{c}_s"] for c in columns})


def blend(ml: Column, rule: Column) -> Column:
    """70 % model, 30 % rules; rules alone without a model score."""
    rule = clamp01(rule)
    return F.when(ml.isNull(), rule).otherwise(clamp01(dbl(0.7) * clamp01(ml) + dbl(0.3) * rule))


def risk_response(
    df: DataFrame, rules_on: str = "raw", keep: tuple[str, ...] = (), model: tuple[str | None, str | None] = (None, None)
) -> DataFrame:
    """Full scoring response for a whole table in one projection.

    ``df`` has customer_id, the raw attributes, the three features (0..100) and
    ``original_score`` (0..1, NULL when unknown). A customer without resilience gets
    the missing-data answer: no model, no rules, band UNKNOWN. ``rules_on`` chooses
    whether rules see the raw attributes or, as a feature-only caller would, none.
    ``keep`` names input columns carried through; ``model`` is the version and hash of the model that scored.
    """
    rules = rule_score() if rules_on == "raw" else _rules_without_attributes()
    step = df.withColumns(
        {
            "payment": null_to_zero(F.col(PAYMENT)),
            "income": null_to_zero(F.col(INCOME)),
            "resilience": present(F.col(RESILIENCE)),
            "rules": rules,
        }
    )
    missing, rules = F.col("resilience").isNull(), F.col("rules")
    step = step.withColumns(
        {
            "p_unit": percent_to_unit(F.col("payment")),
            "i_unit": percent_to_unit(F.col("income")),
            "r_unit": percent_to_unit(F.col("resilience")),
            "rule_score": F.when(missing, dbl(0.0)).otherwise(
                clamp01(F.when(rules > 1.0, rules / dbl(100.0)).otherwise(rules))
            ),
        }
    )
    step = step.withColumn(
        "ml_score",
        F.when(missing, dbl(0.0)).otherwise(target_score(F.col("p_unit"), F.col("i_unit"), F.col("r_unit"))),
    )
    ml, rule = F.col("ml_score"), F.col("rule_score")
    base_value = step.agg(F.avg(F.when(~missing, ml))).scalar()
    step = step.withColumns(
        {
            "final_score": clamp01(dbl(0.7) * ml + dbl(0.3) * rule),
            "original": F.coalesce(F.col("original_score"), rule),
            "base_value": F.when(missing, ml * dbl(0.8)).otherwise(clamp01(base_value)),
        }
    )
    step = step.withColumns(
        {
            "band": band_api(F.col("final_score")),
            "original_band": band_api(F.col("original")).getField("band"),
            "explanations": feature_explanations(),
        }
    )
    final, band = F.col("final_score"), F.col("band")
    warnings = F.array_compact(
        F.array(
            F.when(missing, K.WARN_MISSING),
            F.when(missing, K.WARN_RESILIENCE_NULL),
            F.when((F.col("resilience") == 0.0) & (final < 0.3), K.WARN_RESILIENCE_ZERO),
        )
    )
    no_rules = F.array().cast("array<struct<rule:string,impact:double>>")
    return step.select(
        "customer_id",
        "ml_score",
        "rule_score",
        "final_score",
        "base_value",
        F.when(~missing, final).alias("predicted_risk_score"),
        F.col("original").alias("original_risk_score"),
        F.when(missing, K.BAND_MISSING[0]).otherwise(band.getField("band")).alias("risk_band"),
        band.getField("color").alias("risk_color"),
        F.when(missing, K.BAND_MISSING[1]).otherwise(band.getField("label")).alias("risk_label"),
        F.struct(
            round_up(F.col("p_unit"), 3).alias(PAYMENT),
            round_up(F.col("i_unit"), 3).alias(INCOME),
            round_up(F.col("r_unit"), 3).alias(RESILIENCE),
        ).alias("components"),
        F.struct(
            F.col("original_band"),
            band.getField("band").alias("predicted_band"),
            (F.col("original_band") == band.getField("band")).alias("agreement"),
        ).alias("label_comparison"),
        "explanations",
        explanation_summary(F.col("explanations")).alias("explanation"),
        F.when(missing, no_rules).otherwise(rule_hits()).alias("rule_explanations"),
        F.when(missing, dbl(0.0)).otherwise(clamp01(dbl(1.0) - F.abs(ml - rule))).alias("model_confidence"),
        F.col("payment").alias(PAYMENT),
        F.col("income").alias(INCOME),
        F.coalesce("resilience", dbl(0.0)).alias(RESILIENCE),
        F.struct(*[F.lit(m).cast("string").alias(n) for m, n in zip(model, ("version", "hash"))]).alias("model_info"),
        warnings.alias("warnings"),
        *keep,
    )


def _rules_without_attributes() -> Column:
    """Rule score of a caller that has features only: every attribute defaults to 0, so low savings fires."""
    return dbl(sum(i for _, op, b, _, i in K.RULES if (op == "<" and 0.0 < b) or (op == ">" and 0.0 > b)))


def simple_response(response: DataFrame) -> DataFrame:
    """Short form of the response."""
    return response.select(
        "customer_id",
        F.col("final_score").alias("risk_score"),
        "risk_band",
        "risk_label",
        F.col("model_confidence").alias("confidence"),
        F.when((F.col(RESILIENCE) == 0.0) & (F.col("final_score") < 0.3), K.WARN_SIMPLE).alias("warning"),
    )


def batch_score(ids: DataFrame, response: DataFrame) -> DataFrame:
    """Response for requested ids; an id without features gets an error."""
    picked = response.select(
        "customer_id",
        F.col("predicted_risk_score").alias("risk_score"),
        F.col("risk_band").alias("risk_segment"),
        "risk_label",
        "risk_color",
        F.lit(True).alias("_found"),
    )
    return (
        ids.join(picked, "customer_id", "left")
        .withColumn("error", F.when(F.col("_found").isNull(), "Customer not found"))
        .drop("_found")
    )


def score_v2(df: DataFrame, raw: str) -> DataFrame:
    """Second scoring form: four digits, clamp, band, three digits."""
    step = df.withColumn("_score", clamp01(round_up(F.col(raw), 4)))
    step = step.withColumn("_band", band_api(F.col("_score")))
    return step.select(
        "customer_id",
        round_up(F.col("_score"), 3).alias("v2_score"),
        F.col("_band.band").alias("risk_band"),
        F.col("_band.color").alias("risk_color"),
        F.col("_band.label").alias("risk_label"),
    )


def feature_hash(*columns: str) -> Column:
    """SHA-256 of the features as JSON text, keys sorted, six digits; equal features give equal hashes."""
    parts: list[Column] = []
    for i, c in enumerate(sorted(columns)):
        number = F.coalesce(F.col(c).cast("decimal(18,6)").cast("string"), F.lit("null"))
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{c}": '), number]
    return F.sha2(F.concat(*parts, F.lit("}")), 256)


def latest_prediction(history: DataFrame) -> DataFrame:
    """Newest stored row per customer: a two-step aggregate, so a hot customer is reduced before the shuffle."""
    rest = [c for c in history.columns if c not in ("customer_id", "prediction_time", "prediction_id")]
    newest = F.max(F.struct("prediction_time", "prediction_id", *rest)).alias("row")
    return history.groupBy("customer_id").agg(newest).select("customer_id", "row.*")


def cached_or_fresh(current: DataFrame, history: DataFrame, model: str, feature: str, dataset: str) -> DataFrame:
    """Stored score when model, feature and dataset versions and feature hash all match, else the fresh one.

    ``current``: customer_id, feature_hash, fresh_score. ``history`` also carries
    feature_version and feature_hash.
    """
    last = latest_prediction(history).select(
        "customer_id",
        F.col("risk_score").alias("stored_score"),
        F.col("feature_hash").alias("stored_hash"),
        (
            F.col("model_version").eqNullSafe(F.lit(model))
            & F.col("feature_version").eqNullSafe(F.lit(feature))
            & F.col("dataset_version").eqNullSafe(F.lit(dataset))
        ).alias("same_version"),
    )
    hit = F.coalesce(F.col("same_version"), F.lit(False)) & F.col("feature_hash").eqNullSafe(F.col("stored_hash"))
    return current.join(last, "customer_id", "left").select(
        "customer_id",
        F.when(hit, clamp01(F.col("stored_score"))).otherwise(F.col("fresh_score")).alias("score"),
        hit.alias("from_cache"),
    )


def scored_rows(df: DataFrame, run_ts: Column, model: str, feature: str, dataset: str) -> DataFrame:
    """History rows of a scored table; customers without resilience get an answer but no row."""
    # The filter sits on the stored feature, not on the computed score, so it can reach the scan.
    complete = df.where(present(F.col(RESILIENCE)).isNotNull()).withColumn("feature_hash", feature_hash(*K.FEATURES))
    response = risk_response(complete, keep=("feature_hash",))
    return response.select(
        "customer_id",
        F.col("ml_score").alias("risk_score"),
        F.col("label_comparison.original_band").alias("original_band"),
        band_api(F.col("ml_score")).getField("band").alias("predicted_band"),
        F.lit(model).alias("model_version"),
        F.lit(feature).alias("feature_version"),
        F.lit(dataset).alias("dataset_version"),
        "feature_hash",
        run_ts.alias("prediction_time"),
        F.lit(K.STAMP_API).alias("created_by"),
    )


def quantile_bin(value: Column, edges: list[Column]) -> Column:
    """0-based bin of a value between edges, right closed, lowest value included; equal edges collapse."""
    count = F.lit(0)
    # An inner edge counts when the value is above it and it differs from the edge before.
    for before, edge in zip(edges, edges[1:-1]):
        count = count + F.when((value > edge) & (edge > before), 1).otherwise(0)
    return F.when(value.isNotNull(), count)


def calibration_bin(df: DataFrame, column: str, bins: int, out: str) -> DataFrame:
    """Quantile bin of a column, see ``quantile_bin``."""
    q = exact_quantiles(df, {f"e{i}": (column, i / bins) for i in range(bins + 1)})
    return df.withColumn(out, quantile_bin(F.col(column), [q[f"e{i}"] for i in range(bins + 1)]))


def median_sides(df: DataFrame, medians: dict[str, Column], score: str) -> tuple[dict[str, Column], list[Column]]:
    """Per column whether a row is below its median, and the mean scores of both sides as aggregates."""
    low = {c: F.coalesce(F.col(c) < m, F.lit(False)) for c, m in medians.items()}
    means = [F.avg(F.when(low[c], F.col(score))).alias(f"{c}_low") for c in medians]
    return low, means + [F.avg(F.when(~low[c], F.col(score))).alias(f"{c}_high") for c in medians]


def median_split_bias(df: DataFrame, score: str, columns: list[str]) -> dict[str, Column]:
    """Score minus the mean score of its side of each column's median; a row without the value is on the high side.

    Each column has two groups, so all means are one row of conditional averages
    and no row of the table moves.
    """
    low, aggregates = median_sides(df, exact_quantiles(df, {c: (c, 0.5) for c in columns}), score)
    means = constants(df.agg(*aggregates))
    return {f"{c}_bias": F.col(score) - F.when(low[c], means[f"{c}_low"]).otherwise(means[f"{c}_high"]) for c in columns}


def intersectional_bias(df: DataFrame, score: str, columns: list[str], out: str = "intersectional_bias") -> DataFrame:
    """Score minus the mean of the rows that agree in all columns to one digit.

    Two 0..100 scores to one digit, missing included, make at most 1,002 ** 2 groups whatever the data. Each group is one
    row per task before the shuffle; the join is left to Spark, which broadcasts a small table of means and
    splits a hot group otherwise.
    """
    keys = {f"_k{i}": round_even(F.col(c), 1) for i, c in enumerate(columns)}
    keyed = df.withColumns(keys)
    means = keyed.groupBy(*keys).agg(F.avg(score).alias("_mean")).withColumnsRenamed({k: f"{k}_m" for k in keys})
    means = materialise(means, "group-means")  # written, so that its size is known and the join has two plain sides
    match = [F.col(k).eqNullSafe(F.col(f"{k}_m")) for k in keys]
    return keyed.join(means, match, "left").select(*df.columns, (F.col(score) - F.col("_mean")).alias(out))


def prediction_table(
    features: DataFrame,
    model_hash: str,
    model_version: str,
    model: Callable[[DataFrame], Column] = linear_model,
    attributions: DataFrame | None = None,
    bins: int = 5,
) -> DataFrame:
    """The complete prediction output: score, band, bias columns, confidence, bins, rank, lineage of the given model.

    ``features`` has customer_id and the three features. The raw score is written once with them, and so are the
    positions of its values and of the features'. The scaled score grows with the raw one, so these positions give its
    limits, the medians, the bin edges and the ranks; all means are one more row.
    """
    raw = materialise(features.withColumn("raw_score", model(features)), "raw")
    positions = column_positions(raw, ["raw_score", *K.FEATURES])
    total = positions.totals["raw_score"]
    spots = {("raw_score", p): places(total, p) for p in [0.05, 0.95, *[i / bins for i in range(bins + 1)]]}
    spots |= {(c, 0.5): places(positions.totals[c], 0.5) for c in K.FEATURES}
    at = values_at(positions, {(c, k) for (c, _), (lo, hi, _) in spots.items() for k in (lo, hi)})

    def quantile(column: str, p: float) -> float | None:
        lo, hi, place = spots[column, p]
        return interpolated(at[column, lo], at[column, hi], place)

    p5, p95 = quantile("raw_score", 0.05), quantile("raw_score", 0.95)
    low, high = (F.lit(x).cast("double") for x in (p5, p95))
    scale = lambda x: clamp01((x - low) / (high - low + dbl(1e-6)))

    def scaled_number(x: float | None) -> float | None:
        return None if x is None else min(1.0, max(0.0, (x - p5) / (p95 - p5 + 1e-6)))

    edges = []
    for i in range(bins + 1):
        lo, hi, place = spots["raw_score", i / bins]
        edges.append(F.lit(interpolated(scaled_number(at["raw_score", lo]), scaled_number(at["raw_score", hi]), place)).cast("double"))
    # Values that the scale makes equal become one.
    clipped = positions.of("raw_score").groupBy(scale(F.col("value")).alias("value")).agg(F.sum("n").alias("n"), F.min("before").alias("before"))
    ranks = Positions(clipped.withColumn("name", F.lit("predicted_risk_score")), {"predicted_risk_score": total})

    score = F.col("predicted_risk_score")
    scaled = raw.withColumn("predicted_risk_score", scale(F.col("raw_score")))
    medians = {c: F.lit(quantile(c, 0.5)).cast("double") for c in K.FEATURES}
    below, sides = median_sides(scaled, medians, "predicted_risk_score")
    means = constants(scaled.agg(F.avg(score).alias("score"), F.avg("raw_score").alias("raw"), *sides))
    biases = {f"{c}_bias": score - F.when(below[c], means[f"{c}_low"]).otherwise(means[f"{c}_high"]) for c in K.FEATURES}
    out = with_percent_rank(scaled, "predicted_risk_score", "risk_percentile", ranks, ends=(0.0, 1.0))
    out = intersectional_bias(out, "predicted_risk_score", [INCOME, PAYMENT])
    out = out.withColumn("calibration_bin", quantile_bin(score, edges))
    if attributions is not None:
        out = out.join(attributions, "customer_id", "left")
    return out.select(
        "customer_id",
        INCOME,
        PAYMENT,
        RESILIENCE,
        score.alias("predicted_risk_score"),
        band_cut(score).alias("predicted_band"),
        (score - means["score"]).alias("bias_delta"),
        clamp01(dbl(1.0) - F.abs(score - means["score"])).alias("model_confidence"),
        *[bias.alias(name) for name, bias in biases.items()],
        "intersectional_bias",
        "calibration_bin",
        "risk_percentile",
        F.lit(model_hash).alias("model_hash"),
        F.lit(model_version).alias("model_version"),
        means["raw"].alias("base_value"),
        *(["lime_explanation"] if attributions is not None else []),
    )
