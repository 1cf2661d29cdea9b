"""Change records between two feature snapshots, model registry updates and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.bands import band_trigger
from riskloom.functions.numeric import dbl, round_up
from riskloom.operators.joins import with_active_model
from riskloom.operators.load import upsert_do_update
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.scoring import behaviour_score


def audit_insert(rows: DataFrame) -> DataFrame:
    """History row for every inserted or updated feature row, with fixed versions."""
    return rows.select(
        "customer_id",
        "risk_score",
        "risk_band",
        F.lit(K.TRIGGER_MODEL).alias("model_version"),
        F.lit(K.STAMP_TRIGGER).alias("created_by"),
        F.lit(K.TRIGGER_DATASET).alias("dataset_version"),
    )


def changes(old: DataFrame, new: DataFrame, compared: list[str]) -> DataFrame:
    """New rows that are inserts or differ, null-safe, in a compared column; with the kind of change."""
    before = old.select(F.col("customer_id").alias("_id"), *[F.col(c).alias(f"old_{c}") for c in compared])
    joined = new.join(before, F.col("customer_id") == F.col("_id"), "left")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    kind = F.when(F.col("_id").isNull(), "INSERT").when(~same, "UPDATE")
    return joined.withColumn("change", kind).where(F.col("change").isNotNull()).select(*new.columns, "change")


def deletes(old: DataFrame, new: DataFrame, registry: DataFrame, run_ts: Column) -> DataFrame:
    """Old rows that are gone, stamped with the active model and the time of deletion."""
    gone = old.join(new.select("customer_id"), "customer_id", "left_anti")
    return with_active_model(gone.select("customer_id", "risk_score"), registry).withColumns(
        {"dataset_version": F.lit(K.TRIGGER_DATASET), "deleted_at": run_ts}
    )


def audit_recomputed(rows: DataFrame, run_id: str, run_ts: Column) -> DataFrame:
    """History rows with the score and band computed again from the features; the run id of a row is fixed by run and key."""
    scored = rows.withColumn("risk_score", behaviour_score(unit=True))
    digest = F.md5(F.concat(F.lit(f"{run_id}:"), F.col("customer_id").cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return scored.select(
        "customer_id",
        "risk_score",
        band_trigger(F.col("risk_score")).alias("risk_band"),
        F.lit(K.TRIGGER_MODEL).alias("model_version"),
        run_ts.alias("prediction_time"),
        F.lit(K.STAMP_TRIGGER).alias("created_by"),
        F.lit(K.TRIGGER_DATASET).alias("dataset_version"),
        F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]).alias("pipeline_run_id"),
    )


def audit_with_registry(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """History rows stamped with the active model; no active model is an error."""
    return with_active_model(rows.select("customer_id", "risk_score", "risk_band"), registry, fallback=None)


def activate_model(registry: DataFrame, model: DataFrame) -> DataFrame:
    """Registry with one active model: all others inactive, the given row inserted or replaced."""
    inactive = registry.withColumn("is_active", F.lit(False))
    return upsert_do_update(inactive, model.withColumn("is_active", F.lit(True)), "model_version")


def drift_psi(base: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index per feature over quantile bins of the base.

    Edges are exact base quantiles. Both sides are counted per (feature, bin) in
    one aggregate: the shuffled data is one row per feature, bin and task.
    """
    marks = {f"{c}_{i}": (c, i / bins) for c in columns for i in range(1, bins)}
    q = exact_quantiles(base, marks)

    def binned(df: DataFrame, current_side: bool) -> DataFrame:
        cells = []
        for c in columns:
            place = F.lit(0)
            for i in range(1, bins):
                place = place + F.when(F.col(c) > q[f"{c}_{i}"], 1).otherwise(0)
            cells.append(F.struct(F.lit(c).alias("feature_name"), F.when(F.col(c).isNotNull(), place).alias("bin")))
        rows = df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where(F.col("bin").isNotNull())
        return rows.withColumn("is_current", F.lit(current_side))

    both = binned(base, False).unionByName(binned(current, True))
    counts = both.groupBy("feature_name", "bin").agg(
        F.count_if(~F.col("is_current")).alias("e"), F.count_if(F.col("is_current")).alias("a")
    )
    # At most ``bins`` rows per feature from here on.
    totals = counts.groupBy("feature_name").agg(
        F.sum("e").alias("te"), F.sum("a").alias("ta"), F.collect_list(F.struct("bin", "e", "a")).alias("cells")
    )

    def term(cell: Column) -> Column:
        a = F.greatest(dbl(floor), cell.getField("a") / F.col("ta"))
        e = F.greatest(dbl(floor), cell.getField("e") / F.col("te"))
        return (a - e) * F.log(a / e)

    psi = F.aggregate(F.array_sort("cells"), dbl(0.0), lambda acc, cell: acc + term(cell))
    return totals.select("feature_name", round_up(psi, 4).alias("psi_score"))
