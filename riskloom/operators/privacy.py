"""Anonymisation: masking, generalisation, k-anonymity, l-diversity, suppression and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import masking as M
from riskloom.functions.numeric import dbl, round_up
from riskloom.sources.store import materialise

UNKNOWN = "UNKNOWN"


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Columns that are NULL in every row are dropped: one pass of counts, one row to the driver."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if filled[c] > 0])


def anonymize(df: DataFrame, salt: str, drop_empty: bool = True) -> DataFrame:
    """Pseudonymise, mask and generalise whichever of the known columns exist, in one projection."""
    rules = {
        "customer_id": lambda c: M.hash_id(c, salt),
        "email": M.mask_email,
        "phone": M.mask_phone,
        "monthly_income": M.generalise_income,
        "spending_ratio": M.generalise_spending,
        "account_age_months": M.generalise_account_age,
    }
    out: list[Column] = [
        rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns if c != "age"
    ]
    if "age" in df.columns:
        out.append(M.generalise_age(F.col("age")).alias("age_group"))
    anonymous = df.select(*out)
    return drop_empty_columns(anonymous) if drop_empty else anonymous


def quasi_identifiers(df: DataFrame) -> list[str]:
    return [c for c in K.QUASI_IDENTIFIERS if c in df.columns]


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c)


def k_violations(df: DataFrame, identifiers: list[str], k: int = 3) -> DataFrame:
    """Groups of quasi-identifiers with fewer than ``k`` rows; a missing identifier is the key UNKNOWN."""
    return df.groupBy(*[_key(c) for c in identifiers]).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") < k)


def l_violations(df: DataFrame, identifiers: list[str], sensitive: str, l: int = 3) -> DataFrame:
    """Groups with fewer than ``l`` distinct sensitive values; groups with a missing identifier are not judged."""
    complete = df.dropna(subset=identifiers)
    grouped = complete.groupBy(*[F.col(c).cast("string").alias(c) for c in identifiers])
    return grouped.agg(F.count_distinct(F.col(sensitive)).alias("diversity")).where(F.col("diversity") < l)


def l_diversity_stats(df: DataFrame, identifiers: list[str], sensitive: str, l: int = 3) -> DataFrame:
    """Number of groups, of violating groups, and their share in percent."""
    grouped = df.dropna(subset=identifiers).groupBy(*identifiers).agg(F.count_distinct(F.col(sensitive)).alias("d"))
    counts = grouped.agg(F.count(F.lit(1)).alias("total_groups"), F.count_if(F.col("d") < l).alias("violating_groups"))
    rate = F.coalesce(F.try_divide(F.col("violating_groups") * dbl(100.0), F.col("total_groups")), dbl(0.0))
    return counts.withColumn("violation_rate", round_up(rate, 2)).withColumn("l_value", F.lit(l))


def suppress(df: DataFrame, violations: DataFrame, identifiers: list[str], null_too: bool = False) -> DataFrame:
    """Rows outside the violating groups.

    A missing identifier equals no group, so such rows stay unless ``null_too``.
    The anti join lets a hot group of rows be split by the adaptive skew join; the
    violating side holds small groups only and is broadcast when Spark measures it small.
    """
    keys = violations.select(*[F.col(c).alias(f"v_{c}") for c in identifiers])
    match = [
        (_key(c) if null_too else F.col(c).cast("string")) == F.col(f"v_{c}") for c in identifiers
    ]
    return df.join(keys, match, "left_anti")


def coarsen_if_needed(df: DataFrame, identifiers: list[str], k: int = 3, threshold: float = 0.20) -> DataFrame:
    """Coarser spending and income where violating groups exceed a share of the rows; otherwise unchanged.

    The decision is one row on the driver. ``df`` is read twice; pass a stored frame when it is costly to make.
    """
    sizes = df.groupBy(*[_key(c) for c in identifiers]).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.count_if(F.col("n") < k).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if found.groups <= found.rows * threshold:
        return df
    changes = {}
    if "spending_ratio" in df.columns:
        changes["spending_ratio"] = M.coarser_spending(F.col("spending_ratio"))
    if "monthly_income" in df.columns:
        changes["monthly_income"] = M.coarser_income(F.col("monthly_income"))
    return df.withColumns(changes)


def anonymize_pipeline(
    df: DataFrame,
    salt: str,
    k: int = 3,
    l: int = 3,
    sensitive: str = "risk_score",
    threshold: float = 0.20,
    suppress_null: bool = False,
) -> DataFrame:
    """Anonymise, check k, coarsen if needed, suppress the groups that fail k or l.

    The generalised rows are written once. Suppression removes whole groups, so one
    aggregate per group, its rows and its different sensitive values, answers both checks.
    Groups with a missing identifier are not judged by l.
    """
    anonymous = drop_empty_columns(materialise(anonymize(df, salt, drop_empty=False), "anonymous"))
    identifiers = quasi_identifiers(anonymous)
    coarse = coarsen_if_needed(anonymous, identifiers, k, threshold)
    checks = [F.count(F.lit(1)).alias("n")]
    fails = F.col("n") < k
    if sensitive in coarse.columns:
        whole = F.min(F.array_min(F.array(*[F.col(c).isNotNull().cast("int") for c in identifiers])))
        checks += [F.count_distinct(F.col(sensitive)).alias("diversity"), whole.alias("whole")]
        fails = fails | ((F.col("whole") == 1) & (F.col("diversity") < l))
    groups = coarse.groupBy(*[_key(c) for c in identifiers]).agg(*checks)
    return suppress(coarse, groups.where(fails), identifiers, suppress_null)


def privacy_report(original: DataFrame, final: DataFrame, k: int = 3, l: int = 3, sensitive: str = "risk_score") -> DataFrame:
    """Nine (Metric, Value) rows: sizes, loss, group sizes, re-identification risk, distinct scores, k and l."""
    identifiers = quasi_identifiers(final)
    sizes = final.dropna(subset=identifiers).groupBy(*identifiers).agg(F.count(F.lit(1)).alias("size"))
    groups = sizes.agg(
        F.avg("size").alias("mean"),
        F.min("size").alias("least"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("size") == 1).alias("single"),
        F.count_if(F.col("size") < 3).alias("small"),
        F.count_distinct("size").alias("kinds"),
    )
    before = original.agg(F.count(F.lit(1))).scalar().cast("double")
    ends = final.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(sensitive)).alias("scores"))
    ).scalar()
    after = ends.getField("rows").cast("double")
    n = F.col("groups").cast("double")
    risk = (
        dbl(0.5) * (F.col("single") / n)
        + dbl(0.3) * (F.col("small") / n)
        + dbl(0.2) * (dbl(1.0) - F.col("kinds") / n)
    )
    values = [
        before,
        after,
        round_up((dbl(1.0) - after / before) * dbl(100.0), 2),
        round_up(F.col("mean"), 2),
        F.col("least").cast("double"),
        round_up(risk * dbl(100.0), 2),
        ends.getField("scores").cast("double"),
        dbl(k),
        dbl(l),
    ]
    wide = groups.select(*[v.alias(f"m{i}") for i, v in enumerate(values)])
    rows = [F.struct(F.lit(n).alias("Metric"), F.col(f"m{i}").alias("Value")) for i, n in enumerate(K.PRIVACY_METRICS)]
    return wide.select(F.inline(F.array(*rows)))
