"""Customer, event, prediction and survey frames derived from the driver tables.

Every frame is a plan over whole tables. Joins start from pre-aggregated sides:
line items are summed per order before they meet orders, and orders are summed
per customer before they meet customers, so a hot order or customer shrinks to
one row per map task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import masking
from riskloom.functions.bands import band_cut_synth
from riskloom.functions.numeric import clip, dbl, round_even, round_up
from riskloom.operators import features as feat
from riskloom.sources.tables import read

# End of the observation period of the derived customer attributes.
OBSERVED_UNTIL = "2001-12-31"

_NEEDS = {
    "payment_discipline_score": ["bill_payment_delay_avg", "missed_payments_6m"],
    "income_stability_index": ["income_variance"],
    "financial_resilience_score": ["savings_rate", "spending_ratio", "missed_payments_6m"],
    "risk_score": [
        "missed_payments_6m", "bill_payment_delay_avg", "spending_ratio", "savings_rate", "employment_duration_months",
    ],
}
_NEEDS["risk_band"] = _NEEDS["risk_score"]
WIDE_COLUMNS = ["customer_id", *K.RAW_ATTRIBUTES, *K.FEATURES, "risk_score", "risk_band"]


def customer_attributes(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Raw behaviour attributes per customer.

    With ``since`` / ``until`` only customers with orders in that window appear.
    ``columns`` limits the attributes; line items are read only when the payment
    delay, the one attribute that needs them, is asked for.
    """
    wanted = columns or K.RAW_ATTRIBUTES
    orders = read(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    if since:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        orders = orders.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    if "bill_payment_delay_avg" in wanted:
        per_order = (
            read(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
        )
        orders = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        line_sums = [F.sum("lines").alias("lines"), F.sum("returned").alias("returned")]
    else:
        line_sums = []
    urgent = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    sums = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
        F.min("o_orderdate").alias("first"),
        F.max("o_orderdate").alias("last"),
        F.count_if(urgent).alias("urgent"),
        *line_sums,
    )
    customers = read(spark, sf_dir, "customer", "c_custkey", "c_acctbal").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance")
    )
    joined = customers.join(sums, "customer_id", "inner" if since or until else "left")

    n = F.col("n").cast("double")
    balance = F.col("balance")
    null = F.lit(None).cast("double")

    def months(start: Column, end: Column) -> Column:
        return F.floor(F.datediff(end, start) / dbl(30.0)).cast("int")

    exprs = {
        "monthly_income": lambda: F.when(balance < -890.0, null).otherwise(
            round_up(dbl(10000.0) + F.col("spent").cast("double") / n / dbl(10.0), 2)
        ),
        "income_variance": lambda: round_up(dbl(0.4) * (F.col("high") - F.col("low")) / dbl(500000.0), 3),
        "bill_payment_delay_avg": lambda: round_up(
            F.try_divide(dbl(9.0) * F.col("returned").cast("double"), F.col("lines").cast("double")), 2
        ),
        "missed_payments_6m": lambda: F.when(
            F.col("urgent").isNotNull(), F.least(F.lit(6), F.col("urgent").cast("int"))
        ),
        "spending_ratio": lambda: F.when(
            n.isNotNull(), round_up(dbl(0.3) + dbl(0.8) * F.least(dbl(1.0), n / dbl(20.0)), 2)
        ),
        "savings_rate": lambda: F.when((balance > 9890.0) | n.isNull(), null).otherwise(
            round_up(clip((balance + dbl(1000.0)) / dbl(27500.0), 0.0, 0.4), 2)
        ),
        "employment_duration_months": lambda: months(F.col("first"), F.col("last")),
        "account_age_months": lambda: months(F.col("first"), F.lit(OBSERVED_UNTIL).cast("date")),
    }
    return joined.select("customer_id", *[exprs[c]().alias(c) for c in K.RAW_ATTRIBUTES if c in wanted])


def wide_customers(spark: SparkSession, sf_dir: str, *columns: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Raw attributes, the three feature scores, the 0..100 risk score and its band."""
    wanted = list(columns) or WIDE_COLUMNS
    raw = {c for c in wanted if c in K.RAW_ATTRIBUTES}
    for c in wanted:
        raw.update(_NEEDS.get(c, []))
    base = customer_attributes(spark, sf_dir, [c for c in K.RAW_ATTRIBUTES if c in raw] or ["spending_ratio"], since, until)
    derived = {
        "payment_discipline_score": feat.payment_discipline,
        "income_stability_index": feat.income_stability,
        "financial_resilience_score": feat.financial_resilience,
        "risk_score": feat.synth_risk_score,
    }
    scored = base.withColumns(
        {c: make() for c, make in derived.items() if c in wanted or (c == "risk_score" and "risk_band" in wanted)}
    )
    if "risk_band" in wanted:
        scored = scored.withColumn("risk_band", band_cut_synth(F.col("risk_score")))
    return scored.select(*wanted)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour events."""
    return read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        F.col("value").alias("event_value"),
        F.col("ts").alias("event_time"),
    )


def prediction_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions."""
    return read(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus", "o_orderdate"
    ).select(
        F.col("o_orderkey").alias("prediction_id"),
        F.col("o_custkey").alias("customer_id"),
        round_up(F.col("o_totalprice") / dbl(500000.0), 4).alias("risk_score"),
        F.concat(F.lit("v"), F.substring("o_orderpriority", 1, 1), F.lit(".0")).alias("model_version"),
        F.when(F.col("o_orderstatus") == "F", "dataset_v1").otherwise("v1.0").alias("dataset_version"),
        F.col("o_orderdate").alias("prediction_time"),
        F.when(F.col("o_orderstatus") == "P", K.STAMP_BATCH).otherwise(K.STAMP_API).alias("created_by"),
        F.when(F.col("o_orderstatus") == "F", "High").when(F.col("o_orderstatus") == "P", "Medium").otherwise("Low").alias("original_band"),
        F.when(F.substring("o_orderpriority", 1, 1) <= "2", "v1_raw").otherwise("v2_safe").alias("feature_version"),
    )


def survey_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminal survey answers, ratings as text with dirty values."""
    quantity = F.col("l_quantity")
    return read(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_suppkey", "l_linestatus", "l_partkey", "l_tax"
    ).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "N", "evet")
        .when(F.col("l_returnflag") == "A", "kismen")
        .when(F.col("l_returnflag") == "R", "hayir")
        .alias("understood"),
        F.when(quantity == 13.0, "5 → Çok iyi")
        .when(quantity != 17.0, F.ceil(quantity / dbl(10.0)).cast("string"))
        .alias("rating"),
        (F.lit(1) + (F.col("l_suppkey") + F.col("l_linenumber")) % 5).cast("int").alias("trust"),
        F.when(F.col("l_linenumber") == 7, "emin_degilim")
        .when(F.col("l_linestatus") == "F", "evet")
        .when(F.col("l_linestatus") == "O", "hayir")
        .alias("decision"),
        F.element_at(F.array(F.lit("LOW"), F.lit("MEDIUM"), F.lit("HIGH")), (F.col("l_partkey") % 3 + 1).cast("int")).alias(
            "prediction"
        ),
        F.when(F.col("l_tax") < 0.03, "LOW").when(F.col("l_tax") < 0.06, "MEDIUM").otherwise("HIGH").alias("model_band"),
    )


def form_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web form answers: the same people, form wording, all text."""
    a = survey_answers(spark, sf_dir)
    return a.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("understood") == "evet", "Evet").when(F.col("understood") == "kismen", "Kısmen").when(
            F.col("understood") == "hayir", "Hayır"
        ).alias("understood"),
        "rating",
        F.col("trust").cast("string").alias("trust"),
        F.when(F.col("decision") == "evet", "Evet").when(F.col("decision") == "hayir", "Hayır").when(
            F.col("decision") == "emin_degilim", "Emin Değilim"
        ).alias("decision"),
        "prediction",
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact data of customers."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        key.alias("customer_id"),
        F.concat(
            F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com")
        ).alias("email"),
        (F.lit(5550000000) + key * F.lit(7919)).cast("string").alias("phone"),
        (F.lit(18) + key % 60).cast("int").alias("age"),
    )


def model_registry(spark: SparkSession, sf_dir: str, active: str | None = "v2.0") -> DataFrame:
    """Registered models with their training facts, derived from the stored predictions."""
    return (
        prediction_history(spark, sf_dir)
        .groupBy("model_version")
        .agg(F.count(F.lit(1)).alias("training_rows"), F.max("prediction_time").alias("trained_at"))
        .select(
            "model_version",
            F.when(F.col("model_version") < "v2", "linear").otherwise("xgboost").alias("model_name"),
            "trained_at",
            "training_rows",
            F.col("model_version").eqNullSafe(F.lit(active)).alias("is_active"),
        )
    )


def model_activations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When which model became the active one: in every month that of its first stored prediction, from that moment on."""
    first = F.struct("prediction_time", "prediction_id")
    return (
        prediction_history(spark, sf_dir)
        .select("model_version", "prediction_time", "prediction_id")
        .groupBy(F.trunc("prediction_time", "month").alias("month"))
        .agg(F.min_by("model_version", first).alias("model_version"), F.min("prediction_time").alias("activated_at"))
        .select("model_version", "activated_at")
    )


Window = tuple[str | None, str | None]

# Two observation windows, open at one end: together they cover everything, and customers leave and change between them.
OLD_WINDOW: Window = (None, "2000-12-01")
NEW_WINDOW: Window = ("2000-06-01", None)
WHOLE: Window = (None, None)


def feature_snapshot(spark: SparkSession, sf_dir: str, window: Window = WHOLE) -> DataFrame:
    """Feature table of one observation window, risk score on 0..1 with four digits."""
    return wide_customers(
        spark, sf_dir, "customer_id", *K.FEATURES, "risk_score", "risk_band", since=window[0], until=window[1]
    ).withColumn("risk_score", round_up(F.col("risk_score") / dbl(100.0), 4))


def staging_features(spark: SparkSession, sf_dir: str, clean: bool) -> DataFrame:
    """Staged feature rows. Without ``clean`` some have no resilience or one below the accepted minimum."""
    wide = wide_customers(spark, sf_dir, "customer_id", "monthly_income", *K.FEATURES, "risk_score", "risk_band")
    resilience = F.col("financial_resilience_score")
    value = F.coalesce(resilience, dbl(50.0)) if clean else F.when(F.col("monthly_income").isNull(), 0.5).otherwise(resilience)
    return wide.withColumn("financial_resilience_score", value).drop("monthly_income")


def privacy_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows before anonymisation, risk score rounded to whole points and put on 0..1."""
    wide = wide_customers(spark, sf_dir)
    return wide.withColumn("risk_score", round_even(F.col("risk_score"), 0) / dbl(100.0))


def generalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quasi-identifiers in generalised form with the sensitive score."""
    return privacy_input(spark, sf_dir).select(
        "customer_id",
        masking.generalise_income(F.col("monthly_income")).alias("monthly_income"),
        masking.generalise_spending(F.col("spending_ratio")).alias("spending_ratio"),
        masking.generalise_account_age(F.col("account_age_months")).alias("account_age_months"),
        "risk_score",
    )
