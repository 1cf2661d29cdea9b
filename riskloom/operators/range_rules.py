"""Range rules: which configured interval a value falls in, with texts and fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import unit_if_above_one

_SCHEMA = (
    "feature string, lo double, hi double, rule_label string, color string, impact double, "
    "priority string, action string, description string"
)


def apply_range_rules(values: DataFrame) -> DataFrame:
    """(customer_id, feature, value) with label, colour, impact, priority, insight, description and an action of title, text and priority.

    The rules are a fixed table of nine rows, so the broadcast does not grow with
    the data; the join keeps an equality on ``feature`` and checks [lo, hi) beside it.
    """
    rules = F.broadcast(values.sparkSession.createDataFrame(K.RANGE_RULES, _SCHEMA))
    v = values.withColumn("value", unit_if_above_one(F.col("value"))).alias("v")
    joined = v.join(
        rules.alias("r"),
        (F.col("v.feature") == F.col("r.feature")) & (F.col("value") >= F.col("lo")) & (F.col("value") < F.col("hi")),
        "left",
    ).drop(F.col("r.feature"))
    value, feature = F.col("value"), F.col("feature")
    known = feature.isin(list(K.RANGE_INSIGHT))
    matched = F.col("lo").isNotNull()
    resilience, payment = feature == "financial_resilience", feature == "payment_discipline"
    # Shown labels follow one set of edges; the strong resilience range is shown as medium below 0.8.
    label = (
        F.when(resilience & (value < 0.2), "Kritik")
        .when(value < 0.6, F.when(feature == "income_stability", "Dengesiz").otherwise("Zayıf"))
        .when(value < 0.8, "Orta")
        .otherwise(F.when(feature == "income_stability", "Stabil").otherwise("Güçlü"))
    )
    weak = value < 0.6
    urgent = (resilience & (value < 0.2)) | (payment & weak)
    described = F.coalesce(F.nullif(F.trim("description"), F.lit("")), F.lit(K.RANGE_ACTION_TEXTS[2]))
    texts = K.RANGE_INSIGHT
    insight = (
        F.when(
            resilience,
            F.when(value < 0.2, texts["financial_resilience"][0])
            .when(weak, texts["financial_resilience"][1])
            .otherwise(texts["financial_resilience"][2]),
        )
        .when(payment, F.when(weak, texts["payment_discipline"][0]).otherwise(texts["payment_discipline"][1]))
        .otherwise(F.when(weak, texts["income_stability"][0]).otherwise(texts["income_stability"][1]))
    )
    out = joined.withColumn(
        "label",
        F.when(~known, "Unknown").when(value.isNull(), "Invalid").when(~matched, "Unmapped").otherwise(label),
    )
    return out.select(
        "customer_id",
        "feature",
        "value",
        "label",
        F.coalesce("color", F.lit("gray")).alias("color"),
        F.coalesce("impact", F.lit(0.0)).alias("impact"),
        F.coalesce("priority", F.lit("LOW")).alias("priority"),
        F.when(~known, "Missing rule configuration")
        .when(value.isNull(), "Value could not be parsed")
        .when(~matched, "Value outside defined segmentation")
        .otherwise(insight)
        .alias("insight"),
        F.when(
            matched,
            F.when(resilience & (value < 0.2), K.RANGE_ACTION_RESILIENCE)
            .when(payment & weak, K.RANGE_ACTION_PAYMENT)
            .otherwise(F.coalesce(F.col("action"), F.concat(F.col("label"), F.lit(" optimization")))),
        ).alias("action"),
        F.when(matched, F.when(urgent, F.when(resilience, K.RANGE_ACTION_TEXTS[0]).otherwise(K.RANGE_ACTION_TEXTS[1])).otherwise(described)).alias("action_text"),
        F.when(matched, F.when(urgent, "HIGH").otherwise(F.col("priority"))).alias("action_priority"),
        F.when(~known, K.RANGE_NO_RULE[0]).when(value.isNull(), K.RANGE_NO_RULE[1]).when(~matched, K.RANGE_NO_RULE[2]).otherwise(F.trim("description")).alias("description"),
    )
