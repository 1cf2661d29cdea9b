"""Explanations per row: contributions, texts, factor arrays and a local surrogate."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.linear import BoundedLine
from riskloom.functions.numeric import dbl, normal, null_to_zero, round_up, safe_float, uniform, unit_if_above_one
from riskloom.operators.quantiles import exact_quantiles
from riskloom.sources.store import append_results

PAYMENT, INCOME, RESILIENCE = K.FEATURES
_PAIRS = "array<struct<feature:string,impact:double>>"


def contributions() -> Column:
    """Map feature -> weighted contribution, four digits."""
    entries: list[Column] = []
    for c in K.FEATURES:
        value = safe_float(F.col(c), allow_inf=True) / dbl(100.0)
        entries += [F.lit(c), round_up(value * dbl(K.BEHAVIOUR_WEIGHTS[c]), 4)]
    return F.create_map(*entries)


def ranked_contributions(contribution_map: Column, top: int = 3) -> Column:
    """Largest contributions by absolute value; ties keep feature order."""
    rows = F.array(
        *[
            F.struct(
                (-F.abs(contribution_map[c])).alias("key"),
                F.lit(i).alias("ord"),
                F.lit(c).alias("feature"),
                contribution_map[c].alias("impact"),
            )
            for i, c in enumerate(K.FEATURES)
        ]
    )
    ordered = F.slice(F.array_sort(rows), 1, top)
    return F.transform(ordered, lambda x: F.struct(x.getField("feature").alias("feature"), x.getField("impact").alias("impact")))


def explanation_text(ranked: Column) -> Column:
    """Sentence of the first factor."""
    first = F.get(ranked, F.lit(0)).getField("feature")
    sentence = F.lit(None).cast("string")
    for name, text in reversed(K.FACTOR_TEXT.items()):
        sentence = F.when(first == name, text).otherwise(sentence)
    return F.coalesce(sentence, F.lit(K.FACTOR_TEXT_DEFAULT))


def explanation_confidence(rule_names: Column, attribution_names: Column, top: int = 3) -> Column:
    """Share of the top rule factors that the attribution also names, two digits."""
    ours = F.array_distinct(F.slice(rule_names, 1, top))
    theirs = F.slice(attribution_names, 1, top)
    share = F.try_divide(F.size(F.array_intersect(ours, theirs)).cast("double"), F.size(ours).cast("double"))
    return F.coalesce(round_up(share, 2), dbl(0.0))


def feature_explanations() -> Column:
    """Weak (below 40) and strong (above 70) features with impact and text."""
    rows = []
    for c in K.FEATURES:
        value = null_to_zero(F.col(c))

        def row(impact: float, text: str) -> Column:
            return F.struct(
                F.lit(c).alias("feature"), value.alias("value"), dbl(impact).alias("impact"), F.lit(text).alias("text")
            )

        weak, strong = K.FEATURE_TEXT[c]
        rows.append(F.when(value < 40.0, row(-1.0, weak)).when(value > 70.0, row(1.0, strong)))
    return F.array_compact(F.array(*rows))


def explanation_summary(explanations: Column) -> Column:
    """One sentence of what raises and what lowers the risk."""

    def names(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda e: F.replace(e.getField("feature"), F.lit("_"), F.lit(" "))), ", ")

    raises = F.filter(explanations, lambda e: e.getField("impact") < 0)
    lowers = F.filter(explanations, lambda e: e.getField("impact") > 0)
    text = F.concat_ws(
        " ve ",
        F.when(F.size(raises) > 0, F.concat(names(raises), F.lit(K.SUMMARY_RAISES))),
        F.when(F.size(lowers) > 0, F.concat(names(lowers), F.lit(K.SUMMARY_LOWERS))),
    )
    sentence = F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))), F.lit("."))
    fragile = F.when(null_to_zero(F.col(RESILIENCE)) < 40.0, K.SUMMARY_FRAGILE).otherwise("")
    return F.concat(F.when(text == "", K.SUMMARY_BALANCED).otherwise(sentence), fragile)


def simple_explanation() -> Column:
    """Fixed impacts of three conditions, or a general entry."""

    def row(feature: str, impact: float) -> Column:
        return F.struct(F.lit(feature).alias("feature"), dbl(impact).alias("impact"))

    rows = F.array_compact(
        F.array(
            F.when(F.col(INCOME) > 70.0, row(INCOME, -0.07)),
            F.when(F.col(PAYMENT) > 70.0, row(PAYMENT, -0.05)),
            F.when(F.col(RESILIENCE) < 20.0, row(RESILIENCE, 0.06)),
        )
    )
    return F.when(F.size(rows) > 0, rows).otherwise(F.array(row("general_behavior", 0.01)))


def _one_digit(c: Column) -> Column:
    return round_up(c, 1).cast("decimal(10,1)").cast("string")


def customer_sentence() -> Column:
    """Sentence shown to survey users."""
    parts = F.concat_ws(
        ", ",
        F.when(F.col(PAYMENT) < 60.0, F.concat(F.lit(K.SENTENCE_PAYMENT), _one_digit(F.col(PAYMENT)), F.lit(")"))),
        F.when(F.col(RESILIENCE) < 20.0, F.concat(F.lit(K.SENTENCE_RESILIENCE), _one_digit(F.col(RESILIENCE)), F.lit(")"))),
        F.when(F.col(INCOME) > 80.0, F.concat(F.lit(K.SENTENCE_INCOME), _one_digit(F.col(INCOME)), F.lit(")"))),
    )
    return F.when(parts == "", K.SENTENCE_DEFAULT).otherwise(
        F.concat(F.lit(K.SENTENCE_PREFIX), parts, F.lit(K.SENTENCE_SUFFIX))
    )


def attribution_parse(df: DataFrame, column: str) -> DataFrame:
    """Attribution JSON -> one row per known feature with display name, direction and three-digit impact."""
    item = F.explode(F.from_json(F.col(column), _PAIRS)).alias("item")
    rows = df.select("customer_id", item).where(F.col("item.feature").isin(K.FEATURES))
    name = F.create_map(*[F.lit(x) for pair in K.DISPLAY_NAME.items() for x in pair])
    return rows.select(
        "customer_id",
        name[F.col("item.feature")].alias("factor"),
        F.when(F.col("item.impact") < 0.0, K.DIRECTION_LOWERS).otherwise(K.DIRECTION_RAISES).alias("direction"),
        round_up(F.col("item.impact"), 3).alias("impact"),
    )


def condition_feature(condition: Column) -> Column:
    """Feature before the first comparison sign; two-sided ranges start with a number and stay unknown."""
    name = F.trim(F.split(condition, "[<>=]")[0])
    return F.when(name.isin(K.FEATURES), name).otherwise("unknown_feature")


def condition_feature_contains(condition: Column) -> Column:
    """Known feature found anywhere in the condition, else the condition itself."""
    out = condition
    for c in reversed(K.FEATURES):
        out = F.when(condition.contains(c), c).otherwise(out)
    return out


def attribution_format(pairs: Column) -> Column:
    """Pairs with textual or missing impacts -> uniform four-digit structs."""
    return F.transform(
        pairs,
        lambda x: F.struct(
            x.getField("feature").alias("feature"),
            round_up(safe_float(x.getField("impact"), allow_inf=True), 4).alias("impact"),
        ),
    )


def explain_factors(band: Column, score: Column) -> list[Column]:
    """Flags of raw attributes that raise or lower the risk, with the prediction they belong to."""
    raising = F.array_compact(
        F.array(
            F.when(F.col("spending_ratio") > 0.8, "high_spending_ratio"),
            F.when(F.col("bill_payment_delay_avg") > 3.0, "payment_delay"),
        )
    )
    lowering = F.array_compact(
        F.array(
            F.when(F.col("savings_rate") > 0.2, "high_savings_rate"),
            F.when(F.col("employment_duration_months") > 60, "long_employment_duration"),
        )
    )
    return [
        band.alias("prediction"),
        score.alias("prediction_score"),
        raising.alias("top_positive_factors"),
        lowering.alias("top_negative_factors"),
        F.lit(K.EXPLAIN_SUMMARY).alias("explanation_summary"),
    ]


def explain_customer_json(ids: DataFrame, features: DataFrame) -> DataFrame:
    """JSON object per requested id, or an error object."""
    body = features.select(
        "customer_id", F.to_json(F.struct("customer_id", "risk_score", "risk_band"), {"ignoreNullFields": "false"}).alias("json")
    )
    return ids.join(body, "customer_id", "left").select(
        "customer_id", F.coalesce("json", F.lit('{"error":"customer_not_found"}')).alias("explanation")
    )


def narrative(band: Column, confidence: Column, resilience: Column) -> Column:
    """Sentence chosen by band, confidence and resilience; the first case that holds."""
    r, c = unit_if_above_one(resilience), unit_if_above_one(confidence)
    text = K.NARRATIVE
    return (
        F.when((r < 0.3) & (band == "LOW"), text[0])
        .when(c < 0.6, text[1])
        .when(r < 0.2, text[2])
        .when(r < 0.4, text[3])
        .when(c < 0.85, text[4])
        .otherwise(text[5])
    )


def worst_factor() -> Column:
    """Struct (value, name) of the lowest present feature on 0..1; the first named wins a tie."""
    named = [(RESILIENCE, "Finansal Dayanıklılık"), (PAYMENT, "Ödeme Disiplini"), (INCOME, "Gelir İstikrarı")]
    rows = []
    for i, (c, name) in enumerate(named):
        unit = unit_if_above_one(F.col(c))
        rows.append(F.when(unit.isNotNull(), F.struct(unit.alias("value"), F.lit(i).alias("ord"), F.lit(name).alias("name"))))
    return F.array_min(F.array_compact(F.array(*rows)))


def factor_order(levels: dict[str, Column]) -> Column:
    """Factor names from high to unknown concern, given order kept within a level."""
    rank = F.create_map(*[F.lit(x) for pair in {"high": 3, "medium": 2, "low": 1, "unknown": 0}.items() for x in pair])
    rows = [
        F.struct((-rank[level]).alias("key"), F.lit(i).alias("ord"), F.lit(name).alias("name"))
        for i, (name, level) in enumerate(levels.items())
    ]
    return F.transform(F.array_sort(F.array(*rows)), lambda x: x.getField("name"))


def _array_literal(rows: list[dict[str, float | None]]) -> Column:
    """Numbers as one constant: a JSON text is folded into an array, which generated code reads by reference."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{','.join(f'{name}:double' for name in rows[0])}>>")


def surrogate_draws(spark: SparkSession, samples: int, seed: int) -> tuple[list[Row], Row]:
    """The disturbances (n0, n1, n2, w) that all rows share, and their weighted sums.

    w is the closeness of a copy. The draws do not depend on the data, so they are made once, ``samples`` of them.
    """
    key = F.col("id").cast("string")
    draws = spark.range(1, samples + 1).select("id", *[normal(key, i, seed).alias(f"n{i}") for i in range(3)])
    width = 0.75 * 3.0**0.5
    distance2 = F.col("n0") * F.col("n0") + F.col("n1") * F.col("n1") + F.col("n2") * F.col("n2")
    rows = draws.withColumn("w", F.sqrt(F.exp(-distance2 / dbl(width * width)))).orderBy("id").drop("id").collect()
    sums = {"sw": math.fsum(r.w for r in rows)}
    for i in range(3):
        sums[f"s{i}"] = math.fsum(r.w * r[i] for r in rows)
        sums |= {f"s{i}{j}": math.fsum(r.w * r[i] * r[j] for r in rows) for j in range(i, 3)}
    return rows, Row(**sums)


_SUMS = ("sy", "t0", "t1", "t2")


def _line_sums(filled: DataFrame, at: list[str], line: BoundedLine, deviations: list[float | None], draws: list[Row]) -> DataFrame:
    """The weighted sums of the score over all disturbed copies of every row, without making the copies.

    A copy scores what the row does plus what its draw adds, bounded to 0..1. With the draws in order of what they add, those
    below 0 come first, those above 1 last: two searches per row part them, and sums up to each draw give the rest.
    """
    # Without a finite deviation no copy has a finite value, so the feature counts as 0 in all.
    slopes = [line.slopes.get(c, 0.0) if s is not None and math.isfinite(s) else 0.0 for c, s in zip(K.FEATURES, deviations)]
    added = sorted(((sum(k * s * r[i] for i, (k, s) in enumerate(zip(slopes, deviations)) if k), r) for r in draws), key=lambda x: x[0])
    columns: dict[str, list] = {"added": [*[x for x, _ in added], None]}  # the last entry stands behind the last draw
    for name, factor in zip(_SUMS, (lambda r: 1.0, *[lambda r, i=i: r[i] for i in range(3)])):
        columns[name] = list(accumulate((r.w * factor(r) for _, r in added), initial=0.0))
        columns[f"{name}_added"] = list(accumulate((r.w * factor(r) * x for x, r in added), initial=0.0))
    table = _array_literal([dict(zip(columns, values)) for values in zip(*columns.values())])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(draws).bit_length()))])

    def up_to(bound: Column) -> Column:
        """The sums over the draws that add at most so much."""
        further = lambda n, step: F.when(F.get(table, n + step - 1).getField("added") <= bound, n + step).otherwise(n)
        return F.aggregate(steps, F.lit(0), further, lambda n: F.get(table, n))

    own = sum((dbl(k) * F.col(a) for k, a in zip(slopes, at) if k), dbl(line.constant))
    parted = filled.withColumn("own", own).withColumns({"low": up_to(-F.col("own")), "high": up_to(dbl(1.0) - F.col("own"))})

    def total(name: str) -> Column:
        between = F.col("own") * (F.col(f"high.{name}") - F.col(f"low.{name}")) + (F.col(f"high.{name}_added") - F.col(f"low.{name}_added"))
        return between + (dbl(columns[name][-1]) - F.col(f"high.{name}"))

    return parted.select(*filled.columns, *[total(name).alias(name) for name in _SUMS])


def _determinant(a: list, b: list, c: list):
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - b[0] * (a[1] * c[2] - a[2] * c[1]) + c[0] * (a[1] * b[2] - a[2] * b[1])


def _solve(columns: list[list], rhs: list) -> list[Column]:
    """The three unknowns of a linear system given by its columns; null where it has no single solution."""
    whole = _determinant(*columns)
    return [F.try_divide(_determinant(*[rhs if k == i else v for k, v in enumerate(columns)]), whole) for i in range(3)]


def local_surrogate(
    features: DataFrame,
    score: Callable[[DataFrame], Column],
    samples: int = 5000,
    ridge: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Local linear attribution of a score around every row.

    Every row gets ``samples`` disturbed copies (normal noise in units of the
    population deviation), the copies are scored and weighted by closeness, and the
    weighted normal equations of the three features are solved per row. All rows share
    one seeded set of draws, so their weights and the normal matrix are constants; per row
    only four weighted sums of the score remain. A bounded line has these sums without its copies, see ``_line_sums``. For any other
    score, rows with equal features have equal copies, so these are made once per different triple, in the task that holds it: partial sums leave one row per triple for the shuffle.
    """
    spark = features.sparkSession
    deviations = [F.coalesce(F.nullif(F.stddev_pop(c), dbl(0.0)), dbl(1.0)).alias(f"{c}_s") for c in K.FEATURES]
    found = features.agg(*deviations, *[F.avg(c).alias(f"{c}_m") for c in K.FEATURES]).first()
    stats = {name: dbl(value) if value is not None else F.lit(None).cast("double") for name, value in found.asDict().items()}
    draws, sums = surrogate_draws(spark, samples, seed)
    at = [f"at_{c}" for c in K.FEATURES]
    filled = features.select("customer_id", *[null_to_zero(F.col(c)).alias(a) for c, a in zip(K.FEATURES, at)])
    if isinstance(score, BoundedLine):
        return _solved(_line_sums(filled, at, score, [found[f"{c}_s"] for c in K.FEATURES], draws), "customer_id", at, stats, sums, ridge)
    # A text as key keeps its partitioning from the first aggregate to the join, which numbers do not, as they are normalised at every step.
    filled = filled.withColumn("triple", F.concat_ws(",", *at))
    # Triples are few bytes and much work: a fixed number of parts is not merged by size.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = filled.repartition(parts, "triple").groupBy("triple").agg(*[F.first(a).alias(a) for a in at])
    copies = points.select("triple", *at, F.inline(_array_literal([r.asDict() for r in draws])))
    moved = copies.select(
        "triple", *at, "n0", "n1", "n2", "w",
        *[(F.col(a) + F.col(f"n{i}") * stats[f"{c}_s"]).alias(c) for i, (c, a) in enumerate(zip(K.FEATURES, at))],
    )
    scored = moved.select("triple", *at, "n0", "n1", "n2", (F.col("w") * score(moved)).alias("wy"))
    terms = [F.sum(F.col(f"n{i}") * F.col("wy")).alias(f"t{i}") for i in range(3)]
    s = scored.groupBy("triple").agg(F.sum("wy").alias("sy"), *terms, *[F.first(a).alias(a) for a in at])
    return filled.select("customer_id", "triple").join(_solved(s, "triple", at, stats, sums, ridge), "triple").drop("triple")


def _solved(s: DataFrame, key: str, at: list[str], stats: dict[str, Column], sums: Row, ridge: float) -> DataFrame:
    """Weights and impacts of the features from the weighted sums of the score."""

    def moment(i: int, j: int) -> Column:
        """Weighted covariance of two disturbances, ridge on the diagonal."""
        i, j = min(i, j), max(i, j)
        return dbl(sums[f"s{i}{j}"] - sums[f"s{i}"] * sums[f"s{j}"] / sums["sw"] + (ridge if i == j else 0.0))

    rhs = [F.col(f"t{i}") - dbl(sums[f"s{i}"] / sums["sw"]) * F.col("sy") for i in range(3)]
    out = []
    for c, a, weight in zip(K.FEATURES, at, _solve([[moment(i, j) for j in range(3)] for i in range(3)], rhs)):
        position = (F.col(a) - stats[f"{c}_m"]) / stats[f"{c}_s"]
        out += [weight.alias(f"{c}_weight"), (weight * position).alias(f"{c}_impact")]
    return s.select(key, *out)


def binned_surrogate(
    features: DataFrame, score: Callable[[DataFrame], Column], samples: int = 5000, ridge: float = 1.0, seed: int = 42
) -> DataFrame:
    """Attribution on quartile bins: (customer_id, condition, weight) for each feature of every row.

    A draw takes a quarter of every feature and a place inside it, and is scored. Around a row, each feature says whether
    the draw is in the row's quarter; draws are weighted by how many features are. So the weights depend on the row's three
    quarters only: they are solved once for each of the 64 combinations and looked up. A condition reads ``a < f <= b``,
    open at the first and last quarter. Missing values count as 0.
    """
    filled = features.select("customer_id", *[null_to_zero(F.col(c)).alias(c) for c in K.FEATURES])
    marks = {f"{c}_{k}": (c, k / 4) for c in K.FEATURES for k in range(5)}
    quantiles = exact_quantiles(filled, marks)
    edges = {c: [F.coalesce(quantiles[f"{c}_{k}"], dbl(0.0)) for k in range(5)] for c in K.FEATURES}
    key = F.col("id").cast("string")
    picked = features.sparkSession.range(1, samples + 1).select(
        "id", *[F.floor(dbl(4.0) * uniform(key, 20 + i, seed)).cast("int").alias(f"b{i}") for i in range(3)]
    )

    def inside(i: int, c: str) -> Column:
        low = F.get(F.array(*edges[c][:4]), F.col(f"b{i}"))
        high = F.get(F.array(*edges[c][1:]), F.col(f"b{i}"))
        return low + (high - low) * uniform(key, 30 + i, seed)

    moved = picked.select("b0", "b1", "b2", *[inside(i, c).alias(c) for i, c in enumerate(K.FEATURES)])
    scored = moved.select("b0", "b1", "b2", score(moved).alias("y"))
    # Draws of one combination differ in their score only.
    cells = scored.groupBy("b0", "b1", "b2").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("y"))
    rows = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.struct((k % 4).alias("r0"), F.floor(k / 4 % 4).alias("r1"), F.floor(k / 16).alias("r2")))
    around = cells.select("*", F.inline(rows))
    hit = [(F.col(f"b{i}") == F.col(f"r{i}")).cast("double") for i in range(3)]
    width = 0.75 * 3.0**0.5
    w = F.sqrt(F.exp((hit[0] + hit[1] + hit[2] - dbl(3.0)) / dbl(width * width)))
    weighted = around.select("r0", "r1", "r2", *[h.alias(f"h{i}") for i, h in enumerate(hit)], (w * F.col("n")).alias("w"), (w * F.col("y")).alias("wy"))
    h = [F.col(f"h{i}") for i in range(3)]
    sums = [F.sum("w").alias("sw"), F.sum("wy").alias("sy")] + [F.sum(h[i] * F.col("wy")).alias(f"t{i}") for i in range(3)]
    sums += [F.sum(h[i] * F.col("w")).alias(f"s{i}") for i in range(3)]
    sums += [F.sum(h[i] * h[j] * F.col("w")).alias(f"s{i}{j}") for i in range(3) for j in range(i, 3)]
    s = weighted.groupBy("r0", "r1", "r2").agg(*sums)

    def moment(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        return F.col(f"s{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("sw") + dbl(ridge if i == j else 0.0)

    rhs = [F.col(f"t{i}") - F.col(f"s{i}") * F.col("sy") / F.col("sw") for i in range(3)]
    solved = _solve([[moment(i, j) for j in range(3)] for i in range(3)], rhs)
    table = s.select("r0", "r1", "r2", *[x.alias(f"w{i}") for i, x in enumerate(solved)])

    def quarter(c: str) -> Column:
        return sum(((F.col(c) > x).cast("int") for x in edges[c][1:4]), F.lit(0))

    def condition(i: int, c: str) -> Column:
        texts = F.array(*[round_up(x, 2).cast("decimal(12,2)").cast("string") for x in edges[c][1:4]])
        q = F.col(f"r{i}").cast("int")
        return (
            F.when(q == 0, F.concat(F.lit(f"{c} <= "), F.get(texts, F.lit(0))))
            .when(q == 3, F.concat(F.lit(f"{c} > "), F.get(texts, F.lit(2))))
            .otherwise(F.concat(F.get(texts, q - 1), F.lit(f" < {c} <= "), F.get(texts, q)))
        )

    placed = filled.select("customer_id", *[quarter(c).cast("bigint").alias(f"r{i}") for i, c in enumerate(K.FEATURES)])
    joined = placed.join(F.broadcast(table), ["r0", "r1", "r2"])  # 64 rows at most
    pairs = F.array(*[F.struct(condition(i, c).alias("condition"), F.col(f"w{i}").alias("weight")) for i, c in enumerate(K.FEATURES)])
    return joined.select("customer_id", F.inline(pairs))


def log_explanations(records: DataFrame, run_ts: Column, path: str) -> None:
    """Add explanation records to the log: the contributions and their order, and the rules that fired, as JSON texts."""
    split = lambda c: F.when(F.col(c) != "", F.split(c, r"\|")).otherwise(F.array().cast("array<string>"))
    importance = F.struct(*K.FEATURES, split("top_risk_factors").alias("order"))
    append_results(
        records.select(
            "prediction_id", "customer_id", F.to_json(importance).alias("feature_importance"), F.to_json(split("rules_triggered")).alias("rules_triggered"),
            run_ts.alias("created_at"),
        ), path,
    )


def newest_explanations(spark: SparkSession, path: str) -> DataFrame:
    """The last explanation that the log has of each prediction."""
    names = "prediction_id bigint, customer_id bigint, feature_importance string, rules_triggered string, created_at timestamp_ntz"
    rows = spark.read.schema(names).parquet(path)
    newest = F.max_by(F.struct("customer_id", "feature_importance", "rules_triggered", "created_at"), F.struct("created_at", "feature_importance"))
    return rows.groupBy("prediction_id").agg(newest.alias("e")).select("prediction_id", "e.*")


def attribution_json(surrogate: DataFrame) -> DataFrame:
    """Surrogate impacts as one JSON text per customer, strongest first, four digits."""
    rows = F.array_sort(
        F.array(
            *[
                F.struct(
                    (-F.abs(F.col(f"{c}_impact"))).alias("key"),
                    F.lit(c).alias("feature"),
                    round_up(F.col(f"{c}_impact"), 4).cast("decimal(10,4)").alias("impact"),
                )
                for c in K.FEATURES
            ]
        )
    )
    pairs = F.transform(rows, lambda x: F.struct(x.getField("feature").alias("feature"), x.getField("impact").alias("impact")))
    return surrogate.select("customer_id", F.to_json(pairs).alias("lime_explanation"))
