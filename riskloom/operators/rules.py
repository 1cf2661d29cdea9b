"""Threshold rules over raw customer attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import dbl, null_to_zero, round_up


def _fires(attribute: str, comparison: str, bound: float) -> Column:
    value = null_to_zero(F.col(attribute))
    return value > dbl(bound) if comparison == ">" else value < dbl(bound)


def rule_hits() -> Column:
    """Rules that fire, as array<struct<rule, impact>> in evaluation order; never empty."""

    def entry(name: str, impact: float) -> Column:
        return F.struct(F.lit(name).alias("rule"), dbl(impact).alias("impact"))

    hits = F.array_compact(F.array(*[F.when(_fires(a, op, b), entry(n, i)) for a, op, b, n, i in K.RULES]))
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(entry(*K.RULE_FALLBACK)))


def rule_score() -> Column:
    """Sum of the impacts of the rules that fire, three digits: plain additions, no array is built."""
    terms = [F.when(_fires(a, op, b), dbl(i)).otherwise(dbl(0.0)) for a, op, b, _, i in K.RULES]
    return round_up(reduce(lambda x, y: x + y, terms), 3)


def scorecard(hits: Column) -> Column:
    """Sum of impacts of a rule array, three digits."""
    total = F.aggregate(hits, dbl(0.0), lambda acc, x: acc + null_to_zero(x.getField("impact")))
    return round_up(total, 3)


def rule_names(hits: Column) -> Column:
    return F.transform(hits, lambda x: x.getField("rule"))
