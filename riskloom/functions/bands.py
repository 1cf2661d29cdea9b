"""Banding rules. Edges differ between them (left / right closed), so each keeps its own name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions.numeric import clip, dbl, unit_if_above_one


def band_api(score: Column) -> Column:
    """Left-closed bands of a 0..1 score with colour and label."""

    def row(values: tuple[str, str, str]) -> Column:
        return F.struct(*[F.lit(v).alias(n) for v, n in zip(values, ("band", "color", "label"))])

    return (
        F.when(score < 0.33, row(K.BAND_LOW)).when(score < 0.66, row(K.BAND_MEDIUM)).otherwise(row(K.BAND_HIGH))
    )


def band_cut(score: Column, labels: tuple[str, str, str] = ("LOW", "MEDIUM", "HIGH"), outside: str | None = "nan") -> Column:
    """Right-closed bands of a 0..1 score, lowest edge included."""
    return (
        F.when((score >= 0.0) & (score <= 0.33), labels[0])
        .when((score > 0.33) & (score <= 0.66), labels[1])
        .when((score > 0.66) & (score <= 1.0), labels[2])
        .otherwise(F.lit(outside))
    )


def band_cut_localised(raw: Column) -> Column:
    """Bands of a raw prediction scaled by 25."""
    return band_cut(clip(raw / dbl(25.0), 0.0, 1.0), ("DÜŞÜK", "ORTA", "YÜKSEK"), None)


def band_cut_synth(score: Column) -> Column:
    """Right-closed bands of a 0..100 score."""
    return (
        F.when((score > -0.01) & (score <= 33.0), "Low")
        .when((score > 33.0) & (score <= 66.0), "Medium")
        .when((score > 66.0) & (score <= 100.0), "High")
    )


def band_trigger(score: Column) -> Column:
    """Bands written by the change log; a higher (better) behaviour score says High here."""
    return F.when(score >= 0.7, "High").when(score >= 0.4, "Medium").otherwise("Low")


def risk_category(score: Column) -> Column:
    """Report category of a 0..100 score; no score counts as high."""
    return (
        F.when(score < 40.0, "Low Risk").when(score.between(40.0, 70.0), "Medium Risk").otherwise("High Risk")
    )


def spending_segment(ratio: Column) -> Column:
    return (
        F.when(ratio > 0.8, "High Spender").when(ratio.between(0.5, 0.8), "Moderate Spender").otherwise("Low Spender")
    )


def risk_zone(behaviour: Column) -> Column:
    """Zone of a 0..100 behaviour score (higher is better)."""
    return F.when(behaviour < 50.0, "High").when(behaviour < 75.0, "Medium").when(behaviour >= 75.0, "Low")


def score_word(score: Column) -> Column:
    return F.when(score >= 80.0, "yüksek").when(score >= 60.0, "orta").otherwise("düşük")


def factor_level(unit: Column, resilience: bool = False) -> Column:
    """Concern level of a 0..1 factor; resilience has tighter edges."""
    first, second = (0.3, 0.6) if resilience else (0.4, 0.7)
    return F.when(unit.isNull(), "unknown").when(unit < first, "high").when(unit < second, "medium").otherwise("low")


def band_normalise(text: Column) -> Column:
    band = F.upper(F.trim(text))
    return F.when(band.isin("LOW", "MEDIUM", "HIGH"), band).otherwise("MEDIUM")


def band_override(band: Column, resilience: Column) -> Column:
    """A low band is raised when resilience is weak."""
    return F.when((band == "LOW") & (unit_if_above_one(resilience) < 0.3), "MEDIUM").otherwise(band)
