"""Pseudonymisation, masking and generalisation of identifying columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.numeric import round_even


def hash_id(value: Column, salt: str) -> Column:
    """Pseudonym under a secret salt."""
    return F.sha2(F.concat(value.cast("string"), F.lit(salt)), 256)


def hash_id_plain(value: Column) -> Column:
    """Unsalted hash of the text form, the first 60 bits of its MD5; the same in every process and engine."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 15), 16, 10).cast("bigint")


def mask_email(email: Column) -> Column:
    parts = F.split(email, "@")
    return F.when(
        email.contains("@"), F.concat(F.substring(parts[0], 1, 1), F.lit("***@"), parts[1])
    ).otherwise(email)


def mask_phone(phone: Column) -> Column:
    text = phone.cast("string")
    return (
        F.when(text.isNull(), text)
        .when(F.length(text) < 5, "****")
        .otherwise(F.concat(F.substring(text, 1, 2), F.lit("****"), F.right(text, F.lit(3))))
    )


def interval_text(value: Column, width: int) -> Column:
    """Text ``low-high`` of the fixed-width interval around a number (truncated to an integer first)."""
    low = F.floor(value.cast("bigint") / F.lit(float(width))).cast("bigint") * F.lit(width)
    return F.when(value.isNotNull(), F.concat(low.cast("string"), F.lit("-"), (low + F.lit(width)).cast("string")))


def generalise_age(age: Column) -> Column:
    return interval_text(age, 5)


def generalise_income(income: Column) -> Column:
    return interval_text(income, 10000)


def generalise_account_age(months: Column) -> Column:
    return interval_text(months, 60)


def generalise_spending(ratio: Column) -> Column:
    return round_even(ratio.cast("double"), 0)


def coarser_spending(ratio: Column) -> Column:
    return round_even(ratio, -1)


def coarser_income(interval: Column) -> Column:
    """Lower bound of an income interval, rounded down to a multiple of 20,000, as text."""
    low = F.split(interval, "-")[0].cast("double")
    return (F.floor(low / F.lit(20000.0)).cast("bigint") * F.lit(20000)).cast("string")
