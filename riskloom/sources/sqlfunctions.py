"""Lookups as SQL functions of a session, for use inside any statement.

Each function is a SQL expression over a view, so a call per row is planned as one join of the two tables, and a
call in a filter likewise; nothing runs once per row.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}")

NOT_FOUND = '{"error":"customer_not_found"}'


def register_functions(spark: SparkSession, features: str) -> None:
    """Register the functions over a view or table with customer_id, risk_score and risk_band, one row per customer.

    ``calculate_risk_score(id)``, also as ``risk_score_of(id)``: the stored score, 0 where there is none.
    ``explain_customer(id)``: a JSON text with id, score and band (fields without a value are left out), or an error text for an
    unknown customer. ``customers_in_band(band)``: a table of customer_id and risk_score.
    Registering again, over another view, replaces them.
    """
    if not _PLAIN.fullmatch(features):
        raise ValueError(f"not a plain table name: {features}")
    one = f"FROM {features} WHERE customer_id = _customer_id"
    for name in ("calculate_risk_score", "risk_score_of"):
        _function(spark, f"{name}(_customer_id BIGINT) RETURNS DOUBLE RETURN coalesce((SELECT max(risk_score) {one}), 0D)")
    record = "to_json(named_struct('customer_id', customer_id, 'risk_score', risk_score, 'risk_band', risk_band))"
    _function(spark, f"explain_customer(_customer_id BIGINT) RETURNS STRING RETURN coalesce((SELECT max({record}) {one}), '{NOT_FOUND}')")
    _function(
        spark,
        "customers_in_band(_band STRING) RETURNS TABLE(customer_id BIGINT, risk_score DOUBLE) "
        f"RETURN SELECT customer_id, risk_score FROM {features} WHERE risk_band = _band",
    )


def _function(spark: SparkSession, text: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
