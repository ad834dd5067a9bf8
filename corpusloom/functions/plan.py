"""Keeping expensive expressions from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def where_computed(df: DataFrame, column: str, expression: Column, condition) -> DataFrame:
    """Add ``column`` and keep rows whose value meets ``condition``.

    A plain filter on a computed column is pushed below the projection, which
    then evaluates the expression once for the filter and once for the row.
    Filters do not pass a generator, so the value is handed through one.
    """
    rows = df.select("*", F.explode_outer(F.array(expression)).alias(column))
    return rows.where(condition(F.col(column)))
