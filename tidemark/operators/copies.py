"""Rows that are alike, taken as one, so that dear functions see each value once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(rows: DataFrame, columns: list[str], *aggregates: Column) -> DataFrame:
    """Distinct ``columns`` with ``aggregates`` over their copies.

    Values come out of the aggregate and not out of its keys: filters on what is parsed from them then stay behind it,
    where the optimizer would take those on keys back to all rows.
    """
    return rows.groupBy(*[F.col(c).alias(f"_{c}") for c in columns]).agg(*[F.max(c).alias(c) for c in columns], *aggregates).drop(*[f"_{c}" for c in columns])
