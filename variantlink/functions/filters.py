"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_not_in(df: DataFrame, column: str, allowed: Sequence, other: str, excluded: Sequence) -> DataFrame:
    """Rows whose ``column`` is allowed and whose ``other`` is known and not excluded."""
    return df.where(F.col(column).isin([*allowed]) & ~F.col(other).isin([*excluded]))


def any_evidence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in one of the columns at least."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))


def not_nan(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not NaN; null stays."""
    return df.where(~F.isnan(column))


def table_stats(df: DataFrame, column: str, known: Sequence) -> DataFrame:
    """One row: how many rows have a known value, and how many there are."""
    return df.agg(F.count_if(F.col(column).isin([*known])).alias("known_rows"), F.count("*").alias("total_rows"))
