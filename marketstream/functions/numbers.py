"""Numeric helpers, all built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Text to double; malformed text gives null even in ANSI mode."""
    return text.try_cast("double")


def normalize_numeric(df: DataFrame, scales: Mapping[str, int]) -> DataFrame:
    """Null becomes 0.0, then each column is rounded to its number of decimals."""
    return df.withColumns(
        {name: F.round(F.coalesce(F.col(name), F.lit(0.0)), dp) for name, dp in scales.items()}
    )


def side_volume(side: Column, wanted: str, size: Column) -> Column:
    """``size`` where the row has the wanted side, 0 for any other or null side."""
    return F.when(side == wanted, size).otherwise(F.lit(0.0))


def ratio_or_null(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0.0))
