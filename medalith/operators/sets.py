"""Distinct values and differences between value sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalith.functions.names import col
from medalith.operators.quality import value_sides


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of a column, each once."""
    return df.select(col(column)).filter(col(column).isNotNull()).distinct()


def differences(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Values that only one of two columns has, with the side that has them."""
    side = F.when(F.col("right_rows") == 0, "left").when(F.col("left_rows") == 0, "right")
    return value_sides(left, left_column, right, right_column).select("value", side.alias("only_in")).filter(
        F.col("only_in").isNotNull()
    )
