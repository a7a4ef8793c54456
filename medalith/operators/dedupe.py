"""One row per key, chosen by a total order so that reruns and other engines agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalith.functions.names import col

ROW_ID = "source_row"


def row_order(df: DataFrame) -> list[Column]:
    """Tie-breakers: the row id where the table has one, else a hash of the whole row.

    Rows with the same hash are the same row for every practical purpose, so it does not matter
    which one is kept.
    """
    if ROW_ID in df.columns:
        return [col(ROW_ID).asc_nulls_last()]
    return [F.xxhash64(*[col(c) for c in df.columns]).asc()]


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of every key (null is a key too).

    ``row_number() = 1`` lets Catalyst place a group limit below the shuffle: every task sends at
    most one row per key, so a key that holds a third of the table costs no more than any other.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def latest_per_key(
    df: DataFrame,
    keys: list[str | Column],
    newest: list[str | Column],
    ties: list[Column] | None = None,
) -> DataFrame:
    """The row with the greatest ``newest`` columns per key; nulls count as oldest.

    ``newest`` entries that are Columns may carry their own order (for priorities).
    """
    key_columns = [col(k) if isinstance(k, str) else k for k in keys]
    order = [col(n).desc_nulls_last() if isinstance(n, str) else n for n in newest]
    return first_per_key(df, key_columns, order + (row_order(df) if ties is None else ties))


def first_occurrences(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Distinct rows by ``keys``, each at its first ``position``."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.min(col(position)).alias(position))
