"""Dimension lookups and name matching.

No join here carries a broadcast hint. Spark broadcasts a dimension when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (statically, or at run time from the finished shuffle) and
otherwise sort-merges, splitting hot keys of the larger side with the adaptive skew join.
``prefix_matches`` always sort-merges: neither side of its joins is a dimension of a known size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.functions import values
from medalith.functions.names import col


def look_up(
    df: DataFrame,
    dimension: DataFrame,
    on: Column,
    dimension_key: str,
    take: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Bring ``take`` (dimension column -> new name) from the row whose ``dimension_key`` equals ``on``."""
    side = dimension.select(
        col(dimension_key).alias("__dim_key"), *[col(c).alias(name) for c, name in take.items()]
    )
    return df.join(side, on == F.col("__dim_key"), how).drop("__dim_key")


def arrondissements(spark: SparkSession) -> DataFrame:
    """Mapping table (arrondissement_code, commune_code) of the 45 city arrondissements."""
    frames = [
        spark.range(first, last + 1).select(
            F.col("id").cast("string").alias("arrondissement_code"), F.lit(commune).alias("commune_code")
        )
        for first, last, commune in values.ARRONDISSEMENT_RANGES
    ]
    return reduce(DataFrame.unionByName, frames)


def map_arrondissements(df: DataFrame, code: str, name: str) -> DataFrame:
    """``name``: the commune of an arrondissement code by the mapping table, other codes unchanged."""
    found = look_up(df, arrondissements(df.sparkSession), col(code), "arrondissement_code", {"commune_code": "__commune"})
    return found.withColumn(name, F.coalesce("__commune", col(code))).drop("__commune")


def matching(df: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose keys (column -> column of ``other``) occur in ``other``."""
    return _membership(df, other, keys, "left_semi")


def missing(df: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``other``; a null key never occurs."""
    return _membership(df, other, keys, "left_anti")


def _membership(df: DataFrame, other: DataFrame, keys: dict[str, str], how: str) -> DataFrame:
    side = other.select(*[col(o).alias(f"__key_{i}") for i, o in enumerate(keys.values())])
    condition = [col(k) == F.col(f"__key_{i}") for i, k in enumerate(keys)]
    return df.join(side, condition, how)


def prefix_matches(
    left: DataFrame, right: DataFrame, text: str, block: str, prefix: str, right_block: str
) -> DataFrame:
    """Pairs of ``left`` and ``right`` rows where ``left.text`` equals ``right.prefix``, or starts with
    it while the blocks are equal.

    Written as one equality join per case instead of an OR condition, which only a nested loop could
    run. The left texts are first reduced to distinct (text, block) pairs and each is expanded to its
    own prefixes, so the work grows with the length of a name and never with the size of a block.

    The joins are merge joins by hint: Spark does not count the rows that the prefixes add, so it would send
    them through the driver as a broadcast where the files of the base table are small.
    """
    wanted = left.select(col(text).alias("__text"), col(block).alias("__block")).distinct()
    names = right.withColumns({"__prefix": col(prefix), "__right_block": col(right_block)}).hint("merge")
    equal = wanted.join(names, F.col("__text") == F.col("__prefix"))
    prefixes = wanted.filter(F.col("__block").isNotNull() & (F.length("__text") > 0)).select(
        "__text",
        "__block",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("__text") - 1),
                lambda n: F.substring(F.col("__text"), F.lit(1), n),
            )
        ).alias("__start"),
    )
    longer = prefixes.join(
        names,
        (F.col("__start") == F.col("__prefix")) & (F.col("__block") == F.col("__right_block")),
    ).drop("__start")
    pairs = equal.unionByName(longer).drop("__prefix", "__right_block")
    pairs = pairs.withColumnsRenamed({"__text": "__pair_text", "__block": "__pair_block"})
    return left.join(
        pairs.hint("merge"),
        (col(text) == F.col("__pair_text")) & col(block).eqNullSafe(F.col("__pair_block")),
        "left",
    ).drop("__pair_text", "__pair_block")
