"""Upserts as joins. The source holds at most one row per key; a second one makes the merge fail.

Null keys match nothing, unless ``null_keys_match`` is set: then a null key equals a null key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalith.functions.names import col


def incomplete(keys: list[str]) -> Column:
    """Whether a key column is null."""
    return reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])


def _null_spread(df: DataFrame, keys: list[str]) -> Column:
    """Null keys would all land in one shuffle partition; they are spread over a few join keys per
    partition instead. Rows with a complete key all share the value 0."""
    spread = 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.xxhash64(*[col(c) for c in df.columns])
    return F.when(incomplete(keys), F.pmod(row_hash, F.lit(spread)).cast("int")).otherwise(F.lit(0))


def single_rows(source: DataFrame, keys: list[str], null_keys_match: bool = False) -> DataFrame:
    """The source as it is; the job fails when two of its rows share a key that can match."""
    spread = F.lit(0) if null_keys_match else _null_spread(source, keys)
    counted = source.withColumn("__spread", spread)
    same_key = Window.partitionBy(*[col(k) for k in keys], "__spread")
    counted = counted.withColumn("__rows", F.count(F.lit(1)).over(same_key))
    matching = F.lit(True) if null_keys_match else ~incomplete(keys)
    failure = F.raise_error(F.lit("two source rows for one key"))
    checked = F.when(matching & (F.col("__rows") > 1), failure.cast("boolean")).otherwise(F.lit(True))
    return counted.filter(checked).drop("__rows", "__spread")


def _side(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.select(
        F.struct(*[col(c) for c in df.columns]).alias(name),
        *[col(k).alias(f"__{name}_{i}") for i, k in enumerate(keys)],
        _null_spread(df, keys).alias(f"__{name}_spread"),
    )


def _same_key(keys: list[str], null_keys_match: bool = False) -> list[Column]:
    if null_keys_match:
        return [F.col(f"__t_{i}").eqNullSafe(F.col(f"__s_{i}")) for i in range(len(keys))]
    equal = [F.col(f"__t_{i}") == F.col(f"__s_{i}") for i in range(len(keys))]
    return [*equal, F.col("__t_spread") == F.col("__s_spread")]


def _keys_of(df: DataFrame, keys: list[str], name: str, *more: str) -> DataFrame:
    kept = [F.col(name).getField(m).alias(m) for m in more]
    return _side(df, keys, name).select(*kept, *[f"__{name}_{i}" for i in range(len(keys))], f"__{name}_spread")


def unmatched(target: DataFrame, source: DataFrame, keys: list[str], null_keys_match: bool = False) -> DataFrame:
    """Source rows whose keys the target lacks.

    The target's keys are first narrowed to those the source has: when the source is small enough to
    be broadcast, the target is scanned for its key columns and never shuffled.
    """
    same = _same_key(keys, null_keys_match)
    matched = _keys_of(target, keys, "t").join(_keys_of(source, keys, "s"), same, "left_semi")
    return _side(source, keys, "s").join(matched, same, "left_anti").select("s.*")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    insert_cols: list[str] | None = None,
    null_keys_match: bool = False,
) -> DataFrame:
    """Target rows updated from the source row with the same keys, plus the unmatched source rows.

    ``update_cols`` are the columns a match overwrites and ``insert_cols`` the ones a new row fills
    (default: every source column). Target columns outside the lists keep their value on a match and
    are null in a new row; source columns the target lacks are added to it.
    """
    source = single_rows(source, keys, null_keys_match)
    source_names = set(source.columns)
    updates = set(source.columns if update_cols is None else update_cols) & source_names
    inserts = set(source.columns if insert_cols is None else insert_cols) & source_names | set(keys)
    columns = target.columns + [c for c in source.columns if c not in target.columns and c in updates | inserts]
    types = {f.name: f.dataType for f in [*source.schema.fields, *target.schema.fields]}

    def updated(name: str) -> Column:
        kept = F.col("t").getField(name) if name in target.columns else F.lit(None)
        if name in updates and name not in keys:
            kept = F.when(F.col("s").isNotNull(), F.col("s").getField(name)).otherwise(kept)
        return kept.cast(types[name]).alias(name)

    def inserted(name: str) -> Column:
        return (col(name) if name in inserts else F.lit(None)).cast(types[name]).alias(name)

    old = _side(target, keys, "t").join(_side(source, keys, "s"), _same_key(keys, null_keys_match), "left")
    new = unmatched(target, source, keys, null_keys_match)
    return old.select(*[updated(c) for c in columns]).unionByName(new.select(*[inserted(c) for c in columns]))


def replace_matching(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a source row of the same keys, then the whole source. A null key equals a
    null key here."""
    side = source.select(*[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)])
    condition = [col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    kept = target.join(side, condition, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def not_older(source: DataFrame, target: DataFrame, keys: list[str], newest: list[str], null_keys_match: bool = False) -> DataFrame:
    """Source rows whose key has no newer row in the target, by the columns ``newest``."""
    order = F.struct(*[col(n) for n in newest])
    stored = _keys_of(target.withColumn("__order", order), keys, "t", "__order")
    newer = F.col("__order") > F.col("__new_order")
    rows = _side(source, keys, "s").withColumn("__new_order", F.struct(*[F.col("s").getField(n) for n in newest]))
    return rows.join(stored, [*_same_key(keys, null_keys_match), newer], "left_anti").select("s.*")


def upsert_stats(target: DataFrame, source: DataFrame, keys: list[str], null_keys_match: bool = False) -> DataFrame:
    """One row: how many pairs update, how many source rows are inserted, and 0 deleted."""
    pairs = _keys_of(target, keys, "t").join(_keys_of(source, keys, "s"), _same_key(keys, null_keys_match))
    counts = pairs.agg(F.count(F.lit(1)).alias("updated"), F.lit(0).cast("long").alias("inserted")).unionByName(
        unmatched(target, source, keys, null_keys_match).agg(F.lit(0).cast("long").alias("updated"), F.count(F.lit(1)).alias("inserted"))
    )
    return counts.agg(
        F.sum("updated").alias("updated"), F.sum("inserted").alias("inserted"), F.lit(0).cast("long").alias("deleted")
    )
