"""Parquet tables kept in buckets of a key, so that a merge rewrites only the buckets its source meets.

The bucket is a hash of the key columns and a partition of the table; number and keys lie beside the data in ``_buckets.json``.
A merge reads the buckets that hold a key of the source, stores their new rows, and puts them in the place of the old ones by a
dynamic partition overwrite. Its cost follows the source, not the table. Merging the same source again changes nothing, so a
merge that died half way is repeated.

Rows with a null key, which match nothing, are spread over the buckets by a hash of the row; where null keys may match
(``null_keys_match``), null is one key.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.operators.evolve import combined_schema, type_conflicts
from medalith.operators.upsert import incomplete, not_older, upsert, upsert_stats
from medalith.session import work_dir
from medalith.sources import storage

BUCKET = "__bucket"
BUCKETS = 64


def _layout_file(path: str) -> str:
    return f"{path}/_buckets.json"


def _schema_file(path: str) -> str:
    return f"{path}/_schema.json"


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, _layout_file(path))


def _bucket(df: DataFrame, keys: list[str], buckets: int, null_keys_match: bool) -> Column:
    of_key = F.xxhash64(*[col(k) for k in keys])
    if not null_keys_match:
        of_key = F.when(incomplete(keys), F.xxhash64(*[col(c) for c in df.columns])).otherwise(of_key)
    return F.pmod(of_key, F.lit(buckets)).cast("int")


def _put(rows: DataFrame, path: str) -> None:
    """Write rows with their buckets in the place of these buckets; a large bucket may become several files."""
    even = rows.hint("rebalance", F.col(BUCKET))
    even.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(BUCKET).parquet(path)


def create(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS, null_keys_match: bool = False) -> None:
    """A new bucketed table from rows with at most one row per key; what lies at ``path`` goes."""
    spark = df.sparkSession
    storage.remove_folder(spark, path)
    _put(df.withColumn(BUCKET, _bucket(df, keys, buckets, null_keys_match)), path)
    storage.write_text(spark, _schema_file(path), combined_schema(T.StructType(), df.schema).json())
    # written last: without it the folder is no table
    storage.write_text(spark, _layout_file(path), json.dumps({"keys": keys, "buckets": buckets, "null_keys_match": null_keys_match}))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table with the bucket of each row."""
    schema = T.StructType.fromJson(json.loads(storage.read_text(spark, _schema_file(path))))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def merge(source: DataFrame, path: str, newest: list[str] | None = None, **columns) -> dict[str, int]:
    """Upsert ``source`` into a bucketed table by its keys; counts of updated and inserted rows and of rewritten buckets.

    With ``newest`` a source row is left out when the stored row of its key is newer by these columns. ``update_cols`` and
    ``insert_cols`` are those of ``upsert``. New columns are added to the table; a column of another type raises.
    """
    spark = source.sparkSession
    layout = json.loads(storage.read_text(spark, _layout_file(path)))
    keys, buckets, nulls = layout["keys"], layout["buckets"], layout["null_keys_match"]
    stored = read(spark, path)
    table_schema = T.StructType([f for f in stored.schema.fields if f.name != BUCKET])
    types = {f.name: f.dataType for f in table_schema.fields}
    source = source.withColumns({k: col(k).cast(types[k]) for k in keys})  # equal keys of two types have one bucket
    conflicts = type_conflicts(table_schema, source.schema)
    if conflicts:
        raise TypeError(f"{path}: other types for {conflicts}")

    staged = work_dir(spark, "merge-source")
    source.withColumn(BUCKET, _bucket(source, keys, buckets, nulls)).write.parquet(staged)
    source = spark.read.schema(T.StructType([*source.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(staged)
    met = [r[BUCKET] for r in source.select(BUCKET).distinct().collect()]  # at most the number of buckets
    if not met:
        return {"updated": 0, "inserted": 0, "deleted": 0, "buckets": 0}
    target = stored.where(F.col(BUCKET).isin(met))
    if newest:
        source = not_older(source, target, keys, newest, nulls)
    stats = upsert_stats(target, source, keys, nulls).first().asDict()
    listed = {k: [*v, BUCKET] for k, v in columns.items() if v is not None}
    merged = upsert(target, source, keys, null_keys_match=nulls, **listed)
    result = work_dir(spark, "merge-result")
    merged.write.parquet(result)

    schema = combined_schema(table_schema, T.StructType([f for f in merged.schema.fields if f.name != BUCKET]))
    if schema != table_schema:
        storage.write_text(spark, _schema_file(path), schema.json())
    _put(spark.read.schema(merged.schema).parquet(result), path)
    for folder in (staged, result):
        storage.remove_folder(spark, folder)
    return stats | {"buckets": len(met)}
