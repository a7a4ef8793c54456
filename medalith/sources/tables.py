"""Layered Parquet tables at ``<root>/<layer>/<table>`` and their catalog.

The declared schema of a table lies beside its data in ``_schema.json``. Reading with it needs no footer
scan, and files written before a column existed return null for it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.operators.evolve import combined_schema, type_conflicts
from medalith.operators.preview import preview, table_schema
from medalith.operators.upsert import upsert, upsert_stats
from medalith.session import work_dir
from medalith.sources import buckets, storage

LAYERS = ("bronze", "silver", "gold")
# Partition columns with this prefix say where rows came from; they are no part of the table.
HIDDEN = "__"


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def table_exists(spark: SparkSession, root: str, layer: str, table: str) -> bool:
    return storage.exists(spark, table_path(root, layer, table))


def _schema_file(path: str) -> str:
    return f"{path}/_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    if not storage.exists(spark, _schema_file(path)):
        return None
    return T.StructType.fromJson(json.loads(storage.read_text(spark, _schema_file(path))))


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    storage.write_text(spark, _schema_file(path), schema.json())


def read_path(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    schema = stored_schema(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    shown = columns or [c for c in df.columns if not c.startswith(HIDDEN)]
    return df.select(*[col(c) for c in shown])


def read_table(
    spark: SparkSession, root: str, layer: str, table: str, columns: list[str] | None = None
) -> DataFrame:
    return read_path(spark, table_path(root, layer, table), columns)


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    on_conflict: str = "merge",
    replace_partitions: bool = False,
) -> str:
    """Append to a table or replace it; returns its path.

    ``append`` adds new columns to the table (null in older rows). When a column arrives with another
    type, ``on_conflict='merge'`` raises and ``'replace'`` replaces the table, losing its rows. With
    ``replace_partitions`` the append takes the place of the partitions it brings, so it can be repeated.
    ``overwrite`` writes the complete new folder first and swaps it in, so a plan may read the table
    that it replaces and a failed job leaves the old rows in place.
    """
    spark, path = df.sparkSession, table_path(root, layer, table)
    shown = T.StructType([f for f in df.schema.fields if not f.name.startswith(HIDDEN)])
    if mode == "append" and storage.exists(spark, path):
        current = stored_schema(spark, path) or read_path(spark, path).schema
        conflicts = type_conflicts(current, shown)
        if not conflicts:
            merged = combined_schema(current, shown)
            if merged != current:
                _store_schema(spark, path, merged)
            if replace_partitions:
                writer = _parquet(df, layer, partition_by).option("partitionOverwriteMode", "dynamic")
                writer.mode("overwrite").parquet(path)
            else:
                _parquet(df, layer, partition_by).mode("append").parquet(path)
            return path
        if on_conflict != "replace":
            raise TypeError(f"{layer}.{table}: other types for {conflicts}")
    # The leading underscore keeps an unfinished folder out of the catalog.
    staged = f"{root.rstrip('/')}/{layer}/_staged-{table}-{uuid.uuid4().hex[:12]}"
    _parquet(df, layer, partition_by).parquet(staged)
    _store_schema(spark, staged, combined_schema(T.StructType(), shown))
    storage.replace_folder(spark, staged, path)
    return path


def _parquet(df: DataFrame, layer: str, partition_by: list[str] | None):
    """Bronze, which holds most bytes, is packed tightly; Spark judges by file sizes what to broadcast, so the smaller layers keep theirs."""
    writer = df.write.option("compression", "zstd") if layer == "bronze" else df.write
    return writer.partitionBy(*partition_by) if partition_by else writer


def merge_table(
    source: DataFrame, root: str, layer: str, table: str, keys: list[str], **columns
) -> dict[str, int]:
    """Upsert ``source`` into a table and return the counts of updated and inserted rows.

    The source is stored first: the counts and the new table use it several times over. A table in buckets of these keys
    is merged bucket by bucket; any other one is written anew.
    """
    spark, schema = source.sparkSession, source.schema
    if buckets.is_bucketed(spark, table_path(root, layer, table)):
        stats = buckets.merge(source, table_path(root, layer, table), **columns)
        return {k: stats[k] for k in ("updated", "inserted", "deleted")}
    staged = work_dir(spark, f"merge-{table}")
    source.write.parquet(staged)
    source = spark.read.schema(schema).parquet(staged)
    if not table_exists(spark, root, layer, table):
        write_table(source, root, layer, table, "overwrite")
        return {"updated": 0, "inserted": read_table(spark, root, layer, table).count(), "deleted": 0}
    target = read_table(spark, root, layer, table)
    stats = upsert_stats(target, source, keys, columns.get("null_keys_match", False)).first().asDict()
    write_table(upsert(target, source, keys, **columns), root, layer, table, "overwrite")
    return stats


def register_layers(spark: SparkSession, root: str) -> list[str]:
    """Make every table queryable as ``<layer>_<table>``; returns the view names."""
    views = []
    for layer in LAYERS:
        for table in storage.child_folders(spark, f"{root}/{layer}"):
            view = f"{layer}_{table}"
            read_table(spark, root, layer, table).createOrReplaceTempView(view)
            views.append(view)
    return views


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """One row per table of every layer."""
    rows = [
        (layer, table, table_path(root, layer, table))
        for layer in LAYERS
        for table in storage.child_folders(spark, f"{root}/{layer}")
    ]
    return spark.createDataFrame(rows, "layer string, name string, path string")


def table_info(spark: SparkSession, root: str, layer: str, table: str) -> dict:
    """Path of a table, whether it exists, and the number of its data files."""
    path = table_path(root, layer, table)
    found = storage.exists(spark, path)
    files = read_path(spark, path).select("_metadata.file_path").distinct().count() if found else 0
    return {"path": path, "exists": found, "num_files": files}


def table_detail(
    spark: SparkSession, root: str, layer: str, table: str, preview_rows: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Schema rows of a table, and its first rows."""
    df = read_table(spark, root, layer, table)
    return table_schema(df), preview(df, preview_rows)


def row_counts(spark: SparkSession, root: str, layer: str, tables: list[str]) -> DataFrame:
    """Row count per table in one job; a table that does not exist gets a null count."""
    counts = None
    for table in tables:
        if table_exists(spark, root, layer, table):
            one = read_table(spark, root, layer, table).agg(F.count(F.lit(1)).alias("row_count"))
        else:
            one = spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        one = one.select(F.lit(table).alias("name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
