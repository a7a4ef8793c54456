"""Incremental file ingestion with Structured Streaming.

A run takes the files that arrived since the last one and ends (``availableNow``); the checkpoint
makes every file count exactly once, also when a run dies half way.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.keys import with_ingestion_ts
from medalith.functions.names import col, normalize_names
from medalith.operators.dedupe import latest_per_key
from medalith.operators.evolve import fit_schema
from medalith.sources import buckets, storage
from medalith.sources.delimited import SOURCE_FILE, layouts, read_delimited
from medalith.sources.files import is_reader_error, literal_path, text_lines, usable_files
from medalith.sources.tables import read_path, write_table

RESCUED = "_rescued_data"
# Partition of a streamed table that holds the rows of one batch.
BATCH = "__batch"
_MARK = "_batch.json"
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def read_csv_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";", rescued: bool = False
) -> DataFrame:
    """Stream of the CSV files that appear in ``path``, with the columns of ``schema`` in this order.

    A file whose header differs fails the stream; ``ingest_stream_by_header`` takes such files. With
    ``rescued`` rows that do not fit the types keep their text in ``_rescued_data``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.readStream.option("header", True).option("sep", sep).option("enforceSchema", False)
    if rescued:
        schema = T.StructType(schema.fields + [T.StructField(RESCUED, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    return reader.schema(schema).csv(path)


def stamped(stream: DataFrame, from_filename: bool = True, normalize: bool = False) -> DataFrame:
    """Add ``ingestion_timestamp``, from the name of each row's file or the time of the batch."""
    file_name = F.col("_metadata.file_name")
    df = with_ingestion_ts(stream.select("*", file_name.alias("__file")), F.col("__file") if from_filename else None)
    df = df.drop("__file")
    return normalize_names(df) if normalize else df


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is new to a Parquet folder and return when it is written."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    sep: str = ";",
    normalize: bool = False,
    from_filename: bool = True,
    rescued: bool = False,
) -> None:
    stream = read_csv_stream(spark, path, schema, sep, rescued)
    append_stream(stamped(stream, from_filename, normalize), target, checkpoint)


def _fitted(rows: DataFrame, schema: T.StructType | str) -> DataFrame:
    """``fit_schema``, where the name of the file stays a column of its own."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [*declared.fields, T.StructField(SOURCE_FILE, T.StringType())]
    return fit_schema(rows, T.StructType(fields), RESCUED)


def _without(paths: list[str], others: list[str]) -> list[str]:
    """Paths that are not among the others, whatever scheme they are written with."""
    known = {re.sub("^file:/*", "/", f) for f in others}
    return [f for f in paths if re.sub("^file:/*", "/", f) not in known]


def ingest_stream_by_header(
    spark: SparkSession,
    path: str,
    root: str,
    layer: str,
    table: str,
    checkpoint: str,
    normalize: bool = False,
    from_filename: bool = True,
    schema: T.StructType | str | None = None,
    **options,
) -> None:
    """Append the CSV files that arrived in ``path`` to a table, by the header of each file.

    Columns may come in any order, be missing or be new; new ones are added to the table. The stream
    itself carries only file names; a batch reads its files with ``read_delimited`` and fills a
    partition of its own, so a batch that runs again after a failure takes its own place.

    With ``schema`` the table has these columns and ``_rescued_data``: a JSON object of the columns that the schema does
    not name and of the values that do not fit its types.

    A file without a header line, or one that cannot be read, does not stop the stream: it is entered with a reason in the
    table ``<table>_rejected`` and its batch goes on without it.
    """
    names = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", True).load(path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [literal_path(unquote(r.file_path)) for r in batch.select("file_path").distinct().collect()]
        if not files:
            return
        mark = F.lit(f"b{batch_id}")
        encoding = options.get("encoding", "auto")

        def rows_of(paths: list[str], groups: dict | None = None) -> DataFrame:
            return read_delimited(session, paths, keep_source=True, groups=groups, **options)

        def take(paths: list[str]) -> list[str]:
            """Append the rows of the files; returns those without a header."""
            groups, _ = layouts(session, paths, encoding, options.get("skip_rows", 0))
            headed = [f for group in groups.values() for f in group]
            if headed:
                rows = rows_of(headed, groups)
                name = F.regexp_extract(F.col(SOURCE_FILE), "[^/]*$", 0)
                if schema is not None:
                    rows = _fitted(rows, schema)
                rows = with_ingestion_ts(rows, name if from_filename else None).drop(SOURCE_FILE)
                rows = normalize_names(rows) if normalize else rows
                write_table(rows.withColumn(BATCH, mark), root, layer, table, partition_by=[BATCH], replace_partitions=True)
            return _without(paths, headed)

        broken: list[str] = []
        try:
            empty = take(files)
        except Exception as failure:
            if not is_reader_error(failure):
                raise
            good, broken = usable_files(lambda paths: text_lines(session, paths), files)
            if good and not broken:  # every line can be read, so the columns do not fit
                raise
            empty = take(good) if good else []
        rejected = [(f, "no header line") for f in empty] + [(f, "cannot be read") for f in broken]
        if rejected:
            entries = session.createDataFrame([(re.sub(r"\\(.)", r"\1", f), why) for f, why in rejected], "file_path string, reason string")
            write_table(entries.withColumn(BATCH, mark), root, layer, f"{table}_rejected", partition_by=[BATCH], replace_partitions=True)

    query = (
        names.select(F.col("_metadata.file_path").alias("file_path"))
        .writeStream.foreachBatch(write_batch)
        .queryName(f"files_{uuid.uuid4().hex[:8]}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_snapshot(spark: SparkSession, target: str) -> DataFrame | None:
    """The table an upsert stream maintains, as of its last finished batch."""
    return read_path(spark, target) if buckets.is_bucketed(spark, target) else None


def _finished_batch(spark: SparkSession, target: str, query: str) -> int:
    """The last batch of a query that the table holds, or -1."""
    path = f"{target}/{_MARK}"
    mark = json.loads(storage.read_text(spark, path)) if storage.exists(spark, path) else {}
    return mark["batch"] if mark.get("query") == query else -1


def upsert_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: list[str],
    newest: list[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    n_buckets: int = buckets.BUCKETS,
) -> None:
    """Keep the latest row per key of everything the stream has brought so far, in a table of key buckets.

    A batch rewrites the buckets that its keys fall into, and leaves a mark. A batch that runs again after a failure is
    skipped by its mark or merged again, which changes nothing. ``newest`` is compared with the stored row
    too: a late file does not undo a newer one. A null key is one key, within a batch and in the table.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        if _finished_batch(session, target, query) >= batch_id:
            return
        rows = latest_per_key(prepare(batch) if prepare else batch, keys, newest)
        if buckets.is_bucketed(session, target):
            buckets.merge(rows, target, newest)
        else:
            buckets.create(rows, target, keys, n_buckets, null_keys_match=True)
        storage.write_text(session, f"{target}/{_MARK}", json.dumps({"query": query, "batch": batch_id}))

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .queryName(f"upsert_{uuid.uuid4().hex[:8]}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
