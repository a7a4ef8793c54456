"""Bronze ingestion: source files and landed API pages to raw tables.

Each reader takes paths and returns one frame over all of them; ``ingest_files`` runs a reader over
the files that the ledger does not know yet.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.functions import names
from medalith.functions.keys import with_ingestion_ts
from medalith.operators import ledger as ledgers
from medalith.operators.evolve import type_conflicts
from medalith.operators.nested import arrays_to_json, explode_children, flatten_structs
from medalith.sources import storage
from medalith.sources.delimited import SOURCE_FILE, read_delimited
from medalith.sources.files import is_reader_error, list_source_files, literal_path, text_fingerprints, usable_files
from medalith.sources.json_pages import page_records, read_json_pages, read_pages
from medalith.sources.tables import read_table, table_exists, table_path, write_table

# Code columns that stay text, and preamble lines of the area file.
STATION_TEXT_COLUMNS = ["code_uic", "code_ligne", "idreseau"]
LINE_TEXT_COLUMNS = ["code_ligne"]
AREA_PREAMBLE_ROWS = 5
FLATTEN_LEVELS = 2

LEDGER_TABLE = "checkpoints"
# Partition of a bronze table that holds the rows of one source file.
SOURCE_KEY = "__source_key"


def accueillants(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    df = names.underscore_spaces(read_delimited(spark, paths, **options))
    return with_ingestion_ts(df)


def geo(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    return with_ingestion_ts(read_delimited(spark, paths, encoding="UTF-8", **options))


def logement(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Rent files of several years and encodings; the time comes from the name of each file."""
    keep = options.pop("keep_source", False)
    df = read_delimited(spark, paths, sep=";", keep_source=True, **options)
    # no pattern here: this runs once a row, and one for the end of a path is tried at each of its letters
    file_name = F.substring_index(F.col(SOURCE_FILE), "/", -1)
    df = with_ingestion_ts(df, file_name)
    return df if keep else df.drop(SOURCE_FILE)


def zones_attraction(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    return with_ingestion_ts(read_delimited(spark, paths, skip_rows=AREA_PREAMBLE_ROWS, **options))


def gares(spark: SparkSession, path: str, **options) -> DataFrame:
    df = names.normalize_names(read_json_pages(spark, path, **options))
    return with_ingestion_ts(names.cast_to_text(df, STATION_TEXT_COLUMNS))


def lignes(spark: SparkSession, path: str, **options) -> DataFrame:
    df = names.normalize_names(read_json_pages(spark, path, **options))
    df = names.cast_to_text(df, LINE_TEXT_COLUMNS)
    return with_ingestion_ts(arrays_to_json(df, ["geo_shape_coordinates"]))


def siae_structures(spark: SparkSession, path: str, **options) -> DataFrame:
    return with_ingestion_ts(flatten_structs(read_json_pages(spark, path, **options), max_level=FLATTEN_LEVELS))


def siae_postes(spark: SparkSession, path: str, **options) -> DataFrame:
    postings = explode_children(
        read_json_pages(spark, path, **options), "postes", {"id": "structure_id", "siret": "structure_siret"}
    )
    return with_ingestion_ts(flatten_structs(postings, max_level=FLATTEN_LEVELS))


def open_data(spark: SparkSession, path: str, **options) -> DataFrame:
    return with_ingestion_ts(names.strip_name_quotes(page_records(read_pages(spark, path, **options))))


FILE_READERS: dict[str, Callable[..., DataFrame]] = {
    "accueillants": accueillants,
    "geo": geo,
    "logement": logement,
    "zones_attraction": zones_attraction,
}
API_READERS: dict[str, Callable[..., DataFrame]] = {
    "gares": gares,
    "lignes": lignes,
    "siae_structures": siae_structures,
    "siae_postes": siae_postes,
}


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{LEDGER_TABLE}"
    if storage.exists(spark, path):
        return spark.read.schema(ledgers.LEDGER_SCHEMA).parquet(path).drop("run")
    return spark.createDataFrame([], ledgers.LEDGER_SCHEMA)


def append_ledger(entries: DataFrame, root: str) -> DataFrame:
    """Add the entries of one run, in a folder of their own; returns them as they are stored."""
    path = f"{root}/{LEDGER_TABLE}/run={uuid.uuid4().hex[:12]}"
    entries.write.parquet(path)
    return entries.sparkSession.read.schema(ledgers.LEDGER_SCHEMA).parquet(path)


def clear_ledger(spark: SparkSession, root: str, pipeline: str) -> None:
    """Forget one pipeline: the remaining rows are written aside and swapped in."""
    live = f"{root}/{LEDGER_TABLE}"
    if storage.exists(spark, live):
        staged = f"{live}-staged-{uuid.uuid4().hex[:12]}"
        ledgers.cleared(read_ledger(spark, root), pipeline).write.parquet(f"{staged}/run=kept")
        storage.replace_folder(spark, staged, live)


def ingest_files(
    spark: SparkSession,
    root: str,
    pipeline: str,
    source: str,
    read: Callable[..., DataFrame] | None = None,
    force: bool = False,
    layer: str = "bronze",
) -> DataFrame:
    """Add the new files below ``source`` to the table ``pipeline`` and enter them in the ledger.

    All good files are written by one job. Each file fills a partition of its own, and writing a file
    again takes that partition's place: a run that dies before its ledger entries, the last thing
    written, can be repeated without doubling a row. With ``force`` every file is read again and the
    table is replaced; the ledger is cleared once the new table stands.

    Files that cannot be read, or whose columns have other types than the table's, are found by
    halving the batch, entered as failed and tried again on the next run; they never touch the table.
    Returns one status row.
    """
    read = read or FILE_READERS[pipeline]
    listed = list_source_files(spark, source)
    fresh = listed if force else ledgers.new_files(listed, read_ledger(spark, root), pipeline)
    paths = [literal_path(unquote(r.file_path)) for r in fresh.select("file_path").orderBy("file_path").collect()]
    if not paths:
        return _status(spark.createDataFrame([], "status string, rows_processed long"), pipeline)

    def rows_of(batch: list[str]) -> DataFrame:
        rows = read(spark, batch, keep_source=True)
        if not force and table_exists(spark, root, layer, pipeline):
            conflicts = type_conflicts(read_table(spark, root, layer, pipeline).schema, rows.drop(SOURCE_FILE).schema)
            if conflicts:
                raise TypeError(f"{layer}.{pipeline}: other types for {conflicts}")
        return rows

    def write(batch: list[str]) -> None:
        rows = rows_of(batch).withColumn(SOURCE_KEY, F.md5(SOURCE_FILE)).drop(SOURCE_FILE)
        write_table(rows, root, layer, pipeline, "overwrite" if force else "append", [SOURCE_KEY], replace_partitions=True)

    bad: list[str] = []
    try:
        write(paths)
    except Exception as failure:
        if not is_reader_error(failure):
            raise  # a full disk or a lost executor says nothing about the files
        good, bad = usable_files(rows_of, paths)
        if good:
            write(good)
    if force and len(bad) < len(paths):
        clear_ledger(spark, root, pipeline)
    entries = _entries(spark, paths, bad, _rows_by_file(spark, root, layer, pipeline))
    return _status(append_ledger(ledgers.ledger_entries(entries, pipeline), root), pipeline)


def _rows_by_file(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Rows of each file's partition: counted in the footers, no column is read."""
    path = table_path(root, layer, table)
    if not storage.exists(spark, path):
        return spark.createDataFrame([], f"{SOURCE_KEY} string, rows_processed long")
    stored = spark.read.schema(f"{SOURCE_KEY} string").parquet(path)
    return stored.groupBy(SOURCE_KEY).agg(F.count(F.lit(1)).alias("rows_processed"))


def _entries(spark: SparkSession, paths: list[str], bad: list[str], counts: DataFrame) -> DataFrame:
    listed = list_source_files(spark, paths).withColumn(SOURCE_KEY, F.md5("file_path"))
    good = [p for p in paths if p not in set(bad)]
    hashed = text_fingerprints(spark, good) if good else spark.createDataFrame([], "file_path string, file_hash string")
    failed = spark.createDataFrame([(p,) for p in bad], "path string")
    failed = failed.select(F.regexp_replace("path", r"\\(.)", "$1").alias("path"), F.lit(True).alias("is_bad"))
    # a file without rows has neither a partition nor lines to hash
    return (
        listed.join(counts, SOURCE_KEY, "left")
        .join(hashed, "file_path", "left")
        .join(failed, F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))) == F.col("path"), "left")
        .withColumns(
            {
                "status": F.when(F.col("is_bad"), "failed").otherwise("success"),
                "rows_processed": F.when(F.col("is_bad"), 0).otherwise(F.coalesce("rows_processed", F.lit(0))),
            }
        )
    )


def _status(entries: DataFrame, pipeline: str) -> DataFrame:
    failed = F.count_if(F.col("status") == "failed")
    return entries.agg(
        F.lit(pipeline).alias("pipeline_name"),
        F.count_if(F.col("status") == "success").alias("files_processed"),
        failed.alias("files_failed"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).cast("long").alias("rows_processed"),
        F.when(failed > 0, "partial").otherwise("success").alias("status"),
    )


def refresh_api_table(
    spark: SparkSession,
    root: str,
    pipeline: str,
    landed: str,
    read: Callable[..., DataFrame],
    force: bool = False,
    **options,
) -> str:
    """Replace a table from landed pages; a table that already holds rows is left alone unless forced."""
    if not force and table_exists(spark, root, "bronze", pipeline):
        if not read_table(spark, root, "bronze", pipeline).isEmpty():
            return "skipped"
    write_table(read(spark, landed, **options), root, "bronze", pipeline, "overwrite")
    return "success"


def latest_landed(spark: SparkSession, raw_root: str, table: str) -> str | None:
    """Newest ``<table>_<timestamp>.json`` folder or file below ``raw/api/<table>``."""
    base = f"{raw_root.rstrip('/')}/api/{table}"
    folders = [f for f in storage.child_folders(spark, base) if f.endswith(".json")]
    if folders:
        return f"{base}/{folders[-1]}"
    if not storage.exists(spark, base):
        return None
    newest = list_source_files(spark, base).filter(F.col("file_path").endswith(".json")).agg(F.max("file_path"))
    return newest.first()[0]


def ingest_resources(
    spark: SparkSession, root: str, resources: list[dict], force: bool = True, **options
) -> DataFrame:
    """Refresh one table ``open_data_<name>`` per configured resource (name, path).

    A resource that fails does not stop the others. One row per resource; ``run_summary`` adds them up.
    """
    rows = []
    for resource in resources:
        name = resource.get("name") or resource["resource_id"]
        try:
            refresh_api_table(spark, root, f"open_data_{name}", resource["path"], open_data, force, **options)
            rows.append((name, "success", ""))
        except Exception as error:
            rows.append((name, "failed", type(error).__name__))
    return spark.createDataFrame(rows, "resource string, status string, error string")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: processed, successful and failed resources, and ``partial`` when any failed."""
    failed = F.count_if(F.col("status") == "failed")
    return results.agg(
        F.count(F.lit(1)).alias("resources_processed"),
        F.count_if(F.col("status") == "success").alias("resources_success"),
        failed.alias("resources_failed"),
        F.when(failed > 0, "partial").otherwise("success").alias("status"),
    )
