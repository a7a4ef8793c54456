"""Processed-file ledger: which source files a pipeline has already ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalith.functions.keys import utc_now
from medalith.operators.lookup import missing

LEDGER_SCHEMA = (
    "pipeline_name string, file_path string, file_hash string, processed_at timestamp_ntz, "
    "status string, rows_processed long"
)


def processed_files(ledger: DataFrame, pipeline: str) -> DataFrame:
    done = (F.col("pipeline_name") == pipeline) & (F.col("status") == "success")
    return ledger.filter(done).select("file_path").distinct()


def new_files(files: DataFrame, ledger: DataFrame, pipeline: str) -> DataFrame:
    """Files without a successful entry of the pipeline: unseen ones, and failed ones again."""
    return missing(files, processed_files(ledger, pipeline), {"file_path": "file_path"})


def ledger_entries(files: DataFrame, pipeline: str) -> DataFrame:
    """Ledger rows for files (file_path, file_hash, status, rows_processed)."""
    return files.select(
        F.lit(pipeline).alias("pipeline_name"),
        "file_path",
        F.coalesce("file_hash", F.lit("")).alias("file_hash"),
        utc_now().alias("processed_at"),
        "status",
        F.col("rows_processed").cast("long").alias("rows_processed"),
    )


def cleared(ledger: DataFrame, pipeline: str) -> DataFrame:
    """The ledger without the rows of one pipeline."""
    return ledger.filter(~F.col("pipeline_name").eqNullSafe(F.lit(pipeline)))


def run_status(ledger: DataFrame) -> DataFrame:
    """Per pipeline: processed and failed files, rows, and ``partial`` as soon as one file failed."""
    ok = F.col("status") == "success"
    return ledger.groupBy("pipeline_name").agg(
        F.count_if(ok).alias("files_processed"),
        F.count_if(~ok).alias("files_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("rows_processed"))), F.lit(0)).alias("rows_processed"),
        F.when(F.count_if(~ok) > 0, F.lit("partial")).otherwise(F.lit("success")).alias("status"),
    )
