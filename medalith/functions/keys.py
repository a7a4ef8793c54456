"""Surrogate keys, audit columns and ingestion timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalith.functions.names import col
from medalith.functions.values import AUDIT_COLUMNS


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts written one after another; a null part adds nothing.

    A single null part gives a null key, as hashing a null does.
    """
    if len(parts) == 1:
        return F.md5(parts[0].cast("string"))
    return F.md5(F.concat_ws("", *[p.cast("string") for p in parts]))


def with_surrogate_key(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    return df.withColumn(name, surrogate_key(*[col(c) for c in columns]))


def utc_now() -> Column:
    """Start time of the query as a zone-less UTC timestamp."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def with_audit(df: DataFrame, job_id: str) -> DataFrame:
    insert_id, insert_date, modify_id, modify_date = AUDIT_COLUMNS
    return df.withColumns(
        {
            insert_id: F.lit(job_id),
            insert_date: utc_now(),
            modify_id: F.lit(job_id),
            modify_date: utc_now(),
        }
    )


def file_timestamp(file_name: Column) -> Column:
    """``…_YYYYMMDD_HHMMSS…`` in a file name as a timestamp, null when absent or not a date."""
    text = F.regexp_extract(file_name, r"_(\d{8}_\d{6})", 1)
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def with_ingestion_ts(df: DataFrame, file_name: Column | None = None) -> DataFrame:
    """Add ``ingestion_timestamp``: from the file name when one is given and dated, else now."""
    now = utc_now()
    value = now if file_name is None else F.coalesce(file_timestamp(file_name), now)
    return df.withColumn("ingestion_timestamp", value)
