"""Landed API responses: envelopes, plain lists and single objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.operators.quality import check_row

# Array names of the two response envelopes.
ENVELOPE_ARRAYS = ("results", "data")


def read_pages(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """Responses as they were landed. Pass ``schema`` at scale: without it Spark reads the pages
    twice, once to infer the types."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def page_records(pages: DataFrame, records_at: str | None = "auto") -> DataFrame:
    """Records of all pages: the elements of the envelope's array, or the rows themselves when the
    response was a list or a single object."""
    if records_at == "auto":
        arrays = {f.name for f in pages.schema.fields if isinstance(f.dataType, T.ArrayType)}
        records_at = next((a for a in ENVELOPE_ARRAYS if a in arrays), None)
    if records_at is None:
        return pages
    return pages.select(F.explode(col(records_at)).alias("record")).select("record.*")


def read_json_pages(
    spark: SparkSession,
    path: str | list[str],
    records_at: str | None = "auto",
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    return page_records(read_pages(spark, path, schema, multi_line), records_at)


def check_total(pages: DataFrame, records_at: str = "data") -> DataFrame:
    """Whether the pages hold as many records as ``meta.total`` announces."""
    counts = pages.agg(
        F.max("meta.total").cast("long").alias("announced"),
        F.coalesce(F.sum(F.greatest(F.size(col(records_at)), F.lit(0))), F.lit(0)).cast("long").alias("landed"),
    )
    return check_row(
        counts,
        name=F.lit("Landed records"),
        passed=F.col("announced").eqNullSafe(F.col("landed")),
        message=F.format_string("Announced: %d, landed: %d", "announced", "landed"),
        details=["announced", "landed"],
    )


# The two Corsican and five overseas departments.
OTHER_DEPARTMENTS = ("2A", "2B", "971", "972", "973", "974", "976")


def department_keys(spark: SparkSession) -> DataFrame:
    """The 101 department codes that the structure feed is fetched by."""
    number = F.col("id")
    metropolitan = spark.range(1, 96).filter(number != 20).select(F.lpad(number.cast("string"), 2, "0"))
    others = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in OTHER_DEPARTMENTS])))
    return metropolitan.union(others).toDF("departement")


def department_coverage(records: DataFrame, department: str = "departement") -> DataFrame:
    """Record count per department key, with the keys that brought nothing."""
    landed = records.groupBy(col(department).alias("departement")).agg(F.count(F.lit(1)).alias("n"))
    return (
        department_keys(records.sparkSession)
        .join(landed, "departement", "left")
        .select(
            "departement",
            F.coalesce("n", F.lit(0)).cast("long").alias("records"),
            F.col("n").isNotNull().alias("landed"),
        )
    )


def land_raw(records: DataFrame, raw_root: str, table: str, run_ts: str) -> str:
    """Write records as JSON below ``raw/api/<table>/<table>_<YYYYMMDD_HHMMSS>.json``."""
    path = f"{raw_root.rstrip('/')}/api/{table}/{table}_{run_ts}.json"
    records.write.json(path)
    return path
