"""Table preview, schema listing and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.functions.text import plain_double_text
from medalith.session import work_dir

Filter = tuple[str, str, object]  # column, operator, value

_RANGES = {">": Column.__gt__, "<": Column.__lt__, ">=": Column.__ge__, "<=": Column.__le__}


#: Up to this many rows a page is cut from a top-k, which keeps that many rows in each task.
DEEP_PAGE = 10_000

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _same_kind(data_type: T.DataType, value: object) -> bool:
    if isinstance(value, str):
        return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType, *_TIMES))
    if isinstance(value, bool):
        return isinstance(data_type, (T.BooleanType, T.NumericType))
    if isinstance(value, (int, float)):
        return isinstance(data_type, (T.NumericType, T.BooleanType))
    return True


def _as_text(c: Column, data_type: T.DataType) -> Column:
    return plain_double_text(c) if isinstance(data_type, T.DoubleType) else c.cast("string")


def filter_condition(df: DataFrame, column: str, operator: str, value: object) -> Column | None:
    """Condition of one preview filter, or None when the filter has to be ignored.

    A text never equals a number, but is read as a date or time where the column is one; ``!=`` keeps nulls, ``contains`` is a case-insensitive regular
    expression on the text of the value, and the range operators read their value as a number and
    apply to numeric columns only; NaN is in no range.
    """
    if column not in df.columns:
        return None
    c, data_type = col(column), df.schema[column].dataType
    if operator in ("=", "!="):
        if not _same_kind(data_type, value):
            return F.lit(operator == "!=")
        wanted = F.lit(value)
        if isinstance(value, str) and isinstance(data_type, _TIMES):
            wanted = wanted.try_cast(data_type)
        equal = c.eqNullSafe(wanted) & c.isNotNull()
        return equal if operator == "=" else ~equal
    if operator == "contains":
        return F.coalesce(_as_text(c, data_type).rlike(f"(?i){value}"), F.lit(False))
    if operator in _RANGES:
        try:
            bound = float(value)
        except (TypeError, ValueError):
            return None
        if isinstance(data_type, T.BooleanType):
            c = c.cast("int")
        elif not isinstance(data_type, T.NumericType):
            return None
        inside = _RANGES[operator](c, F.lit(bound))
        if isinstance(data_type, (T.DoubleType, T.FloatType)):
            inside &= ~F.isnan(c)
        return inside & F.lit(bound == bound)
    return None


def filtered(df: DataFrame, filters: Iterable[Filter] = ()) -> DataFrame:
    result = df
    for column, operator, value in filters:
        condition = filter_condition(df, column, operator, value)
        if condition is not None:
            result = result.filter(condition)
    return result


def preview(
    df: DataFrame,
    limit: int = 100,
    filters: Iterable[Filter] = (),
    sort_by: str | list[str] | None = None,
    sort_order: str = "asc",
) -> DataFrame:
    """Filtered rows, sorted with nulls last in either direction, first ``limit`` only.

    An unknown filter or sort column is ignored. Sort and limit together are one top-k, which keeps
    ``limit`` rows per task.
    """
    result = filtered(df, filters)
    names = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    ascending = sort_order.lower() == "asc"
    order = [col(n).asc_nulls_last() if ascending else col(n).desc_nulls_last() for n in names if n in df.columns]
    return (result.orderBy(*order) if order else result).limit(limit)


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0, deep: int = DEEP_PAGE) -> DataFrame:
    """``limit`` rows after the first ``offset`` ones in the given order.

    A page that ends within ``deep`` rows is one top-k. Beyond that the rows are range-partitioned and sorted once and
    written with their partition and place in it; the counts of the partitions before give each row its rank, and a
    page is a filter on ranks. No task holds more than its range. Both ways return the same rows if the order is total.
    A page past the end is empty.
    """
    if offset + limit <= deep:
        return df.orderBy(*order).offset(offset).limit(limit)
    path = work_dir(df.sparkSession, "page")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.orderBy(*order).select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), place.alias("place"))
    placed.write.parquet(path)
    sorted_rows = df.sparkSession.read.schema(placed.schema).parquet(path)
    # one row per sorted partition, so the running sum over all of them is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("part", (F.sum("n").over(before) - F.col("n")).alias("start"), "n")
    starts = starts.where((F.col("start") < offset + limit) & (F.col("start") + F.col("n") > offset))
    ranked = sorted_rows.join(starts, "part").withColumn("rank", F.col("start") + F.col("place"))
    return ranked.where(F.col("rank").between(offset, offset + limit - 1)).orderBy("rank").select("row.*")


def preview_counts(df: DataFrame, filters: Iterable[Filter] = (), limit: int = 100) -> DataFrame:
    """One row: rows of the table, rows that pass the filters, rows that the preview shows."""
    passes = F.lit(True)
    for column, operator, value in filters:
        condition = filter_condition(df, column, operator, value)
        if condition is not None:
            passes &= condition
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(passes).alias("filtered_rows"))
    return counts.withColumn("preview_rows", F.least("filtered_rows", F.lit(limit).cast("long")))


def table_schema(df: DataFrame) -> DataFrame:
    """One row per column with the row and column counts of the table.

    Counting reads no column, only the row counts in the file footers.
    """
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.inline(fields), "row_count", F.lit(len(df.columns)).alias("num_fields"))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(col(c), F.lit(None)) for c in floats}) if floats else df


def run_sql(spark: SparkSession, sql: str, limit: int = 1000) -> tuple[DataFrame, int]:
    """First ``limit`` rows of a query over the registered tables, and its full row count.

    The query runs once: its rows are counted as they pass into a top-k by position, so only the page leaves the tasks.
    """
    try:
        result = spark.sql(sql)
    except AnalysisException as error:
        if error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND":
            known = ", ".join(sorted(t.name for t in spark.catalog.listTables())) or "none"
            raise LookupError(f"Table not found. Available tables: {known}") from error
        raise
    counted, position = Observation(), "_".join(["position", *result.columns])
    watched = nan_to_null(result).observe(counted, F.count(F.lit(1)).alias("rows"))
    first = watched.withColumn(position, F.monotonically_increasing_id()).orderBy(position).limit(max(limit, 1)).drop(position)
    rows = first.collect()
    # a plan that is known to be empty passes no metrics on
    return spark.createDataFrame(rows[:limit], first.schema), counted.get["rows"] if rows else 0
