"""Reading the given tables, and handing a prepared column to a plan without clashing names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.session import shared_root, shuffles_go, stored

__all__ = ["column", "dealt", "hash_share", "id_and_text", "released", "shuffles_go", "slices", "stored", "table"]

ROWS_AT_ONCE = 1000
Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also when the name holds dots or backticks."""
    return df["`" + name.replace("`", "``") + "`"]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, under fixed names; a null text counts as empty."""
    return docs.select(
        column(docs, id_col).cast("long").alias("doc_id"),
        F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"),
    )


def hash_share(hash_value: Column, rows: int, wanted: int) -> Column:
    """Whether a hash lies in a share of its range that holds somewhat more than ``wanted`` of ``rows`` different values.

    Taken before an ordered limit, it keeps that limit from gathering ``wanted`` rows of every task in one.
    """
    share = min(1.0, (1.3 * wanted + 50) / max(1, rows))
    return F.pmod(hash_value, F.lit(1 << 24)) < int(share * (1 << 24)) + 1


def slices(batches: Batches) -> Batches:
    """The batches in parts of at most ``ROWS_AT_ONCE`` rows, so Python holds that many texts and results at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; at a task's end its worker gives back what Arrow keeps for later, as workers outlive a stage."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


def dealt(df: DataFrame, parts: int, part: str) -> DataFrame:
    """A frame whose column ``part`` names one of ``parts`` partitions, shuffled once and kept so in the shared work folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.repartitionById(parts, df[part]).checkpoint()
