"""The corpus pipeline: documents through five of the operators, each stage on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm import byte_bpe, decontamination, language_id, line_dedup, ngram_join
from medalith.llm.frames import stored, table

BYTE_BPE = "byte_bpe_50k.json"
#: Workers bring along what earlier stages left, so the last one keeps a smaller table of known words than op5 does, and only
#: while a task runs.
KNOWN_WORDS = 100_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``rejected``; documents without an id stay."""
    ids = rejected.select(F.col("doc_id").alias("rejected_id")).distinct()
    return docs.join(ids, docs["doc_id"] == ids["rejected_id"], "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, in no known language, or with no language likely enough."""
    found = language_id.identify(spark, language_id.document_rows(docs), language_id.fit(docs))
    rejected = found.where(~F.col("kept")).select("row_key").distinct()
    return docs.join(rejected, language_id.document_row_key(docs) == rejected["row_key"], "left_anti")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; its text loses the lines that an earlier document has."""
    own = {c: f"__own_{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}  # not the counts of this stage
    kept = line_dedup.dedup(docs.withColumnsRenamed(own)).drop("n_lines", "n_dropped")
    kept = kept.withColumnsRenamed({hidden: c for c, hidden in own.items()})
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies connect, only the one with the smallest id stays."""
    groups = ngram_join.similar_components(spark, docs)
    return without(docs, groups.where("component_id < doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents into which a benchmark item leaks."""
    found = decontamination.leaks_column(spark, F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(found) == 0)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (four bytes each) and whether decoding them gives the text back."""
    texts = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    found = byte_bpe.with_round_trip(texts, public_tokenizers.path(BYTE_BPE), KNOWN_WORDS)
    return found.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

#: Language scores, near copies and merges have no form in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
