"""The registered queries of this subpackage, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm import alignment, byte_bpe, collocations, decontamination, hamming_index, language_id, line_dedup, main_text, ngram_join, secrets, token_store, toxicity, url_filter
from medalith.llm.frames import table
from medalith.session import work_dir

#: The vocabulary files; another folder is a parameter of the operators, never copied here.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_store.document_digests(spark, path)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and every page, by a text model fitted on labelled documents.

    Pages bring markup, addresses and hosts; a document's language column is the declared one, its source the host.
    """
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents)
    found = {
        "doc_id": language_id.identify(spark, language_id.document_rows(documents), model, "language-documents"),
        "page_id": language_id.identify(spark, language_id.page_rows(table(spark, sf_dir, "pages")), model, "language-pages"),
    }
    results = ["language", F.round("posterior", 6).alias("posterior"), "text_language", "n_trigrams", "kept"]
    ids = {c: [F.col("id").alias(k) if k == c else F.lit(None).cast("long").alias(k) for k in found] for c in found}
    return found["doc_id"].select(*ids["doc_id"], *results).unionByName(found["page_id"].select(*ids["page_id"], *results))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and each benchmark item that leaks into it."""
    docs = decontamination.with_leaks(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    # a plain explode would bring a filter on the array's size, and with it a second pass of the search
    return docs.select("doc_id", F.explode_outer("leaks").alias("leak")).where("leak is not null").select("doc_id", "leak.*")


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(spark, table(spark, sf_dir, "documents"))
    counts = [secrets.kind_count("base", kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    base = F.sha2(F.encode(secrets.spans_text("base"), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, secrets.spans_text("spans").alias("spans"))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    docs = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.encode(F.col("text"), path).alias("ids"))
    both = docs.withColumn("decoded", byte_bpe.decode(F.col("ids"), path))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.with_main_text(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(spark, table(spark, sf_dir, "pages"))
    return judged.withColumn("bad_share", F.round("bad_share", 6))


@query
def op8_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hamming_index.valid_vectors(table(spark, sf_dir, "embeddings"))
    codes = hamming_index.fit(rows)
    if codes is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    index = hamming_index.build_index(spark, rows, codes)
    return hamming_index.search(spark, index, index.where("vec_id % 100 = 0").select("vec_id", "vector"), codes)


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(spark, table(spark, sf_dir, "documents"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    found = alignment.align(spark, table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.encode("groups", "UTF-8"), 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model, share = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(spark, documents, model, share)
