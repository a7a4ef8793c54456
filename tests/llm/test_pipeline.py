"""The pipeline's stages against plain versions, and the registered queries."""

import os

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from compare import compare, connect
from test_line_dedup import plain as plain_lines
from test_ngram_join import plain as plain_groups
from tokenizers import Tokenizer

import __spark_entry__ as entry
from medalith.llm import oracle
from medalith.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_registered():
    names = set(entry.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert set(oracle.STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], oracle.STATEMENTS[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(oracle.STATEMENTS)))
def test_queries_run(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0


def test_stages_follow_each_other(spark, documents):
    docs = documents
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_jaccard_join", "decontamination", "byte_bpe"]
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert kept.count() >= 0.99 * docs.count()
    docs = spark.createDataFrame(kept.collect(), kept.schema)

    lines = stages["line_dedup"](spark, docs, SF_DIR)
    assert lines.columns == documents.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted((d, t) for d, t, _, _ in plain_lines(rows))
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    docs = spark.createDataFrame(lines.collect(), lines.schema)

    groups = stages["ngram_jaccard_join"](spark, docs, SF_DIR)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in groups.collect()) == sorted(d for d, _, c in plain_groups(rows) if d == c)
    docs = spark.createDataFrame(groups.collect(), groups.schema)

    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, docs, SF_DIR)
    left = {r.doc_id for r in clean.collect()}
    for r in docs.collect():
        whole = any(" ".join(item) in " ".join(r.text.lower().split()) for item in items if len(item) >= 5)
        assert not (whole and r.doc_id in left)
    docs = spark.createDataFrame(clean.collect(), clean.schema)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in stages["byte_bpe"](spark, docs, SF_DIR).collect():
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.round_trip and r.n_tokens * 4 == len(r["ids"])


ODD = [
    (1, "The and that with for the ing tion of there and the others", "en", "s", 58, "x"),
    (1, "The and that with for the ing tion of there and the others", "en", "s", 58, "x"),
    (None, "The and that with for the ing tion of there and the others", None, None, None, None),
    (2, None, "en", "s", None, None),
    (3, "", None, None, 0, None),
    (4, "\n\n\n", "de", "", 3, ""),
    (5, "word " * 50_000, "en", "s", 250_000, "long"),
]


def test_stages_take_odd_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(ODD, SCHEMA)
        result = stage(spark, docs, SF_DIR)
        rows = result.collect()
        assert len(rows) <= len(ODD), name
        if name != "byte_bpe":
            assert result.columns == docs.columns, name


def test_stages_take_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), SF_DIR).count() == 0, name


def test_run(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() > 0
    assert result.where("not round_trip").count() == 0


def test_columns_named_like_the_counts_of_a_stage(spark):
    rows = [(1, "a line of some length\nown", "en", "s", 3, 7, None), (2, "a line of some length\nother", "en", "s", 3, 8, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_dropped string")
    found = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF_DIR)
    assert found.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()) == [(1, rows[0][1], 7, None), (2, "other", 8, "x")]
