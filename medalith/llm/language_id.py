"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

For each language l the evidence adds up as logarithms:

* the text: hashed byte trigrams under a naive Bayes model that is fitted on at most ``SAMPLE_PER_LANGUAGE`` different
  labelled texts of each language (chosen by their hash); trigrams overlap, so a text weighs at most ``WEIGHT``
  independent ones;
* the declared markup language and the address suffix: P(value | l) from counts over all rows, by the language that
  the text alone points to;
* the host: a prior P(l | host), smoothed towards its domain, which is smoothed towards all rows.

All counts are grouped aggregations over the whole table, and a row's own vote is taken out of them. The class ``und``
stands for no known language (uniform trigrams). Every label is a class; one with few texts has a model of few trigrams,
smoothed like the others. A row is rejected when it has no letters, when ``und`` wins, or when the best language stays
below ``MIN_POSTERIOR`` together with those that differ from it in the region only (``en-us``, ``en-gb``). A row with
letters whose declared language has no class is never rejected; nothing is known about that language.

Defined results: null or empty text has no trigrams and is rejected; null evidence is left out; a host is one key of
a join whose other side has one row per host, so a hot host can be split. Without any labelled row nothing is
rejected and the language is null. Repeated rows get equal results.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.frames import column, released, stored
from medalith.llm.words import pieces, text_bytes

SAMPLE_PER_LANGUAGE = 2000
WEIGHT = 60.0
MIN_POSTERIOR = 0.5
VOTE_TRIGRAMS = 30
PRIOR_ROWS = 10.0
UNIFORM_SHARE = 0.3
UNKNOWN = "und"
UNKNOWN_PRIOR = 1e-4
BUCKETS = 1 << 16
#: Scores that a worker holds at a time.
SCORES = 1 << 20
KEYS = ("row_key", "id", "declared", "suffix", "domain", "host")
_SCORED = "row_key long, id long, declared string, suffix string, domain string, host string, n long, scores array<double>, vote int"

_UNSEEN = math.log(UNIFORM_SHARE / BUCKETS)
#: Byte table: ASCII letters lowered, non-ASCII bytes kept, all else a blank.
_LETTER = np.full(256, 32, dtype=np.uint32)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of the trigram buckets that a language has, those of language k from ``begin[k]`` on."""

    languages: list[str]
    begin: np.ndarray
    buckets: np.ndarray
    logs: np.ndarray

    def row(self, k: int) -> np.ndarray:
        """Log-probability of every bucket in a language."""
        logs = np.full(BUCKETS, _UNSEEN, dtype=np.float32)
        logs[self.buckets[self.begin[k] : self.begin[k + 1]]] = self.logs[self.begin[k] : self.begin[k + 1]]
        return logs


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter, and where each row's trigrams begin (one more entry)."""
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    letters = np.full(high - low + 2, 32, dtype=np.uint32)
    letters[1:-1] = _LETTER[data[low:high]]
    before, after = letters[:-2].copy(), letters[2:].copy()
    cuts = offsets - low
    before[cuts[cuts < high - low]] = 32  # no trigram goes over the border of two rows
    after[cuts[cuts > 0] - 1] = 32
    places = np.flatnonzero(letters[1:-1] != 32)
    code = (before[places] << np.uint32(16)) | (letters[1:-1][places] << np.uint32(8)) | after[places]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), np.searchsorted(places, cuts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams by label and bucket, texts under the bucket -1; the rows come in runs of one label."""
    current, total, texts = None, np.zeros(BUCKETS, dtype=np.int64), 0

    def counts() -> pa.RecordBatch:
        bucket = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array([current] * (len(bucket) + 1), pa.string()), pa.array(np.append(bucket, -1), pa.int32()), pa.array(np.append(total[bucket], texts), pa.int64())],
            names=["label", "bucket", "n"],
        )

    for batch in batches:
        labels = batch.column("label").to_pylist()
        data, offsets = text_bytes(batch.column("text"))
        for first, last in pieces(offsets):
            buckets, begin = trigrams(data, offsets[first : last + 1])
            for row in range(last - first):
                if labels[first + row] != current:
                    if texts:
                        yield counts()
                    current, texts = labels[first + row], 0
                    total[:] = 0
                texts += 1
                total += np.bincount(buckets[begin[row] : begin[row + 1]], minlength=BUCKETS)
    if texts:
        yield counts()


def _sample_counts(rows: DataFrame, shares: dict[str, float], per_language: int) -> dict[str, tuple[np.ndarray, np.ndarray, int]]:
    """By label: buckets, trigrams in each, and texts, in at most ``per_language`` texts of the given shares (1 for other labels)."""
    if shares:
        table = F.explode(F.from_json(F.lit(json.dumps(shares)), "map<string,double>")).alias("label", "share")
        rows = rows.join(rows.sparkSession.range(1).select(table), "label", "left")
        rows = rows.where(F.col("share").isNull() | (F.pmod("hash", F.lit(1 << 24)) < F.col("share") * (1 << 24)))
    distinct = rows.groupBy("label", "hash").agg(F.min("text").alias("text"))  # copies of a text are one before the shuffle
    order = Window.partitionBy("label").orderBy("hash")
    sample = distinct.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    counted = sample.select("label", "text").mapInArrow(released(_counted), "label string, bucket int, n long")
    summed = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    gathered = summed.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("all"))  # BUCKETS + 1 at most
    found = {}
    for row in gathered.select("label", F.col("all.bucket").alias("buckets"), F.col("all.n").alias("n")).toLocalIterator():
        found[row.label] = (np.array(row.buckets[1:], dtype=np.uint16), np.array(row.n[1:], dtype=np.int64), row.n[0])
    return found


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> TextModel | None:
    """A model of every label from a bounded sample of each one's rows; None when no labelled row has letters.

    The label ``und`` names no language and makes no class.
    """
    rows = labelled.select(
        column(labelled, text_col).cast("string").alias("text"), F.lower(F.trim(column(labelled, label_col).cast("string"))).alias("label")
    ).where(f"length(text) > 0 and length(label) > 0 and label <> '{UNKNOWN}'")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    sizes = rows.groupBy("label").agg(F.approx_count_distinct("hash").alias("texts")).collect()
    # a share of the hash range that holds somewhat more than enough different texts, as all copies of a text lie in it or none
    enough = 1.3 * per_language + 50
    shares = {r.label: enough / r.texts for r in sizes if r.texts > enough}
    counts = _sample_counts(rows, shares, per_language)
    short = [label for label in shares if label not in counts or counts[label][2] < per_language]
    if short:  # the estimate of their texts was far too high
        counts |= _sample_counts(rows.where(F.col("label").isin(short)), {}, per_language)
    languages = sorted(label for label, (buckets, _, _) in counts.items() if len(buckets))
    if not languages:
        return None
    logs = [np.log((1 - UNIFORM_SHARE) * counts[k][1] / counts[k][1].sum() + UNIFORM_SHARE / BUCKETS) for k in languages]
    begin = np.cumsum([0, *[len(x) for x in logs]])
    return TextModel(languages, begin, np.concatenate([counts[k][0] for k in languages]), np.concatenate(logs).astype(np.float32))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(model.value.languages) + 1
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for start, end in pieces(offsets):
                step = max(1, SCORES // classes)
                for first in range(start, end, step):
                    last = min(end, first + step)
                    yield scored(batch.slice(first, last - first), data, offsets[first : last + 1], classes)

    def scored(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, classes: int) -> pa.RecordBatch:
        buckets, begin = trigrams(data, offsets)
        n = np.diff(begin)
        sums = np.zeros((len(n), classes))
        filled = np.flatnonzero(n)
        if len(filled):
            for k in range(classes - 1):
                sums[filled, k] = np.add.reduceat(model.value.row(k)[buckets].astype(np.float64), begin[filled])
            sums[:, -1] = n * -math.log(BUCKETS)
        scores = sums * (WEIGHT / (n + WEIGHT))[:, None]
        best = scores.argmax(axis=1)
        unsure = (n < VOTE_TRIGRAMS) | (best == classes - 1)
        rows = pa.FixedSizeListArray.from_arrays(pa.array(scores.ravel()), classes).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in KEYS], pa.array(n, pa.int64()), rows, pa.array(best, pa.int32(), mask=unsure)],
            names=[*KEYS, "n", "scores", "vote"],
        )

    return run


def _votes(scored: DataFrame, feature: str, languages: int) -> DataFrame:
    """Votes per language for each value of a feature: one row per value, combined before the shuffle."""
    cast = scored.where(F.col(feature).isNotNull() & F.col("vote").isNotNull()).groupBy(feature, "vote").count()
    found = cast.groupBy(feature).agg(F.map_from_entries(F.collect_list(F.struct("vote", "count"))).alias("by_vote"))  # an entry a language
    each = F.expr(f"transform(sequence(0, {languages - 1}), k -> coalesce(by_vote[k], 0L))")
    return found.select(feature, each.alias(f"{feature}_votes"))


def _without_own(votes: str) -> str:
    return f"transform({votes}, (c, k) -> cast(c - if(k = vote, 1, 0) as double))"


def identify(spark: SparkSession, rows: DataFrame, model: TextModel | None, label: str = "language") -> DataFrame:
    """``row_key, id, language, posterior, text_language, n_trigrams, kept`` for rows of the columns ``KEYS`` and ``text``."""
    if model is None:
        nothing = F.lit(None)
        return rows.select("row_key", "id", nothing.cast("string").alias("language"), nothing.cast("double").alias("posterior"),
                           nothing.cast("string").alias("text_language"), F.lit(0).cast("long").alias("n_trigrams"), F.lit(True).alias("kept"))
    size = len(model.languages)
    texts = spark.sparkContext.broadcast(model)  # only the buckets that a language has
    scored = stored(spark, rows.select(*KEYS, "text").mapInArrow(released(_scored(texts)), _SCORED), label)
    totals = scored.where("vote is not null").groupBy("vote").count().collect()
    count = [0.0] * size
    for row in totals:
        count[row.vote] = float(row["count"])
    whole = sum(count)
    share = [(c + 1) / (whole + size) for c in count]
    share_sql = "array(" + ",".join(f"{s!r}D" for s in share) + ")"
    count_sql = "array(" + ",".join(f"{c!r}D" for c in count) + ")"

    joined = scored
    for feature in ("declared", "suffix", "domain", "host"):
        joined = joined.join(_votes(scored, feature, size), feature, "left")
    m = PRIOR_ROWS
    wide = joined
    for feature in ("declared", "suffix"):
        own = _without_own(f"{feature}_votes")
        wide = wide.withColumn(f"{feature}_n", F.expr(own)).withColumn(
            f"{feature}_share", F.expr(f"(aggregate({feature}_n, 0D, (s, x) -> s + x) + 1) / ({whole!r}D + {size})")
        )
        likelihood = f"zip_with({feature}_n, {count_sql}, (c, t) -> ln((c + {m} * {feature}_share) / (t + {m})))"
        wide = wide.withColumn(f"{feature}_log", F.expr(f"concat({likelihood}, array(ln({feature}_share)))"))
    wide = wide.withColumn("by_domain", F.expr(_smoothed("domain_votes", share_sql, m)))
    wide = wide.withColumn("by_host", F.expr(_smoothed("host_votes", "by_domain", m)))
    prior = f"concat(transform(by_host, p -> ln(p * {1 - UNKNOWN_PRIOR})), array(ln({UNKNOWN_PRIOR}D)))"
    wide = wide.withColumn("logs", F.expr(f"zip_with(scores, {prior}, (a, b) -> a + b)"))
    for feature in ("declared", "suffix"):
        wide = wide.withColumn("logs", F.expr(f"if({feature}_log is null, logs, zip_with(logs, {feature}_log, (a, b) -> a + b))"))
    wide = wide.withColumn("top", F.array_max("logs")).withColumn("best", F.expr("array_position(logs, top) - 1").cast("int"))
    names = F.array(*[F.lit(x) for x in [*model.languages, UNKNOWN]])
    posterior = F.expr("1 / aggregate(logs, 0D, (s, x) -> s + exp(x - top))")
    primary = [re.split("[-_]", x)[0] for x in [*model.languages, UNKNOWN]]
    families = ",".join(str(primary.index(x)) for x in primary)
    alike = F.expr(f"aggregate(zip_with(logs, array({families}), (x, f) -> if(f = array({families})[best], exp(x - top), 0D)), 0D, (s, x) -> s + x)")
    known = sorted({*model.languages, *primary})
    named = wide.select(
        "row_key", "id", F.get(names, F.col("best")).alias("language"), posterior.alias("posterior"),
        F.get(names, F.col("vote")).alias("text_language"), F.col("n").alias("n_trigrams"),
        (alike * posterior if len(set(primary)) < len(primary) else posterior).alias("likely"),
        F.coalesce(~F.lower(F.trim("declared")).isin(known) & (F.length(F.trim("declared")) > 0), F.lit(False)).alias("undecided"),
    )
    sure = (F.col("language") != UNKNOWN) & (F.col("likely") >= MIN_POSTERIOR)
    return named.withColumn("kept", (F.col("n_trigrams") > 0) & (sure | F.col("undecided"))).drop("likely", "undecided")


def _smoothed(votes: str, towards: str, m: float) -> str:
    own = _without_own(votes)
    total = f"aggregate({own}, 0D, (s, x) -> s + x)"
    return f"if({votes} is null, {towards}, zip_with({own}, {towards}, (c, p) -> (c + {m} * p) / ({total} + {m})))"


def document_row_key(docs: DataFrame) -> Column:
    return F.xxhash64(*[column(docs, c) for c in ("doc_id", "text", "lang", "source")])


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as evidence: their language column is the declared one, their source the host."""
    return docs.select(
        document_row_key(docs).alias("row_key"), docs["doc_id"].cast("long").alias("id"), F.lower(F.trim(docs["lang"])).alias("declared"),
        F.lit(None).cast("string").alias("suffix"), F.lit(None).cast("string").alias("domain"), docs["source"].cast("string").alias("host"),
        docs["text"].cast("string").alias("text"),
    )


_ADDRESS = r"^[^:/?#]+://([^/?#]*)"


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as evidence: the markup's language attribute, the address and the text between the tags.

    The address suffix is a path's leading two-letter segment where it has one, else the last part of the host.
    """
    url, html = F.coalesce(pages["url"], F.lit("")), F.coalesce(pages["html"], F.lit(""))
    host = F.nullif(F.lower(F.regexp_extract(url, _ADDRESS, 1)), F.lit(""))
    segment = F.nullif(F.lower(F.regexp_extract(url, _ADDRESS + r"/([A-Za-z]{2})(?:[/?#]|$)", 2)), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;", " ")
    return pages.select(
        F.xxhash64("page_id", "url", "html").alias("row_key"), pages["page_id"].cast("long").alias("id"), declared.alias("declared"),
        F.coalesce(segment, F.substring_index(host, ".", -1)).alias("suffix"), F.substring_index(host, ".", -2).alias("domain"),
        host.alias("host"), text.alias("text"),
    )
