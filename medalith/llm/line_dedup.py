"""Removal of lines that already stand in an earlier document (DataFrame operations only).

Lines become hashes of their keys, stored once. The hashes are range-partitioned and sorted by document and position inside each
partition; one pass per partition sees the first document of a key and marks the lines of all later ones. What comes
out is a bitmap of the dropped lines per document, in which words without a dropped line are left out: small, and
without any text.

Skew: keys with at least a share of 1/``HOT_SHARE`` of all lines get their first document from an aggregate that is combined
before the shuffle, and their lines are spread over the range partitions. There are at most ``HOT_SHARE`` of them.

Defined results: null or empty text is one empty line. A null id counts as the largest id, so it never holds a first
occurrence against a document with an id. Rows that repeat an id belong to one document: a line of the smallest id
that holds its key stays however often it stands there. Columns besides id and text are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalith.llm.frames import column, id_and_text, stored

MIN_CHARS = 10
HOT_SHARE = 4096
SPREAD = 1024
NO_ID = 2**63 - 1
#: Fixed values of the line key: the stripped characters, and the letters to lower.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _with_identity(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` orders documents; ``doc`` and ``body`` find a row again."""
    d = id_and_text(docs, id_col, text_col)
    return d.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("body"), "text")


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line whose key is long enough: 96 bits of the key's hash, the document and the position."""
    lines = _with_identity(docs, id_col, text_col).select("doc", "body", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc", "body", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"), "doc", "body", "pos")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc, body, pos`` of every line whose key stands in a document with a smaller id."""
    # counting, the bounds of the ranges and the shuffle read the hashes; the texts are split once for them
    lines = stored(docs.sparkSession, hashed_lines(docs, id_col, text_col, min_chars), "lines")
    least = max(2, -(-lines.count() // HOT_SHARE))
    counted = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("hot_first"))
    hot = counted.where(F.col("n") >= least).drop("n")
    # HOT_SHARE rows at most, so this is always small enough to be sent to every executor
    known = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    part = F.when(F.col("hot_first").isNotNull(), F.pmod(F.xxhash64("doc", "pos"), F.lit(SPREAD))).otherwise(F.lit(0))
    placed = known.withColumn("part", part.cast("int")).repartitionByRange("h1", "part")
    in_order = Window.partitionBy("h1", "h2", "part").orderBy("doc", "pos")
    first = F.coalesce("hot_first", F.first("doc").over(in_order))
    return placed.withColumn("first", first).where(F.col("doc") > F.col("first")).select("doc", "body", "pos")


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc, body, dropped`` for documents that lose lines: 64 positions per word, words of zeros left out.

    The keep bitmap is the complement. Its size follows the number of dropped lines, not the text.
    """
    bits = dropped_lines(docs, id_col, text_col, min_chars).groupBy(
        "doc", "body", F.expr("cast(pos div 64 as int)").alias("word")
    ).agg(F.expr("bit_or(shiftleft(1L, cast(pos % 64 as int)))").alias("bits"))
    return bits.groupBy("doc", "body").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def with_kept_text(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text left after dropping lines, and the columns ``n_lines`` and ``n_dropped``.

    The frame's own columns of these two names, if any, are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    doc = F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID))
    row = docs.select(doc.alias("doc"), F.xxhash64(text).alias("body"), text.alias("whole"), F.struct(*[column(docs, c) for c in keep]).alias("row"))
    joined = row.join(bitmaps, ["doc", "body"], "left")
    words = F.expr("cast((size(lines) + 63) div 64 as int)")
    dense = F.expr("transform(sequence(0, words - 1), w -> coalesce(by_word[w], 0L))")
    kept = F.expr("concat_ws('\\n', filter(lines, (l, i) -> (shiftright(dense[cast(i div 64 as int)], cast(i % 64 as int)) & 1L) = 0L))")
    n_dropped = F.expr("aggregate(dropped, 0L, (s, x) -> s + bit_count(x.bits))")
    wide = joined.withColumn("lines", lines_of(F.col("whole")))
    wide = wide.withColumn("by_word", F.map_from_entries("dropped")).withColumn("words", words).withColumn("dense", F.when(F.col("dropped").isNotNull(), dense))
    result = F.when(F.col("dropped").isNull(), F.col("whole")).otherwise(kept)
    return wide.select(
        *[(result if c == text_col else F.col("row").getField(c)).alias(c) for c in keep],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Each document with only its kept lines, joined by a newline."""
    return with_kept_text(docs, drop_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col)
