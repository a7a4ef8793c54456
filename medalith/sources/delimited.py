"""Delimited text with unknown separator, encoding and layout.

Header lines and encodings come from one aggregate over the lines of all files. The files themselves are
read by Spark's CSV source, in splits.
"""

from __future__ import annotations

import csv
import io
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col
from medalith.sources.files import literal_path, text_lines

SOURCE_FILE = "__source_file"
_CORRUPT = "__corrupt"
_OVERFLOW = "__overflow"
# Separators that are looked for, and the one assumed when none occurs.
SEPARATORS = (",", ";", "\t")
FALLBACK_SEPARATOR = ";"


def sniff_separator(header: str) -> str:
    counts = {s: len(_fields(header, s)) - 1 for s in SEPARATORS}
    best = max(counts, key=counts.get)
    return best if counts[best] else FALLBACK_SEPARATOR


def _fields(line: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(line), delimiter=sep), [])


def _column_names(header: str, sep: str) -> list[str]:
    """Header fields without a byte-order mark; repeated names get ``.1``, ``.2``…, empty ones a place."""
    names: list[str] = []
    for i, name in enumerate(_fields(header.lstrip("﻿"), sep)):
        name = name or f"Unnamed: {i}"
        n = sum(1 for other in names if other == name or other.startswith(name + "."))
        names.append(f"{name}.{n}" if n and name in names else name)
    return names


def _decoded(raw: bytes, charset: str) -> str:
    return bytes(raw).decode(charset, errors="replace")


def _first_ids(lines: DataFrame) -> dict[str, int]:
    """Id of the first line of each file."""
    heads = lines.filter(F.col("block_start") == 0).groupBy("file_path").agg(F.min("line_id").alias("first"))
    return {r.file_path: r["first"] for r in heads.collect()}


def layouts(spark: SparkSession, paths: list[str], encoding: str = "auto", skip_rows: int = 0) -> tuple[dict[tuple[str, str], list[str]], int]:
    """Files by (header line, encoding), from one aggregate over the lines that is combined per task, and how many lack a header.

    The header is the first line that is not blank, or the one after ``skip_rows`` lines of the same file. With
    ``encoding='auto'`` a file is UTF-8 if all its lines are, else Latin-1. Files without any line are in neither result.
    """
    lines = text_lines(spark, paths)
    raw = F.col("value").cast("binary")
    valid = F.bool_and(F.is_valid_utf8("value")) if encoding == "auto" else F.lit(True)
    in_head = F.col("block_start") == 0
    if skip_rows:
        # Line ids are consecutive within a split, so the header's id is known from the file's first one. For a file with fewer
        # lines this id belongs to the next file; each file's own one is told apart below.
        own = {path: first + skip_rows for path, first in _first_ids(lines).items()}
        is_header = F.col("line_id").isin([*own.values()]) & in_head
        header = F.collect_list(F.when(is_header, F.struct("line_id", raw.alias("line"))))
    else:
        own = {}
        is_header = in_head & (F.length(F.trim("value")) > 0)
        first = F.min_by(F.when(is_header, F.struct("line_id", raw.alias("line"))), F.when(is_header, F.col("line_id")))
        header = F.when(first.isNotNull(), F.array(first)).otherwise(F.array())
    # the list stays empty; with one among its results Spark aggregates by hash, where a line as result alone makes it sort all lines
    no_list = F.collect_list(F.lit(None).cast("string")).alias("no_list")
    found = lines.groupBy("file_path").agg(header.alias("headers"), valid.alias("is_utf8"), no_list)
    groups: dict[tuple[str, str], list[str]] = {}
    without = 0
    for row in found.orderBy("file_path").collect():
        headers = [h.line for h in row.headers if own.get(row.file_path, h.line_id) == h.line_id]
        if not headers:
            without += 1
            continue
        charset = encoding if encoding != "auto" else "UTF-8" if row.is_utf8 else "ISO-8859-1"
        groups.setdefault((_decoded(headers[0], charset), charset), []).append(literal_path(unquote(row.file_path)))
    return groups, without


def files_by_layout(
    spark: SparkSession, paths: list[str], encoding: str, skip_rows: int = 0
) -> dict[tuple[str, str], list[str]]:
    """``layouts``, where a single layout keeps the paths as they were given, so that Spark lists the folders itself."""
    groups, without = layouts(spark, paths, encoding, skip_rows)
    whole = len(groups) == 1 and not (skip_rows and without)
    return {kind: paths for kind in groups} if whole else groups


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = "auto",
    encoding: str = "auto",
    skip_rows: int = 0,
    all_string: bool = True,
    multi_line: bool = False,
    keep_source: bool = False,
    groups: dict[tuple[str, str], list[str]] | None = None,
) -> DataFrame:
    """Header CSV files as one frame.

    Files may differ in separator, encoding (UTF-8, else Latin-1) and columns; a column that a file
    lacks is null. Rows with more fields than the header are dropped, shorter rows are padded with
    nulls. ``skip_rows`` lines before the header are ignored. With ``all_string=False`` the types are
    inferred by one more pass. ``keep_source`` adds the file path as ``__source_file``. ``groups`` are the ``layouts`` of the
    files where the caller has them already.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if skip_rows:
        return _read_after_preamble(spark, paths, sep, encoding, skip_rows, keep_source)
    groups = files_by_layout(spark, paths, encoding) if groups is None else groups
    if not groups:
        raise ValueError(f"no header line in {paths}")
    frames = [
        _read_layout(
            spark, files, header, sniff_separator(header) if sep == "auto" else sep, charset, all_string, multi_line
        )
        for (header, charset), files in groups.items()
    ]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df if keep_source else df.drop(SOURCE_FILE)


def _read_layout(
    spark: SparkSession, files: list[str], header: str, sep: str, charset: str, all_string: bool, multi_line: bool
) -> DataFrame:
    names = _column_names(header, sep)
    options = {
        "header": True, "sep": sep, "encoding": charset, "quote": '"', "escape": '"', "multiLine": multi_line,
        "recursiveFileLookup": True,
    }
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not all_string:
        inferred = spark.read.options(**options, inferSchema=True, enforceSchema=True).csv(files).schema
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, inferred.fields)])
    rows = (
        spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
        .schema(T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())]))
        .csv(files)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    # Regular rows leave the corrupt column null; only irregular ones are parsed a second time, with
    # room for one field more, to tell long rows from short ones.
    wider = ", ".join(f"`{_OVERFLOW}{i}` string" for i in range(len(names) + 1)) + f", `{_CORRUPT}` string"
    # Spark refuses a scan whose only used column is the corrupt one, hence the first column beside it.
    nothing = F.left(F.coalesce(col(names[0]).cast("string"), F.lit("")), F.lit(0))
    irregular = F.when(F.col(_CORRUPT).isNotNull(), F.concat(F.col(_CORRUPT), nothing))
    parsed = F.from_csv(
        irregular, wider, {"sep": sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": _CORRUPT}
    )
    too_long = parsed.getField(_CORRUPT).isNull() | parsed.getField(f"{_OVERFLOW}{len(names)}").isNotNull()
    return rows.filter(F.col(_CORRUPT).isNull() | ~(irregular.isNotNull() & too_long)).drop(_CORRUPT)


def _read_after_preamble(
    spark: SparkSession, paths: list[str], sep: str, encoding: str, skip_rows: int, keep_source: bool
) -> DataFrame:
    """Rows below a header that stands on line ``skip_rows + 1`` of each file.

    The lines up to the header are dropped by their ids, so lines are neither shuffled nor joined. The ids of both
    scans agree because they read the same splits.
    """
    frames = []
    for (header, charset), files in files_by_layout(spark, paths, encoding, skip_rows).items():
        lines = text_lines(spark, files)
        preamble = [first + k for first in _first_ids(lines).values() for k in range(skip_rows + 1)]
        text = F.col("value") if charset.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
        body = lines.filter(~(F.col("line_id").isin(preamble) & (F.col("block_start") == 0))).withColumn("value", text)
        separator = sniff_separator(header) if sep == "auto" else sep
        schema = ", ".join(f"`{n}` string" for n in [*_column_names(header, separator), _OVERFLOW])
        parsed = F.from_csv("value", schema, {"sep": separator, "quote": '"', "escape": '"'})
        frames.append(
            body.filter(F.length(F.trim("value")) > 0)
            .select(F.col("file_path").alias(SOURCE_FILE), parsed.alias("row"))
            .filter(F.col("row").getField(_OVERFLOW).isNull())
            .select("row.*", SOURCE_FILE)
            .drop(_OVERFLOW)
        )
    if not frames:
        raise ValueError(f"no line {skip_rows + 1} in {paths}")
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df if keep_source else df.drop(SOURCE_FILE)
