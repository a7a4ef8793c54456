"""Cleaning expressions shared by the silver, legacy and gold plans. All of them are built-in
column expressions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions import values


def is_filled(c: Column) -> Column:
    """Neither null, nor empty, nor the text ``nan`` that a text cast of a missing value leaves."""
    return c.isNotNull() & (c != "") & (c != "nan")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def is_true_text(c: Column, true_texts: tuple[str, ...]) -> Column:
    """Whether the text of a text or boolean column is one of ``true_texts``; null counts as false."""
    return F.coalesce(c.cast("string").isin(*true_texts), F.lit(False))


def _dotted(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit("."))


def comma_double(c: Column) -> Column:
    """``'12,5'`` -> 12.5; text that is no number gives null."""
    return _dotted(c).try_cast("double")


def comma_decimal(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """``'12,5'`` -> 12.50, straight from the text so that ties round half up."""
    return _dotted(c).try_cast(f"decimal({precision},{scale})")


def rounded_int(c: Column) -> Column:
    """Whole number from text or number, halves rounded away from zero, null when it is no number."""
    return F.round(c.try_cast("double")).try_cast("int")


def plain_double_text(c: Column) -> Column:
    """Shortest decimal text of a double, written out between 1e-4 and 1e16 (``0.0005``) and as
    ``5e-05`` outside. A key hashed from a coordinate must not depend on an engine's own layout."""
    text = c.cast("string")
    written_out = F.regexp_replace(
        F.regexp_replace(text.cast("decimal(38,20)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ".0"
    )
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.lpad(F.abs(exponent).cast("string"), 2, "0")
    )
    magnitude = F.abs(c)
    # The usual sizes are told apart by number and formatted once.
    return (
        F.when((magnitude >= 1e-3) & (magnitude < 1e7) | (c == 0), text)
        .when((magnitude >= 1e-4) & (magnitude < 1e16), written_out)
        .when(F.contains(text, F.lit("E")), scientific)
        .otherwise(text)
    )


def utc_timestamp(c: Column, data_type: T.DataType) -> Column:
    """Zone-less UTC timestamp of a stamp or of ISO text; text with an offset is moved to UTC."""

    def moved(stamp: Column) -> Column:
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), stamp.cast("timestamp_ntz"))

    if isinstance(data_type, T.TimestampType):
        return moved(c)
    if not isinstance(data_type, T.StringType):
        return c.cast("timestamp_ntz")
    has_offset = c.rlike(r"[T ][0-9:.]+ ?(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    return F.when(has_offset, moved(c.try_cast("timestamp"))).otherwise(c.try_cast("timestamp_ntz"))


def department_code(commune_code: Column) -> Column:
    overseas = reduce(lambda a, b: a | b, [commune_code.startswith(p) for p in values.OVERSEAS_PREFIXES])
    return F.when(overseas, F.substring(commune_code, 1, 3)).otherwise(F.substring(commune_code, 1, 2))


def region_code(commune_code: Column) -> Column:
    """Region of a commune code, null for codes outside the listed departments."""
    two, three = F.substring(commune_code, 1, 2), F.substring(commune_code, 1, 3)
    region = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, departments in values.DEPARTMENTS_BY_REGION.items():
        region = region.when(two.isin(*departments), code)
    for code, department in values.OVERSEAS_DEPARTMENT_BY_REGION.items():
        region = region.when(three == department, code)
    return region


def padded_commune_code(c: Column) -> Column:
    return F.lpad(c.cast("string"), 5, "0")


def fold_arrondissement(commune_code: Column, communes: dict[str, str] = values.ARRONDISSEMENT_COMMUNES) -> Column:
    """Commune that an arrondissement code belongs to; other codes stay as they are.

    A map lookup mentions the code twice, where a CASE per prefix would repeat it (and whatever it is
    computed from) in every branch of a pushed-down filter.
    """
    pairs = F.create_map(*[F.lit(x) for pair in communes.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, F.substring(commune_code, 1, 3)), commune_code)


def without_french_part(label: Column) -> Column:
    return F.regexp_replace(label, r"(?i)\s*\(partie française\)", "")


def spelled_oe(c: Column) -> Column:
    return F.replace(c, F.lit("œ"), F.lit("oe"))


def pole_label(label: Column) -> Column:
    """Area label as the pole commune is spelled."""
    spelled = spelled_oe(label)
    result = F.when(F.lit(False), spelled)
    for prefix in values.POLE_NAME_PREFIXES:
        result = result.when(spelled.ilike(prefix + "%"), prefix)
    return result.otherwise(spelled)


def plain_name_key(c: Column) -> Column:
    """Upper-case letters and digits of a name, everything else dropped."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def name_key(c: Column) -> Column:
    return plain_name_key(spelled_oe(c))


def upper_name(c: Column) -> Column:
    return F.upper(F.trim(c))


def city_key(c: Column, squeeze: bool = False) -> Column:
    """Upper-case city name with spaces for hyphens; ``squeeze`` also halves double spaces."""
    spaced = F.replace(c, F.lit("-"), F.lit(" "))
    if squeeze:
        spaced = F.replace(spaced, F.lit("  "), F.lit(" "))
    return upper_name(spaced)


def rome_code(label: Column) -> Column:
    """ROME code in ``Label (K2503)``; empty when there is none."""
    return F.regexp_extract(label, r"\(([A-Z][0-9]{4})\)", 1)


def digit_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]", ""))
