"""Column-name clean-up. Every function is ``DataFrame -> DataFrame`` and works on streams too."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column reference that survives dots, such as ``lwr.IPm2``."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def _without_collisions(names: list[str]) -> list[str]:
    seen: set[str] = set()
    result = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in seen:
            n += 1
            candidate = f"{name}_{n}"
        seen.add(candidate.lower())
        result.append(candidate)
    return result


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case names with ``_`` for every other character; colliding names get ``_2``, ``_3``…"""
    return df.toDF(*_without_collisions([re.sub(r"[^a-zA-Z0-9]", "_", c).lower() for c in df.columns]))


def underscore_spaces(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def strip_name_quotes(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip('"') for c in df.columns])


def cast_to_text(df: DataFrame, names: list[str]) -> DataFrame:
    """Cast the listed columns to string; names that are not there are passed over."""
    present = [c for c in names if c in df.columns]
    return df.withColumns({c: col(c).cast("string") for c in present}) if present else df
