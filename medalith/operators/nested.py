"""Nested JSON records to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col, quoted


def flatten_structs(df: DataFrame, sep: str = "_", max_level: int | None = None) -> DataFrame:
    """Struct fields as columns named ``parent_child``, down to ``max_level`` nested levels.

    Deeper structs, arrays and maps stay as they are. When a flattened name meets an existing
    column, the flattened one is kept.
    """
    flat: dict[str, Column] = {}

    def visit(path: list[str], field: T.StructField, level: int) -> None:
        if isinstance(field.dataType, T.StructType) and (max_level is None or level < max_level):
            for child in field.dataType.fields:
                visit(path + [child.name], child, level + 1)
        else:
            flat[sep.join(path)] = F.col(".".join(quoted(p) for p in path))

    def nested(field: T.StructField) -> bool:
        return isinstance(field.dataType, T.StructType)

    for field in sorted(df.schema.fields, key=nested):
        visit([field.name], field, 0)
    return df.select(*[c.alias(name) for name, c in flat.items()])


def explode_children(df: DataFrame, array_column: str, parent_columns: dict[str, str]) -> DataFrame:
    """One row per array element: the parent columns under new names, then the element's fields.

    Parents without elements disappear; an element field hides a parent column of the same name.
    """
    element = df.schema[array_column].dataType.elementType
    if not isinstance(element, T.StructType):
        raise TypeError(f"{array_column} must hold structs")
    parents = {new: old for old, new in parent_columns.items() if new not in element.fieldNames()}
    exploded = df.select(
        *[col(old).alias(new) for new, old in parents.items()],
        F.explode(col(array_column)).alias("__child"),
    )
    return exploded.select(*[col(c) for c in parents], "__child.*")


def arrays_to_json(df: DataFrame, names: list[str]) -> DataFrame:
    """Array columns as JSON text, null kept; numeric arrays are written ``[1.5, 2]``."""

    def as_text(name: str) -> Column:
        element = df.schema[name].dataType
        while isinstance(element, T.ArrayType):
            element = element.elementType
        text = F.to_json(col(name))
        return F.replace(text, F.lit(","), F.lit(", ")) if isinstance(element, T.NumericType) else text

    present = [c for c in names if c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType)]
    return df.withColumns({c: as_text(c) for c in present}) if present else df
