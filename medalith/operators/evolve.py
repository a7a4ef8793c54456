"""Schema evolution: added columns, changed types, declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalith.functions.names import col


def type_conflicts(current: T.StructType, incoming: T.StructType) -> list[str]:
    """Columns that both schemas have with different types."""
    known = {f.name: f.dataType for f in current.fields}
    return [f.name for f in incoming.fields if f.name in known and known[f.name] != f.dataType]


def combined_schema(current: T.StructType, incoming: T.StructType) -> T.StructType:
    """Current columns, then the new ones; everything nullable, since older rows lack the new ones."""
    names = set(current.names)
    fields = list(current.fields) + [f for f in incoming.fields if f.name not in names]
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])


def schema_union(left: DataFrame, right: DataFrame, on_conflict: str = "merge") -> DataFrame:
    """Rows of both frames with the columns of both. With ``on_conflict='replace'`` a changed column
    type drops the left rows, as replacing the table would."""
    conflicts = type_conflicts(left.schema, right.schema)
    if conflicts and on_conflict == "replace":
        return right
    if conflicts:
        raise TypeError(f"other types for {conflicts}")
    return left.unionByName(right, allowMissingColumns=True)


def commented_schema(columns: list[tuple[str, str, str]]) -> T.StructType:
    """Schema from (name, type, comment) triples; apply it with ``df.to(schema)``."""
    schema = T.StructType()
    for name, data_type, comment in columns:
        field = T.StructType.fromDDL(f"`{name}` {data_type}").fields[0]
        schema.add(T.StructField(name, field.dataType, True, {"comment": comment}))
    return schema


def fit_schema(rows: DataFrame, schema: T.StructType | str, rescued: str = "_rescued_data") -> DataFrame:
    """Text rows with the declared columns and types; what does not fit is kept as JSON in the column ``rescued``.

    The JSON object holds the columns that the schema does not name and the values that their type cannot hold, by column
    name in the order of the rows; it is null when there are none. A declared column that the rows lack is null.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    declared = {f.name: f.dataType for f in schema.fields}
    fitted = {n: col(n).try_cast(t) for n, t in declared.items() if n in rows.columns}
    left = [F.when(fitted[n].isNull(), col(n)).alias(n) if n in fitted else col(n) for n in rows.columns]
    as_json = F.nullif(F.to_json(F.struct(*left)), F.lit("{}"))
    columns = [(fitted[n] if n in fitted else F.lit(None).cast(t)).alias(n) for n, t in declared.items()]
    return rows.select(*columns, as_json.alias(rescued))
