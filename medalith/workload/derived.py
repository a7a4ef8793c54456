"""Bronze tables derived from the given tables.

Each table is a list of (column, expression) over one of four bases. The expressions are plain SQL
that Spark and DuckDB both understand, so that every query over a derived table can be checked. The
number of rows, keys and names grows with the given tables; homonyms and duplicates per key do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

_BASES = {
    "orders": "orders",
    "customer": "customer",
    "lineitem": "lineitem",
    "lineitem_orders": "lineitem JOIN orders ON l_orderkey = o_orderkey",
}


def _digits(n: str, width: int) -> str:
    return f"LPAD(CAST({n} AS STRING), {width}, '0')"


def _commune_code(k: str) -> str:
    return (
        f"CASE WHEN {k} % 97 = 0 THEN NULL WHEN {k} % 89 = 0 THEN 'nan' WHEN {k} % 83 = 0 THEN '' "
        f"WHEN {k} % 31 = 0 THEN '13055' WHEN {k} % 37 = 0 THEN '69123' WHEN {k} % 41 = 0 THEN '75056' "
        f"WHEN {k} % 43 = 0 THEN CONCAT('2', CASE WHEN {k} % 2 = 0 THEN 'A' ELSE 'B' END, {_digits(f'{k} % 1000', 3)}) "
        f"WHEN {k} % 20 = 0 THEN CONCAT('97', CAST(1 + {k} % 6 AS STRING), {_digits(f'{k} % 100', 2)}) "
        f"ELSE {_plain_code(k)} END"
    )


def _plain_code(k: str) -> str:
    return _digits(f"1000 + ({k} * 617) % 94000", 5)


def _rent(shift: int) -> str:
    """A rent with a decimal comma, from the whole quantity and the line number."""
    return f"CONCAT(CAST(CAST(l_quantity AS INT) + {shift} AS STRING), ',', {_digits('l_linenumber * 7', 2)})"


# Two neighbouring customers share a town name, so names are homonyms of each other in pairs.
def _town(k: str) -> str:
    return f"CAST({k} - {k} % 2 AS STRING)"


_ORDER_ROW = "o_orderkey"
LINE_ROW = (
    "CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', "
    "CAST(l_suppkey AS STRING), '-', CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING))"
)

BRONZE: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "bronze_geo": (
        "orders",
        [
            ("code_insee", _commune_code("o_custkey")),
            ("nom_standard", f"CONCAT('Ville ', {_town('o_custkey')})"),
            ("code_postal", _plain_code("o_custkey")),
            ("ingestion_timestamp", "o_orderdate"),
            ("source_row", _ORDER_ROW),
        ],
    ),
    "bronze_geo_snapshot": (
        "customer",
        [
            ("code_insee", _plain_code("c_custkey")),
            ("nom_standard", f"CONCAT('Ville ', {_town('c_custkey')})"),
            ("code_postal", _plain_code("c_custkey")),
            ("source_row", "c_custkey"),
        ],
    ),
    "bronze_accueillants": (
        "orders",
        [
            ("statut", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_orderstatus END"),
            (
                "Ville",
                f"CASE WHEN o_custkey % 50 = 0 THEN '' WHEN o_custkey % 51 = 0 THEN NULL "
                f"ELSE CONCAT(' Ville ', {_town('o_custkey')}, ' ') END",
            ),
            ("Code_postal", f"' ' || {_commune_code('o_custkey')}"),
            ("Latitude", "CONCAT(CAST(31 + o_custkey % 70 AS STRING), '.0625')"),
            ("Longitude", "CONCAT(CAST(o_custkey % 15 - 5 AS STRING), '.0004')"),
            ("ingestion_timestamp", "o_orderdate"),
            ("source_row", _ORDER_ROW),
        ],
    ),
    "bronze_logement": (
        "lineitem_orders",
        [
            (
                "INSEE_C",
                f"CASE WHEN o_custkey % 31 = 0 THEN CONCAT('132', {_digits('1 + o_custkey % 16', 2)}) "
                f"WHEN o_custkey % 37 = 0 THEN CONCAT('693', {_digits('81 + o_custkey % 9', 2)}) "
                f"WHEN o_custkey % 74 = 1 THEN '69123' "
                f"WHEN o_custkey % 41 = 0 THEN CONCAT('751', {_digits('1 + o_custkey % 20', 2)}) "
                f"ELSE CAST(1000 + (o_custkey * 617) % 94000 AS STRING) END",
            ),
            ("LIBGEO", f"CONCAT('Ville ', {_town('o_custkey')})"),
            ("EPCI", f"CONCAT('2', {_digits('o_custkey % 1000', 8)})"),
            ("DEP", f"SUBSTRING({_plain_code('o_custkey')}, 1, 2)"),
            ("REG", "CAST(o_custkey % 18 AS STRING)"),
            ("TYPPRED", "CASE WHEN l_linenumber % 2 = 0 THEN 'commune' ELSE 'maille' END"),
            ("loypredm2", f"CASE WHEN l_linenumber = 6 THEN '' ELSE {_rent(0)} END"),
            ("lwr.IPm2", _rent(-1)),
            ("upr.IPm2", f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {_rent(1)} END"),
            ("ingestion_timestamp", "l_shipdate"),
            ("source_row", LINE_ROW),
        ],
    ),
    "bronze_gares": (
        "lineitem",
        [
            ("code_uic", "CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST(87000000 + l_partkey AS STRING) END"),
            ("libelle", "CONCAT('Gare ', CAST(l_partkey AS STRING))"),
            ("fret", "CASE l_linestatus WHEN 'F' THEN 'O' ELSE 'N' END"),
            ("voyageurs", "CASE l_returnflag WHEN 'A' THEN 'O' WHEN 'R' THEN 'true' ELSE 'N' END"),
            ("code_ligne", "CAST(l_suppkey AS STRING)"),
            ("rg_troncon", "CAST(l_linenumber AS STRING)"),
            ("c_geo", _commune_code("l_partkey")),
            ("x_wgs84", "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_discount END"),
            ("y_wgs84", "l_quantity"),
            ("ingestion_timestamp", "l_shipdate"),
            ("source_row", LINE_ROW),
        ],
    ),
    "bronze_lignes": (
        "lineitem",
        [
            ("code_ligne", "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END"),
            ("lib_ligne", "CONCAT('Ligne ', CAST(l_suppkey AS STRING))"),
            ("catlig", "CASE WHEN l_suppkey % 5 = 0 THEN 'Ligne à grande vitesse' ELSE 'Ligne classique' END"),
            ("rg_troncon", "CAST(l_linenumber AS STRING)"),
            ("x_d_l93", "l_quantity"),
            ("ingestion_timestamp", "l_shipdate"),
            ("source_row", LINE_ROW),
        ],
    ),
    "bronze_siae_structures": (
        "customer",
        [
            ("id", "CONCAT('st-', CAST(c_custkey AS STRING))"),
            (
                "siret",
                f"CASE WHEN c_custkey % 53 = 0 THEN '123 456' WHEN c_custkey % 59 = 0 THEN NULL "
                f"ELSE {_digits('(c_custkey - c_custkey % 3) * 7919', 14)} END",
            ),
            (
                "type",
                "CASE c_custkey % 4 WHEN 0 THEN 'EI' WHEN 1 THEN 'AI' WHEN 2 THEN 'ACI' ELSE 'ETTI' END",
            ),
            ("raison_sociale", "c_name"),
            (
                "ville",
                f"CASE WHEN c_custkey % 11 = 0 THEN CONCAT('Inconnue-', {_town('c_custkey')}) "
                f"WHEN c_custkey % 7 = 0 THEN CONCAT('ville-', {_town('c_custkey')}, '-sur-mer') "
                f"WHEN c_custkey % 13 = 0 THEN CONCAT('ville--', {_town('c_custkey')}) "
                f"ELSE CONCAT('ville-', {_town('c_custkey')}) END",
            ),
            ("code_postal", _plain_code("c_custkey")),
            ("departement", f"SUBSTRING({_plain_code('c_custkey')}, 1, 2)"),
            ("telephone", "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CONCAT('01', CAST(c_custkey AS STRING)) END"),
            (
                "bloque_candidatures",
                "CASE WHEN c_custkey % 5 = 0 THEN TRUE WHEN c_custkey % 5 = 1 THEN NULL ELSE FALSE END",
            ),
            (
                "mis_a_jour_le",
                f"CONCAT('2024-', {_digits('1 + c_custkey % 12', 2)}, '-', {_digits('1 + c_custkey % 28', 2)}, 'T08:00:00')",
            ),
            ("source_row", "c_custkey"),
        ],
    ),
    "bronze_siae_postes": (
        "lineitem_orders",
        [
            ("id", "CONCAT('p-', CAST(l_orderkey AS STRING))"),
            ("structure_id", "CONCAT('st-', CAST(o_custkey AS STRING))"),
            (
                "rome",
                f"CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Agent sans code' WHEN 2 THEN 'Agent (abc)' "
                f"ELSE CONCAT('Agent (K', {_digits('l_partkey % 10000', 4)}, ')') END",
            ),
            (
                "recrutement_ouvert",
                "CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'R' THEN 't' ELSE 'False' END",
            ),
            (
                "nombre_postes_ouverts",
                "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '2.5' "
                "ELSE CAST(l_linenumber AS STRING) END",
            ),
            ("cree_le", "o_orderdate"),
            ("mis_a_jour_le", "l_shipdate"),
            ("source_row", LINE_ROW),
        ],
    ),
    "bronze_zones_attraction": (
        "orders",
        [
            ("CODGEO", _commune_code("o_custkey")),
            ("LIBGEO", f"CONCAT('Ville ', {_town('o_custkey')})"),
            ("AAV2020", _digits("o_custkey % 50", 3)),
            (
                "LIBAAV2020",
                f"CONCAT(CASE WHEN o_custkey % 9 = 0 THEN CONCAT('Ville ', {_town('o_custkey + 2')}, "
                f"CASE WHEN o_custkey % 18 = 0 THEN CHR(9) ELSE '' END, ' - ') ELSE '' END, "
                f"'VILLE-', {_town('o_custkey + 5')}, "
                f"CASE WHEN o_custkey % 10 = 0 THEN ' (Partie Française)' ELSE '' END)",
            ),
            ("CATEAAV2020", "CAST(o_custkey % 5 AS STRING)"),
            ("DEP", "CAST(o_custkey % 96 AS STRING)"),
            ("REG", "CAST(o_custkey % 18 AS STRING)"),
            ("ingestion_timestamp", "o_orderdate"),
            ("source_row", _ORDER_ROW),
        ],
    ),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a Spark frame."""
    base, columns = BRONZE[name]
    if base == "lineitem_orders":
        lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
        df = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        df = read(spark, sf_dir, base)
    return df.selectExpr(*[f"{expression} AS `{column}`" for column, expression in columns])


def bronze_sql(name: str) -> str:
    """The same table as ANSI SQL over the given tables."""
    base, columns = BRONZE[name]
    listed = ", ".join(f'{expression} AS "{column}"' for column, expression in columns)
    return f"SELECT {listed} FROM {_BASES[base]}"
