"""The silver and gold tables with their inputs, and a full run over stored layers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.plans import bronze, gold, legacy, silver
from medalith.session import shuffles_go
from medalith.sources.tables import read_table, row_counts, write_table


@dataclass(frozen=True)
class Table:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    description: str = ""


# In an order that builds every table after its inputs.
SILVER = {
    "dim_commune": Table(silver.dim_commune, ("bronze.geo",), "Communes avec département et région"),
    "dim_accueillant": Table(
        silver.dim_accueillant, ("bronze.accueillants", "silver.dim_commune"), "Lieux d'accueil géolocalisés"
    ),
    "dim_gare": Table(silver.dim_gare, ("bronze.gares", "silver.dim_commune"), "Gares de voyageurs"),
    "dim_ligne": Table(silver.dim_ligne, ("bronze.lignes",), "Lignes ferroviaires"),
    "dim_siae_structure": Table(
        silver.dim_siae_structure,
        ("bronze.siae_structures", "bronze.geo", "silver.dim_commune"),
        "Structures d'insertion rattachées à leur commune",
    ),
    "fact_logement": Table(
        silver.fact_logement, ("bronze.logement", "silver.dim_commune"), "Loyers prédits par commune"
    ),
    "fact_zone_attraction": Table(
        silver.fact_zone_attraction,
        ("bronze.zones_attraction", "silver.dim_commune"),
        "Communes et pôle de leur aire d'attraction",
    ),
    "fact_siae_poste": Table(
        silver.fact_siae_poste, ("bronze.siae_postes", "silver.dim_siae_structure"), "Postes des structures"
    ),
}
GOLD = {
    "rent_by_commune": Table(gold.rent_by_commune, ("silver.dim_commune", "silver.fact_logement")),
    "jobs_with_structure": Table(
        gold.jobs_with_structure, ("silver.dim_siae_structure", "silver.fact_siae_poste")
    ),
    "stations_by_commune": Table(gold.stations_by_commune, ("silver.dim_commune", "silver.dim_gare")),
    "structures_by_area": Table(
        gold.structures_by_area,
        ("silver.fact_zone_attraction", "silver.dim_siae_structure", "silver.fact_siae_poste"),
    ),
    "low_rent_with_structures": Table(
        gold.low_rent_with_structures, ("silver.dim_commune", "silver.fact_logement", "silver.dim_siae_structure")
    ),
    "transport_access": Table(
        gold.transport_access, ("silver.dim_siae_structure", "silver.dim_commune", "silver.dim_gare")
    ),
}


# The older silver tables that three gold queries still read, stored with the other silver tables.
LEGACY = {
    "old_geo": Table(legacy.geo, ("bronze.geo",)),
    "old_siae_structures": Table(legacy.siae_structures, ("bronze.siae_structures", "bronze.geo_snapshot")),
    "old_logement": Table(legacy.logement, ("bronze.logement",)),
}
LEGACY_GOLD = {
    "positions_by_department": Table(
        gold.positions_by_department, ("bronze.siae_postes", "silver.old_siae_structures")
    ),
    "structures_and_rents": Table(
        gold.structures_and_rents, ("silver.old_siae_structures", "silver.old_geo", "silver.old_logement")
    ),
    "accepting_structures": Table(gold.accepting_structures, ("silver.old_siae_structures",)),
}
# Stage -> layer its tables are stored in, and the tables.
STAGES = {
    "silver": ("silver", SILVER),
    "gold": ("gold", GOLD),
    "legacy": ("silver", LEGACY),
    "legacy_gold": ("gold", LEGACY_GOLD),
}


def dependency_edges(spark: SparkSession) -> DataFrame:
    """Edges (node, dependency) between ``layer.table`` names."""
    rows = [
        (f"{layer}.{name}", dependency)
        for layer, tables in (("silver", SILVER), ("gold", GOLD))
        for name, table in tables.items()
        for dependency in table.inputs
    ]
    return spark.createDataFrame(rows, "node string, dependency string")


def ingest_layer(
    spark: SparkSession, root: str, files: dict[str, str], pages: dict[str, str] | None = None, force: bool = False, **options
) -> list[tuple[str, str, str]]:
    """The bronze stage: new files of each file pipeline, landed pages of each API table.

    ``files`` and ``pages`` map a pipeline to its folder. One pipeline's failure does not stop the
    others. Returns (table, status, message) per pipeline, as ``build_layer`` does.
    """
    outcome = []
    for name, folder in files.items():
        try:
            done = bronze.ingest_files(spark, root, name, folder, force=force).first()
            outcome.append((name, done.status, f"{done.rows_processed} rows"))
        except Exception as error:
            outcome.append((name, "failed", str(error).splitlines()[0]))
    for name, folder in (pages or {}).items():
        try:
            status = bronze.refresh_api_table(spark, root, name, folder, bronze.API_READERS[name], force, **options)
            outcome.append((name, status, ""))
        except Exception as error:
            outcome.append((name, "failed", str(error).splitlines()[0]))
    return outcome


def build_layer(spark: SparkSession, root: str, stage: str) -> list[tuple[str, str, str]]:
    """Write every table of a stage from the stored tables it reads; stop at the first failure.

    Returns (table, status, message) per table tried. Each table is one Spark job over stored inputs,
    so nothing upstream is computed twice and a rerun starts from finished tables. Its shuffle files go with it.
    """
    outcome = []
    layer, tables = STAGES[stage]
    for name, table in tables.items():
        try:
            inputs = [read_table(spark, root, *i.split(".")) for i in table.inputs]
            with shuffles_go(spark):
                write_table(table.build(*inputs), root, layer, name, "overwrite")
            outcome.append((name, "success", ""))
        except Exception as error:
            outcome.append((name, "failed", str(error).splitlines()[0]))
            break
    return outcome


def silver_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Silver tables with description, inputs and row count (null while a table is not built)."""
    registry = spark.createDataFrame(
        [(n, t.description, ", ".join(t.inputs)) for n, t in SILVER.items()],
        "name string, description string, dependencies string",
    )
    return registry.join(row_counts(spark, root, "silver", list(SILVER)), "name", "left").select(
        "name", "description", "dependencies", F.col("row_count")
    )
