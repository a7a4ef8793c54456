"""Older silver tables, kept for their extra semantics: no keys, source column names, fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalith.functions import text, values
from medalith.functions.names import col
from medalith.operators.dedupe import latest_per_key, row_order
from medalith.operators.lookup import prefix_matches
from medalith.operators.upsert import upsert

LATEST = "ingestion_timestamp"


def accueillants(bronze: DataFrame) -> DataFrame:
    status = F.coalesce("statut", F.lit(values.DEFAULT_HOST_STATUS)).alias("statut")
    return bronze.select(status, "Ville", "Code_postal", "Latitude", "Longitude")


def geo(bronze: DataFrame) -> DataFrame:
    return bronze.select(F.col("code_insee").alias("CODGEO"), F.col("nom_standard").alias("LIBGEO"))


def gares(bronze: DataFrame) -> DataFrame:
    """Stations flagged exactly ``O``, newest per UIC code, with readable coordinate names."""
    newest = latest_per_key(bronze.filter(F.col("voyageurs") == "O"), ["code_uic"], [LATEST])
    names = [
        "code_uic", "libelle", "fret", "voyageurs", "code_ligne", "rg_troncon", "pk", "commune", "departemen",
        "idreseau", "idgaia", "x_l93", "y_l93", "x_wgs84", "y_wgs84", "c_geo", "geo_point", "geo_shape", LATEST,
    ]
    present = newest.select(*[c for c in names if c in newest.columns])
    return present.withColumnsRenamed({"x_wgs84": "longitude", "y_wgs84": "latitude"})


def lignes(bronze: DataFrame) -> DataFrame:
    """Newest row per line code, null code included; the high-speed flag is the text 1 or 0."""
    newest = latest_per_key(bronze, ["code_ligne"], [LATEST])
    flag = F.when(F.col("catlig") == values.HIGH_SPEED_CATEGORY, "1").otherwise("0")
    names = [
        "code_ligne", "lib_ligne", "catlig", "isTGV", "rg_troncon", "pkd", "pkf", "idgaia", "x_d_l93", "y_d_l93",
        "x_f_l93", "y_f_l93", "x_d_wgs84", "y_d_wgs84", "x_f_wgs84", "y_f_wgs84", "c_geo_d", "c_geo_f",
        "geo_point", "geo_shape", LATEST,
    ]
    typed = newest.withColumns({"isTGV": flag, "rg_troncon": text.rounded_int(F.col("rg_troncon"))})
    return typed.select(*[c for c in names if c in typed.columns])


def logement(bronze: DataFrame) -> DataFrame:
    """Newest rents per partition code.

    The partition code of the Lyon arrondissements differs from the commune code they are shown
    under, so that commune may appear twice. Files of different years name the code column
    ``INSEE_C`` or ``INSEE``.
    """
    codes = [col(c) for c in ("INSEE_C", "INSEE") if c in bronze.columns]
    padded = text.padded_commune_code(F.coalesce(*codes))
    partition = text.fold_arrondissement(padded, values.LEGACY_ARRONDISSEMENT_PARTITIONS)
    newest = latest_per_key(bronze, [partition], [LATEST], row_order(bronze))

    def optional(name: str) -> Column:
        return col(name).cast("string") if name in bronze.columns else F.lit(None).cast("string")

    return newest.select(
        text.fold_arrondissement(padded).alias("code_commune"),
        optional("LIBGEO").alias("lib_commune"),
        optional("EPCI").alias("lib_epci"),
        optional("DEP").alias("lib_dep"),
        optional("REG").alias("lib_reg"),
        col("loypredm2").alias("prix_loyer"),
        col("lwr.IPm2").alias("borne_inf_pred"),
        col("upr.IPm2").alias("borne_sup_pred"),
        col("TYPPRED").alias("niveau_pred"),
        F.coalesce(optional("_rescued_data"), F.lit("")).alias("rescued_data"),
    )


def siae_structures(structures: DataFrame, geo: DataFrame) -> DataFrame:
    """Structures with every geo row of their city: the same name anywhere, or a name that the city
    starts with in the same department. Unmatched structures stay, several matches give several rows."""
    keyed = structures.withColumns(
        {"__city": text.city_key(F.col("ville"), squeeze=True), "__dept": F.substring("code_postal", 1, 2)}
    )
    places = geo.select(
        text.upper_name(F.col("nom_standard")).alias("__name"),
        F.substring("code_postal", 1, 2).alias("__geo_dept"),
        F.col("code_insee").alias("__insee"),
        F.col("nom_standard").alias("__label"),
    )
    placed = prefix_matches(keyed, places, "__city", "__dept", "__name", "__geo_dept")

    def optional(name: str) -> Column:
        return col(name) if name in structures.columns else F.lit(None).cast("string")

    return placed.select(
        "id",
        "siret",
        optional("type").alias("structure_type"),
        optional("raison_sociale").alias("legal_name"),
        optional("enseigne").alias("trade_name"),
        F.coalesce(optional("telephone"), F.lit("")).alias("phone"),
        F.coalesce(optional("courriel"), F.lit("")).alias("email"),
        F.coalesce(optional("site_web"), F.lit("")).alias("website"),
        optional("description").alias("description"),
        F.col("bloque_candidatures").alias("accepting_applications"),
        optional("cree_le").alias("created_at"),
        F.col("mis_a_jour_le").alias("updated_at"),
        optional("addresse_ligne_1").alias("address_line_1"),
        F.coalesce(optional("addresse_ligne_2"), F.lit("")).alias("address_line_2"),
        F.col("code_postal").alias("postal_code"),
        text.upper_name(F.col("ville")).alias("city"),
        optional("departement").alias("department"),
        F.col("__insee").alias("insee_code"),
        F.col("__label").alias("standardized_city_name"),
    )


def siae_postes(postes: DataFrame, structures: DataFrame) -> DataFrame:
    """Postings with the context of every row their structure has in the older structure table."""
    context = structures.select(
        F.col("id").alias("__id"), "city", "postal_code", "department", "insee_code", "structure_type",
        F.col("legal_name").alias("structure_name"),
    )

    def optional(name: str) -> Column:
        return col(name) if name in postes.columns else F.lit(None).cast("string")

    return postes.join(context, F.col("structure_id") == F.col("__id"), "left").select(
        F.col("id").alias("poste_id"),
        "structure_id",
        optional("structure_siret").alias("siret"),
        F.col("rome").alias("rome_code"),
        F.coalesce(optional("appellation_modifiee"), F.lit("")).alias("job_title"),
        F.coalesce(optional("description"), F.lit("")).alias("job_description"),
        F.coalesce(optional("type_contrat"), F.lit("")).alias("contract_type"),
        F.col("recrutement_ouvert").cast("string").alias("is_recruiting"),
        F.coalesce(text.rounded_int(F.col("nombre_postes_ouverts")), F.lit(0)).alias("positions_available"),
        F.col("cree_le").alias("created_at"),
        F.col("mis_a_jour_le").alias("updated_at"),
        "city", "postal_code", "department", "insee_code", "structure_type", "structure_name",
    )


def zones_attraction(zones: DataFrame, communes: DataFrame, separator: str = " - ") -> DataFrame:
    """One row per name part of an area label and matching commune.

    ``separator`` is a regular expression: plain hyphens between spaces, or ``\\s* - \\s*``.
    """
    label = text.without_french_part(F.col("LIBAAV2020"))
    parts = zones.filter(F.col("AAV2020") != values.NO_AREA_CODE).select(
        "CODGEO",
        *[c for c in ("LIBGEO",) if c in zones.columns],
        "AAV2020",
        F.explode(F.split(label, separator)).alias("part"),
        "CATEAAV2020",
        "DEP",
        "REG",
    )
    named = parts.withColumn("LIBAAV2020", text.pole_label(F.trim("part")))
    poles = communes.select(F.col("CODGEO").alias("CODGEOAAV"), text.name_key(F.col("LIBGEO")).alias("__pole"))
    name = text.plain_name_key(F.col("LIBAAV2020"))
    matched = named.filter(name != "").join(poles, name == F.col("__pole"))
    return matched.filter(~F.contains("CODGEO", "CODGEOAAV")).select(
        "CODGEO",
        *[c for c in ("LIBGEO",) if c in zones.columns],
        F.col("AAV2020").alias("CODEAAV"),
        "CODGEOAAV",
        "LIBAAV2020",
        F.col("CATEAAV2020").alias("CATEAAV"),
        "DEP",
        "REG",
    )


# Notebook variants: the older tables were kept up to date by a merge of the newest rows.


def merge_gares(target: DataFrame, bronze: DataFrame) -> DataFrame:
    return upsert(target, gares(bronze).filter(F.col("code_uic").isNotNull()), ["code_uic"])


def merge_lignes(target: DataFrame, bronze: DataFrame) -> DataFrame:
    return upsert(target, lignes(bronze), ["code_ligne"])


def merge_logement(target: DataFrame, bronze: DataFrame) -> DataFrame:
    """The merge key is the commune shown, which two partition codes share: the newest of them wins,
    where a merge with two source rows per key would fail."""
    codes = [col(c) for c in ("INSEE_C", "INSEE") if c in bronze.columns]
    commune = text.fold_arrondissement(text.padded_commune_code(F.coalesce(*codes)))
    return upsert(target, logement(latest_per_key(bronze, [commune], [LATEST], row_order(bronze))), ["code_commune"])
