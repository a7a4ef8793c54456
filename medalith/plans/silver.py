"""Silver star schema: five dimensions and three facts, each one lazy plan over bronze frames.

Tables with fixed columns get every column they promise even when the source lacks an optional one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalith.functions import text, values
from medalith.functions.keys import surrogate_key, with_audit
from medalith.functions.names import col
from medalith.operators.dedupe import first_per_key, latest_per_key, row_order
from medalith.operators.lookup import look_up

LATEST = "ingestion_timestamp"


def _optional(df: DataFrame, name: str, data_type: str = "string") -> Column:
    return col(name) if name in df.columns else F.lit(None).cast(data_type)


def dim_commune(geo: DataFrame) -> DataFrame:
    code = F.col("code_insee")
    newest = latest_per_key(geo.filter(text.is_filled(code)), ["code_insee"], [LATEST])
    return with_audit(
        newest.select(
            surrogate_key(code).alias("commune_sk"),
            code.alias("commune_code"),
            F.col("nom_standard").alias("commune_label"),
            text.department_code(code).alias("departement_code"),
            text.region_code(code).alias("region_code"),
        ),
        "silver_geo",
    )


def dim_accueillant(accueillants: DataFrame, communes: DataFrame) -> DataFrame:
    """Host places, newest per place. Status text is part of the place, so one address with two
    statuses stays two rows."""
    order = row_order(accueillants)
    places = accueillants.filter(text.is_filled(F.col("Ville"))).withColumns(
        {
            "city": F.trim("Ville"),
            "postal": F.trim("Code_postal"),
            "lat": F.col("Latitude").try_cast("double"),
            "lon": F.col("Longitude").try_cast("double"),
        }
    )
    newest = latest_per_key(places, ["city", "postal", "lat", "lon", "statut"], [LATEST], order)
    on_map = newest.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).select(
        F.coalesce("statut", F.lit(values.DEFAULT_HOST_STATUS)).alias("statut"),
        F.col("city").alias("ville"),
        F.col("postal").alias("code_postal"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
    )
    key = surrogate_key(
        text.plain_double_text(F.col("latitude")),
        text.plain_double_text(F.col("longitude")),
        F.col("statut"),
        F.col("code_postal"),
        F.upper("ville"),
    )
    found = look_up(
        on_map, communes, F.substring("code_postal", 1, 5), "commune_code", {"commune_sk": "commune_sk"}
    )
    return with_audit(
        found.select(
            key.alias("accueillant_sk"), "commune_sk", "statut", "ville", "code_postal", "latitude", "longitude"
        ),
        "dim_accueillant",
    )


def dim_gare(gares: DataFrame, communes: DataFrame) -> DataFrame:
    """Passenger stations, newest per UIC code. The passenger flag alone decides: stations without a
    UIC code pass too, and count as one key."""
    flag = F.col("voyageurs")
    passengers = gares.filter(text.is_true_text(flag, values.STATION_TRUE_TEXTS))
    newest = latest_per_key(passengers, ["code_uic"], [LATEST])
    found = look_up(newest, communes, F.col("c_geo"), "commune_code", {"commune_sk": "found_sk"})

    def words(name: str) -> Column:
        return text.text_or_empty(_optional(gares, name))

    def number(name: str) -> Column:
        return F.coalesce(_optional(gares, name, "double").try_cast("double"), F.lit(0.0))

    columns = {
        "gare_sk": surrogate_key(F.col("code_uic")),
        "commune_sk": text.text_or_empty(F.col("found_sk")),
        "code_uic": words("code_uic"),
        "libelle": words("libelle"),
        "fret": text.is_true_text(_optional(gares, "fret"), values.STATION_TRUE_TEXTS),
        "voyageurs": text.is_true_text(flag, values.STATION_TRUE_TEXTS),
        "code_ligne": words("code_ligne"),
        "rg_troncon": words("rg_troncon"),
        "pk": words("pk"),
        "commune": words("commune"),
        "departement": words("departemen"),
        "idreseau": words("idreseau"),
        "idgaia": words("idgaia"),
        "x_l93": number("x_l93"),
        "y_l93": number("y_l93"),
        "longitude": number("x_wgs84"),
        "latitude": number("y_wgs84"),
        "c_geo": words("c_geo"),
        "geo_point": words("geo_point"),
        "geo_shape_coordinates": words("geo_shape_coordinates"),
        "geo_shape_type": words("geo_shape_type"),
        LATEST: text.utc_timestamp(F.col(LATEST), gares.schema[LATEST].dataType),
    }
    return with_audit(found.select(*[c.alias(n) for n, c in columns.items()]), "dim_gare")


def dim_ligne(lignes: DataFrame) -> DataFrame:
    newest = latest_per_key(lignes.filter(F.col("code_ligne").isNotNull()), ["code_ligne"], [LATEST])
    high_speed = F.coalesce(F.col("catlig") == values.HIGH_SPEED_CATEGORY, F.lit(False))
    numbers = ["x_d_l93", "y_d_l93", "x_f_l93", "y_f_l93", "x_d_wgs84", "y_d_wgs84", "x_f_wgs84", "y_f_wgs84"]
    return with_audit(
        newest.select(
            surrogate_key(F.col("code_ligne")).alias("ligne_sk"),
            F.col("code_ligne").alias("ligne_code"),
            F.col("lib_ligne").alias("ligne_label"),
            F.col("catlig").alias("categorie"),
            high_speed.alias("is_tgv"),
            *[_optional(lignes, c).alias(c) for c in ("rg_troncon", "pkd", "pkf", "idgaia")],
            *[_optional(lignes, c, "double").alias(c) for c in numbers],
            *[
                _optional(lignes, c).alias(c)
                for c in ("c_geo_d", "c_geo_f", "geo_point", "geo_shape_type", "geo_shape_coordinates")
            ],
            LATEST,
        ),
        "dim_ligne",
    )


def communes_by_city(geo: DataFrame, communes: DataFrame) -> DataFrame:
    """One geo row per normalized city name: a name known as a commune first, then the lowest code.

    A structure's match depends on nothing but its city name, so choosing here gives the same row as
    joining every homonym to every structure and choosing afterwards, without those pairs.
    """
    names = geo.select(
        text.upper_name(F.col("nom_standard")).alias("city_name"), "code_insee", "nom_standard"
    ).distinct()
    known = look_up(names, communes, F.col("code_insee"), "commune_code", {"commune_sk": "commune_sk"})
    order = [
        F.col("commune_sk").isNull(),
        F.col("code_insee").asc_nulls_last(),
        F.col("nom_standard").asc_nulls_last(),
    ]
    return first_per_key(known.filter(F.col("city_name").isNotNull()), [F.col("city_name")], order)


def dim_siae_structure(structures: DataFrame, geo: DataFrame, communes: DataFrame) -> DataFrame:
    """Structures with a 14-digit SIRET; per SIRET a row with a known commune wins over newer ones."""
    order = row_order(structures)
    valid = structures.filter(text.digit_count(F.col("siret")) == 14)
    placed = valid.join(
        communes_by_city(geo, communes), text.city_key(F.col("ville")) == F.col("city_name"), "left"
    )
    best = latest_per_key(placed, ["siret"], [F.col("commune_sk").isNull(), "mis_a_jour_le"], order)

    def optional(name: str) -> Column:
        return _optional(structures, name)

    columns = {
        "siae_structure_sk": surrogate_key(F.col("siret")),
        "commune_sk": F.col("commune_sk"),
        "id": F.col("id"),
        "siret": F.col("siret"),
        "structure_type": optional("type"),
        "raison_sociale": optional("raison_sociale"),
        "enseigne": optional("enseigne"),
        "telephone": F.coalesce(optional("telephone"), F.lit("")),
        "courriel": F.coalesce(optional("courriel"), F.lit("")),
        "site_web": F.coalesce(optional("site_web"), F.lit("")),
        "description": optional("description"),
        "accepte_candidatures": ~F.coalesce(F.col("bloque_candidatures"), F.lit(False)),
        "date_creation": optional("cree_le"),
        "date_mise_a_jour": F.col("mis_a_jour_le"),
        "adresse_ligne1": optional("addresse_ligne_1"),
        "adresse_ligne2": F.coalesce(optional("addresse_ligne_2"), F.lit("")),
        "code_postal": optional("code_postal"),
        "ville": F.col("ville"),
        "departement": optional("departement"),
        "code_insee": F.col("code_insee"),
        "ville_standardisee": F.col("nom_standard"),
    }
    return with_audit(best.select(*[c.alias(n) for n, c in columns.items()]), "silver_siae_structures")


def fact_logement(logement: DataFrame, communes: DataFrame) -> DataFrame:
    """Predicted rents per commune. The newest row of a commune is chosen first and judged afterwards,
    so a bad newest row removes the commune."""
    code = text.fold_arrondissement(text.padded_commune_code(F.col("INSEE_C")))
    order = row_order(logement)
    newest = latest_per_key(logement.withColumn("code_commune", code), ["code_commune"], [LATEST], order)
    rent, low, high = (col(c) for c in ("loypredm2", "lwr.IPm2", "upr.IPm2"))
    sound = newest.filter(
        (text.comma_double(rent) > 0) & (text.comma_double(low) < text.comma_double(high))
    )
    found = look_up(
        sound, communes, F.col("code_commune"), "commune_code", {"commune_sk": "commune_sk"}, "inner"
    )
    return with_audit(
        found.select(
            surrogate_key(F.col("code_commune")).alias("logement_sk"),
            "commune_sk",
            text.text_or_empty(F.col("EPCI")).alias("epci_code"),
            text.comma_decimal(rent).alias("loyer_predicted_m2"),
            text.comma_decimal(low).alias("loyer_lower_bound_m2"),
            text.comma_decimal(high).alias("loyer_upper_bound_m2"),
            text.text_or_empty(F.col("TYPPRED")).alias("prediction_level"),
            F.lit("").alias("data_rescued"),
            F.substring("code_commune", 1, 2).alias("code_departement"),
            text.text_or_empty(F.col("REG")).alias("code_region"),
        ),
        "fact_logement",
    )


def fact_siae_poste(postes: DataFrame, structures: DataFrame) -> DataFrame:
    """Job postings whose label has a part in parentheses, newest per posting and structure."""
    newest_by = ["mis_a_jour_le"] + ([LATEST] if LATEST in postes.columns else [])
    labelled = postes.filter(F.col("rome").like("%(%)%"))
    newest = latest_per_key(labelled, ["id", "structure_id"], newest_by)
    found = look_up(
        newest,
        structures.withColumn("id", F.col("id").cast("string")),
        F.col("structure_id").cast("string"),
        "id",
        {"siae_structure_sk": "found_sk"},
    )

    def words(name: str) -> Column:
        return text.text_or_empty(_optional(postes, name))

    def stamp(name: str) -> Column:
        return text.utc_timestamp(F.col(name), postes.schema[name].dataType)

    columns = {
        "siae_poste_sk": surrogate_key(F.col("id"), F.col("structure_id")),
        "siae_structure_sk": F.coalesce("found_sk", F.lit("")),
        "poste_id": F.col("id").cast("string"),
        "structure_id": F.col("structure_id").cast("string"),
        "structure_siret": words("structure_siret"),
        "rome_code": text.rome_code(F.col("rome")),
        "intitule_poste": F.coalesce(_optional(postes, "appellation_modifiee").cast("string"), F.col("rome")),
        "description_poste": words("description"),
        "contrat_type": words("type_contrat"),
        "poste_disponible": text.is_true_text(F.col("recrutement_ouvert"), values.POSTING_TRUE_TEXTS),
        "postes_nombre": F.coalesce(text.rounded_int(F.col("nombre_postes_ouverts")), F.lit(0)),
        "creation_date_utc": stamp("cree_le"),
        "modification_date_utc": stamp("mis_a_jour_le"),
    }
    return with_audit(found.select(*[c.alias(n) for n, c in columns.items()]), "fact_siae_poste")


def fact_zone_attraction(zones: DataFrame, communes: DataFrame) -> DataFrame:
    """Communes and the pole commune of their attraction area, matched by name.

    A pole name may belong to several communes; each gives a row. The pole's key comes from the name
    match itself: commune codes are unique in the dimension, so looking it up again changes nothing.
    """
    kept = zones.filter((F.col("AAV2020") != values.NO_AREA_CODE) & F.col("CODGEO").isNotNull())
    newest = latest_per_key(kept, ["CODGEO", "AAV2020"], [LATEST])
    label = text.pole_label(text.without_french_part(F.col("LIBAAV2020")))
    named = newest.select("CODGEO", "AAV2020", label.alias("area_label"), "CATEAAV2020", "DEP", "REG")
    poles = communes.select(
        text.name_key(F.col("commune_label")).alias("pole_name"),
        F.col("commune_code").alias("pole_code"),
        F.col("commune_sk").alias("commune_pole_sk"),
    )
    # a name without letters and digits has an empty key, which is no name to match by
    pole_name = text.plain_name_key(F.col("area_label"))
    matched = named.filter(pole_name != "").join(poles, pole_name == F.col("pole_name")).filter(
        ~F.contains("CODGEO", "pole_code")
    )
    found = look_up(
        matched, communes, F.col("CODGEO"), "commune_code", {"commune_sk": "commune_sk"}, "inner"
    )
    return with_audit(
        found.select(
            surrogate_key(F.col("CODGEO"), F.col("AAV2020"), F.col("pole_code")).alias("zone_attraction_sk"),
            "commune_sk",
            "commune_pole_sk",
            F.col("AAV2020").alias("aire_attraction_code"),
            F.col("area_label").alias("aire_attraction_label"),
            F.col("CATEAAV2020").alias("aire_attraction_categorie"),
            F.col("DEP").alias("departement_code"),
            F.col("REG").alias("region_code"),
        ),
        "fact_zone_attraction",
    )
