"""The registered queries as ANSI SQL over the given tables.

Each statement spells the query out in its plain form (joins with their fan-out, windows over the
whole join), independent of how the Spark plan computes it.
"""

from __future__ import annotations

import re

from medalith.functions import values
from medalith.workload import derived

# --- shared relations: name -> SQL, which may use other relations and the given tables --------------

RELATIONS: dict[str, str] = {name: derived.bronze_sql(name) for name in derived.BRONZE}

def _region(column: str) -> str:
    """Region of a commune code, over the same fixed codes as the library."""
    listed = [
        f"WHEN substring({column}, 1, 2) IN ({', '.join(repr(d) for d in departments)}) THEN '{region}'"
        for region, departments in values.DEPARTMENTS_BY_REGION.items()
    ]
    listed += [
        f"WHEN substring({column}, 1, 3) = '{department}' THEN '{region}'"
        for region, department in values.OVERSEAS_DEPARTMENT_BY_REGION.items()
    ]
    return f"CASE {' '.join(listed)} END"


def _department(column: str) -> str:
    overseas = " OR ".join(f"{column} LIKE '{prefix}%'" for prefix in values.OVERSEAS_PREFIXES)
    return f"CASE WHEN {overseas} THEN substring({column}, 1, 3) ELSE substring({column}, 1, 2) END"


def _folded(code: str, lyon: str = "69123") -> str:
    return (
        f"CASE WHEN {code} LIKE '132%' THEN '13055' WHEN {code} LIKE '693%' THEN '{lyon}' "
        f"WHEN {code} LIKE '751%' THEN '75056' ELSE {code} END"
    )


def _dotted(column: str) -> str:
    return f"REPLACE({column}, ',', '.')"


def _pole(label: str) -> str:
    spelled = f"REPLACE({label}, 'œ', 'oe')"
    return (
        f"CASE WHEN {spelled} ILIKE 'Hesdin%' THEN 'Hesdin' WHEN {spelled} ILIKE 'Cugand%' THEN 'Cugand' "
        f"ELSE {spelled} END"
    )


def _letters(name: str) -> str:
    return f"regexp_replace(upper({name}), '[^A-Z0-9]', '', 'g')"


def _no_part(label: str) -> str:
    return f"regexp_replace({label}, '(?i)\\s*\\(partie française\\)', '', 'g')"


def _rank(keys: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def _newest(keys: str, time: str = "ingestion_timestamp") -> str:
    return _rank(keys, f"{time} DESC NULLS LAST, source_row ASC NULLS LAST")


RELATIONS["dim_commune"] = f"""
SELECT md5(code_insee) AS commune_sk, code_insee AS commune_code, nom_standard AS commune_label,
  {_department("code_insee")} AS departement_code, {_region("code_insee")} AS region_code,
  'silver_geo' AS job_insert_id, 'silver_geo' AS job_modify_id
FROM bronze_geo WHERE code_insee IS NOT NULL AND code_insee NOT IN ('', 'nan') {_newest("code_insee")}"""

RELATIONS["hosts"] = f"""
SELECT coalesce(statut, 'Sans statut') AS statut, trim(Ville) AS ville, trim(Code_postal) AS code_postal,
  CAST(Latitude AS DOUBLE) AS latitude, CAST(Longitude AS DOUBLE) AS longitude
FROM (SELECT * FROM bronze_accueillants WHERE Ville IS NOT NULL AND Ville NOT IN ('', 'nan')
  {_newest("trim(Ville), trim(Code_postal), CAST(Latitude AS DOUBLE), CAST(Longitude AS DOUBLE), statut")}) d
WHERE CAST(Latitude AS DOUBLE) BETWEEN -90 AND 90 AND CAST(Longitude AS DOUBLE) BETWEEN -180 AND 180"""

RELATIONS["dim_accueillant"] = """
SELECT md5(concat(CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), statut, coalesce(code_postal, ''), upper(ville)))
    AS accueillant_sk,
  commune_sk, statut, ville, code_postal, latitude, longitude,
  'dim_accueillant' AS job_insert_id, 'dim_accueillant' AS job_modify_id
FROM hosts LEFT JOIN dim_commune ON substring(code_postal, 1, 5) = commune_code"""

RELATIONS["dim_gare"] = f"""
SELECT md5(g.code_uic) AS gare_sk, coalesce(c.commune_sk, '') AS commune_sk, coalesce(g.code_uic, '') AS code_uic,
  libelle, fret IN ('O', 'true') AS fret, voyageurs IN ('O', 'true') AS voyageurs, code_ligne, rg_troncon,
  '' AS pk, '' AS commune, '' AS departement, '' AS idreseau, '' AS idgaia,
  CAST(0 AS DOUBLE) AS x_l93, CAST(0 AS DOUBLE) AS y_l93, coalesce(x_wgs84, 0) AS longitude,
  coalesce(y_wgs84, 0) AS latitude, coalesce(c_geo, '') AS c_geo, '' AS geo_point,
  '' AS geo_shape_coordinates, '' AS geo_shape_type, ingestion_timestamp,
  'dim_gare' AS job_insert_id, 'dim_gare' AS job_modify_id
FROM (SELECT * FROM bronze_gares WHERE voyageurs IN ('O', 'true') {_newest("code_uic")}) g
LEFT JOIN dim_commune c ON g.c_geo = c.commune_code"""

RELATIONS["dim_ligne"] = f"""
SELECT md5(code_ligne) AS ligne_sk, code_ligne AS ligne_code, lib_ligne AS ligne_label, catlig AS categorie,
  catlig = 'Ligne à grande vitesse' AS is_tgv, rg_troncon, CAST(NULL AS VARCHAR) AS pkd, CAST(NULL AS VARCHAR) AS pkf,
  CAST(NULL AS VARCHAR) AS idgaia, x_d_l93, CAST(NULL AS DOUBLE) AS y_d_l93, CAST(NULL AS DOUBLE) AS x_f_l93,
  CAST(NULL AS DOUBLE) AS y_f_l93, CAST(NULL AS DOUBLE) AS x_d_wgs84, CAST(NULL AS DOUBLE) AS y_d_wgs84,
  CAST(NULL AS DOUBLE) AS x_f_wgs84, CAST(NULL AS DOUBLE) AS y_f_wgs84, CAST(NULL AS VARCHAR) AS c_geo_d,
  CAST(NULL AS VARCHAR) AS c_geo_f, CAST(NULL AS VARCHAR) AS geo_point, CAST(NULL AS VARCHAR) AS geo_shape_type,
  CAST(NULL AS VARCHAR) AS geo_shape_coordinates, ingestion_timestamp,
  'dim_ligne' AS job_insert_id, 'dim_ligne' AS job_modify_id
FROM bronze_lignes WHERE code_ligne IS NOT NULL {_newest("code_ligne")}"""

RELATIONS["placed_structures"] = """
SELECT s.*, g.code_insee, g.nom_standard, c.commune_sk, g.source_row AS geo_row
FROM bronze_siae_structures s
LEFT JOIN bronze_geo g ON upper(trim(replace(s.ville, '-', ' '))) = upper(trim(g.nom_standard))
LEFT JOIN dim_commune c ON g.code_insee = c.commune_code
WHERE length(regexp_replace(s.siret, '[^0-9]', '', 'g')) = 14"""

_BEST_STRUCTURE = _rank(
    "siret",
    "CASE WHEN commune_sk IS NULL THEN 1 ELSE 0 END, mis_a_jour_le DESC NULLS LAST, source_row, "
    "code_insee NULLS LAST, nom_standard NULLS LAST, geo_row",
)
RELATIONS["dim_siae_structure"] = f"""
SELECT md5(siret) AS siae_structure_sk, commune_sk, id, siret, type AS structure_type, raison_sociale,
  CAST(NULL AS VARCHAR) AS enseigne, coalesce(telephone, '') AS telephone, '' AS courriel, '' AS site_web,
  CAST(NULL AS VARCHAR) AS description, bloque_candidatures IS DISTINCT FROM TRUE AS accepte_candidatures,
  CAST(NULL AS VARCHAR) AS date_creation, mis_a_jour_le AS date_mise_a_jour, CAST(NULL AS VARCHAR) AS adresse_ligne1,
  '' AS adresse_ligne2, code_postal, ville, departement, code_insee, nom_standard AS ville_standardisee,
  'silver_siae_structures' AS job_insert_id, 'silver_siae_structures' AS job_modify_id
FROM placed_structures {_BEST_STRUCTURE}"""

_RENT_CODE = "lpad(INSEE_C, 5, '0')"
RELATIONS["fact_logement"] = f"""
SELECT md5(code_commune) AS logement_sk, c.commune_sk, EPCI AS epci_code,
  CAST({_dotted("loypredm2")} AS DECIMAL(10,2)) AS loyer_predicted_m2,
  CAST({_dotted('"lwr.IPm2"')} AS DECIMAL(10,2)) AS loyer_lower_bound_m2,
  CAST({_dotted('"upr.IPm2"')} AS DECIMAL(10,2)) AS loyer_upper_bound_m2,
  TYPPRED AS prediction_level, '' AS data_rescued, substring(code_commune, 1, 2) AS code_departement,
  REG AS code_region, 'fact_logement' AS job_insert_id, 'fact_logement' AS job_modify_id
FROM (SELECT *, {_folded(_RENT_CODE)} AS code_commune FROM bronze_logement {_newest(_folded(_RENT_CODE))}) r
JOIN dim_commune c ON r.code_commune = c.commune_code
WHERE TRY_CAST({_dotted("loypredm2")} AS DOUBLE) > 0
  AND TRY_CAST({_dotted('"lwr.IPm2"')} AS DOUBLE) < TRY_CAST({_dotted('"upr.IPm2"')} AS DOUBLE)"""

_POSITIONS = "coalesce(CAST(round(TRY_CAST(nombre_postes_ouverts AS DOUBLE)) AS INTEGER), 0)"
_ROME = "regexp_extract(rome, '\\(([A-Z][0-9]{4})\\)', 1)"
RELATIONS["fact_siae_poste"] = f"""
SELECT md5(concat(p.id, p.structure_id)) AS siae_poste_sk, coalesce(s.siae_structure_sk, '') AS siae_structure_sk,
  p.id AS poste_id, p.structure_id, '' AS structure_siret, {_ROME} AS rome_code, rome AS intitule_poste,
  '' AS description_poste, '' AS contrat_type, recrutement_ouvert IN ('true', 'True', '1', 't') AS poste_disponible,
  {_POSITIONS} AS postes_nombre, cree_le AS creation_date_utc, p.mis_a_jour_le AS modification_date_utc,
  'fact_siae_poste' AS job_insert_id, 'fact_siae_poste' AS job_modify_id
FROM (SELECT * FROM bronze_siae_postes WHERE rome LIKE '%(%)%' {_newest("id, structure_id", "mis_a_jour_le")}) p
LEFT JOIN dim_siae_structure s ON p.structure_id = s.id"""

RELATIONS["area_names"] = f"""
SELECT CODGEO, AAV2020, {_pole("stripped")} AS area_label, CATEAAV2020, DEP, REG
FROM (SELECT *, {_no_part("LIBAAV2020")} AS stripped FROM bronze_zones_attraction
  WHERE AAV2020 <> '000' AND CODGEO IS NOT NULL {_newest("CODGEO, AAV2020")}) z"""

RELATIONS["fact_zone_attraction"] = f"""
SELECT md5(concat(n.CODGEO, n.AAV2020, p.commune_code)) AS zone_attraction_sk, c1.commune_sk, c2.commune_sk AS commune_pole_sk,
  n.AAV2020 AS aire_attraction_code, n.area_label AS aire_attraction_label,
  n.CATEAAV2020 AS aire_attraction_categorie, n.DEP AS departement_code, n.REG AS region_code,
  'fact_zone_attraction' AS job_insert_id, 'fact_zone_attraction' AS job_modify_id
FROM area_names n
JOIN dim_commune p ON {_letters("n.area_label")} = {_letters("replace(p.commune_label, 'œ', 'oe')")}
JOIN dim_commune c1 ON n.CODGEO = c1.commune_code
JOIN dim_commune c2 ON p.commune_code = c2.commune_code
WHERE n.CODGEO NOT LIKE concat('%', p.commune_code, '%')"""

_CITY = "upper(trim(replace(replace(s.ville, '-', ' '), '  ', ' ')))"
RELATIONS["old_structures"] = f"""
SELECT s.id, s.siret, s.type AS structure_type, s.raison_sociale AS legal_name, CAST(NULL AS VARCHAR) AS trade_name,
  coalesce(s.telephone, '') AS phone, '' AS email, '' AS website, CAST(NULL AS VARCHAR) AS description,
  s.bloque_candidatures AS accepting_applications, CAST(NULL AS VARCHAR) AS created_at, s.mis_a_jour_le AS updated_at,
  CAST(NULL AS VARCHAR) AS address_line_1, '' AS address_line_2, s.code_postal AS postal_code,
  upper(trim(s.ville)) AS city, s.departement AS department, g.code_insee AS insee_code,
  g.nom_standard AS standardized_city_name
FROM bronze_siae_structures s
LEFT JOIN bronze_geo_snapshot g ON {_CITY} = upper(trim(g.nom_standard))
  OR (starts_with({_CITY}, upper(trim(g.nom_standard))) AND left(s.code_postal, 2) = left(g.code_postal, 2))"""

RELATIONS["old_postes"] = f"""
SELECT p.id AS poste_id, p.structure_id, CAST(NULL AS VARCHAR) AS siret, p.rome AS rome_code, '' AS job_title,
  '' AS job_description, '' AS contract_type, p.recrutement_ouvert AS is_recruiting,
  {_POSITIONS} AS positions_available, p.cree_le AS created_at, p.mis_a_jour_le AS updated_at, s.city, s.postal_code,
  s.department, s.insee_code, s.structure_type, s.legal_name AS structure_name
FROM bronze_siae_postes p LEFT JOIN old_structures s ON p.structure_id = s.id"""


def _old_rents(source: str, where: str = "TRUE", code: str = _RENT_CODE) -> str:
    return f"""
SELECT {_folded(code)} AS code_commune, LIBGEO AS lib_commune, EPCI AS lib_epci, DEP AS lib_dep, REG AS lib_reg,
  loypredm2 AS prix_loyer, "lwr.IPm2" AS borne_inf_pred, "upr.IPm2" AS borne_sup_pred, TYPPRED AS niveau_pred,
  '' AS rescued_data
FROM {source} WHERE {where} """


RELATIONS["old_rents"] = _old_rents("bronze_logement") + _newest(_folded(_RENT_CODE, "69300"))

_OLD_STATION = (
    "SELECT code_uic, libelle, fret, voyageurs, code_ligne, rg_troncon, x_wgs84 AS longitude, y_wgs84 AS latitude, "
    "c_geo, ingestion_timestamp FROM bronze_gares WHERE voyageurs = 'O'"
)
_OLD_LINE = (
    "SELECT code_ligne, lib_ligne, catlig, CASE WHEN catlig = 'Ligne à grande vitesse' THEN '1' ELSE '0' END AS \"isTGV\", "
    "CAST(rg_troncon AS INTEGER) AS rg_troncon, x_d_l93, ingestion_timestamp FROM bronze_lignes"
)


def _old_zones(parts: str) -> str:
    return f"""
SELECT b.CODGEO, b.LIBGEO, b.AAV2020 AS "CODEAAV", g.code_insee AS "CODGEOAAV", b.label AS "LIBAAV2020",
  b.CATEAAV2020 AS "CATEAAV", b.DEP, b.REG
FROM (SELECT CODGEO, LIBGEO, AAV2020, {_pole("trim(part)")} AS label, CATEAAV2020, DEP, REG
  FROM (SELECT *, unnest({parts}) AS part FROM bronze_zones_attraction WHERE AAV2020 <> '000') e) b
JOIN bronze_geo_snapshot g ON {_letters("b.label")} = {_letters("replace(g.nom_standard, 'œ', 'oe')")}
WHERE b.CODGEO NOT LIKE concat('%', g.code_insee, '%')"""


def _merged(target: str, source: str, key: str) -> str:
    """A merge that updates every column: source rows, and target rows whose key the source lacks."""
    return (
        f"WITH src AS ({source}), tgt AS ({target}) SELECT * FROM src UNION ALL BY NAME "
        f"SELECT * FROM tgt WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM src WHERE {key} IS NOT NULL)"
    )


_SPLIT_98 = "ingestion_timestamp < TIMESTAMP '1998-01-01'"
_SPLIT_96 = "ingestion_timestamp < TIMESTAMP '1996-01-01'"

RELATIONS["old_orders"] = """
SELECT o_custkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderkey
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) = 1"""
RELATIONS["new_orders"] = RELATIONS["old_orders"].replace("o_orderdate < TIMESTAMP", "o_orderdate >= TIMESTAMP")
_MERGED_ORDERS = """
SELECT * FROM new_orders UNION ALL
SELECT t.* FROM old_orders t ANTI JOIN new_orders s USING (o_custkey, o_orderpriority)"""
_ORDER_STATS = """
SELECT (SELECT count(*) FROM old_orders SEMI JOIN new_orders USING (o_custkey, o_orderpriority)) AS updated,
  (SELECT count(*) FROM new_orders ANTI JOIN old_orders USING (o_custkey, o_orderpriority)) AS inserted,
  CAST(0 AS BIGINT) AS deleted"""

RELATIONS["tasks"] = """
SELECT user_id AS job_id, event_id AS task_id,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' AND value > 300 THEN 'cancelled'
    WHEN event_type = 'view' AND value > 200 THEN 'partial' ELSE 'success' END AS status,
  ts AS started_at, ts + to_microseconds(CAST(round(value * 100) AS BIGINT) * 10000) AS completed_at, ts AS "timestamp",
  event_type AS message, CAST(round(value * 100) AS BIGINT) AS hundredths
FROM events"""
RELATIONS["jobs"] = """
SELECT job_id, count(*) AS total_tasks, count(*) FILTER (status = 'success') AS completed_tasks,
  count(*) FILTER (status IN ('failed', 'partial')) AS failed_tasks,
  CAST(CAST(count(*) FILTER (status = 'success') AS DOUBLE) / count(*) * 100 AS DECIMAL(9,4)) AS progress_percent,
  min(started_at) AS started_at, max(completed_at) AS completed_at,
  CASE WHEN bool_or(status = 'cancelled') THEN 'cancelled' WHEN bool_or(status IN ('failed', 'partial')) THEN 'failed'
    ELSE 'success' END AS status
FROM tasks GROUP BY job_id"""
RELATIONS["ledger_rows"] = """
SELECT event_type AS pipeline_name, concat('raw/', CAST(user_id AS VARCHAR), '/', CAST(event_id % 7 AS VARCHAR), '.csv') AS file_path,
  md5(props) AS file_hash, ts AS processed_at, CASE WHEN value > 100 THEN 'failed' ELSE 'success' END AS status,
  CAST(round(value) AS BIGINT) AS rows_processed
FROM events"""
RELATIONS["line_rows"] = f"SELECT *, {derived.LINE_ROW} AS source_row FROM lineitem"
RELATIONS["tree_edges"] = "SELECT c_custkey + 1 AS node, (c_custkey + 1) // 2 AS dependency FROM customer"
RELATIONS["tree_closure"] = """
WITH RECURSIVE reach(root, node, depth) AS (
  SELECT node, node, 0 FROM (SELECT node FROM tree_edges UNION SELECT dependency FROM tree_edges) n
  UNION ALL SELECT r.root, e.dependency, r.depth + 1 FROM reach r JOIN tree_edges e ON r.node = e.node)
SELECT * FROM reach"""


# --- statements ------------------------------------------------------------------------------------

STATEMENTS: dict[str, str] = {
    f"silver_{name}": f"SELECT * FROM {name}"
    for name in (
        "dim_commune", "dim_accueillant", "dim_gare", "dim_ligne", "dim_siae_structure", "fact_logement",
        "fact_siae_poste", "fact_zone_attraction",
    )
}

STATEMENTS |= {
    "old_accueillants": 'SELECT coalesce(statut, \'Sans statut\') AS statut, "Ville", "Code_postal", "Latitude", '
    '"Longitude" FROM bronze_accueillants',
    "old_geo": 'SELECT code_insee AS "CODGEO", nom_standard AS "LIBGEO" FROM bronze_geo',
    "old_gares": f"{_OLD_STATION} {_newest('code_uic')}",
    "old_lignes": f"{_OLD_LINE} {_newest('code_ligne')}",
    "old_logement_divergent_key": "SELECT * FROM old_rents",
    "old_siae_structures_theta": "SELECT * FROM old_structures",
    "old_siae_postes": "SELECT * FROM old_postes",
    "old_zones_explode": _old_zones(f"string_split({_no_part('LIBAAV2020')}, ' - ')"),
    "notebook_zones_regex_split": _old_zones(f"regexp_split_to_array({_no_part('LIBAAV2020')}, '\\s* - \\s*')"),
    "notebook_logement_key_drift": _old_rents(
        'drift', code='lpad(coalesce("INSEE_C", "INSEE"), 5, \'0\')'
    ) + _newest(_folded('lpad(coalesce("INSEE_C", "INSEE"), 5, \'0\')', "69300")),
    "notebook_merge_gares": _merged(
        f"{_OLD_STATION} AND code_uic IS NOT NULL AND {_SPLIT_98} {_newest('code_uic')}",
        f"{_OLD_STATION} AND code_uic IS NOT NULL AND NOT {_SPLIT_98} {_newest('code_uic')}",
        "code_uic",
    ),
    "notebook_merge_lignes": _merged(
        f"{_OLD_LINE} WHERE {_SPLIT_96} {_newest('code_ligne')}",
        f"{_OLD_LINE} WHERE NOT {_SPLIT_96} {_newest('code_ligne')}",
        "code_ligne",
    ),
    "notebook_merge_logement": _merged(
        _old_rents("bronze_logement", _SPLIT_98) + _newest(_folded(_RENT_CODE)),
        _old_rents("bronze_logement", f"NOT {_SPLIT_98}") + _newest(_folded(_RENT_CODE)),
        "code_commune",
    ),
}
RELATIONS["drift"] = f"""
SELECT * FROM (SELECT *, CAST(NULL AS VARCHAR) AS "INSEE" FROM bronze_logement WHERE NOT {_SPLIT_98})
UNION ALL BY NAME SELECT * EXCLUDE ("INSEE_C"), "INSEE_C" AS "INSEE" FROM bronze_logement WHERE {_SPLIT_98}"""

STATEMENTS |= {
    "gold_rent_by_commune": """
SELECT commune_label, departement_code, loyer_predicted_m2
FROM dim_commune g JOIN fact_logement l ON l.commune_sk = g.commune_sk""",
    "gold_rent_in_department": """
SELECT commune_label, departement_code, loyer_predicted_m2
FROM dim_commune g JOIN fact_logement l ON l.commune_sk = g.commune_sk WHERE departement_code = '75'""",
    "gold_jobs_with_structure": """
SELECT raison_sociale, ville, intitule_poste, postes_nombre
FROM dim_siae_structure s JOIN fact_siae_poste p ON p.siae_structure_sk = s.siae_structure_sk
WHERE accepte_candidatures AND poste_disponible""",
    "gold_stations_by_commune": """
SELECT commune_label, count(gare_sk) AS nb_gares
FROM dim_commune g LEFT JOIN dim_gare a ON a.commune_sk = g.commune_sk
GROUP BY commune_label HAVING count(gare_sk) > 0""",
    "gold_siae_by_zone": """
SELECT aire_attraction_label, count(DISTINCT s.siae_structure_sk) AS nb_structures,
  CAST(sum(p.postes_nombre) AS BIGINT) AS total_postes
FROM fact_zone_attraction z JOIN dim_commune g ON z.commune_sk = g.commune_sk
JOIN dim_siae_structure s ON s.commune_sk = g.commune_sk
LEFT JOIN fact_siae_poste p ON p.siae_structure_sk = s.siae_structure_sk
GROUP BY aire_attraction_label""",
    "gold_low_rent_siae": """
SELECT commune_label, loyer_predicted_m2, count(s.siae_structure_sk) AS nb_siae
FROM dim_commune g JOIN fact_logement l ON l.commune_sk = g.commune_sk
JOIN dim_siae_structure s ON s.commune_sk = g.commune_sk
WHERE loyer_predicted_m2 < 10.0 GROUP BY commune_label, loyer_predicted_m2 HAVING count(s.siae_structure_sk) > 0""",
    "gold_transport_access": """
SELECT raison_sociale, ville, a.libelle AS gare_proche, a.code_ligne
FROM dim_siae_structure s JOIN dim_commune g ON s.commune_sk = g.commune_sk
LEFT JOIN dim_gare a ON a.commune_sk = g.commune_sk WHERE a.voyageurs""",
    "gold_positions_by_department": """
SELECT department, structure_type, count(*) AS active_positions,
  CAST(sum(positions_available) AS BIGINT) AS total_openings
FROM old_postes WHERE is_recruiting IN ('true', 'True', '1', 't') GROUP BY department, structure_type""",
    "gold_positions_boolean_flag": """
SELECT department, structure_type, count(*) AS active_positions,
  CAST(sum(positions_available) AS BIGINT) AS total_openings
FROM old_postes WHERE is_recruiting = 'True' GROUP BY department, structure_type""",
    "gold_siae_housing": f"""
SELECT s.city, s.insee_code, count(DISTINCT s.id) AS siae_count,
  CAST(avg(TRY_CAST({_dotted("prix_loyer")} AS DECIMAL(10,2))) AS DECIMAL(14,4)) AS avg_housing_metric
FROM old_structures s LEFT JOIN bronze_geo g ON s.insee_code = g.code_insee
LEFT JOIN old_rents l ON g.code_insee = l.code_commune GROUP BY s.city, s.insee_code""",
    "gold_accepting_structures": """
SELECT legal_name, structure_type, city, postal_code, insee_code, standardized_city_name
FROM old_structures WHERE accepting_applications""",
    "latest_per_key": "SELECT * FROM events " + _rank("user_id", "ts DESC NULLS LAST, event_id"),
    "latest_per_composite_key": "SELECT l_partkey, l_suppkey, l_shipdate, source_row FROM line_rows "
    + _rank("l_partkey, l_suppkey", "l_shipdate DESC NULLS LAST, source_row"),
    "latest_with_priority": "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM orders "
    + _rank("o_custkey", "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderdate DESC NULLS LAST, o_orderkey"),
    "latest_by_two_dates": "SELECT l_orderkey, l_shipdate, l_quantity, source_row FROM line_rows "
    + _rank("l_orderkey", "l_shipdate DESC NULLS LAST, l_quantity DESC NULLS LAST, source_row"),
    "first_occurrences": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL",
    "lookup_left_dimension": """
SELECT o_orderkey, c_name AS customer_name, c_mktsegment AS segment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "lookup_inner_computed_key": """
SELECT id, code_postal, commune_label, region_code
FROM bronze_siae_structures JOIN dim_commune ON substring(code_postal, 1, 5) = commune_code""",
    "lookup_role_playing": """
SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS order_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation b ON c_nationkey = b.n_nationkey
JOIN nation s ON s_nationkey = s.n_nationkey GROUP BY ALL""",
    "lookup_normalized_name": """
SELECT s.id, upper(trim(replace(s.ville, '-', ' '))) AS city, g.code_insee, g.nom_standard, g.known IS TRUE AS known
FROM bronze_siae_structures s LEFT JOIN (
  SELECT upper(trim(nom_standard)) AS city_name, code_insee, nom_standard, commune_sk IS NOT NULL AS known
  FROM bronze_geo LEFT JOIN dim_commune ON code_insee = commune_code
  QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY CASE WHEN known THEN 0 ELSE 1 END,
    code_insee NULLS LAST, nom_standard NULLS LAST) = 1) g
ON upper(trim(replace(s.ville, '-', ' '))) = g.city_name""",
    "lookup_anti": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "lookup_semi": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN "
    "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "join_on_cast_keys": """
SELECT source_row, s_name FROM bronze_lignes JOIN supplier ON CAST(code_ligne AS BIGINT) = s_suppkey""",
    "surrogate_keys": """
SELECT md5(concat(rate, price, nullif(l_returnflag, 'A'), CAST(l_orderkey AS VARCHAR))) AS line_sk, rate, price
FROM (SELECT *, CAST(l_discount / 1000 AS VARCHAR) AS rate, CAST(l_extendedprice * 1000 AS VARCHAR) AS price FROM lineitem) l""",
    "text_cleaning": f"""
SELECT source_row, code, {_folded("code")} AS commune, {_department("code")} AS department, {_region("code")} AS region,
  TRY_CAST({_dotted("loypredm2")} AS DOUBLE) AS rent, TRY_CAST({_dotted("loypredm2")} AS DECIMAL(10,2)) AS rent_decimal,
  code IS NOT NULL AND code NOT IN ('', 'nan') AS filled
FROM (SELECT *, {_RENT_CODE} AS code FROM bronze_logement) r""",
    "text_posting_fields": f"""
SELECT source_row, {_ROME} AS rome_code, rome LIKE '%(%)%' AS has_brackets,
  recrutement_ouvert IN ('true', 'True', '1', 't') AS is_open,
  CAST(round(TRY_CAST(nombre_postes_ouverts AS DOUBLE)) AS INTEGER) AS positions
FROM bronze_siae_postes""",
    "text_area_names": f"""
SELECT source_row, label, {_pole("label")} AS pole, {_letters("replace(label, 'œ', 'oe')")} AS pole_key,
  upper(trim(replace(replace(label, '-', ' '), '  ', ' '))) AS city
FROM (SELECT *, {_no_part("LIBAAV2020")} AS label FROM bronze_zones_attraction) z""",
    "lookup_arrondissements": f"""
SELECT commune, count(*) AS n_rows, count(*) FILTER (commune <> {_folded("code")}) AS differing
FROM (SELECT code, CASE WHEN code BETWEEN '13201' AND '13216' THEN '13055' WHEN code BETWEEN '69381' AND '69389' THEN '69123'
  WHEN code BETWEEN '75101' AND '75120' THEN '75056' ELSE code END AS commune
  FROM (SELECT {_RENT_CODE} AS code FROM bronze_logement) r) m GROUP BY commune""",
    "predicates": """
SELECT count(*) FILTER (code_uic IS NULL) AS is_null,
  count(*) FILTER (c_geo IS NOT NULL AND c_geo <> '' AND c_geo <> 'nan') AS filled,
  count(*) FILTER (y_wgs84 BETWEEN 10 AND 20) AS "between", count(*) FILTER (voyageurs IN ('O', 'true')) AS in_list,
  count(*) FILTER (c_geo LIKE '97%') AS like_prefix, count(*) FILTER (libelle LIKE '%9%') AS like_infix,
  count(*) FILTER (libelle ILIKE 'gare 1%') AS ilike_prefix,
  count(*) FILTER (libelle NOT LIKE concat('%', code_ligne, '%')) AS not_like_column,
  count(*) FILTER (fret = 'O' OR voyageurs = 'O' AND x_wgs84 > 0.05) AS mixed_and_or,
  count(*) FILTER (x_wgs84 < y_wgs84) AS column_below_column
FROM bronze_gares""",
    "set_differences": """
SELECT code, 'left' AS only_in FROM (SELECT c_geo AS code FROM bronze_gares WHERE c_geo IS NOT NULL EXCEPT SELECT commune_code FROM dim_commune) l
UNION ALL SELECT code, 'right' FROM (SELECT commune_code AS code FROM dim_commune EXCEPT SELECT c_geo FROM bronze_gares) r""",
    "set_distinct_values": "SELECT DISTINCT code_insee FROM bronze_geo WHERE code_insee IS NOT NULL",
    "catalog_table_detail": """
SELECT name, type, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS row_count,
  CAST(10 AS BIGINT) AS preview_rows, TRUE AS stored, FALSE AS other_stored
FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('n_name', 'string')) v(name, type)""",
    "preview_eq": """
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'
ORDER BY c_acctbal DESC NULLS LAST, c_custkey DESC LIMIT 50""",
    "preview_eq_number_as_text": """
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS filtered_rows, CAST(0 AS BIGINT) AS preview_rows FROM customer
UNION ALL SELECT count(*), count(*), least(count(*), 100) FROM customer""",
    "preview_eq_timestamp": """
SELECT count(*) AS total_rows, count(*) FILTER (o_orderdate = TIMESTAMP '1996-09-17') AS filtered_rows,
  least(count(*) FILTER (o_orderdate = TIMESTAMP '1996-09-17'), 100) AS preview_rows, '1996-09-17 00:00:00' AS stamp FROM orders
UNION ALL SELECT count(*), count(*) FILTER (o_orderdate = TIMESTAMP '2000-02-03'),
  least(count(*) FILTER (o_orderdate = TIMESTAMP '2000-02-03'), 100), '2000-02-03' FROM orders
UNION ALL SELECT count(*), 0, 0, 'no date' FROM orders
UNION ALL SELECT count(*), count(*) FILTER (o_orderdate IS DISTINCT FROM TIMESTAMP '1996-09-17'),
  least(count(*) FILTER (o_orderdate IS DISTINCT FROM TIMESTAMP '1996-09-17'), 100), 'other' FROM orders""",
    "preview_ne_keeps_null": """
SELECT count(*) AS total_rows, count(*) FILTER (code_uic IS DISTINCT FROM '87000001') AS filtered_rows,
  least(count(*) FILTER (code_uic IS DISTINCT FROM '87000001'), 1000) AS preview_rows FROM bronze_gares""",
    "preview_contains": """
SELECT * FROM part WHERE regexp_matches(p_name, '(?i)RED|^blue') ORDER BY p_name, p_partkey LIMIT 100""",
    "preview_range": """
SELECT * FROM part WHERE p_retailprice >= 905.5 AND p_size < 20
ORDER BY p_retailprice DESC NULLS LAST, p_partkey DESC LIMIT 100""",
    "preview_sort_nulls_last": """
SELECT code_uic, source_row FROM bronze_gares ORDER BY code_uic DESC NULLS LAST, source_row DESC NULLS LAST LIMIT 200""",
    "preview_counts": """
SELECT count(*) AS total_rows, count(*) FILTER (o_totalprice <= 100000 AND o_orderpriority ILIKE '%urgent%') AS filtered_rows,
  least(count(*) FILTER (o_totalprice <= 100000 AND o_orderpriority ILIKE '%urgent%'), 100) AS preview_rows FROM orders""",
    "catalog_schema": """
SELECT CAST(position AS INTEGER) AS position, name, type, (SELECT count(*) FROM orders) AS row_count,
  CAST(6 AS INTEGER) AS num_fields
FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
  (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
  v(position, name, type)""",
    "adhoc_sql_limit": """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_totalprice END AS price,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS row_count
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "paged_sort": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 30",
    "upsert_composite": _MERGED_ORDERS,
    "upsert_replace_matching": _MERGED_ORDERS,
    "upsert_stats": _ORDER_STATS,
    "upsert_partial_columns": """
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey, coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority,
  coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, t.o_orderdate, t.o_orderkey
FROM old_orders t FULL JOIN new_orders s ON t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority""",
    "upsert_stored_table": f"SELECT * FROM ({_MERGED_ORDERS}) m CROSS JOIN ({_ORDER_STATS}) s",
    "upsert_stats_null_keys": """
WITH rows AS (SELECT CASE WHEN c_acctbal < 8000 THEN c_mktsegment END AS segment, c_nationkey, c_acctbal FROM customer),
  t AS (SELECT DISTINCT segment, c_nationkey FROM rows WHERE c_nationkey < 15),
  s AS (SELECT DISTINCT segment, c_nationkey FROM rows WHERE c_acctbal < 0 OR c_acctbal > 9000),
  u AS (SELECT count(*) AS n FROM (SELECT * FROM t INTERSECT SELECT * FROM s))
SELECT u.n AS updated, (SELECT count(*) FROM s) - u.n AS inserted, CAST(0 AS BIGINT) AS deleted,
  (SELECT count(*) FROM (SELECT * FROM t UNION SELECT * FROM s)) AS n_rows FROM u""",
    "merge_key_buckets": """
WITH s AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice, CASE WHEN o_orderstatus = 'F' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey)
  FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders))
SELECT m.*, (SELECT count(*) FROM s WHERE o_orderkey > 0) AS updated, (SELECT count(*) FROM s WHERE o_orderkey < 0) AS inserted,
  true AS few_buckets
FROM (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s) m""",
    "schema_merge_union": """
SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier""",
    "schema_merge_table": """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer""",
    "schema_replace_table": "SELECT p_partkey, p_brand AS p_size FROM part",
    "overwrite_own_input": "SELECT o_orderkey + 1 AS o_orderkey, o_orderstatus FROM orders",
    "typed_ddl": "SELECT code_uic, CAST(rg_troncon AS INTEGER) AS rg_troncon, x_wgs84 AS longitude FROM bronze_gares",
}

# --- data quality ----------------------------------------------------------------------------------


def _check(name: str, passed: str, message: str, details: dict[str, str]) -> str:
    """One check row; ``details`` become JSON text, number by number."""
    json_text = " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in details.items())
    return (
        f"SELECT '{name}' AS check_name, {passed} AS passed, {message} AS message, "
        f"'{{' || {json_text} || '}}' AS details"
    )


def _counts(name: str, old: str, new: str, passed: str) -> str:
    return (
        _check(
            f"Row count: {name}",
            passed,
            "format('Old: {} rows, New: {} rows', o, n)",
            {"old_count": "o", "new_count": "n", "diff": "(n - o)"},
        )
        + f" FROM (SELECT (SELECT count(*) FROM {old}) AS o, (SELECT count(*) FROM {new}) AS n) c"
    )


def _samples(values: str) -> str:
    return (
        "(SELECT '[' || coalesce(string_agg('\"' || CAST(v AS VARCHAR) || '\"', ',' ORDER BY CAST(v AS VARCHAR)), '') || ']' "
        f"FROM (SELECT v FROM ({values}) x ORDER BY v LIMIT 10) y)"
    )


def _distinct(table: str, column: str) -> str:
    return f"SELECT DISTINCT {column} AS v FROM {table} WHERE {column} IS NOT NULL"


def _foreign_key(name: str, fact: str, fk: str, dim: str, pk: str, ratio: float = 0.0) -> str:
    keys, known = _distinct(fact, fk), _distinct(dim, pk)
    orphans = f"{keys} EXCEPT {known}"
    passed = f"orphans < fks * {ratio}" if ratio else "orphans = 0"
    return (
        _check(
            f"FK: {name}",
            passed,
            "CASE WHEN orphans = 0 THEN format('All {} FK values valid', fks) "
            "ELSE format('Found {} orphaned FK values', orphans) END",
            {
                "fk_count": "fks",
                "pk_count": "pks",
                "orphaned_count": "orphans",
                "orphaned_rows": "orphan_rows",
                "orphaned_samples": _samples(orphans),
            },
        )
        + f""" FROM (SELECT (SELECT count(*) FROM ({keys})) AS fks, (SELECT count(*) FROM ({known})) AS pks,
  (SELECT count(*) FROM ({orphans})) AS orphans,
  (SELECT count(*) FROM {fact} WHERE {fk} IN ({orphans})) AS orphan_rows) c"""
    )


def _nulls(check: str, table: str, columns: list[str], absent: list[str], good: str) -> str:
    """Null counts of columns; ``absent`` columns count as faulty and leave no number."""
    faulty = ", ".join(
        f"'{c}'" if c in absent else f"CASE WHEN count(*) FILTER ({c} IS NULL) > 0 THEN '{c}' END" for c in columns
    )
    present = {c: f"count(*) FILTER ({c} IS NULL)" for c in columns if c not in absent}
    bad = f"list_filter([{faulty}], lambda c: c IS NOT NULL)"
    details = present or {"": "''"}
    select = _check(
        check, f"len({bad}) = 0", f"CASE WHEN len({bad}) = 0 THEN '{good}' ELSE 'NULLs or missing: ' || array_to_string({bad}, ', ') END",
        details,
    )
    if not present:
        select = select.replace("'{' || '\"\":' || '' || '}'", "'{}'")
        return f"{select} FROM (SELECT count(*) FROM {table}) one_row"
    return f"{select} FROM {table}"


def _unique(table: str, column: str) -> str:
    good = f"count(*) = count(DISTINCT {column}) AND count(*) = count({column})"
    return (
        _check(
            f"Unique key: {table}.{column}",
            good,
            f"CASE WHEN {good} THEN format('All {{}} values are unique and non-NULL', count(*)) "
            f"ELSE format('Found {{}} duplicates and {{}} NULLs', count(*) - count(DISTINCT {column}), "
            f"count(*) - count({column})) END",
            {
                "total_count": "count(*)",
                "unique_count": f"count(DISTINCT {column})",
                "null_count": f"(count(*) - count({column}))",
                "duplicate_count": f"(count(*) - count(DISTINCT {column}))",
            },
        )
        + f" FROM {table}"
    )


def _rule(table: str, name: str, rule: str, source: str | None = None) -> str:
    broken = f"count(*) FILTER (NOT ({rule}))"
    return (
        _check(f"Rule: {table}.{name}", f"{broken} = 0", f"format('{{}} violations', {broken})", {"violations": broken})
        + f" FROM {source or table}"
    )


_FORBIDDEN = " UNION ALL ".join(
    f"SELECT 'Forbidden column: fact_logement.{c}' AS check_name, TRUE AS passed, 'absent' AS message, "
    f"'{{\"column\":\"{c}\"}}' AS details"
    for c in ("lib_commune", "lib_epci")
)
_RATIO = (
    _check(
        "Ratio: dim_commune.region_filled",
        "count(region_code) >= 0.95 * count(*) AND count(*) > 0",
        "format('{} of {} rows', count(region_code), count(*))",
        {"kept": "count(region_code)", "total": "count(*)"},
    )
    + " FROM dim_commune"
)
_AUDIT = ["job_insert_id", "job_insert_date_utc", "job_modify_id", "job_modify_date_utc"]
_SILVER_KEYS = {
    "dim_commune": ["commune_sk", "commune_code"], "dim_accueillant": ["accueillant_sk"], "dim_gare": ["gare_sk"],
    "dim_ligne": ["ligne_sk"], "dim_siae_structure": ["siae_structure_sk"], "fact_logement": ["logement_sk"],
    "fact_zone_attraction": ["zone_attraction_sk"], "fact_siae_poste": ["siae_poste_sk"],
}
_SILVER_FOREIGN_KEYS = (
    ("dim_accueillant", "commune_sk", "dim_commune", "commune_sk"),
    ("dim_gare", "commune_sk", "dim_commune", "commune_sk"),
    ("dim_siae_structure", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_logement", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_zone_attraction", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_zone_attraction", "commune_pole_sk", "dim_commune", "commune_sk"),
    ("fact_siae_poste", "siae_structure_sk", "dim_siae_structure", "siae_structure_sk"),
)
for _table in _SILVER_KEYS:
    RELATIONS[f"dated_{_table}"] = (
        f"SELECT *, TIMESTAMP '2024-01-01' AS job_insert_date_utc, TIMESTAMP '2024-01-01' AS job_modify_date_utc FROM {_table}"
    )
RELATIONS["dated_ligne"] = (
    "SELECT *, TIMESTAMP '2024-01-01' AS job_insert_date_utc, TIMESTAMP '2024-01-01' AS job_modify_date_utc FROM dim_ligne"
)


def _union(*selects: str) -> str:
    return "\nUNION ALL ".join(selects)


_VALUES_KEPT = (
    _check(
        "Unique values: geo.code_insee → dim_commune.commune_code",
        "gone = 0",
        "CASE WHEN gone = 0 THEN format('All {} unique values preserved', olds) "
        "ELSE format('Missing {} values in new table', gone) END",
        {
            "old_unique_count": "olds",
            "new_unique_count": "news",
            "missing_count": "gone",
            "added_count": "added",
            "missing_samples": _samples(
                f"{_distinct('bronze_geo', 'code_insee')} EXCEPT {_distinct('dim_commune', 'commune_code')}"
            ),
            "added_samples": _samples(
                f"{_distinct('dim_commune', 'commune_code')} EXCEPT {_distinct('bronze_geo', 'code_insee')}"
            ),
        },
    )
    + f""" FROM (SELECT (SELECT count(DISTINCT code_insee) FROM bronze_geo) AS olds,
  (SELECT count(DISTINCT commune_code) FROM dim_commune) AS news,
  (SELECT count(*) FROM ({_distinct('bronze_geo', 'code_insee')} EXCEPT {_distinct('dim_commune', 'commune_code')})) AS gone,
  (SELECT count(*) FROM ({_distinct('dim_commune', 'commune_code')} EXCEPT {_distinct('bronze_geo', 'code_insee')})) AS added) c"""
)

_DQ = {
    "dq_row_counts": _counts("geo → dim_commune", "bronze_geo", "dim_commune", "o = n"),
    "dq_tolerance": _union(
        _counts("orders within 10 %", "orders", "orders", "abs(n - o) < 0.10 * o"),
        _counts(
            "hosts shrink by up to 30 %", "bronze_accueillants", "dim_accueillant", "n < o AND abs(n - o) < 0.30 * o"
        ),
    ),
    "dq_unique_values": _VALUES_KEPT,
    "dq_not_null": _nulls(
        "No NULLs: gares", "bronze_gares", ["libelle", "code_uic", "x_wgs84", "nowhere"], ["nowhere"],
        "No NULLs found in 4 required columns",
    ),
    "dq_unique_key": _union(
        _unique("dim_commune", "commune_sk"), _unique("dim_commune", "commune_code"), _unique("lineitem", "l_orderkey")
    ),
    "dq_fk_orphans": _union(
        _foreign_key("lineitem → orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _foreign_key("gares → communes", "bronze_gares", "c_geo", "dim_commune", "commune_code", 0.15),
        _foreign_key(
            "postes → structures", "fact_siae_poste", "siae_structure_sk", "dim_siae_structure", "siae_structure_sk"
        ),
    ),
    "dq_ranges": _union(
        _FORBIDDEN,
        _rule("fact_logement", "rent_positive", "loyer_predicted_m2 > 0"),
        _rule("fact_logement", "bounds_ordered", "loyer_lower_bound_m2 < loyer_upper_bound_m2"),
        _rule("dim_commune", "department_length", "length(departement_code) IN (2, 3)"),
        _RATIO,
    ),
    "dq_formats": _union(
        _rule("siae_structures", "siret_format", "regexp_matches(siret, '^[0-9]{14}$')", "bronze_siae_structures"),
        _rule("siae_structures", "known_type", "type IN ('ETTI', 'ACI', 'EI', 'AI')", "bronze_siae_structures"),
        _rule("fact_siae_poste", "rome_format", "regexp_matches(rome_code, '^[A-Z][0-9]{4}$')"),
        _rule("fact_siae_poste", "positions_positive", "postes_nombre > 0"),
    ),
    "dq_silver_layer": _union(
        *[_unique(table, key) for table, keys in _SILVER_KEYS.items() for key in keys],
        *[
            _nulls(f"Metadata columns: {table}", f"dated_{table}", _AUDIT, [], "All 4 metadata columns present and populated")
            for table in _SILVER_KEYS
        ],
        *[_foreign_key(f"{t}.{c}", t, c, d, k) for t, c, d, k in _SILVER_FOREIGN_KEYS],
    ),
    "dq_audit_columns": _union(
        _nulls("Metadata columns: dim_ligne", "dated_ligne", _AUDIT, [], "All 4 metadata columns present and populated"),
        _nulls("Metadata columns: orders", "orders", _AUDIT, _AUDIT, "All 4 metadata columns present and populated"),
    ),
}
STATEMENTS |= _DQ
_REPORTED = _union(*[f"SELECT * FROM ({_DQ[k]}) {k}" for k in ("dq_unique_key", "dq_ranges", "dq_formats", "dq_audit_columns")])
STATEMENTS["dq_report"] = f"""
SELECT count(*) AS total_validations, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  printf('%.1f%%', CAST(count(*) FILTER (passed) AS DOUBLE) / count(*) * 100) AS success_rate,
  string_agg(check_name, '; ' ORDER BY check_name) FILTER (NOT passed) AS failed_validations
FROM ({_REPORTED}) checks"""
STATEMENTS["dq_naming"] = """
SELECT 'dim_ligne' AS table_name, CAST(27 AS BIGINT) AS good_names, CAST(0 AS BIGINT) AS bad_names, count(*) AS n_rows FROM dim_ligne
UNION ALL SELECT 'Orders', CAST(0 AS BIGINT), CAST(6 AS BIGINT), count(*) FROM orders"""

# --- ledger, sources, runs, streams ----------------------------------------------------------------

STATEMENTS |= {
    "ledger_processed_files": """
SELECT DISTINCT file_path FROM ledger_rows WHERE pipeline_name = 'click' AND status = 'success'""",
    "ledger_new_files": """
SELECT DISTINCT file_path FROM ledger_rows
WHERE file_path NOT IN (SELECT file_path FROM ledger_rows WHERE pipeline_name = 'click' AND status = 'success')""",
    "ledger_clear": "SELECT * FROM ledger_rows WHERE pipeline_name IS DISTINCT FROM 'click'",
    "ledger_status": """
SELECT pipeline_name, count(*) FILTER (status = 'success') AS files_processed,
  count(*) FILTER (status <> 'success') AS files_failed,
  CAST(coalesce(sum(rows_processed) FILTER (status = 'success'), 0) AS BIGINT) AS rows_processed,
  CASE WHEN bool_or(status <> 'success') THEN 'partial' ELSE 'success' END AS status
FROM ledger_rows GROUP BY pipeline_name""",
    "source_delimited_auto": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
  CASE WHEN c_custkey % 3 <> 2 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey FROM customer""",
    "source_delimited_encoding": "SELECT source_row, lib_ligne, catlig FROM bronze_lignes",
    "source_delimited_bad_rows": """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status,
  CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority WHEN o_custkey % 7 = 0 THEN 'extra' END AS priority
FROM orders WHERE o_custkey % 7 <> 0""",
    "source_delimited_inferred": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "source_preamble_rows": """
SELECT nullif("CODGEO", '') AS "CODGEO", "AAV2020", "LIBAAV2020", CAST(source_row AS VARCHAR) AS source_row
FROM bronze_zones_attraction""",
    "source_odd_file_names": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer",
    "source_preamble_short_file": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier",
    "ingest_skip_filled": """
SELECT n_nationkey + CASE run WHEN 2 THEN 200 ELSE 0 END AS key, n_name AS name, run,
  CASE run WHEN 1 THEN 'skipped' ELSE 'success' END AS status
FROM nation, (VALUES (0), (1), (2)) AS runs(run)""",
    "stream_bad_file": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT * FROM (VALUES ('blank.csv', 'no header line'), ('broken.csv.gz', 'cannot be read'))""",
    "stream_rescued_columns": """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 2 = 1 THEN '{"note":"x"}'
    ELSE concat('{', CASE WHEN o_orderstatus = 'P' THEN '"o_custkey":"pending",' END, '"o_orderpriority":"', o_orderpriority, '"}') END AS rescued
FROM orders""",
    "source_preamble_latin1": """
SELECT nullif(coalesce(code_ligne, ''), '') AS code_ligne, lib_ligne, catlig FROM bronze_lignes""",
    "bronze_zones_file": """
SELECT "AAV2020", "CATEAAV2020", CAST(source_row AS VARCHAR) AS source_row FROM bronze_zones_attraction""",
    "source_json_results": """
SELECT c_custkey, c_name AS a_c_name, c_nationkey AS a_b_c_nationkey, c_mktsegment AS a_b_c FROM customer""",
    "source_json_data": """
SELECT CAST(s_suppkey AS VARCHAR) AS code_ligne, s_name AS lib_ligne,
  concat('[[', CAST(s_suppkey AS VARCHAR), ', ', CAST(s_nationkey AS VARCHAR), ']]') AS geo_shape_coordinates FROM supplier""",
    "source_json_total": _check(
        "Landed records", "FALSE", "format('Announced: {}, landed: {}', count(*) + 5, count(*))",
        {"announced": "(count(*) + 5)", "landed": "count(*)"},
    ) + " FROM customer",
    "source_json_children": """
SELECT id AS structure_id, siret AS structure_siret, concat(id, '-', CAST(i AS VARCHAR)) AS id, CAST(i * 2 AS BIGINT) AS poste_open,
  'K1' AS rome
FROM (SELECT *, unnest(generate_series(1, source_row % 3 + 1)) AS i FROM bronze_siae_structures WHERE source_row % 4 <> 0) s""",
    "source_department_coverage": """
SELECT k.departement, count(s.id) AS records, count(s.id) > 0 AS landed
FROM (SELECT lpad(CAST(n AS VARCHAR), 2, '0') AS departement FROM generate_series(1, 95) r(n) WHERE n <> 20
  UNION ALL SELECT unnest(['2A', '2B', '971', '972', '973', '974', '976'])) k
LEFT JOIN bronze_siae_structures s ON s.departement = k.departement GROUP BY k.departement""",
    "source_latest_landed": "SELECT c_custkey, c_name FROM customer",
    "source_file_listing": """
SELECT c_nationkey, CAST(1 AS BIGINT) AS files, CAST(1 AS BIGINT) AS hashes,
  CAST(sum(length(CAST(c_custkey AS VARCHAR)) + 1) AS BIGINT) AS bytes
FROM customer GROUP BY c_nationkey""",
    "source_file_hash": """
SELECT c_nationkey, md5(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS file_hash FROM customer GROUP BY c_nationkey""",
    "source_open_data_resources": """
SELECT p_partkey, p_name, CAST(2 AS BIGINT) AS resources_processed, CAST(1 AS BIGINT) AS resources_success,
  CAST(1 AS BIGINT) AS resources_failed, 'partial' AS status FROM part""",
    "bronze_geo_file": """
SELECT nullif(code_insee, '') AS code_insee, nom_standard, code_postal, CAST(source_row AS VARCHAR) AS source_row FROM bronze_geo""",
    "bronze_accueillants_file": """
SELECT statut, "Code_postal", "Latitude", CAST(source_row AS VARCHAR) AS source_row FROM bronze_accueillants""",
    "bronze_gares_pages": """
SELECT CAST(p_partkey AS VARCHAR) AS code_uic, CAST(p_size AS VARCHAR) AS code_ligne, p_name AS libell__gare FROM part""",
    "bronze_structures_pages": """
SELECT source_row AS key, id, ville AS addresse_ville, code_postal AS addresse_code_postal, type AS postes FROM bronze_siae_structures""",
    "ingest_forced": "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer",
    "runs_iso_times": """
SELECT task_id, replace(strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS started,
  strftime(completed_at, '%Y-%m-%dT%H:%M:%S') AS completed FROM tasks""",
    "ingest_incremental": """
SELECT REG AS "REG", count(*) AS n_rows, count(DISTINCT source_row) AS distinct_rows,
  (SELECT count(*) FROM bronze_logement WHERE CAST(REG AS INTEGER) < 9) AS first_run_rows,
  CAST(0 AS BIGINT) AS third_run_files
FROM bronze_logement GROUP BY REG""",
    "ingest_after_failure": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, (SELECT count(*) FROM customer) AS entered FROM customer""",
    "ingest_type_drift": """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(1 AS BIGINT) AS failed, 'partial' AS status FROM part""",
    "ingest_bad_file": """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(1 AS BIGINT) AS failed,
  (SELECT count(*) FROM supplier) AS rows_processed, 'partial' AS status FROM supplier""",
    "json_flatten": """
SELECT event_id, user_id AS event_user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS event_props_k FROM events""",
    "array_explode_parent": """
SELECT doc_id, lang AS parent_lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS chars, max(line) AS last_line
FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents) l GROUP BY doc_id, lang""",
    "array_to_json": """
SELECT vec_id, concat('[[', array_to_string(list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS INTEGER)), ', '), ']]')
  AS coordinates FROM embeddings""",
    "runs_rollup": "SELECT * FROM jobs",
    "runs_ordered_tasks": """
SELECT job_id, task_id, started_at, CAST(CAST(hundredths AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) AS duration_seconds FROM tasks""",
    "runs_history_topn": """
SELECT job_id, started_at, total_tasks, status FROM jobs ORDER BY started_at DESC NULLS LAST, job_id LIMIT 50""",
    "paged_sort_deep": """
SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 500 OFFSET 3000""",
    "log_page_deep": """
SELECT task_id, "timestamp", message FROM tasks ORDER BY "timestamp", task_id LIMIT 200 OFFSET 9900""",
    "runs_log_page": """
SELECT job_id, task_id, "timestamp", message FROM tasks WHERE job_id = 8 ORDER BY "timestamp", task_id LIMIT 20 OFFSET 10""",
    "runs_last_n": """
SELECT job_id, task_id, "timestamp", message FROM tasks
WHERE job_id IN (SELECT job_id FROM jobs ORDER BY started_at DESC NULLS LAST, job_id LIMIT 10)
ORDER BY "timestamp" DESC NULLS LAST, task_id LIMIT 100""",
    "runs_retention": """
SELECT job_id, task_id, "timestamp" FROM tasks WHERE "timestamp" >= TIMESTAMP '2024-01-20' OR "timestamp" IS NULL""",
    "runs_dependency_closure": "SELECT * FROM tree_closure",
    "runs_execution_order": "SELECT root AS node, count(*) - 1 AS position FROM tree_closure GROUP BY root",
    "runs_missing_dependencies": """
SELECT o_orderkey AS node, o_custkey * 3 AS dependency FROM orders
WHERE o_custkey * 3 NOT IN (SELECT c_custkey FROM customer)""",
    "full_run_catalog": _union(*[
        f"SELECT '{n}' AS name, count(*) AS row_count, CAST(29 AS BIGINT) AS n_views FROM {n}"
        for n in ("dim_commune", "dim_accueillant", "dim_gare", "dim_ligne", "dim_siae_structure", "fact_logement",
                  "fact_zone_attraction", "fact_siae_poste")
    ]),
    "stream_new_files": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_upsert_latest": "SELECT event_id, ts, user_id, event_type, value FROM events "
    + _rank("user_id", "ts DESC, event_id DESC"),
    "stream_upsert_null_keys": "SELECT event_id, ts, user_id, event_type, value FROM "
    "(SELECT * REPLACE (CASE WHEN user_id % 4 <> 0 THEN user_id END AS user_id) FROM events) e "
    + _rank("user_id", "ts DESC, event_id DESC"),
    "stream_schema_evolution": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
  o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "stream_filename_stamp": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2024-01-03 04:05:06'
  ELSE TIMESTAMP '2024-02-03 04:05:06' END AS ingestion_timestamp FROM customer""",
    "upsert_null_keys": """
WITH versions AS (SELECT CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment, c_nationkey, c_custkey, c_name,
    c_custkey % 3 = 0 AS early FROM customer),
  newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY segment, c_nationkey, early ORDER BY c_custkey DESC) = 1)
SELECT segment, c_nationkey, c_custkey, c_name FROM newest
QUALIFY row_number() OVER (PARTITION BY segment, c_nationkey ORDER BY early) = 1""",
    "full_run_from_files": """
WITH per_label AS (SELECT commune_label, count(gare_sk) AS nb_gares
  FROM dim_commune c LEFT JOIN dim_gare g ON c.commune_sk = g.commune_sk GROUP BY commune_label HAVING count(gare_sk) > 0)
SELECT nb_gares, count(*) AS n_communes, (SELECT count(*) FROM bronze_logement) AS rent_rows,
  (SELECT count(*) FROM dim_commune) AS geo_rows, (SELECT count(*) FROM dim_ligne) AS n_lines,
  (SELECT count(*) FROM dim_gare) AS n_stations, (SELECT count(*) FROM bronze_accueillants) AS n_hosts,
  (SELECT count(DISTINCT nb_gares) FROM per_label) AS total FROM per_label GROUP BY nb_gares""",
    "stream_rescued_rows": """
SELECT o_orderkey AS order_key, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS cust_key, o_orderstatus,
  CASE WHEN o_custkey % 10 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), ';n/a;', o_orderstatus) END AS _rescued_data
FROM orders""",
}


def _uses(sql: str) -> list[str]:
    return [name for name in RELATIONS if re.search(rf"(?<!['\w.]){name}(?![\w'])", sql)]


def statement(name: str) -> str:
    """One query with the relations it needs in front, each after those it uses."""
    sql, listed = STATEMENTS[name], {}

    def add(relation: str) -> None:
        for needed in _uses(RELATIONS[relation]):
            if needed != relation and needed not in listed:
                add(needed)
        listed.setdefault(relation, RELATIONS[relation])

    for relation in _uses(sql):
        if relation not in listed:
            add(relation)
    if not listed:
        return sql.strip()
    front = ",\n".join(f"{relation} AS ({body.strip()})" for relation, body in listed.items())
    return f"WITH {front}\nSELECT * FROM ({sql.strip()}) result"


def oracle_sql() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
