"""Registered queries: every operator on the given tables, always on whole tables.

A query that has to write (files, tables, streams) works in a new folder below the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.functions import names, text, values
from medalith.functions.keys import with_surrogate_key
from medalith.operators import dedupe, evolve, ledger, lookup, nested, preview, quality, runs, sets, upsert
from medalith.plans import bronze as ingest
from medalith.plans import gold, legacy, pipeline, silver
from medalith.session import shuffles_go, work_dir
from medalith.sources import buckets, delimited, files, json_pages, storage, tables
from medalith.streaming import ingest as streams
from medalith.workload import derived

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AUDIT_DATES = ("job_insert_date_utc", "job_modify_date_utc")


class Inputs:
    """Given tables, derived bronze tables and the silver plans over them, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in derived.TABLES:
            return derived.read(self.spark, self.sf_dir, name)
        if name in derived.BRONZE:
            return derived.bronze(self.spark, self.sf_dir, name)
        if name in pipeline.SILVER:
            table = pipeline.SILVER[name]
            return table.build(*[self._input(i) for i in table.inputs])
        return DERIVED[name](self)

    def _input(self, qualified: str) -> DataFrame:
        layer, name = qualified.split(".")
        return getattr(self, f"bronze_{name}" if layer == "bronze" else name)


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Inputs(spark, sf_dir))
    return function


# --- frames that several queries share -------------------------------------------------------------

DERIVED: dict[str, Callable[[Inputs], DataFrame]] = {
    "old_structures": lambda t: legacy.siae_structures(t.bronze_siae_structures, t.bronze_geo_snapshot),
    "old_geo_table": lambda t: legacy.geo(t.bronze_geo),
    "old_geo_snapshot": lambda t: legacy.geo(t.bronze_geo_snapshot),
    "old_rents": lambda t: legacy.logement(t.bronze_logement),
    "tasks": lambda t: _tasks(t.events),
    "ledger_rows": lambda t: _ledger_rows(t.events),
    "line_rows": lambda t: t.lineitem.withColumn("source_row", F.expr(derived.LINE_ROW)),
    "priced_orders": lambda t: t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")),
}


def _tasks(events: DataFrame) -> DataFrame:
    """Events read as task records: the user is the job, the event the task, the value its seconds."""
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when((F.col("event_type") == "signup") & (F.col("value") > 300), "cancelled")
        .when((F.col("event_type") == "view") & (F.col("value") > 200), "partial")
        .otherwise("success")
    )
    elapsed = F.make_dt_interval(secs=F.round("value", 2).cast("decimal(18,6)"))
    return events.select(
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("task_id"),
        status.alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + elapsed).alias("completed_at"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("message"),
    )


def _ledger_rows(events: DataFrame) -> DataFrame:
    """Events read as ledger rows: the type is the pipeline, a user's k-th kind of file the path."""
    return events.select(
        F.col("event_type").alias("pipeline_name"),
        F.concat(F.lit("raw/"), F.col("user_id"), F.lit("/"), F.col("event_id") % 7, F.lit(".csv")).alias("file_path"),
        F.md5(F.col("props")).alias("file_hash"),
        F.col("ts").alias("processed_at"),
        F.when(F.col("value") > 100, "failed").otherwise("success").alias("status"),
        F.round("value").cast("long").alias("rows_processed"),
    )


# --- silver, legacy and gold -----------------------------------------------------------------------


def _silver_query(name: str) -> None:
    QUERIES[f"silver_{name}"] = lambda spark, sf_dir: getattr(Inputs(spark, sf_dir), name).drop(*AUDIT_DATES)


for _name in pipeline.SILVER:
    _silver_query(_name)


@query
def old_accueillants(t):
    return legacy.accueillants(t.bronze_accueillants)


@query
def old_geo(t):
    return t.old_geo_table


@query
def old_gares(t):
    return legacy.gares(t.bronze_gares)


@query
def old_lignes(t):
    return legacy.lignes(t.bronze_lignes)


@query
def old_logement_divergent_key(t):
    return t.old_rents


@query
def old_siae_structures_theta(t):
    return t.old_structures


@query
def old_siae_postes(t):
    return legacy.siae_postes(t.bronze_siae_postes, t.old_structures)


@query
def old_zones_explode(t):
    return legacy.zones_attraction(t.bronze_zones_attraction, t.old_geo_snapshot)


@query
def notebook_zones_regex_split(t):
    return legacy.zones_attraction(t.bronze_zones_attraction, t.old_geo_snapshot, r"\s* - \s*")


@query
def notebook_logement_key_drift(t):
    """Two vintages of rent files that name the code column differently, read as one."""
    rows = t.bronze_logement
    recent = F.col("ingestion_timestamp") >= F.lit("1998-01-01").cast("timestamp_ntz")
    older = rows.filter(~recent).withColumnRenamed("INSEE_C", "INSEE")
    return legacy.logement(evolve.schema_union(rows.filter(recent), older))


@query
def notebook_merge_gares(t):
    rows, early = t.bronze_gares, F.col("ingestion_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")
    target = legacy.gares(rows.filter(early)).filter(F.col("code_uic").isNotNull())
    return legacy.merge_gares(target, rows.filter(~early))


@query
def notebook_merge_lignes(t):
    rows, early = t.bronze_lignes, F.col("ingestion_timestamp") < F.lit("1996-01-01").cast("timestamp_ntz")
    return legacy.merge_lignes(legacy.lignes(rows.filter(early)), rows.filter(~early))


@query
def notebook_merge_logement(t):
    rows, early = t.bronze_logement, F.col("ingestion_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")
    target = legacy.merge_logement(t.old_rents.limit(0), rows.filter(early))
    return legacy.merge_logement(target, rows.filter(~early))


@query
def gold_rent_by_commune(t):
    return gold.shown("rent_by_commune", gold.rent_by_commune(t.dim_commune, t.fact_logement))


@query
def gold_rent_in_department(t):
    return gold.shown("rent_by_commune", gold.rent_by_commune(t.dim_commune, t.fact_logement, "75"))


@query
def gold_jobs_with_structure(t):
    return gold.jobs_with_structure(t.dim_siae_structure, t.fact_siae_poste)


@query
def gold_stations_by_commune(t):
    return gold.shown("stations_by_commune", gold.stations_by_commune(t.dim_commune, t.dim_gare))


@query
def gold_siae_by_zone(t):
    return gold.shown("structures_by_area", gold.structures_by_area(t.fact_zone_attraction, t.dim_siae_structure, t.fact_siae_poste))


@query
def gold_low_rent_siae(t):
    return gold.shown("low_rent_with_structures", gold.low_rent_with_structures(t.dim_commune, t.fact_logement, t.dim_siae_structure))


@query
def gold_transport_access(t):
    return gold.transport_access(t.dim_siae_structure, t.dim_commune, t.dim_gare)


@query
def gold_positions_by_department(t):
    return gold.shown("positions_by_department", gold.positions_by_department(t.bronze_siae_postes, t.old_structures))


@query
def gold_positions_boolean_flag(t):
    """The same over a feed whose flag is a boolean."""
    postings = t.bronze_siae_postes.withColumn("recrutement_ouvert", F.col("recrutement_ouvert") == "True")
    return gold.shown("positions_by_department", gold.positions_by_department(postings, t.old_structures))


@query
def gold_siae_housing(t):
    result = gold.structures_and_rents(t.old_structures, t.old_geo_table, t.old_rents)
    return result.withColumn("avg_housing_metric", F.col("avg_housing_metric").cast("decimal(14,4)"))


@query
def gold_accepting_structures(t):
    return gold.accepting_structures(t.old_structures)


# --- windows ---------------------------------------------------------------------------------------


@query
def latest_per_key(t):
    return dedupe.latest_per_key(t.events, ["user_id"], ["ts"], [F.col("event_id")])


@query
def latest_per_composite_key(t):
    rows = dedupe.latest_per_key(t.line_rows, ["l_partkey", "l_suppkey"], ["l_shipdate"])
    return rows.select("l_partkey", "l_suppkey", "l_shipdate", "source_row")


@query
def latest_with_priority(t):
    done_first = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return dedupe.latest_per_key(t.orders, ["o_custkey"], [done_first, "o_orderdate"], [F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"
    )


@query
def latest_by_two_dates(t):
    rows = dedupe.latest_per_key(t.line_rows, ["l_orderkey"], ["l_shipdate", "l_quantity"])
    return rows.select("l_orderkey", "l_shipdate", "l_quantity", "source_row")


@query
def first_occurrences(t):
    return dedupe.first_occurrences(t.events, ["user_id", "event_type"], "event_id")


# --- joins and keys --------------------------------------------------------------------------------


@query
def lookup_left_dimension(t):
    found = lookup.look_up(
        t.orders, t.customer, F.col("o_custkey"), "c_custkey", {"c_name": "customer_name", "c_mktsegment": "segment"}
    )
    return found.select("o_orderkey", "customer_name", "segment")


@query
def lookup_inner_computed_key(t):
    structures = t.bronze_siae_structures.select("id", "code_postal")
    return lookup.look_up(
        structures,
        t.dim_commune,
        F.substring("code_postal", 1, 5),
        "commune_code",
        {"commune_label": "commune_label", "region_code": "region_code"},
        "inner",
    )


@query
def lookup_role_playing(t):
    """The nation table twice: of the customer and of the supplier of each order line."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lookup.look_up(lines, t.customer, F.col("o_custkey"), "c_custkey", {"c_nationkey": "buyer_key"}, "inner")
    lines = lookup.look_up(lines, t.supplier, F.col("l_suppkey"), "s_suppkey", {"s_nationkey": "seller_key"}, "inner")
    lines = lookup.look_up(lines, t.nation, F.col("buyer_key"), "n_nationkey", {"n_name": "buyer_nation"}, "inner")
    lines = lookup.look_up(lines, t.nation, F.col("seller_key"), "n_nationkey", {"n_name": "seller_nation"}, "inner")
    return lines.groupBy("buyer_nation", "seller_nation").agg(F.count(F.lit(1)).alias("order_lines"))


@query
def lookup_normalized_name(t):
    places = silver.communes_by_city(t.bronze_geo, t.dim_commune)
    rows = t.bronze_siae_structures.withColumn("city", text.city_key(F.col("ville")))
    return rows.join(places, F.col("city") == F.col("city_name"), "left").select(
        "id", "city", "code_insee", "nom_standard", F.col("commune_sk").isNotNull().alias("known")
    )


@query
def lookup_anti(t):
    """Customers without an urgent order."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return lookup.missing(t.customer, urgent, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


@query
def lookup_semi(t):
    """Customers with an urgent order."""
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return lookup.matching(t.customer, urgent, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


@query
def join_on_cast_keys(t):
    lines = t.bronze_lignes.select(F.col("code_ligne"), F.col("source_row"))
    return lines.join(t.supplier, F.col("code_ligne").cast("long") == F.col("s_suppkey")).select("source_row", "s_name")


@query
def surrogate_keys(t):
    """Keys over several columns, null parts skipped, numbers in their shortest decimal form."""
    rows = t.lineitem.withColumns(
        {
            "rate": text.plain_double_text(F.col("l_discount") / 1000),
            "price": text.plain_double_text(F.col("l_extendedprice") * 1000),
            "flag": F.nullif("l_returnflag", F.lit("A")),
        }
    )
    return with_surrogate_key(rows, "line_sk", ["rate", "price", "flag", "l_orderkey"]).select(
        "line_sk", "rate", "price"
    )


@query
def text_cleaning(t):
    c = F.col
    codes = t.bronze_logement.withColumn("code", text.padded_commune_code(c("INSEE_C")))
    rent = names.col("loypredm2")
    return codes.select(
        "source_row",
        "code",
        text.fold_arrondissement(c("code")).alias("commune"),
        text.department_code(c("code")).alias("department"),
        text.region_code(c("code")).alias("region"),
        text.comma_double(rent).alias("rent"),
        text.comma_decimal(rent).alias("rent_decimal"),
        text.is_filled(c("code")).alias("filled"),
    )


@query
def text_posting_fields(t):
    c = F.col
    return t.bronze_siae_postes.select(
        "source_row",
        text.rome_code(c("rome")).alias("rome_code"),
        c("rome").like("%(%)%").alias("has_brackets"),
        text.is_true_text(c("recrutement_ouvert"), values.POSTING_TRUE_TEXTS).alias("is_open"),
        text.rounded_int(c("nombre_postes_ouverts")).alias("positions"),
    )


@query
def text_area_names(t):
    label = text.without_french_part(F.col("LIBAAV2020"))
    return t.bronze_zones_attraction.select(
        "source_row",
        label.alias("label"),
        text.pole_label(label).alias("pole"),
        text.name_key(label).alias("pole_key"),
        text.city_key(label, squeeze=True).alias("city"),
    )


@query
def lookup_arrondissements(t):
    """Arrondissements folded by the mapping table, and the codes that folding by prefix treats otherwise."""
    codes = t.bronze_logement.withColumn("code", text.padded_commune_code(F.col("INSEE_C")))
    mapped = lookup.map_arrondissements(codes, "code", "commune")
    return mapped.groupBy("commune").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("commune") != text.fold_arrondissement(F.col("code"))).alias("differing"),
    )


@query
def predicates(t):
    """Each kind of filter the pipelines use, as a count over the stations."""
    c, d = F.col, t.bronze_gares
    return d.agg(
        F.count_if(c("code_uic").isNull()).alias("is_null"),
        F.count_if(text.is_filled(c("c_geo"))).alias("filled"),
        F.count_if(c("y_wgs84").between(10, 20)).alias("between"),
        F.count_if(c("voyageurs").isin("O", "true")).alias("in_list"),
        F.count_if(c("c_geo").startswith("97")).alias("like_prefix"),
        F.count_if(c("libelle").like("%9%")).alias("like_infix"),
        F.count_if(c("libelle").ilike("gare 1%")).alias("ilike_prefix"),
        F.count_if(~F.contains("libelle", "code_ligne")).alias("not_like_column"),
        F.count_if((c("fret") == "O") | (c("voyageurs") == "O") & (c("x_wgs84") > 0.05)).alias("mixed_and_or"),
        F.count_if(c("x_wgs84") < c("y_wgs84")).alias("column_below_column"),
    )


@query
def set_differences(t):
    result = sets.differences(t.bronze_gares, "c_geo", t.dim_commune, "commune_code")
    return result.withColumnRenamed("value", "code")


@query
def set_distinct_values(t):
    return sets.distinct_values(t.bronze_geo, "code_insee")


# --- preview, schema, ad-hoc SQL -------------------------------------------------------------------


@query
def preview_eq(t):
    return preview.preview(t.customer, 50, [("c_mktsegment", "=", "BUILDING")], ["c_acctbal", "c_custkey"], "desc")


@query
def preview_eq_number_as_text(t):
    """A text never equals a number: the filter keeps nothing, its negation everything."""
    rows = preview.preview_counts(t.customer, [("c_nationkey", "=", "5")])
    return rows.unionByName(preview.preview_counts(t.customer, [("c_nationkey", "!=", "5")]))


@query
def preview_eq_timestamp(t):
    """A text filter on a time column is read as a time; a text that is none matches nothing."""
    stamps = ["1996-09-17 00:00:00", "2000-02-03", "no date"]
    counts = [preview.preview_counts(t.orders, [("o_orderdate", "=", s)]).withColumn("stamp", F.lit(s)) for s in stamps]
    counts.append(preview.preview_counts(t.orders, [("o_orderdate", "!=", stamps[0])]).withColumn("stamp", F.lit("other")))
    return reduce(DataFrame.unionByName, counts)


@query
def preview_ne_keeps_null(t):
    return preview.preview_counts(t.bronze_gares, [("code_uic", "!=", "87000001")], 1000)


@query
def preview_contains(t):
    return preview.preview(t.part, 100, [("p_name", "contains", "RED|^blue")], ["p_name", "p_partkey"])


@query
def preview_range(t):
    bounds = [("p_retailprice", ">=", "905.5"), ("p_size", "<", "20"), ("p_name", ">", "5"), ("nowhere", "=", "1")]
    return preview.preview(t.part, 100, bounds, ["p_retailprice", "p_partkey"], "desc")


@query
def preview_sort_nulls_last(t):
    return preview.preview(t.bronze_gares, 200, (), ["code_uic", "source_row"], "desc").select("code_uic", "source_row")


@query
def preview_counts(t):
    return preview.preview_counts(t.orders, [("o_totalprice", "<=", "100000"), ("o_orderpriority", "contains", "urgent")])


@query
def catalog_schema(t):
    rows = preview.table_schema(t.orders)
    return rows.select("position", "name", "type", "row_count", "num_fields")


@query
def catalog_table_detail(t):
    """Schema and first rows of a stored table, and what is known about its files."""
    root = work_dir(t.spark, "lake")
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")
    tables.write_table(places, root, "gold", "places")
    schema, head = tables.table_detail(t.spark, root, "gold", "places")
    info = tables.table_info(t.spark, root, "gold", "places")
    return schema.select(
        "name",
        "type",
        "row_count",
        F.lit(head.count()).cast("long").alias("preview_rows"),
        F.lit(info["exists"] and info["num_files"] > 0).alias("stored"),
        F.lit(tables.table_info(t.spark, root, "gold", "nothing")["exists"]).alias("other_stored"),
    )


@query
def adhoc_sql_limit(t):
    t.orders.createOrReplaceTempView("silver_orders_adhoc")
    rows, total = preview.run_sql(
        t.spark,
        "SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 0 THEN double('NaN') ELSE o_totalprice END AS price "
        "FROM silver_orders_adhoc WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey",
        limit=25,
    )
    return rows.withColumn("row_count", F.lit(total).cast("long"))


@query
def paged_sort(t):
    return t.orders.orderBy(F.col("o_orderdate").desc(), "o_orderkey").offset(30).limit(20).select("o_orderkey", "o_orderdate")


@query
def paged_sort_deep(t):
    """A page far into the lines by ship date: ranks from the counts of sorted ranges."""
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return preview.page(t.lineitem.select(*keys), [F.col("l_shipdate").desc_nulls_last(), *keys[1:]], 500, 3_000, deep=1_000)


@query
def log_page_deep(t):
    """A late page of the log of a job that owns every task."""
    logs = t.tasks.withColumn("job_id", F.lit(1))
    return runs.log_page(logs, 1, limit=200, offset=9_900, ties=["task_id"]).select("task_id", "timestamp", "message")


# --- sinks -----------------------------------------------------------------------------------------


def _order_versions(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Target and source of an upsert on (customer, priority): the newest order up to and after a date."""
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    rows = t.priced_orders.select("o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate", "o_orderkey")

    def newest(df: DataFrame) -> DataFrame:
        return dedupe.latest_per_key(df, ["o_custkey", "o_orderpriority"], ["o_orderdate"], [F.col("o_orderkey")])

    return newest(rows.filter(~late)), newest(rows.filter(late))


_ORDER_KEYS = ["o_custkey", "o_orderpriority"]


@query
def upsert_composite(t):
    return upsert.upsert(*_order_versions(t), _ORDER_KEYS)


@query
def upsert_replace_matching(t):
    return upsert.replace_matching(*_order_versions(t), _ORDER_KEYS)


@query
def upsert_stats(t):
    return upsert.upsert_stats(*_order_versions(t), _ORDER_KEYS)


@query
def upsert_partial_columns(t):
    target, source = _order_versions(t)
    return upsert.upsert(target, source, _ORDER_KEYS, ["o_totalprice"], ["o_custkey", "o_orderpriority", "o_totalprice"])


@query
def upsert_null_keys(t):
    """Customers by segment text, some of it null: the null key is one key when it may match."""
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))

    def newest(df: DataFrame) -> DataFrame:
        rows = df.select(segment.alias("segment"), "c_nationkey", "c_custkey", "c_name")
        return dedupe.latest_per_key(rows, ["segment", "c_nationkey"], ["c_custkey"])

    early = F.col("c_custkey") % 3 == 0
    target, source = newest(t.customer.filter(early)), newest(t.customer.filter(~early))
    return upsert.upsert(target, source, ["segment", "c_nationkey"], null_keys_match=True)


@query
def upsert_stored_table(t):
    """A stored table merged in place; the counts are those the merge returns."""
    target, source = _order_versions(t)
    root = work_dir(t.spark, "merge")
    tables.merge_table(target, root, "silver", "orders", _ORDER_KEYS)
    stats = tables.merge_table(source, root, "silver", "orders", _ORDER_KEYS)
    merged = tables.read_table(t.spark, root, "silver", "orders")
    return merged.withColumns({k: F.lit(v).cast("long") for k, v in stats.items()})


def _segments(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Customers by segment and nation, the segment sometimes null: those of some nations, and those with a debt."""
    segment = F.when(F.col("c_acctbal") < 8000, F.col("c_mktsegment"))

    def newest(df: DataFrame) -> DataFrame:
        return dedupe.latest_per_key(df.select(segment.alias("segment"), "c_nationkey", "c_custkey", "c_name"), ["segment", "c_nationkey"], ["c_custkey"])

    return newest(t.customer.filter("c_nationkey < 15")), newest(t.customer.filter("c_acctbal < 0 or c_acctbal > 9000"))


@query
def upsert_stats_null_keys(t):
    """Counts of a stored merge whose null keys match, and the rows it left."""
    target, source = _segments(t)
    root = work_dir(t.spark, "merge")
    tables.merge_table(target, root, "silver", "segments", ["segment", "c_nationkey"])
    stats = tables.merge_table(source, root, "silver", "segments", ["segment", "c_nationkey"], null_keys_match=True)
    n_rows = tables.read_table(t.spark, root, "silver", "segments").agg(F.count(F.lit(1)).alias("n_rows"))
    return n_rows.withColumns({k: F.lit(v).cast("long") for k, v in stats.items()})


@query
def merge_key_buckets(t):
    """The orders of the last day, changed, merged into a table in buckets: only the buckets of their keys are rewritten."""
    path = f"{work_dir(t.spark, 'merge')}/silver/orders"
    last = t.orders.agg(F.max("o_orderdate").alias("last"))
    source = t.orders.join(last, F.col("o_orderdate") == F.col("last")).drop("last")
    source = source.withColumns({"o_totalprice": F.col("o_totalprice") * 2, "o_orderkey": F.col("o_orderkey") * F.when(F.col("o_orderstatus") == "F", -1).otherwise(1)})
    buckets.create(t.orders, path, ["o_orderkey"], 256)
    files_before = _bucket_files(t.spark, path)
    stats = buckets.merge(source, path)
    rewritten = _bucket_files(t.spark, path).join(files_before, ["bucket", "file"], "left_anti").select("bucket").distinct().count()
    merged = buckets.read(t.spark, path).drop(buckets.BUCKET)
    return merged.withColumns(
        {"updated": F.lit(stats["updated"]), "inserted": F.lit(stats["inserted"]), "few_buckets": F.lit(rewritten == stats["buckets"] <= source.count())}
    )


def _bucket_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of each bucket as they are now."""
    found = buckets.read(spark, path).select(F.col(buckets.BUCKET).alias("bucket"), F.col("_metadata.file_path").alias("file")).distinct()
    return spark.createDataFrame([tuple(r) for r in found.collect()], "bucket int, file string")


@query
def schema_merge_union(t):
    left = t.customer.select("c_custkey", "c_name")
    right = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("nation"))
    return evolve.schema_union(left, right)


@query
def schema_merge_table(t):
    """Appends with an added column: older rows read it as null."""
    root = work_dir(t.spark, "evolve")
    tables.write_table(t.customer.select("c_custkey", "c_name"), root, "bronze", "parties")
    tables.write_table(t.customer.select("c_custkey", "c_mktsegment"), root, "bronze", "parties")
    return tables.read_table(t.spark, root, "bronze", "parties")


@query
def schema_replace_table(t):
    """An append with another type for a column replaces the table."""
    root = work_dir(t.spark, "evolve")
    tables.write_table(t.part.select("p_partkey", "p_size"), root, "bronze", "parts")
    renamed = t.part.select("p_partkey", F.col("p_brand").alias("p_size"))
    tables.write_table(renamed, root, "bronze", "parts", on_conflict="replace")
    return tables.read_table(t.spark, root, "bronze", "parts")


@query
def overwrite_own_input(t):
    """A table replaced by a plan that reads it, partitioned, then read with one column."""
    root = work_dir(t.spark, "swap")
    tables.write_table(t.orders.select("o_orderkey", "o_orderstatus"), root, "silver", "orders", "overwrite")
    stored = tables.read_table(t.spark, root, "silver", "orders")
    bigger = stored.withColumn("o_orderkey", F.col("o_orderkey") + 1)
    tables.write_table(bigger, root, "silver", "orders", "overwrite", partition_by=["o_orderstatus"])
    return tables.read_table(t.spark, root, "silver", "orders", ["o_orderkey", "o_orderstatus"])


@query
def typed_ddl(t):
    """Rows cast to a declared schema with column comments."""
    schema = evolve.commented_schema(
        [("code_uic", "string", "Code UIC"), ("rg_troncon", "int", "Rang"), ("longitude", "double", "WGS84")]
    )
    rows = t.bronze_gares.select(
        "code_uic", F.col("rg_troncon").try_cast("int").alias("rg_troncon"), F.col("x_wgs84").alias("longitude")
    )
    return rows.to(schema)


# --- data quality ----------------------------------------------------------------------------------


@query
def dq_row_counts(t):
    return quality.check_row_counts(t.bronze_geo, t.dim_commune, "geo → dim_commune")


@query
def dq_tolerance(t):
    return quality.union_checks(
        quality.check_row_counts(t.orders, t.priced_orders, "orders within 10 %", 0.10),
        quality.check_row_counts(t.bronze_accueillants, t.dim_accueillant, "hosts shrink by up to 30 %", 0.30, True),
    )


@query
def dq_unique_values(t):
    return quality.check_values_preserved(
        t.bronze_geo, "code_insee", t.dim_commune, "commune_code", "geo.code_insee → dim_commune.commune_code"
    )


@query
def dq_not_null(t):
    return quality.check_table(t.bronze_gares, "gares", not_null=["libelle", "code_uic", "x_wgs84", "nowhere"])


@query
def dq_unique_key(t):
    return quality.union_checks(
        quality.check_table(t.dim_commune, "dim_commune", unique=["commune_sk", "commune_code"]),
        quality.check_table(t.lineitem, "lineitem", unique=["l_orderkey"]),
    )


@query
def dq_fk_orphans(t):
    return quality.union_checks(
        quality.check_foreign_key(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem → orders"),
        quality.check_foreign_key(t.bronze_gares, "c_geo", t.dim_commune, "commune_code", "gares → communes", 0.15),
        quality.check_foreign_key(
            t.fact_siae_poste, "siae_structure_sk", t.dim_siae_structure, "siae_structure_sk", "postes → structures"
        ),
    )


@query
def dq_ranges(t):
    low, high = F.col("loyer_lower_bound_m2"), F.col("loyer_upper_bound_m2")
    return quality.union_checks(
        quality.check_table(
            t.fact_logement,
            "fact_logement",
            forbidden=["lib_commune", "lib_epci"],
            rules={"rent_positive": F.col("loyer_predicted_m2") > 0, "bounds_ordered": low < high},
        ),
        quality.check_table(
            t.dim_commune,
            "dim_commune",
            rules={"department_length": F.length("departement_code").isin(2, 3)},
            ratios={"region_filled": (F.col("region_code").isNotNull(), 0.95)},
        ),
    )


@query
def dq_formats(t):
    return quality.union_checks(
        quality.check_table(
            t.bronze_siae_structures,
            "siae_structures",
            rules={
                "siret_format": F.col("siret").rlike(values.SIRET_FORMAT),
                "known_type": F.col("type").isin(*values.STRUCTURE_TYPES),
            },
        ),
        quality.check_table(
            t.fact_siae_poste,
            "fact_siae_poste",
            rules={
                "rome_format": F.col("rome_code").rlike(values.ROME_FORMAT),
                "positions_positive": F.col("postes_nombre") > 0,
            },
        ),
    )


@query
def dq_audit_columns(t):
    return quality.union_checks(
        quality.check_table(t.dim_ligne, "dim_ligne", audit=True),
        quality.check_table(t.orders, "orders", audit=True),
    )


@query
def dq_silver_layer(t):
    """All eight silver tables: keys and audit columns in one pass per table, then every foreign key."""
    keys = {
        "dim_commune": ["commune_sk", "commune_code"], "dim_accueillant": ["accueillant_sk"], "dim_gare": ["gare_sk"],
        "dim_ligne": ["ligne_sk"], "dim_siae_structure": ["siae_structure_sk"], "fact_logement": ["logement_sk"],
        "fact_zone_attraction": ["zone_attraction_sk"], "fact_siae_poste": ["siae_poste_sk"],
    }
    checks = [quality.check_table(getattr(t, name), name, unique=unique, audit=True) for name, unique in keys.items()]
    for table, column, dimension, key in SILVER_FOREIGN_KEYS:
        name = f"{table}.{column}"
        checks.append(quality.check_foreign_key(getattr(t, table), column, getattr(t, dimension), key, name))
    return quality.union_checks(*checks)


SILVER_FOREIGN_KEYS = (
    ("dim_accueillant", "commune_sk", "dim_commune", "commune_sk"),
    ("dim_gare", "commune_sk", "dim_commune", "commune_sk"),
    ("dim_siae_structure", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_logement", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_zone_attraction", "commune_sk", "dim_commune", "commune_sk"),
    ("fact_zone_attraction", "commune_pole_sk", "dim_commune", "commune_sk"),
    ("fact_siae_poste", "siae_structure_sk", "dim_siae_structure", "siae_structure_sk"),
)


@query
def dq_report(t):
    return quality.quality_report(
        quality.union_checks(dq_unique_key(t), dq_ranges(t), dq_formats(t), dq_audit_columns(t))
    )


@query
def dq_naming(t):
    """Column names of the silver tables against the naming rules, with the rows they apply to."""
    naming = quality.check_naming(t.dim_ligne, "dim_ligne").unionByName(quality.check_naming(t.orders, "Orders"))
    sizes = t.dim_ligne.agg(F.count(F.lit(1)).alias("n")).select(F.lit("dim_ligne").alias("table_name"), "n")
    sizes = sizes.unionByName(t.orders.agg(F.count(F.lit(1)).alias("n")).select(F.lit("Orders").alias("table_name"), "n"))
    return naming.join(sizes, "table_name").groupBy("table_name").agg(
        F.count_if("passed").alias("good_names"), F.count_if(~F.col("passed")).alias("bad_names"), F.max("n").alias("n_rows")
    )


# --- ledger ----------------------------------------------------------------------------------------


@query
def ledger_processed_files(t):
    return ledger.processed_files(t.ledger_rows, "click")


@query
def ledger_new_files(t):
    return ledger.new_files(t.ledger_rows.select("file_path").distinct(), t.ledger_rows, "click")


@query
def ledger_clear(t):
    return ledger.cleared(t.ledger_rows, "click")


@query
def ledger_status(t):
    return ledger.run_status(t.ledger_rows)


# --- sources ---------------------------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str, **options) -> str:
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, **options}
    df.write.options(**options).csv(path)
    return path


@query
def source_delimited_auto(t):
    """Files with three separators and different columns, read as one frame of text."""
    folder = work_dir(t.spark, "csv")
    customer = t.customer.select("c_custkey", "c_name", "c_nationkey")
    for separator, name, rest in ((",", "comma", 0), (";", "semicolon", 1), ("\t", "tab", 2)):
        rows = customer.filter(F.col("c_custkey") % 3 == rest)
        _write_csv(rows.drop("c_nationkey") if name == "tab" else rows, f"{folder}/{name}", sep=separator)
    return delimited.read_delimited(t.spark, [f"{folder}/{n}" for n in ("comma", "semicolon", "tab")])


@query
def source_delimited_encoding(t):
    """UTF-8 and Latin-1 files side by side."""
    folder = work_dir(t.spark, "csv")
    lines = t.bronze_lignes.select("source_row", "lib_ligne", "catlig")
    fast = F.col("catlig") == values.HIGH_SPEED_CATEGORY
    _write_csv(lines.filter(fast), f"{folder}/latin", sep=";", encoding="ISO-8859-1")
    _write_csv(lines.filter(~fast), f"{folder}/utf", sep=";")
    return delimited.read_delimited(t.spark, [f"{folder}/latin", f"{folder}/utf"], sep=";")


@query
def source_delimited_bad_rows(t):
    """Rows with a field too many are dropped, rows with one too few are padded."""
    folder = work_dir(t.spark, "csv")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    line = F.concat_ws(
        ";",
        F.col("o_orderkey"),
        F.col("o_orderstatus"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")),
        F.when(F.col("o_custkey") % 7 == 0, F.lit("extra;more")),
    )
    headed = F.when(place == 0, F.concat(F.lit("key;status;priority\n"), line)).otherwise(line)
    t.orders.select(headed).write.text(folder)
    return delimited.read_delimited(t.spark, folder)


@query
def source_delimited_inferred(t):
    folder = _write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), work_dir(t.spark, "csv"), sep=";")
    rows = delimited.read_delimited(t.spark, folder, all_string=False)
    return rows.select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_retailprice")


@query
def source_preamble_rows(t):
    """Files with five title lines before the header."""
    folder = work_dir(t.spark, "preamble")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    line = F.concat_ws(";", "CODGEO", "AAV2020", "LIBAAV2020", "source_row")
    head = "Composition communale\n\nNiveau;commune\nMillesime\n----\nCODGEO;AAV2020;LIBAAV2020;source_row\n"
    zones = t.bronze_zones_attraction.withColumn("CODGEO", F.coalesce("CODGEO", F.lit("")))
    zones.select(F.when(place == 0, F.concat(F.lit(head), line)).otherwise(line)).write.text(folder)
    return delimited.read_delimited(t.spark, folder, skip_rows=5)


@query
def source_odd_file_names(t):
    """Folders and files whose names hold the characters of path patterns."""
    folder = f"{work_dir(t.spark, 'csv')}/year=[2024]"
    for part, name in enumerate(("{a}", "b[1]", "c*d?")):
        rows = t.customer.filter(F.col("c_custkey") % 3 == part).select("c_custkey", "c_name")
        _write_csv(rows if part else rows.select("c_name", "c_custkey"), f"{folder}/{name}", sep=";")
    return delimited.read_delimited(t.spark, files.literal_path(folder))


@query
def source_preamble_short_file(t):
    """Files shorter than the preamble, beside good ones: they hold no header and lend none to the next file."""
    folder = work_dir(t.spark, "preamble")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    head = "Titre\n\nNiveau\nMillesime\n----\ns_suppkey,s_name\n"
    line = F.concat_ws(",", "s_suppkey", "s_name")
    rows = t.supplier.repartition(8, "s_suppkey").select(F.when(place == 0, F.concat(F.lit(head), line)).otherwise(line))
    rows.write.text(folder)
    for number in range(8):
        storage.write_text(t.spark, f"{folder}/{'part' if number % 2 else 'a'}-0000{number}-short.txt", "Titre\nNiveau\n")
    return delimited.read_delimited(t.spark, folder, skip_rows=5)


@query
def source_preamble_latin1(t):
    """Latin-1 files with title lines before the header, beside UTF-8 ones."""
    folder = work_dir(t.spark, "preamble")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    head = F.array(*[F.lit(x) for x in ("Référentiel", "Année;2024", "code_ligne;lib_ligne;catlig")])
    line = F.concat_ws(";", F.coalesce("code_ligne", F.lit("")), "lib_ligne", "catlig")
    lines = t.bronze_lignes.select("rg_troncon", line.alias("line"))
    for encoding, rest in (("ISO-8859-1", 0), ("UTF-8", 1)):
        part = lines.filter(F.col("rg_troncon").cast("int") % 2 == rest)
        headed = part.select(F.explode(F.when(place == 0, F.concat(head, F.array("line"))).otherwise(F.array("line"))))
        options = {"sep": "\x01", "quote": "\x02", "encoding": encoding, "header": False}
        headed.write.options(**options).csv(f"{folder}/{encoding}")
    return delimited.read_delimited(t.spark, folder, skip_rows=2)


@query
def bronze_zones_file(t):
    """The area file with its five title lines, through its own reader."""
    folder = work_dir(t.spark, "zones")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    line = F.concat_ws(",", "AAV2020", "CATEAAV2020", "source_row")
    head = "Titre\n\nNiveau\nMillesime\n----\nAAV2020,CATEAAV2020,source_row\n"
    rows = t.bronze_zones_attraction.select(F.when(place == 0, F.concat(F.lit(head), line)).otherwise(line))
    rows.write.text(folder)
    return ingest.zones_attraction(t.spark, [folder]).drop("ingestion_timestamp")


def _pages(df: DataFrame, key: str, array: str) -> DataFrame:
    """Envelope pages of at most a hundred records with consecutive keys."""
    record = F.struct(*[names.col(c) for c in df.columns])
    return df.groupBy(F.floor(names.col(key) / 100).alias("page")).agg(F.collect_list(record).alias(array))


@query
def source_json_results(t):
    """``{"results": […], "next": …}`` pages; nested fields flattened two levels deep."""
    records = t.customer.select(
        "c_custkey",
        F.struct("c_name", F.struct("c_nationkey", F.struct("c_mktsegment").alias("c")).alias("b")).alias("a"),
    )
    path = f"{work_dir(t.spark, 'pages')}/api"
    _pages(records, "c_custkey", "results").withColumn("next", F.lit("more")).write.json(path)
    rows = json_pages.read_json_pages(t.spark, path, multi_line=False)
    flat = nested.flatten_structs(rows, max_level=2)
    return flat.withColumn("a_b_c", F.col("a_b_c.c_mktsegment"))


@query
def source_json_data(t):
    """``{"data": […], "meta": …}`` pages with odd column names and coordinates as nested lists."""
    folder = work_dir(t.spark, "pages")
    records = t.supplier.select(
        F.col("s_suppkey").alias("Code Ligne"),
        F.col("s_name").alias("Lib-Ligne"),
        F.array(F.array(F.col("s_suppkey"), F.col("s_nationkey").cast("long"))).alias("geo.shape.coordinates"),
    )
    total = F.struct(F.lit(t.supplier.count()).alias("total"))
    _pages(records, "Code Ligne", "data").withColumn("meta", total).drop("page").write.json(folder)
    return ingest.lignes(t.spark, folder, multi_line=False).drop("ingestion_timestamp")


@query
def source_json_total(t):
    folder = work_dir(t.spark, "pages")
    total = F.struct((F.lit(t.customer.count()) + 5).alias("total"))
    _pages(t.customer, "c_custkey", "data").withColumn("meta", total).drop("page").write.json(folder)
    return json_pages.check_total(json_pages.read_pages(t.spark, folder, multi_line=False))


@query
def source_json_children(t):
    """Structures with nested postings: one row per posting with its parent's keys."""
    folder = work_dir(t.spark, "pages")
    postings = F.transform(
        F.sequence(F.lit(1), (F.col("c_custkey") % 3).cast("int") + 1),
        lambda i: F.struct(
            F.concat_ws("-", "id", i).alias("id"), F.struct((i * 2).alias("open")).alias("poste"), F.lit("K1").alias("rome")
        ),
    )
    none = F.lit(None).cast("array<struct<id:string,poste:struct<open:int>,rome:string>>")
    structures = t.bronze_siae_structures.withColumn("c_custkey", F.col("source_row")).select(
        "id", "siret", F.when(F.col("c_custkey") % 4 == 0, none).otherwise(postings).alias("postes")
    )
    structures.write.json(folder)
    return ingest.siae_postes(t.spark, folder, multi_line=False).drop("ingestion_timestamp")


@query
def source_department_coverage(t):
    return json_pages.department_coverage(t.bronze_siae_structures)


@query
def source_latest_landed(t):
    """Of two landed responses the one with the later stamp in its name is read."""
    root = work_dir(t.spark, "raw")
    json_pages.land_raw(t.customer.select("c_custkey"), root, "parties", "20240101_000000")
    json_pages.land_raw(t.customer.select("c_custkey", "c_name"), root, "parties", "20240201_000000")
    path = ingest.latest_landed(t.spark, root, "parties")
    return json_pages.read_json_pages(t.spark, path, multi_line=False)


@query
def source_file_listing(t):
    """Listing with content hashes: per folder the files, and the hashes that are well formed."""
    folder = work_dir(t.spark, "files")
    t.customer.select("c_custkey", "c_nationkey").repartition("c_nationkey").write.partitionBy("c_nationkey").csv(folder)
    listed = files.list_source_files(t.spark, folder, with_hash=True)
    nation = F.regexp_extract("file_path", "c_nationkey=([0-9]+)", 1).cast("int")
    return listed.groupBy(nation.alias("c_nationkey")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("file_hash").rlike("^[0-9a-f]{32}$")).alias("hashes"),
        F.sum("length").alias("bytes"),
    )


@query
def source_file_hash(t):
    """The MD5 of a file is the MD5 of its lines; one file per nation, small ones and larger ones."""
    folder = work_dir(t.spark, "files")
    lines = t.customer.select("c_nationkey", "c_custkey", "c_name").repartition("c_nationkey")
    lines = lines.sortWithinPartitions("c_nationkey", "c_custkey").drop("c_custkey")
    lines.write.partitionBy("c_nationkey").text(folder)
    listed = files.list_source_files(t.spark, folder, with_hash=True)
    nation = F.regexp_extract("file_path", "c_nationkey=([0-9]+)", 1).cast("int")
    return listed.select(nation.alias("c_nationkey"), "file_hash")


@query
def source_open_data_resources(t):
    """Several configured resources, one of them missing; the table of one is read back."""
    folder, root = work_dir(t.spark, "pages"), work_dir(t.spark, "lake")
    quoted_names = t.part.select(F.col("p_partkey").alias('"p_partkey"'), F.col("p_name").alias('"p_name"'))
    quoted_names.write.json(f"{folder}/parts")
    resources = [
        {"name": "parts", "path": f"{folder}/parts"},
        {"name": "gone", "path": f"{folder}/gone"},
    ]
    summary = ingest.run_summary(ingest.ingest_resources(t.spark, root, resources, multi_line=False)).first()
    rows = tables.read_table(t.spark, root, "bronze", "open_data_parts", ["p_partkey", "p_name"])
    return rows.withColumns({k: F.lit(v) for k, v in summary.asDict().items()})


@query
def bronze_geo_file(t):
    """Commune file with a byte-order mark in front of its header, everything read as text."""
    folder = work_dir(t.spark, "csv")
    geo = t.bronze_geo.select(
        F.col("code_insee").alias("\ufeffcode_insee"), "nom_standard", "code_postal", F.col("source_row")
    )
    _write_csv(geo, folder)
    return ingest.geo(t.spark, [folder]).drop("ingestion_timestamp")


@query
def bronze_accueillants_file(t):
    folder = work_dir(t.spark, "csv")
    hosts = t.bronze_accueillants.select("statut", F.col("Code_postal").alias("Code postal"), "Latitude", "source_row")
    _write_csv(hosts, folder, sep=";")
    return ingest.accueillants(t.spark, [folder]).drop("ingestion_timestamp")


@query
def bronze_gares_pages(t):
    """Station pages: names normalized, the listed codes as text."""
    folder = work_dir(t.spark, "pages")
    stations = t.part.select(
        F.col("p_partkey").alias("Code UIC"), F.col("p_size").alias("Code-Ligne"), F.col("p_name").alias("Libellé gare")
    )
    _pages(stations, "Code UIC", "data").drop("page").write.json(folder)
    return ingest.gares(t.spark, folder, multi_line=False).drop("ingestion_timestamp")


@query
def bronze_structures_pages(t):
    """Structure pages: nested objects flattened, postings left as a list."""
    folder = work_dir(t.spark, "pages")
    rows = t.bronze_siae_structures.select(
        F.col("source_row").alias("key"), "id", F.struct("ville", "code_postal").alias("addresse"), F.array("type").alias("postes")
    )
    _pages(rows, "key", "results").write.json(folder)
    flat = ingest.siae_structures(t.spark, folder, multi_line=False).drop("ingestion_timestamp")
    return flat.withColumn("postes", F.concat_ws(",", "postes"))


@query
def ingest_forced(t):
    """A forced run reads every file again and replaces the table: no row is doubled."""
    source, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")
    _write_csv(t.customer.select("c_custkey", "c_name"), source)
    for force in (False, False, True):
        ingest.ingest_files(t.spark, root, "parties", source, ingest.geo, force=force)
    return tables.read_table(t.spark, root, "bronze", "parties", ["c_custkey", "c_name"])


@query
def ingest_incremental(t):
    """Two deliveries of rent files: the second run reads only what the ledger does not know."""
    source, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")
    rents = t.bronze_logement.drop("ingestion_timestamp")
    early = F.col("REG").cast("int") < 9
    _write_csv(rents.filter(early), f"{source}/first", sep=";")
    first = ingest.ingest_files(t.spark, root, "logement", source)
    first_rows = first.first().rows_processed
    _write_csv(rents.filter(~early), f"{source}/second", sep=";", encoding="ISO-8859-1")
    ingest.ingest_files(t.spark, root, "logement", source)
    again = ingest.ingest_files(t.spark, root, "logement", source).first()
    table = tables.read_table(t.spark, root, "bronze", "logement")
    return table.groupBy("REG").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("source_row").alias("distinct_rows"),
        F.lit(first_rows).cast("long").alias("first_run_rows"),
        F.lit(again.files_processed).cast("long").alias("third_run_files"),
    )


@query
def ingest_after_failure(t):
    """A run that dies before its ledger entries is repeated: no row is doubled, none is lost."""
    source, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")
    rows = t.customer.select("c_custkey", "c_name")
    _write_csv(rows.filter("c_custkey % 2 = 0"), f"{source}/first")
    ingest.ingest_files(t.spark, root, "parties", source, ingest.geo)
    storage.remove_folder(t.spark, f"{root}/{ingest.LEDGER_TABLE}")
    _write_csv(rows.filter("c_custkey % 2 = 1"), f"{source}/second")
    ingest.ingest_files(t.spark, root, "parties", source, ingest.geo)
    entered = ingest.read_ledger(t.spark, root).agg(F.sum("rows_processed")).first()[0]
    table = tables.read_table(t.spark, root, "bronze", "parties", ["c_custkey", "c_name"])
    return table.withColumn("entered", F.lit(entered).cast("long"))


@query
def ingest_type_drift(t):
    """Files whose column comes with another type are put aside as failed; the table keeps its rows."""
    source, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")

    def typed(spark: SparkSession, paths: list[str], **options) -> DataFrame:
        return delimited.read_delimited(spark, paths, all_string=False, **options)

    small = t.part.select("p_partkey", "p_size").coalesce(1)
    _write_csv(small, f"{source}/first")
    ingest.ingest_files(t.spark, root, "parts", source, typed)
    _write_csv(t.part.select("p_partkey", F.col("p_brand").alias("p_size")).coalesce(1), f"{source}/second")
    status = ingest.ingest_files(t.spark, root, "parts", source, typed).first()
    table = tables.read_table(t.spark, root, "bronze", "parts")
    return table.select(
        F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("long").alias("p_size"),
        F.lit(status.files_failed).alias("failed"), F.lit(status.status).alias("status"),
    )


@query
def ingest_bad_file(t):
    """A file that cannot be read at all is entered as failed, the others of its batch are taken."""
    source, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")
    _write_csv(t.supplier.select("s_suppkey", "s_name"), source)
    storage.write_text(t.spark, f"{source}/broken.csv.gz", "s_suppkey,s_name\nno archive at all\n")
    status = ingest.ingest_files(t.spark, root, "suppliers", source, ingest.geo).first()
    table = tables.read_table(t.spark, root, "bronze", "suppliers", ["s_suppkey", "s_name"])
    return table.withColumns(
        {"failed": F.lit(status.files_failed), "rows_processed": F.lit(status.rows_processed), "status": F.lit(status.status)}
    )


@query
def ingest_skip_filled(t):
    """A table that holds rows is left alone by a second run, and replaced by a forced one."""
    root = work_dir(t.spark, "lake")
    found = None
    for run, force in enumerate((False, False, True)):
        landed = f"{root}/landed/{run}"
        rows = t.nation.select((F.col("n_nationkey") + 100 * run).alias("key"), F.col("n_name").alias("name"))
        _pages(rows, "key", "results").write.json(landed)
        status = ingest.refresh_api_table(t.spark, root, "nations", landed, _results, force)
        table = tables.read_table(t.spark, root, "bronze", "nations").select("key", "name", F.lit(run).alias("run"), F.lit(status).alias("status"))
        table.write.parquet(f"{root}/seen/{run}")
        seen = t.spark.read.parquet(f"{root}/seen/{run}")
        found = seen if found is None else found.unionByName(seen)
    return found


def _results(spark: SparkSession, path: str) -> DataFrame:
    return json_pages.read_json_pages(spark, path, "results", "results array<struct<key: long, name: string>>", multi_line=False)


@query
def json_flatten(t):
    """The JSON text of an event as nested records, flattened into columns."""
    rows = t.events.select(
        "event_id",
        F.struct(
            F.struct(F.col("user_id").alias("id")).alias("user"), F.from_json("props", "k int").alias("props")
        ).alias("event"),
    )
    return nested.flatten_structs(rows)


@query
def array_explode_parent(t):
    """The lines of a document as child records; a child field hides a parent column of its name."""
    line = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"), F.length(x).alias("n_chars")))
    rows = t.documents.select("doc_id", "lang", "n_chars", line.alias("lines"))
    exploded = nested.explode_children(rows, "lines", {"doc_id": "doc_id", "lang": "parent_lang", "n_chars": "n_chars"})
    return exploded.groupBy("doc_id", "parent_lang").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("n_chars").alias("chars"), F.max("line").alias("last_line")
    )


@query
def array_to_json(t):
    rounded = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))
    rows = t.embeddings.select("vec_id", F.array(rounded).alias("coordinates"))
    return nested.arrays_to_json(rows, ["coordinates", "nowhere"])


# --- runs ------------------------------------------------------------------------------------------


@query
def runs_rollup(t):
    jobs = runs.job_rollup(t.tasks)
    return jobs.withColumn("progress_percent", F.col("progress_percent").cast("decimal(9,4)"))


@query
def runs_ordered_tasks(t):
    rows = runs.ordered_tasks(t.tasks)
    seconds = F.col("duration_seconds").cast("decimal(18,6)")
    return rows.select("job_id", "task_id", "started_at", seconds.alias("duration_seconds"))


@query
def runs_iso_times(t):
    return t.tasks.select(
        "task_id", runs.iso_time(F.col("started_at")).alias("started"),
        runs.iso_time(F.date_trunc("SECOND", "completed_at").cast("timestamp_ntz")).alias("completed"),
    )


@query
def runs_history_topn(t):
    jobs = runs.job_rollup(t.tasks).select("job_id", "started_at", "total_tasks", "status")
    return runs.recent(jobs, "started_at", 50, ["job_id"])


@query
def runs_log_page(t):
    return runs.log_page(t.tasks, 8, limit=20, offset=10, ties=["task_id"]).select("job_id", "task_id", "timestamp", "message")


@query
def runs_last_n(t):
    jobs = runs.job_rollup(t.tasks)
    rows = runs.latest_log_lines(t.tasks, jobs, limit=100, ties=["task_id"])
    return rows.select("job_id", "task_id", "timestamp", "message")


@query
def runs_retention(t):
    rows = runs.retain(t.tasks, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return rows.select("job_id", "task_id", "timestamp")


def _customer_edges(t: Inputs) -> DataFrame:
    """A dependency tree over the customers, numbered from one: n depends on n / 2."""
    key = F.col("c_custkey") + 1
    return t.customer.select(key.alias("node"), F.floor(key / 2).alias("dependency"))


@query
def runs_dependency_closure(t):
    return runs.dependency_closure(_customer_edges(t))


@query
def runs_execution_order(t):
    return runs.execution_order(runs.dependency_closure(_customer_edges(t)))


@query
def runs_missing_dependencies(t):
    edges = t.orders.select(F.col("o_orderkey").alias("node"), (F.col("o_custkey") * 3).alias("dependency"))
    return runs.missing_dependencies(edges, t.customer.select(F.col("c_custkey").alias("node")))


# --- stored layers and streams ---------------------------------------------------------------------


def _build(t: Inputs, root: str, stages: tuple[str, ...] = ("silver", "gold", "legacy", "legacy_gold")) -> None:
    for stage in stages:
        for table, status, message in pipeline.build_layer(t.spark, root, stage):
            if status != "success":
                raise RuntimeError(f"{stage}.{table}: {message}")


@query
def full_run_from_files(t):
    """Delivered files and pages, bronze, silver, gold, then SQL over the registered tables.

    All files are delivered compressed, as text of this size is.
    """
    packed = {"compression": "gzip"}
    raw, root = work_dir(t.spark, "raw"), work_dir(t.spark, "lake")
    # files carry no time of their own here, so the newest row of a commune is picked before delivery
    newest = dedupe.latest_per_key(t.bronze_geo.filter(text.is_filled(F.col("code_insee"))), ["code_insee"], ["ingestion_timestamp"])
    _write_csv(newest.drop("ingestion_timestamp"), f"{raw}/geo", **packed)
    _write_csv(t.bronze_accueillants.drop("ingestion_timestamp"), f"{raw}/accueillants", sep=";", **packed)
    rents, joined = t.bronze_logement.drop("ingestion_timestamp"), work_dir(t.spark, "rents")
    rents.write.option("compression", "zstd").parquet(joined)  # both deliveries read one join
    rents = t.spark.read.schema(rents.schema).parquet(joined)
    for rest, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        _write_csv(rents.filter(F.col("REG").cast("int") % 2 == rest), f"{raw}/logement/{rest}", sep=";", encoding=encoding, **packed)
    for name in ("gares", "lignes"):
        getattr(t, f"bronze_{name}").drop("ingestion_timestamp").write.options(**packed).json(f"{raw}/{name}")
    sources = {n: f"{raw}/{n}" for n in ("geo", "accueillants", "logement")}
    landed = {n: f"{raw}/{n}" for n in ("gares", "lignes")}
    outcome = pipeline.ingest_layer(t.spark, root, sources, landed, multi_line=False)
    bad = [o for o in outcome if o[1] != "success"]
    if bad:
        raise RuntimeError(str(bad))
    for stage, name in (("silver", "dim_commune"), ("silver", "dim_gare"), ("silver", "dim_ligne"), ("gold", "stations_by_commune")):
        layer, known = pipeline.STAGES[stage]
        inputs = [tables.read_table(t.spark, root, *i.split(".")) for i in known[name].inputs]
        tables.write_table(known[name].build(*inputs), root, layer, name, "overwrite")
    tables.register_layers(t.spark, root)
    sql = """
SELECT g.nb_gares, count(*) AS n_communes, (SELECT count(*) FROM bronze_logement) AS rent_rows,
  (SELECT count(*) FROM bronze_geo) AS geo_rows, (SELECT count(*) FROM silver_dim_ligne) AS n_lines,
  (SELECT count(*) FROM silver_dim_gare) AS n_stations, (SELECT count(*) FROM bronze_accueillants) AS n_hosts
FROM gold_stations_by_commune g GROUP BY g.nb_gares"""
    rows, total = preview.run_sql(t.spark, sql, limit=100_000)
    return rows.withColumn("total", F.lit(total).cast("long"))


@query
def full_run_catalog(t):
    """Bronze tables stored, silver and gold built from them, then the catalog of the silver layer."""
    root = work_dir(t.spark, "lake")
    for name in derived.BRONZE:
        with shuffles_go(t.spark):
            tables.write_table(getattr(t, name), root, "bronze", name.removeprefix("bronze_"), "overwrite")
    _build(t, root)
    views = tables.register_layers(t.spark, root)
    described = pipeline.silver_catalog(t.spark, root)
    listed = tables.catalog(t.spark, root).filter("layer = 'silver'").select("name")
    return described.join(listed, "name").select("name", "row_count", F.lit(len(views)).cast("long").alias("n_views"))


_EVENT_COLUMNS = "event_id long, ts string, user_id long, event_type string, value double"


def _drop_events(t: Inputs, folder: str, second: bool) -> None:
    """Deliver one half of the events as CSV files into a watched folder."""
    half = F.col("event_id") % 2 == (1 if second else 0)
    rows = t.events.filter(half).select("event_id", F.col("ts").cast("string"), "user_id", "event_type", "value")
    rows.write.mode("append").options(header=True, sep=";").csv(folder)


@query
def stream_new_files(t):
    """Two runs of a file stream over a growing folder: every file is taken once."""
    folder = work_dir(t.spark, "stream")
    for second in (False, True):
        _drop_events(t, f"{folder}/in", second)
        streams.ingest_stream(t.spark, f"{folder}/in", _EVENT_COLUMNS, f"{folder}/out", f"{folder}/check")
    rows = t.spark.read.parquet(f"{folder}/out")
    return rows.drop("ingestion_timestamp").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_upsert_latest(t):
    """Latest event per user, kept up to date over two runs of a stream."""
    folder = work_dir(t.spark, "stream")
    for second in (False, True):
        _drop_events(t, f"{folder}/in", second)
        stream = streams.read_csv_stream(t.spark, f"{folder}/in", _EVENT_COLUMNS)
        streams.upsert_stream(stream, f"{folder}/out", f"{folder}/check", ["user_id"], ["ts", "event_id"])
    rows = streams.current_snapshot(t.spark, f"{folder}/out")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_upsert_null_keys(t):
    """Latest event per user over three runs, where many events have no user: they are one key."""
    folder = work_dir(t.spark, "stream")
    user = F.when(F.col("user_id") % 4 != 0, F.col("user_id"))
    for part in range(3):
        rows = t.events.filter(F.col("event_id") % 3 == part)
        rows = rows.select("event_id", F.col("ts").cast("string"), user.alias("user_id"), "event_type", "value")
        rows.write.mode("append").options(header=True, sep=";").csv(f"{folder}/in")
        stream = streams.read_csv_stream(t.spark, f"{folder}/in", _EVENT_COLUMNS)
        streams.upsert_stream(stream, f"{folder}/out", f"{folder}/check", ["user_id"], ["ts", "event_id"])
    found = streams.current_snapshot(t.spark, f"{folder}/out")
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_schema_evolution(t):
    """Files with columns in another order, a missing and a new one, over two runs of one stream."""
    folder = work_dir(t.spark, "stream")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    first, second = orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1")
    deliveries = (first.drop("o_orderpriority"), second.select("o_orderpriority", "o_orderstatus", "o_orderkey"))
    for rows in deliveries:
        rows.write.mode("append").options(header=True, sep=";").csv(f"{folder}/in")
        streams.ingest_stream_by_header(t.spark, f"{folder}/in", folder, "bronze", "orders", f"{folder}/check")
    return tables.read_table(t.spark, folder, "bronze", "orders").drop("ingestion_timestamp")


@query
def stream_bad_file(t):
    """A blank and a broken file arrive with good ones: they are entered as rejected, and a later run takes what is new."""
    folder = work_dir(t.spark, "stream")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    for half, name in ((0, "blank.csv"), (1, "broken.csv.gz")):
        orders.filter(F.col("o_orderkey") % 2 == half).write.mode("append").options(header=True, sep=";").csv(f"{folder}/in")
        storage.write_text(t.spark, f"{folder}/in/{name}", "\n \n" if half == 0 else "no archive at all\n")
        streams.ingest_stream_by_header(t.spark, f"{folder}/in", folder, "bronze", "orders", f"{folder}/check")
    rejected = tables.read_table(t.spark, folder, "bronze", "orders_rejected")
    rejected = rejected.select(F.regexp_extract("file_path", "[^/]*$", 0).alias("o_orderkey"), F.col("reason").alias("o_orderstatus"))
    return tables.read_table(t.spark, folder, "bronze", "orders").drop("ingestion_timestamp").unionByName(rejected)


@query
def stream_rescued_columns(t):
    """Files with a column more than declared, one less, and values that do not fit: the rest is kept as JSON."""
    folder = work_dir(t.spark, "stream")
    late = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey")
    deliveries = (
        t.orders.filter("o_orderkey % 2 = 0").select("o_orderkey", late, "o_orderpriority"),
        t.orders.filter("o_orderkey % 2 = 1").select("o_orderstatus", "o_orderkey", F.lit("x").alias("note")),
    )
    for rows in deliveries:
        rows.write.mode("append").options(header=True, sep=";").csv(f"{folder}/in")
        schema = "o_orderkey long, o_custkey long, o_orderstatus string"
        streams.ingest_stream_by_header(t.spark, f"{folder}/in", folder, "bronze", "orders", f"{folder}/check", schema=schema)
    return tables.read_table(t.spark, folder, "bronze", "orders").drop("ingestion_timestamp").withColumnRenamed("_rescued_data", "rescued")


@query
def stream_filename_stamp(t):
    """Files that carry a stamp in their name: each row gets the stamp of its file."""
    folder = work_dir(t.spark, "stream")
    for month in (1, 2):
        rows = t.customer.filter(F.col("c_custkey") % 2 == month - 1).select("c_custkey", "c_name")
        staged = _write_csv(rows, f"{folder}/staged-{month}", sep=";")
        stamp = f"20240{month}03_040506"
        _take_as(t.spark, staged, f"{folder}/in", stamp)
        streams.ingest_stream_by_header(t.spark, f"{folder}/in", folder, "bronze", "parties", f"{folder}/check")
    return tables.read_table(t.spark, folder, "bronze", "parties")


def _take_as(spark: SparkSession, staged: str, folder: str, stamp: str) -> None:
    """Move written files into a watched folder under names that end in a stamp."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    fs = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(paths(folder))
    listed = files.list_source_files(spark, staged).select("file_path").collect()
    for number, row in enumerate(sorted(r.file_path for r in listed)):
        fs.rename(paths(row), paths(f"{folder}/parties{number}_{stamp}.csv"))


@query
def stream_rescued_rows(t):
    """Rows that do not fit the declared types keep their text, names are normalized in the stream."""
    folder = work_dir(t.spark, "stream")
    broken = F.when(F.col("o_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    rows = t.orders.select(F.col("o_orderkey").alias("Order Key"), broken.alias("Cust-Key"), "o_orderstatus")
    rows.write.options(header=True, sep=";").csv(f"{folder}/in")
    schema = "`Order Key` long, `Cust-Key` long, o_orderstatus string"
    streams.ingest_stream(
        t.spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/check", normalize=True, rescued=True
    )
    return t.spark.read.parquet(f"{folder}/out").drop("ingestion_timestamp")
