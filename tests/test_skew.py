"""One key holds a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from medalith.operators import dedupe, lookup, upsert
from medalith.plans import gold, pipeline, silver

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
N = 300_000


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=N):
    """Rows whose key is 0, or null, for a third each."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 16).select(F.col("id"), key.cast("long").alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_hot_keys(no_broadcast):
    spark = no_broadcast
    dimension = spark.range(0, N, 1, 16).select(F.col("id").alias("code"), F.md5(F.col("id").cast("string")).alias("label"))
    found = lookup.look_up(hot(spark), dimension, F.col("k"), "code", {"label": "label"})
    assert "skew=true" in final_plan(found)
    assert found.agg(F.count("*"), F.count("label")).first()[:] == (N, 2 * N // 3)


def test_hot_groups_shrink_before_the_shuffle(no_broadcast):
    df = hot(no_broadcast)
    latest = dedupe.latest_per_key(df, ["k"], ["id"])
    latest.collect()
    assert latest.count() == N // 3 + 2
    assert latest.filter("k IS NULL").first().id == N - 2


def test_upsert_with_hot_null_keys(no_broadcast):
    target = hot(no_broadcast).filter("k IS NULL OR k > 0").select("k", F.col("pad").alias("v"))
    source = no_broadcast.range(10).select((F.col("id") * 3 + 2).alias("k"), F.lit("new").alias("v"))
    merged = upsert.upsert(target, source, ["k"])
    assert merged.agg(F.count("*"), F.count_if(F.col("v") == "new")).first()[:] == (2 * N // 3, 10)


def test_one_city_with_a_third_of_the_structures(no_broadcast):
    spark = no_broadcast
    geo = spark.range(3000).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("code_insee"),
        F.when(F.col("id") < 1000, "PARIS").otherwise(F.concat(F.lit("Ville "), F.col("id"))).alias("nom_standard"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ingestion_timestamp"),
    )
    structures = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"),
        F.lpad(F.col("id").cast("string"), 14, "0").alias("siret"),
        F.when(F.col("id") % 3 == 0, "Paris").otherwise(F.concat(F.lit("ville-"), F.col("id") % 3000)).alias("ville"),
        F.lit(False).alias("bloque_candidatures"),
        F.lit("2024").alias("mis_a_jour_le"),
    )
    communes = silver.dim_commune(geo)
    dimension = silver.dim_siae_structure(structures, geo, communes)
    assert dimension.count() == 30_000
    paris = dimension.filter("ville = 'Paris'").agg(F.count("*"), F.min("code_insee"), F.max("code_insee")).first()
    assert paris[:] == (10_000, "00000", "00000")


def test_counts_over_two_hot_sides_need_no_pairs(no_broadcast):
    """A commune with 20,000 structures and 20,000 stations: 400 million pairs if they were built."""
    spark = no_broadcast
    communes = spark.createDataFrame([("c", "Paris")], "commune_sk string, commune_label string")
    structures = spark.range(20_000).select(F.col("id").cast("string").alias("siae_structure_sk"), F.lit("c").alias("commune_sk"))
    areas = spark.range(20_000).select(F.lit("area").alias("aire_attraction_label"), F.lit("c").alias("commune_sk"))
    postings = structures.select("siae_structure_sk", F.lit(2).alias("postes_nombre"))
    row = gold.structures_by_area(areas, structures, postings).first()
    assert (row.nb_structures, row.total_postes) == (20_000, 2 * 20_000 * 20_000)
    stations = spark.range(20_000).select(F.col("id").cast("string").alias("gare_sk"), F.lit("c").alias("commune_sk"))
    assert gold.stations_by_commune(communes, stations).first().nb_gares == 20_000


def test_pairs_of_one_commune_are_dealt_out(spark):
    """400 structures and 300 stations of one commune: several tasks make the pairs, and rows may be equal or lack a key."""
    communes = spark.createDataFrame([("c", "Paris"), ("d", "Lyon")], "commune_sk string, commune_label string")
    key = F.when(F.col("id") % 50 != 0, (F.col("id") - F.col("id") % 2).cast("string"))
    commune = F.when(F.col("id") == 7, "d").otherwise("c").alias("commune_sk")
    structures = spark.range(400).select(key.alias("siae_structure_sk"), commune, F.lit("r").alias("raison_sociale"), F.lit("v").alias("ville"))
    stations = spark.range(300).select(
        key.alias("gare_sk"), commune, (F.col("id") % 3 != 0).alias("voyageurs"), F.col("id").cast("string").alias("libelle"), F.lit("1").alias("code_ligne")
    )
    found = gold.transport_access(structures, communes, stations)
    assert found.columns == ["raison_sociale", "ville", "gare_proche", "code_ligne"]
    counts = {r.gare_proche: r["count"] for r in found.groupBy("gare_proche").count().collect()}
    assert counts == {str(k): 1 if k == 7 else 399 for k in range(300) if k % 3}
    by_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) > 2 and max(by_task) < sum(by_task) / 2


def test_pairs_are_never_met_by_a_broadcast_of_the_repeated_rows(spark, capsys):
    """Spark judges stations by the file they come from, while the grid repeats each of them."""
    communes = spark.range(2).select(F.col("id").cast("string").alias("commune_sk"))
    structures = spark.range(4).select(F.col("id").cast("string").alias("siae_structure_sk"), (F.col("id") % 1 + 1).cast("string").alias("commune_sk"), F.lit("r").alias("raison_sociale"), F.lit("v").alias("ville"))
    stations = spark.range(3).select(
        F.col("id").cast("string").alias("gare_sk"), (F.col("id") % 1 + 1).cast("string").alias("commune_sk"), F.lit(True).alias("voyageurs"), F.lit("l").alias("libelle"), F.lit("1").alias("code_ligne")
    )
    found = gold.transport_access(structures, communes, stations)
    found.explain()
    assert re.search(r"SortMergeJoin \[[^\]]*__row", capsys.readouterr().out)
    assert found.count() == 12


def test_pairs_of_large_communes_come_in_runs_of_stations(spark):
    """Every stretch of 2,048 pairs of a task names few of the 6,000 stations, so a file of the pairs stays small."""
    communes = spark.range(1).select(F.lit("c").alias("commune_sk"))
    structures = spark.range(96).select(
        F.col("id").cast("string").alias("siae_structure_sk"), F.lit("c").alias("commune_sk"), F.concat(F.lit("r"), "id").alias("raison_sociale"), F.lit("v").alias("ville")
    )
    stations = spark.range(6000).select(
        F.col("id").cast("string").alias("gare_sk"), F.lit("c").alias("commune_sk"), F.lit(True).alias("voyageurs"), F.concat(F.lit("g"), "id").alias("libelle"), F.lit("1").alias("code_ligne")
    )
    found = gold.transport_access(structures, communes, stations).withColumn("at", F.monotonically_increasing_id())
    assert found.agg(F.count("*"), F.count_distinct("raison_sociale", "gare_proche")).first()[:] == (96 * 6000, 96 * 6000)
    stretches = found.groupBy(F.floor(F.col("at") / 2048)).agg(F.count_distinct("gare_proche").alias("named"))
    assert stretches.agg(F.max("named")).first()[0] <= 640


def test_shuffle_files_of_a_table_go_when_it_is_written(spark, tmp_path, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name, None), []
    monkeypatch.setattr(pipeline, "write_table", lambda *_: seen.append(spark.conf.get(name, None)))
    monkeypatch.setitem(pipeline.STAGES, "one", ("silver", {"numbers": pipeline.Table(lambda: spark.range(3), ())}))
    assert pipeline.build_layer(spark, str(tmp_path), "one") == [("numbers", "success", "")]
    assert seen == ["true"] and spark.conf.get(name, None) == before
