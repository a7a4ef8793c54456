import random

import pytest
from pyspark.sql import functions as F

from medalith.operators import dedupe, evolve, ledger, lookup, nested, preview, quality, runs, upsert


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 2), ("a", 1, 1), ("a", None, 0), (None, 3, 5), (None, 4, 6)], "k string, ts int, source_row int"
    )
    assert rows(dedupe.latest_per_key(df, ["k"], ["ts"])) == [("a", 1, 1), (None, 4, 6)]
    plain = df.drop("source_row")
    assert dedupe.latest_per_key(plain, ["k"], ["ts"]).count() == 2


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    latest = dedupe.latest_per_key(df, ["k"], ["ts"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_prefix_matches_equal_the_theta_join(spark):
    rng = random.Random(7)
    words = ["", "A", "AB", "ABC", "B", "BA", "ABCD", None]
    left = spark.createDataFrame(
        [(i, rng.choice(words), rng.choice(["1", "2", None])) for i in range(60)], "id int, t string, b string"
    )
    right = spark.createDataFrame(
        [(i, rng.choice(words), rng.choice(["1", "2", None])) for i in range(25)], "rid int, p string, rb string"
    )
    expected = left.join(
        right, (F.col("t") == F.col("p")) | (F.startswith("t", "p") & (F.col("b") == F.col("rb"))), "left"
    ).select("id", "rid")
    found = lookup.prefix_matches(left, right, "t", "b", "p", "rb")
    assert rows(found.select("id", "rid")) == rows(expected)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_prefixes_never_pass_the_driver(spark, tmp_path):
    """Files that are small on disk expand to many prefixes, which must not become a broadcast."""
    spark.range(2000).select(
        F.format_string("NAME %05d", "id").alias("t"), (F.col("id") % 9).cast("string").alias("b")
    ).write.parquet(f"{tmp_path}/names")
    names = spark.read.parquet(f"{tmp_path}/names")
    right = names.select(F.substring("t", 1, 9).alias("p"), F.col("b").alias("rb")).distinct()
    found = lookup.prefix_matches(names, right, "t", "b", "p", "rb")
    joins = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in joins and found.count() == 2000


def test_upsert_matches_on_all_keys(spark):
    target = spark.createDataFrame([(1, "x", 10, "t"), (1, "y", 20, "t"), (None, "z", 30, "t")], "a int, b string, v int, w string")
    source = spark.createDataFrame([(1, "x", 11, 5), (2, "x", 12, 6), (None, "z", 13, 7)], "a int, b string, v int, n int")
    merged = upsert.upsert(target, source, ["a", "b"])
    assert merged.columns == ["a", "b", "v", "w", "n"]
    assert rows(merged) == rows(
        spark.createDataFrame(
            [(1, "x", 11, "t", 5), (1, "y", 20, "t", None), (2, "x", 12, None, 6), (None, "z", 30, "t", None),
             (None, "z", 13, None, 7)], "a int, b string, v int, w string, n int")
    )
    assert upsert.upsert_stats(target, source, ["a", "b"]).first().asDict() == {"updated": 1, "inserted": 2, "deleted": 0}
    partial = upsert.upsert(target, source, ["a", "b"], update_cols=["n"], insert_cols=["v"])
    assert (1, "x", 10, "t", 5) in rows(partial) and (2, "x", 12, None, None) in rows(partial)
    replaced = upsert.replace_matching(target, source, ["a", "b"])
    assert (1, "x", 11, None, 5) in rows(replaced) and replaced.count() == 4


def test_null_keys_are_spread_in_an_upsert(spark):
    target = spark.range(4000).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("v"))
    assert upsert._side(target, ["k"], "t").select("__t_spread").distinct().count() == 16 * 8  # 16 per shuffle partition
    assert upsert.upsert(target, target, ["k"]).count() == 8000


def test_two_source_rows_for_a_key_fail(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    twice = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="two source rows for one key"):
        upsert.upsert(target, twice, ["k"]).collect()
    nulls = spark.createDataFrame([(None, 2), (None, 3)], "k string, v int")
    assert upsert.upsert(target, nulls, ["k"]).count() == 3
    with pytest.raises(Exception, match="two source rows for one key"):
        upsert.upsert(target, nulls, ["k"], null_keys_match=True).collect()
    one = spark.createDataFrame([(None, 2)], "k string, v int")
    again = upsert.upsert(upsert.upsert(target, one, ["k"], null_keys_match=True), one, ["k"], null_keys_match=True)
    assert again.count() == 2


def test_small_upserts_leave_the_target_in_place(spark):
    target = spark.range(100000).select("id", (F.col("id") * 2).alias("v"))
    merged = upsert.upsert(target, spark.range(5).select("id", F.lit(0).cast("long").alias("v")), ["id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and merged.count() == 100000


def test_schema_evolution(spark):
    left, right = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, 3)], "k int, w int")
    assert rows(evolve.schema_union(left, right)) == [(1, "a", None), (2, None, 3)]
    changed = spark.createDataFrame([("2", "b")], "k string, v string")
    with pytest.raises(TypeError):
        evolve.schema_union(left, changed)
    assert rows(evolve.schema_union(left, changed, "replace")) == [("2", "b")]
    schema = evolve.commented_schema([("a b", "int", "A"), ("c", "array<string>", "C")])
    assert schema["a b"].metadata == {"comment": "A"} and schema["c"].dataType.simpleString() == "array<string>"


def test_flatten_levels_and_collisions(spark):
    df = spark.sql(
        "SELECT 1 AS id, named_struct('b', named_struct('c', named_struct('d', 2)), 'x', 3) AS a, 9 AS a_x, array(1) AS l"
    )
    assert nested.flatten_structs(df).columns == ["id", "a_x", "l", "a_b_c_d"]
    assert nested.flatten_structs(df).first().a_x == 3
    two = nested.flatten_structs(df, max_level=2)
    assert two.columns == ["id", "a_x", "l", "a_b_c"] and dict(two.dtypes)["a_b_c"].startswith("struct")
    assert nested.flatten_structs(df, max_level=0).columns == ["id", "a_x", "l", "a"]


def test_explode_children(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('s1', '99', array(named_struct('id', 'p1', 'structure_siret', 'own'))), "
        "('s2', '98', array()), ('s3', '97', NULL) AS t(id, siret, postes)"
    )
    children = nested.explode_children(df, "postes", {"id": "structure_id", "siret": "structure_siret"})
    assert children.columns == ["structure_id", "id", "structure_siret"]
    assert rows(children) == [("s1", "p1", "own")]


def test_arrays_to_json(spark):
    df = spark.sql("SELECT array(array(2.5D, 48.0D), array(1.0D)) AS c, array('a,b') AS s, CAST(NULL AS array<int>) AS n")
    row = nested.arrays_to_json(df, ["c", "s", "n"]).first()
    assert tuple(row) == ("[[2.5, 48.0], [1.0]]", '["a,b"]', None)


def test_preview_filters(spark):
    df = spark.createDataFrame(
        [("Rouge", 1.0, True), ("rOUGE2", float("nan"), False), (None, 3.0, None)], "c string, n double, b boolean"
    )

    def kept(*filters):
        return preview.preview_counts(df, filters).first().filtered_rows

    assert kept(("c", "=", "Rouge")) == 1 and kept(("c", "!=", "Rouge")) == 2
    assert kept(("n", "=", "1.0")) == 0 and kept(("n", "!=", "1.0")) == 3 and kept(("n", "=", 1.0)) == 1
    assert kept(("c", "contains", "rouge$")) == 1 and kept(("n", "contains", r"^3\.0$")) == 1
    assert kept(("n", ">", "0")) == 2 and kept(("n", ">", "nan")) == 0
    assert kept(("n", ">", "x")) == 3 and kept(("c", ">", "5")) == 3 and kept(("nowhere", "=", "1")) == 3
    assert kept(("b", ">=", "1")) == 1 and kept(("c", "like", "R")) == 3
    assert [r.n for r in preview.preview(df.filter("NOT isnan(n) OR c IS NULL"), 5, (), "n", "DESC").collect()] == [3.0, 1.0]
    assert preview.preview(df, 2, (), "nowhere").count() == 2


@pytest.mark.parametrize("offset, limit", [(0, 7), (40, 25), (990, 30), (1000, 5), (5000, 5), (10, 0)])
def test_deep_pages_are_those_of_a_sort(spark, offset, limit):
    values = [(None if i % 50 == 0 else i * 7919 % 200, i, f"r{i}") for i in range(1000)]
    df = spark.createDataFrame(values, "a int, rank int, part string").repartition(9)
    order = [F.col("a").desc_nulls_last(), F.col("rank")]
    expected = sorted(values, key=lambda v: (v[0] is None, -(v[0] or 0), v[1]))[offset : offset + limit]
    for deep in (0, 10_000):
        found = preview.page(df, order, limit, offset, deep)
        assert found.columns == df.columns
        assert [tuple(r) for r in found.collect()] == expected


def test_deep_page_of_an_empty_table(spark):
    assert preview.page(spark.createDataFrame([], "a int"), [F.col("a")], 5, 20_000).collect() == []


def test_run_sql_runs_the_query_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    spark.udf.register("counted", counted)
    spark.range(0, 500, 1, 6).createOrReplaceTempView("bronze_ids")
    sql = "SELECT counted(id) AS id, CAST(NULL AS INT) AS nothing, 1 AS position FROM bronze_ids"
    found, total = preview.run_sql(spark, sql, limit=3)
    assert [tuple(r) for r in found.collect()] == [(0, None, 1), (1, None, 1), (2, None, 1)]
    assert (total, seen.value) == (500, 500)
    assert preview.run_sql(spark, "SELECT * FROM bronze_ids WHERE id < 0")[1] == 0
    assert preview.run_sql(spark, "SELECT * FROM bronze_ids WHERE 1 = 0")[1] == 0
    found, total = preview.run_sql(spark, "SELECT id % 5 AS k, count(*) AS n FROM bronze_ids GROUP BY ALL ORDER BY k DESC", limit=2)
    assert ([tuple(r) for r in found.collect()], total) == ([(4, 100), (3, 100)], 5)
    assert preview.run_sql(spark, "SELECT * FROM bronze_ids", limit=0)[0].collect() == []


def test_run_sql(spark):
    spark.range(5).selectExpr("id", "double('NaN') AS x").createOrReplaceTempView("bronze_numbers")
    result, total = preview.run_sql(spark, "SELECT * FROM bronze_numbers ORDER BY id", limit=2)
    assert total == 5 and rows(result) == [(0, None), (1, None)]
    with pytest.raises(LookupError, match="bronze_numbers"):
        preview.run_sql(spark, "SELECT * FROM bronze_nothing")


def test_checks_on_empty_and_broken_tables(spark):
    empty = spark.createDataFrame([], "k int, v string")
    verdicts = {r.check_name: r.passed for r in quality.check_table(empty, "e", ["v"], ["k", "gone"], audit=True).collect()}
    assert verdicts == {"No NULLs: e": True, "Unique key: e.k": True, "Unique key: e.gone": False, "Metadata columns: e": False}
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    checks = quality.check_table(
        df, "t", not_null=["v"], unique=["k"], forbidden=["v"], rules={"short": F.length("v") < 1},
        ratios={"filled": (F.col("v").isNotNull(), 0.5)},
    )
    assert [r.passed for r in checks.collect()] == [False, False, False, False, True]
    report = quality.quality_report(checks).first()
    assert (report.total_validations, report.passed, report.success_rate) == (5, 1, "20.0%")
    assert quality.quality_report(checks.limit(0)).first().success_rate == "N/A"


def test_foreign_key_counts_rows_behind_orphans(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",), ("c",)], "pk string")
    row = quality.check_foreign_key(fact, "fk", dim, "pk", "x").first()
    assert not row.passed
    assert row.details == '{"fk_count":2,"pk_count":2,"orphaned_count":1,"orphaned_rows":2,"orphaned_samples":["b"]}'
    assert quality.check_foreign_key(fact, "fk", dim, "pk", "x", 0.6).first().passed
    assert not quality.check_row_counts(fact, dim, "x").first().passed
    assert quality.check_row_counts(fact, dim, "x", 0.6, shrink_only=True).first().passed


def test_naming(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["commune_sk", "loyerPredit", "r2"])
    verdict = {r.column_name: r.passed for r in quality.check_naming(df, "dim_x").collect()}
    assert verdict == {"commune_sk": True, "loyerPredit": False, "r2": True}


def test_ledger_retries_failed_files(spark):
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "file_path string")
    done = spark.createDataFrame([("f1", "h", "success", 3), ("f2", None, "failed", 0)],
                                 "file_path string, file_hash string, status string, rows_processed long")
    entries = ledger.ledger_entries(done, "geo")
    assert entries.schema.simpleString().startswith("struct<pipeline_name:string")
    assert rows(ledger.new_files(files, entries, "geo")) == [("f2",), ("f3",)]
    assert ledger.new_files(files, entries, "other").count() == 3
    assert ledger.cleared(entries, "geo").isEmpty()
    assert ledger.run_status(entries).first().status == "partial"


def test_dependencies(spark):
    from medalith.plans.pipeline import dependency_edges

    edges = dependency_edges(spark)
    closure = runs.dependency_closure(edges)
    nodes = {r.node for r in closure.filter("root = 'gold.structures_by_area'").collect()}
    assert {"bronze.geo", "silver.dim_commune", "bronze.siae_postes"} <= nodes
    order = {r.node: r.position for r in runs.execution_order(closure).collect()}
    assert all(order[e.dependency] < order[e.node] for e in edges.collect())
    assert runs.cyclic_nodes(edges, closure).isEmpty()
    looped = edges.union(spark.createDataFrame([("bronze.geo", "silver.dim_commune")], edges.schema))
    one = spark.createDataFrame([("silver.dim_commune",)], "node string")
    assert rows(runs.cyclic_nodes(looped, runs.dependency_closure(looped, one))) == [("silver.dim_commune",)]
    known = edges.select("node").union(edges.filter("dependency <> 'bronze.geo'").select("dependency"))
    assert {r.dependency for r in runs.missing_dependencies(edges, known.toDF("node")).collect()} == {"bronze.geo"}


def test_job_status_rules(spark):
    tasks = spark.createDataFrame(
        [(1, "success"), (1, "partial"), (2, "success"), (3, "failed"), (3, "cancelled"), (4, "success"), (4, "running")],
        "job_id int, status string",
    ).withColumns({c: F.lit("2024-01-01").cast("timestamp_ntz") for c in ("started_at", "completed_at")})
    result = {r.job_id: (r.status, r.progress_percent) for r in runs.job_rollup(tasks).collect()}
    assert result == {1: ("failed", 50.0), 2: ("success", 100.0), 3: ("cancelled", 0.0), 4: ("running", 50.0)}
