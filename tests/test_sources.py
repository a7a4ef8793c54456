import hashlib
import json

import pytest
from pyspark.sql import functions as F

from medalith.plans import bronze, legacy, pipeline
from medalith.session import work_dir
from medalith.sources import delimited, files, json_pages, tables
from medalith.streaming import ingest


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_separators_marks_and_uneven_rows(spark, tmp_path):
    put(tmp_path / "a b.csv", "﻿code;name;code\n01;Été;1\n02;short\n03;long;1;2\n04;\"semi;colon\";4\n\n05;long;;\n")
    put(tmp_path / "b.csv", "code,name\n06,x\n")
    put(tmp_path / "sub" / "c.csv", "code\tnew\n07\ty\n")
    put(tmp_path / "d.csv", "code\n08\n")
    df = delimited.read_delimited(spark, str(tmp_path))
    assert set(df.columns) == {"code", "name", "code.1", "new"}
    found = rows(df.select("code", "name", "`code.1`", "new"))
    assert found == [
        ("01", "Été", "1", None), ("02", "short", None, None), ("04", "semi;colon", "4", None), ("06", "x", None, None),
        ("07", None, None, "y"), ("08", None, None, None),
    ]
    assert df.count() == 6


def test_latin_1_files(spark, tmp_path):
    put(tmp_path / "u.csv", "a;b\né;1\n")
    put(tmp_path / "l.csv", "a;b\nplain;0\nè;2\n".encode("latin-1"))
    assert rows(delimited.read_delimited(spark, str(tmp_path), sep=";")) == [("plain", "0"), ("è", "2"), ("é", "1")]


def test_preamble_over_several_files_and_splits(spark, tmp_path):
    head = "Title;;\n\nLevel;x\n-\n-\nCODGEO;AAV2020\n"
    body = "".join(f"{i:05d};{i % 50:03d}\n" for i in range(4000))
    put(tmp_path / "one.csv", head + body)
    put(tmp_path / "two.csv", head + "99999;001\n99998;002;3\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = delimited.read_delimited(spark, str(tmp_path), skip_rows=5)
        assert df.columns == ["CODGEO", "AAV2020"]
        assert df.count() == 4001 and df.select("CODGEO").distinct().count() == 4001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_shapes(spark, tmp_path):
    record = {"id": 1, "nested": {"a": {"b": {"c": 1}}}}
    put(tmp_path / "list" / "1.json", json.dumps([record, record]))
    put(tmp_path / "results" / "1.json", json.dumps({"results": [record], "next": "2"}))
    put(tmp_path / "results" / "2.json", json.dumps({"results": [], "next": None}))
    put(tmp_path / "data" / "1.json", json.dumps({"data": [record] * 3, "links": {}, "meta": {"total": 3}}, indent=1))
    put(tmp_path / "bare" / "1.json", json.dumps(record))
    counts = {k: json_pages.read_json_pages(spark, str(tmp_path / k)).count() for k in ("list", "results", "data", "bare")}
    assert counts == {"list": 2, "results": 1, "data": 3, "bare": 1}
    assert json_pages.check_total(json_pages.read_pages(spark, str(tmp_path / "data"))).first().passed
    flat = bronze.siae_structures(spark, str(tmp_path / "data"))
    assert flat.columns == ["id", "nested_a_b", "ingestion_timestamp"]
    assert json_pages.department_keys(spark).count() == 101


def test_api_columns(spark, tmp_path):
    page = {"data": [{"Code UIC": 87, "Code-Ligne": 1, "geo_shape.coordinates": [[1.5, 2.0]]}], "meta": {"total": 1}}
    put(tmp_path / "g" / "1.json", json.dumps(page))
    stations = bronze.gares(spark, str(tmp_path / "g")).first()
    assert (stations.code_uic, stations.code_ligne) == ("87", "1")
    assert bronze.lignes(spark, str(tmp_path / "g")).first().geo_shape_coordinates == "[[1.5, 2.0]]"


def test_file_listing_and_hash(spark, tmp_path):
    put(tmp_path / "a.txt", "abc")
    put(tmp_path / "deep" / "b c.txt", b"x" * 5000)
    listed = files.list_source_files(spark, str(tmp_path), with_hash=True)
    found = {r.length: r.file_hash for r in listed.collect()}
    assert found == {3: hashlib.md5(b"abc").hexdigest(), 5000: hashlib.md5(b"x" * 5000).hexdigest()}
    assert files.latest_file(listed).first().file_path.endswith("b%20c.txt")


def test_incremental_ingest_isolates_bad_files(spark, tmp_path):
    raw, root = tmp_path / "raw", work_dir(spark, "lake")
    put(raw / "rents_20240101_000000.csv", "INSEE_C;lwr.IPm2\n1001;1,5\n")
    put(raw / "rents 2.csv", "INSEE;lwr.IPm2\n1002;2,5\n1003;3,5\n")

    def read(session, paths, keep_source=False):
        if any("broken" in p for p in paths):
            raise OSError("broken file")
        return bronze.logement(session, paths, keep_source=keep_source)

    def run(force=False):
        return tuple(bronze.ingest_files(spark, root, "logement", str(raw), read, force=force).first())

    assert run() == ("logement", 2, 0, 3, "success")
    put(raw / "broken.csv", "INSEE_C;lwr.IPm2\n1;1\n")
    put(raw / "rents3.csv", "INSEE_C;lwr.IPm2\n1004;4,5\n")
    assert run() == ("logement", 1, 1, 1, "partial")
    assert run() == ("logement", 0, 1, 0, "partial")
    table = tables.read_table(spark, root, "bronze", "logement")
    assert set(table.columns) == {"INSEE_C", "INSEE", "lwr.IPm2", "ingestion_timestamp"} and table.count() == 4
    assert run(force=True) == ("logement", 3, 1, 4, "partial")
    assert tables.read_table(spark, root, "bronze", "logement").count() == 4
    hashes = [r.file_hash for r in bronze.read_ledger(spark, root).filter("status = 'success'").collect()]
    assert len(hashes) == 3 and all(len(h) == 32 for h in hashes)


def test_failed_runs_can_be_repeated(spark, tmp_path, monkeypatch):
    """A run that dies between writing and its ledger entries leaves nothing doubled, forced or not."""
    raw, root = tmp_path / "raw", work_dir(spark, "lake")
    put(raw / "a.csv", "k;v\n1;x\n2;y\n")
    put(raw / "b[1].csv", "v;k\nz;3\n")

    def run(force=False):
        return tuple(bronze.ingest_files(spark, root, "accueillants", str(raw), force=force).first())

    def stored():
        return sorted((r.k, r.v) for r in tables.read_table(spark, root, "bronze", "accueillants").collect())

    def dies(*_):
        raise OSError("lost the driver")

    everything = [("1", "x"), ("2", "y"), ("3", "z")]
    for force in (False, True):
        with monkeypatch.context() as patch:
            patch.setattr(bronze, "append_ledger", dies)
            with pytest.raises(OSError):
                run(force)
        assert stored() == everything
        assert run() == ("accueillants", 2, 0, 3, "success")
        assert stored() == everything
        assert run() == ("accueillants", 0, 0, 0, "success")
    put(raw / "c.csv", "k;v;w\n4;u;new\n")
    assert run() == ("accueillants", 1, 0, 1, "success")
    assert stored() == [*everything, ("4", "u")]


def test_type_drift_never_touches_the_table(spark, tmp_path):
    raw, root = tmp_path / "raw", work_dir(spark, "lake")

    def read(session, paths, keep_source=False):
        return delimited.read_delimited(session, paths, all_string=False, keep_source=keep_source)

    def run():
        return tuple(bronze.ingest_files(spark, root, "parts", str(raw), read).first())

    put(raw / "1.csv", "k,size\n1,10\n")
    assert run() == ("parts", 1, 0, 1, "success")
    put(raw / "2.csv", "k,size\n2,large\n")
    put(raw / "3.csv", "k,size\n3,30\n")
    assert run() == ("parts", 1, 1, 1, "partial")
    assert sorted((r.k, r["size"]) for r in tables.read_table(spark, root, "bronze", "parts").collect()) == [(1, 10), (3, 30)]
    failed = bronze.read_ledger(spark, root).filter("status = 'failed'").collect()
    assert [r.file_path.rsplit("/", 1)[1] for r in failed] == ["2.csv"]


def test_layouts_and_encodings_of_odd_files(spark, tmp_path):
    put(tmp_path / "x[1].csv", "a;b\n1;é\n")
    put(tmp_path / "{y}.csv", "b;a\nü;2\n".encode("latin-1"))
    put(tmp_path / "z*.csv", "\n\na;b\n3;o\n")
    found = delimited.read_delimited(spark, str(tmp_path))
    assert sorted((r.a, r.b) for r in found.collect()) == [("1", "é"), ("2", "ü"), ("3", "o")]
    put(tmp_path / "p" / "1.csv", "Titre é\n\na;b\n1;é\n".encode("latin-1"))
    put(tmp_path / "p" / "2.csv", "Titre é\n\na;b\n2;é\n\n3;x\n")
    found = delimited.read_delimited(spark, str(tmp_path / "p"), skip_rows=2)
    assert sorted((r.a, r.b) for r in found.collect()) == [("1", "é"), ("2", "é"), ("3", "x")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_fingerprints_take_files_of_any_size(spark, tmp_path):
    put(tmp_path / "a.txt", "x\ny\n")
    put(tmp_path / "b.txt", "y\nx\n")
    put(tmp_path / "c.txt", "x\ny\ny\n" * 100_000)
    hashes = {r.file_path[-5:]: r.file_hash for r in files.text_fingerprints(spark, str(tmp_path)).collect()}
    assert hashes["a.txt"] == hashes["b.txt"] != hashes["c.txt"] and len(hashes["c.txt"]) == 32


def test_csv_stream_refuses_a_foreign_header(spark, tmp_path):
    put(tmp_path / "in" / "1.csv", "c;a\n30;10\n")
    with pytest.raises(Exception, match="CSV header|STREAM_FAILED"):
        ingest.ingest_stream(spark, str(tmp_path / "in"), "a string, b string, c string", str(tmp_path / "out"), str(tmp_path / "check"))
    root = work_dir(spark, "lake")
    ingest.ingest_stream_by_header(spark, str(tmp_path / "in"), root, "bronze", "t", str(tmp_path / "check2"))
    put(tmp_path / "in" / "2.csv", "a;b\n11;21\n")
    for _ in range(2):
        ingest.ingest_stream_by_header(spark, str(tmp_path / "in"), root, "bronze", "t", str(tmp_path / "check2"))
    found = tables.read_table(spark, root, "bronze", "t")
    assert sorted((r.a, r.b, r.c) for r in found.collect()) == [("10", None, "30"), ("11", "21", None)]


def test_stored_tables(spark):
    root = work_dir(spark, "lake")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.write_table(df, root, "bronze", "t")
    with pytest.raises(TypeError):
        tables.write_table(df.withColumn("k", F.lit("x")), root, "bronze", "t")
    assert rows(tables.read_table(spark, root, "bronze", "t")) == [(1, "a")]
    assert tables.merge_table(spark.createDataFrame([(1, "b"), (2, "c")], df.schema), root, "bronze", "t", ["k"]) == {
        "updated": 1, "inserted": 1, "deleted": 0,
    }
    tables.write_table(df.limit(0), root, "silver", "dim_commune", "overwrite")
    assert tables.register_layers(spark, root) == ["bronze_t", "silver_dim_commune"]
    assert rows(spark.table("bronze_t")) == [(1, "b"), (2, "c")]
    assert [(r.layer, r.name) for r in tables.catalog(spark, root).collect()] == [("bronze", "t"), ("silver", "dim_commune")]
    counts = {r.name: r.row_count for r in pipeline.silver_catalog(spark, root).collect()}
    assert counts["dim_commune"] == 0 and counts["dim_gare"] is None and len(counts) == 8


def test_failed_layer_stops(spark):
    outcome = pipeline.build_layer(spark, work_dir(spark, "lake"), "silver")
    assert len(outcome) == 1 and outcome[0][:2] == ("dim_commune", "failed")


def test_api_refresh_skips_filled_tables(spark, tmp_path):
    root = work_dir(spark, "lake")
    json_pages.land_raw(spark.range(3), str(tmp_path), "t", "20240101_000000")
    landed = bronze.latest_landed(spark, str(tmp_path), "t")
    assert landed.endswith("t_20240101_000000.json")
    options = {"multi_line": False}
    assert bronze.refresh_api_table(spark, root, "t", landed, bronze.open_data, **options) == "success"
    assert bronze.refresh_api_table(spark, root, "t", landed, bronze.open_data, **options) == "skipped"
    assert bronze.refresh_api_table(spark, root, "t", landed, bronze.open_data, force=True, **options) == "success"
    assert bronze.latest_landed(spark, str(tmp_path), "nothing") is None


def test_stream_takes_files_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    schema = "`Code UIC` string, n int"
    put(folder / "g_20240101_010203.csv", "Code UIC;n\n1;5\n2;x\n")
    ingest.ingest_stream(spark, str(folder), schema, out, check, normalize=True, rescued=True)
    put(folder / "g_20240102_010203.csv", "Code UIC;n\n3;7\n")
    for _ in range(2):
        ingest.ingest_stream(spark, str(folder), schema, out, check, normalize=True, rescued=True)
    found = spark.read.parquet(out)
    assert found.columns == ["code_uic", "n", "_rescued_data", "ingestion_timestamp"]
    assert [(r.code_uic, r.n, r._rescued_data, r.ingestion_timestamp.day) for r in found.orderBy("code_uic").collect()] == [
        ("1", 5, None, 1), ("2", None, "2;x", 1), ("3", 7, None, 2),
    ]


def test_upsert_stream_keeps_the_newest(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for day, content in ((1, "k;ts;v\na;2;x\nb;1;y\n"), (2, "k;ts;v\na;1;late\nc;1;z\n"), (3, "k;ts;v\nb;5;new\n")):
        put(folder / f"{day}.csv", content)
        stream = ingest.read_csv_stream(spark, str(folder), "k string, ts int, v string")
        ingest.upsert_stream(stream, out, check, ["k"], ["ts"])
    assert rows(ingest.current_snapshot(spark, out)) == [("a", 2, "x"), ("b", 5, "new"), ("c", 1, "z")]


def test_notebook_merge_keeps_unlisted_target_columns(spark):
    bronze_lines = spark.createDataFrame(
        [("1", "L1", "Ligne à grande vitesse", "2", 5), ("1", "old", None, "x", 1)],
        "code_ligne string, lib_ligne string, catlig string, rg_troncon string, ingestion_timestamp int",
    )
    target = spark.createDataFrame([("1", "gone", "note"), ("9", "kept", "k")], "code_ligne string, lib_ligne string, note string")
    merged = {r.code_ligne: r for r in legacy.merge_lignes(target, bronze_lines).collect()}
    assert (merged["1"].lib_ligne, merged["1"].note, merged["1"].isTGV, merged["1"].rg_troncon) == ("L1", "note", "1", 2)
    assert merged["9"].lib_ligne == "kept"


def test_packed_deliveries_give_the_same_rows_as_plain_ones(spark, tmp_path):
    """Files of both kinds lie beside each other, and the bronze table that they fill is packed too."""
    plain = spark.range(50).select(F.col("id").cast("string").alias("a"), F.lit("é").alias("b"))
    options = {"header": True, "sep": ";", "encoding": "ISO-8859-1"}
    for name, packing in (("plain", "none"), ("packed", "gzip")):
        plain.write.options(**options, compression=packing).csv(str(tmp_path / "raw" / name))
    done = bronze.ingest_files(spark, str(tmp_path / "lake"), "accueillants", str(tmp_path / "raw")).first()
    assert (done.status, done.rows_processed) == ("success", 100)
    table = tables.read_table(spark, str(tmp_path / "lake"), "bronze", "accueillants")
    assert {(r.a, r.b): r["count"] for r in table.groupBy("a", "b").count().collect()} == {(str(k), "é"): 2 for k in range(50)}
    files = [p.name for p in (tmp_path / "lake" / "bronze" / "accueillants").rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)


def test_file_names_are_cut_without_a_pattern(spark, tmp_path, capsys):
    """The time comes from the name of the file, not of its folder, and no search along the path runs once a row."""
    folder = tmp_path / "old_20200101_000000"
    folder.mkdir()
    (folder / "rents_20240102_030405.csv").write_text("a;b\n1;2\n")
    rents = bronze.logement(spark, [str(folder)])
    assert [str(r.ingestion_timestamp) for r in rents.collect()] == ["2024-01-02 03:04:05"]
    rents.explain()
    assert "[^/]*$" not in capsys.readouterr().out


def test_layouts_do_not_sort_all_lines(spark, tmp_path, monkeypatch, capsys):
    """Headers come from an aggregate by hash."""
    (tmp_path / "a.csv").write_text("\na;b\n1;2\n")
    frame = type(spark.range(1))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: (df.explain(), collect(df))[1])
    groups, without = delimited.layouts(spark, [str(tmp_path)])
    plan = capsys.readouterr().out
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert ([*groups], without) == ([("a;b", "UTF-8")], 0)
