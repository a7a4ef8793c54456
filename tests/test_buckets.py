"""Tables in key buckets: merges against a plain dictionary, what they rewrite, and streams of them."""

import os
import random

import pytest

from medalith.operators import evolve, upsert
from medalith.session import work_dir
from medalith.sources import buckets, files, tables
from medalith.streaming import ingest


def bucket_files(path):
    return {b: sorted(f for f in os.listdir(f"{path}/{b}") if f.endswith(".parquet")) for b in os.listdir(path) if b.startswith("__bucket=")}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, j string, v long, w string")


@pytest.mark.parametrize("nulls", [False, True])
def test_merges_equal_a_dictionary(spark, nulls):
    pick, path = random.Random(int(nulls)), work_dir(spark, "buckets")
    key = lambda: (pick.choice([*range(40), None]), pick.choice(["a", "b", None]))
    free = lambda k: not nulls and None in k

    def delivery(n, mark):
        keys = [key() for _ in range(n)]
        single = list({k: None for k in keys if not free(k)}) + [k for k in keys if free(k)]
        return [(*k, pick.randint(0, 99), f"{mark}{i}") for i, k in enumerate(single)]

    expected, loose = {}, []
    for turn in range(4):
        rows = delivery(60 if not turn else 12, f"t{turn}-")
        if turn:
            stats = buckets.merge(frame(spark, rows), path)
            known = [r for r in rows if not free(r[:2]) and r[:2] in expected]
            assert (stats["updated"], stats["inserted"]) == (len(known), len(rows) - len(known))
        else:
            buckets.create(frame(spark, rows), path, ["k", "j"], 16, null_keys_match=nulls)
        expected |= {r[:2]: r for r in rows if not free(r[:2])}
        loose += [r for r in rows if free(r[:2])]
        found = [tuple(r)[:4] for r in buckets.read(spark, path).collect()]
        assert sorted(found, key=str) == sorted([*expected.values(), *loose], key=str)


def test_a_small_merge_rewrites_its_buckets_only(spark):
    path = work_dir(spark, "buckets")
    buckets.create(spark.range(20_000).selectExpr("id as k", "id * 2 as v"), path, ["k"], 64)
    before = bucket_files(path)
    stats = buckets.merge(spark.createDataFrame([(k, -1) for k in (*range(8), 50_000, 50_001)], "k int, v long"), path)
    after = bucket_files(path)
    changed = [b for b in before if before[b] != after[b]]
    assert len(before) == 64 and len(changed) == stats["buckets"] <= 10
    assert stats == {"updated": 8, "inserted": 2, "deleted": 0, "buckets": len(changed)}
    table = buckets.read(spark, path)
    assert table.count() == 20_002 and table.where("v = -1").count() == 10


def test_columns_types_and_empty_sources(spark):
    root = work_dir(spark, "lake")
    path = tables.table_path(root, "silver", "t")
    buckets.create(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path, ["k"], 4)
    assert buckets.merge(spark.createDataFrame([], "k long, v string"), path)["buckets"] == 0
    stats = tables.merge_table(spark.createDataFrame([(2, "c", 9), (3, "d", 8)], "k long, v string, extra int"), root, "silver", "t", ["k"], update_cols=["extra"])
    assert stats == {"updated": 1, "inserted": 1, "deleted": 0}
    table = tables.read_table(spark, root, "silver", "t")
    assert table.columns == ["k", "v", "extra"]
    assert sorted(tuple(r) for r in table.collect()) == [(1, "a", None), (2, "b", 9), (3, "d", 8)]
    with pytest.raises(TypeError):
        buckets.merge(spark.createDataFrame([(1, 2.5)], "k long, v double"), path)
    with pytest.raises(Exception, match="two source rows"):
        buckets.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), path)
    assert sorted(tuple(r) for r in table.collect()) == [(1, "a", None), (2, "b", 9), (3, "d", 8)]


def test_stream_batches_rewrite_what_they_touch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run(name, rows, check="check"):
        if rows:
            (folder / name).write_text("k;ts;v\n" + "".join(f"{k};{ts};{v}\n" for k, ts, v in rows))
        stream = ingest.read_csv_stream(spark, str(folder), "k string, ts long, v string")
        ingest.upsert_stream(stream, out, str(tmp_path / check), ["k"], ["ts"])
        return bucket_files(out)

    first = run("1.csv", [(f"k{i}", 5, "old") for i in range(500)])
    second = run("2.csv", [("k1", 6, "new"), ("k2", 4, "late"), ("x", 1, "x")])
    changed = [b for b in second if first.get(b) != second[b]]
    assert len(first) == 64 and 1 <= len(changed) <= 3
    rows = {r.k: r.v for r in ingest.current_snapshot(spark, out).collect()}
    assert len(rows) == 501 and (rows["k1"], rows["k2"], rows["x"]) == ("new", "old", "x")
    assert run("", []) == second
    # the same files through a new checkpoint: every batch is merged again and changes no row
    run("", [], "other")
    assert {r.k: r.v for r in ingest.current_snapshot(spark, out).collect()} == rows


def test_counts_with_null_keys(spark):
    target, source = (spark.createDataFrame(rows, "k long") for rows in ([(None,), (1,)], [(None,), (2,)]))
    assert upsert.upsert_stats(target, source, ["k"], True).first().asDict() == {"updated": 1, "inserted": 1, "deleted": 0}
    assert upsert.upsert_stats(target, source, ["k"]).first().asDict() == {"updated": 0, "inserted": 2, "deleted": 0}


def test_rows_that_do_not_fit_are_rescued(spark):
    rows = spark.createDataFrame([("1", "2.5", "x", None), ("y", None, None, "z"), (None, "oops", None, None)], "a string, b string, c string, `d.e` string")
    found = evolve.fit_schema(rows, "a int, b double, f date")
    assert found.columns == ["a", "b", "f", "_rescued_data"]
    assert [tuple(r) for r in found.collect()] == [
        (1, 2.5, None, '{"c":"x"}'), (None, None, None, '{"a":"y","d.e":"z"}'), (None, None, None, '{"b":"oops"}')
    ]
    assert evolve.fit_schema(rows.select("a").limit(0), "a int").collect() == []


def test_failures_of_the_cluster_are_no_verdict_on_files(spark):
    def lost(paths):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        files.usable_files(lost, ["a", "b"])
