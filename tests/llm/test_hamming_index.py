"""Nearest neighbours: recall, exact results on small tables, and odd vectors."""

import numpy as np
import pytest

from medalith.llm import hamming_index as h


def run(spark, rows, k=10, asked="vec_id % 100 = 0"):
    vectors = h.valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    codes = h.fit(vectors, k=k)
    if codes is None:
        return {}
    index = h.build_index(spark, vectors, codes)
    found = {}
    for r in h.search(spark, index, index.where(asked).select("vec_id", "vector"), codes, k).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return found


def plain(rows, k=10):
    fine = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows if i is not None and v is not None and None not in v]
    fine = [(i, v) for i, v in fine if np.isfinite(v).all() and v.any()]
    sizes = [len(v) for _, v in fine]
    fine = [(i, v) for i, v in fine if len(v) == max(sorted(set(sizes)), key=sizes.count)]
    found = {}
    for q, a in fine:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in fine if i != q)[:k]
            found[q] = [(rank + 1, i, d) for rank, (d, i) in enumerate(near)]
    return {q: n for q, n in found.items() if n}


def test_recall(spark):
    pick = np.random.default_rng(1)
    centers = pick.normal(size=(8, 64))
    rows = [(i, (centers[i % 8] + pick.normal(size=64)).tolist()) for i in range(3000)]
    found, expected = run(spark, rows), plain(rows)
    assert set(found) == set(expected)
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    assert all([rank for rank, _, _ in n] == list(range(1, 11)) for n in found.values())


def test_small_table_with_odd_vectors_is_exact(spark):
    rows = [
        (0, [1.0, 0.0]), (100, [0.0, 1.0]), (200, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (9, []), (None, [1.0, 0.0]), (300, [float("-inf"), 0.0]), (10, [-1.0, 0.5]),
    ]
    assert run(spark, rows) == plain(rows)


def test_copies_of_one_vector(spark):
    pick = np.random.default_rng(2)
    rows = [(i, [1.0] * 16) for i in range(1200)] + [(2000 + i, pick.normal(size=16).tolist()) for i in range(300)]
    found, expected = run(spark, rows), plain(rows)
    assert {q: n for q, n in found.items() if q < 1200} == {q: n for q, n in expected.items() if q < 1200}
    assert [i for _, i, _ in found[0]] == list(range(1, 11)) and [i for _, i, _ in found[100]] == list(range(10))


def test_repeated_ids_are_ones_own(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.5])]
    assert [i for _, i, _ in run(spark, rows)[0]] == [1]


def test_empty_and_single(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0])]) == {}
    assert run(spark, [(0, None)]) == {}


@pytest.mark.parametrize("radius", [0, 3, 8, 15, 40])
def test_probing_finds_every_code_within_the_radius(radius):
    pick = np.random.default_rng(radius)
    base = pick.integers(0, 2**40, 50, dtype=np.uint64)
    codes = np.concatenate([base ^ (np.uint64(1) << pick.integers(0, 40, 50, dtype=np.uint64)) for _ in range(20)])
    tables = h.BlockTables(codes, 40)
    for code in base[:10]:
        assert tables.within(code, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ code) <= radius).tolist()


def test_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(h, "QUERY_BLOCK", 2)
    pick = np.random.default_rng(3)
    rows = [(i * 50, pick.normal(size=4).tolist()) for i in range(14)]
    found, expected = run(spark, rows), plain(rows)
    assert {q: [(r, i) for r, i, _ in n] for q, n in found.items()} == {q: [(r, i) for r, i, _ in n] for q, n in expected.items()}


def test_very_large_and_very_small_vectors(spark):
    pick = np.random.default_rng(7)
    rows = [(i, pick.normal(size=8).tolist()) for i in range(300)] + [(1000, [1e200] * 8), (1100, [1.7e308, -1.7e308] * 4), (1200, [1e-200] * 8), (1201, [3e-200] * 8)]
    for chosen in (rows, rows[300:], [(i, [1e200 * x for x in v]) for i, v in rows[:300]]):
        vectors = h.valid_vectors(spark.createDataFrame(chosen, "vec_id long, embedding array<double>"))
        codes = h.fit(vectors)
        index = h.build_index(spark, vectors, codes)
        asked = index.where("vec_id % 100 = 0").select("vec_id", "vector")
        found = h.search(spark, index, asked, codes).collect()
        ids = {i for i, _ in chosen}
        assert {r.query_id for r in found} == {i for i in ids if i % 100 == 0}
        values = dict(chosen)
        for r in found:
            apart = np.array(values[r.query_id]) / 4 - np.array(values[r.vec_id]) / 4
            top = np.abs(apart).max()
            exact = top * np.sqrt(((apart / top) ** 2).sum()) if top else 0.0
            with np.errstate(over="ignore"):
                assert r.score == pytest.approx(exact * 4, rel=1e-9) or (np.isinf(r.score) and exact > 1e307)
        if len(chosen) == 4:
            assert next(r.vec_id for r in found if r.query_id == 1200 and r["rank"] == 1) == 1201


def test_ordinary_distances_are_the_plain_ones():
    apart = np.random.default_rng(2).normal(size=(50, 16))
    assert (h.distances(apart) == np.sqrt((apart**2).sum(axis=1))).all()
    assert h.distances(np.array([[3e200, 4e200], [3e-200, 4e-200], [0.0, 0.0]])) == pytest.approx([5e200, 5e-200, 0.0], rel=1e-12)
