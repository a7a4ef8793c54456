"""The Jaccard join against a comparison of all pairs."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from medalith.llm import ngram_join, words
from medalith.llm.components import connected_components

LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def plain(rows):
    """Size and smallest reachable id per row, by comparing every pair of different sets."""
    sets = {}
    for doc, text in rows:
        if doc is not None and shingle_set(text):
            sets.setdefault(shingle_set(text), set()).add(doc)
    above = {}

    def root(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        if a != b:
            above[max(a, b)] = min(a, b)

    for ids in sets.values():
        for doc in ids:
            join(min(ids), doc)
    by_shingle = {}
    for one in sets:
        for shingle in one:
            by_shingle.setdefault(shingle, []).append(one)
    for one, ids in sets.items():
        for two in {other for shingle in one for other in by_shingle[shingle]}:
            if 100 * len(one & two) >= 75 * len(one | two):
                join(min(ids), min(sets[two]))
    return sorted([(doc, len(shingle_set(text)), None if doc is None else root(doc)) for doc, text in rows], key=str)


def run(spark, rows):
    found = ngram_join.similar_components(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted([tuple(r) for r in found.collect()], key=str)


def near_copies(seed, groups, copies, length, edits):
    pick = random.Random(seed)
    rows, doc = [], 0
    for group in range(groups):
        base = [f"g{group}w{i}" for i in range(length)]
        for _ in range(copies):
            own = list(base)
            for _ in range(pick.randint(0, edits)):
                own[pick.randrange(length)] = f"e{pick.random()}"
            rows.append((doc, " ".join(own)))
            doc += 1
    pick.shuffle(rows)
    return rows


EDGES = [
    (1, "one two three four five six seven"),
    (2, "ONE two\tthree four\nfive six seven"),
    (3, "one two three four five six eight"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r"),
    (7, "one two"),
    (8, "One  Two"),
    (9, "two one"),
    (None, "one two three four five six seven"),
    (10, "É é"),
    (11, "é é"),
    (12, "one two three four five six seven"),
    (13, "a b c d e " * 500),
    (13, "one two"),
    (14, "a b c d e " * 400),
    (15, "x" * 100_000 + " y z"),
]


def test_edges(spark):
    assert run(spark, EDGES) == plain(EDGES)


def test_similarity_around_the_threshold(spark):
    rows = near_copies(1, 12, 25, 60, 4)
    assert run(spark, rows) == plain(rows)


def test_large_group_of_near_copies(spark):
    rows = near_copies(2, 1, 1500, 40, 2)
    assert run(spark, rows) == plain(rows)


def test_large_group_with_repeated_ids(spark):
    rows = near_copies(4, 1, 2000, 24, 4)
    rows += [(doc, other) for (doc, _), (_, other) in zip(rows[:200], near_copies(6, 20, 10, 30, 3), strict=True)]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("documents, shingles", [(1024, 1 << 19), (7, 1 << 19), (1024, 200)])
def test_blocks_alone_find_every_component(spark, monkeypatch, documents, shingles):
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "OPEN_BLOCK_DOCUMENTS", documents)
    monkeypatch.setattr(ngram_join, "OPEN_BLOCK_SHINGLES", shingles)
    rows = near_copies(7, 4, 60, 30, 6) + [(1000 + d, t) for d, t in near_copies(8, 1, 150, 24, 4)] + EDGES
    assert run(spark, rows) == plain(rows)


def test_passages_that_many_documents_share(spark):
    pick = random.Random(3)
    shared = [" ".join(f"s{k}w{i}" for i in range(12)) for k in range(6)]
    rows = [
        (d, " ".join([pick.choice(shared), pick.choice(shared), " ".join(f"d{d % 90}w{i}" for i in range(pick.randint(0, 30)))]))
        for d in range(400)
    ]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_other_columns_do_not_matter(spark):
    schema = "doc_id long, text string, h string, n string, node string, component string, block string, a string"
    rows = [(1, "a b c d e f", *"uvwxyz"), (2, "a b c d e f", *"uvwxyz")]
    found = ngram_join.similar_components(spark, spark.createDataFrame(rows, schema))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 2, 1), (2, 2, 1)]


def test_divide_skip_search_finds_what_a_scan_finds():
    pick = np.random.default_rng(5)
    universe = np.unique(pick.integers(0, 2**63, 300).astype(np.uint64))
    sets = [(k, np.sort(pick.choice(universe, pick.integers(1, 120), replace=False))) for k in range(60)]
    sets += [(100 + k, np.unique(np.concatenate([s[: -3 or None], universe[:k]]))) for k, (_, s) in enumerate(sets[:10])]
    index = ngram_join.BlockIndex(sets, 75)
    for _, query in sets:
        expected = [d for d, s in sets if 100 * len(np.intersect1d(s, query)) >= 75 * len(np.union1d(s, query))]
        assert sorted(index.search(query)) == sorted(expected)


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c d e", " x\x0by\x0cz \r\n q ", "é É ß 日本 a b", "w " * 3000])
def test_shingles_are_those_of_the_words(text):
    rows = ["before it", text, None, "after"]
    found = list(words.shingle_sets(pa.array(rows)))
    assert [len(x) for x in found] == [len(shingle_set(t)) for t in rows]
    assert all(np.array_equal(x, next(words.shingle_sets(pa.array([t])))) for x, t in zip(found, rows, strict=True))


def test_least_overlap_is_the_threshold():
    for a, b, c in itertools.product(range(1, 30), range(1, 30), range(30)):
        if c <= min(a, b):
            assert (100 * c >= 75 * (a + b - c)) == (c >= ngram_join.least_overlap(a, b))


def test_connected_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (1, 1), (3, 2), (2, 3), (None, 4), (5, None), *((100 + i, 101 + i) for i in range(60))]
    found = connected_components(spark, spark.createDataFrame(links, "a long, b long"))
    expected = {1: 1, 2: 2, 3: 2, 6: 6, 7: 6, 8: 6, 9: 6, **{100 + i: 100 for i in range(61)}}
    assert {r.node: r.component for r in found.collect()} == expected
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_of_many_rows_are_hashed_together(monkeypatch):
    rows = [f"a{k} b c d e f" if k % 3 else f"short {k}" for k in range(2000)]
    expected = [np.unique(words.shingles(words.hashed_words(*words.text_bytes(pa.array([t])))[0])) for t in rows]
    calls, mix = [], words.mix
    monkeypatch.setattr(words, "mix", lambda x: calls.append(len(x)) or mix(x))
    assert all(np.array_equal(a, b) for a, b in zip(words.shingle_sets(pa.array(rows)), expected, strict=True))
    assert len(calls) < 100  # not some for each row


def test_row_longer_than_a_piece_between_short_ones(monkeypatch):
    rows = ["a b", "q" * 300 + " y z é", "w x y z v " * 50, "", None, "c d e f g h"]
    whole = [x.tolist() for x in words.shingle_sets(pa.array(rows))]
    monkeypatch.setattr(words, "SHINGLE_PIECE", 16)
    monkeypatch.setattr(words, "PIECE", 64)
    assert [x.tolist() for x in words.shingle_sets(pa.array(rows))] == whole
    assert [len(x) for x in whole] == [len(shingle_set(t)) for t in rows]


def test_list_members_are_sorted_by_hash_first(spark):
    entries = spark.createDataFrame([], "bucket int, h long, split long, doc_id long, n int, place int").repartition("bucket")
    plan = ngram_join._list_members(entries, 75)._jdf.queryExecution().toString()
    assert re.search(r"\bSort \[h#", plan)
