"""Greedy string tiling against a plain version, and leaks into documents."""

import random

import numpy as np
import pytest

from medalith.llm import decontamination as d


def plain_tiles(item, text, min_tile):
    """Marks the longest common open run, as long as there is one."""
    used_p, used_t, tiles = set(), set(), []
    while True:
        best = (min_tile - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and p + n not in used_p and t + n not in used_t:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        if best[0] < min_tile:
            return tiles
        n, p, t = best
        used_p.update(range(p, p + n))
        used_t.update(range(t, t + n))
        tiles.append((p, t, n))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_cover_what_a_plain_search_covers(seed):
    pick = random.Random(seed)
    letters = pick.choice([3, 8, 40])
    item = [pick.randrange(letters) for _ in range(pick.randint(1, 60))]
    text = [pick.randrange(letters) for _ in range(pick.randint(0, 40))]
    for _ in range(pick.randint(0, 3)):
        a = pick.randrange(len(item))
        text += item[a : a + pick.randint(1, 50)]
    found = d.greedy_tiles(np.array(item, dtype=np.uint64), np.array(text, dtype=np.uint64), 4)
    expected = plain_tiles(item, text, 4)
    assert all(item[p : p + n] == text[t : t + n] for p, t, n in found)
    for place in (0, 1):
        covered = [x for tile in found for x in range(tile[place], tile[place] + tile[2])]
        assert len(covered) == len(set(covered))
    # ties between equally long runs may fall differently, so the cover may differ by a little
    assert sorted((n for _, _, n in found), reverse=True)[:1] == sorted((n for _, _, n in expected), reverse=True)[:1]
    assert abs(sum(n for *_, n in found) - sum(n for *_, n in expected)) <= max(8, len(item) // 4)


ITEM = " ".join(f"word{i}" for i in range(40))
ITEMS = [(1, ITEM), (2, "too short item"), (3, None), (4, ""), (5, "Ünïcode fragen sind ANDERE Fragen als these ones here"), (6, ITEM), (None, "a null id item with enough words")]


def leaks(spark, rows, items=ITEMS, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = d.with_leaks(spark, docs, spark.createDataFrame(items, "item_id long, text string"), **how).collect()
    return [(r.doc_id, [h.item_id for h in r.leaks]) for r in found]


def test_leaks(spark):
    words = ITEM.split()
    reordered = " ".join(words[20:] + ["between"] + words[:20])
    edited = " ".join("x" if i % 12 == 6 else w for i, w in enumerate(words))
    rows = [
        (1, f"before {ITEM.upper()}, after"),
        (2, reordered),
        (3, edited),
        (4, " ".join(words[:12])),
        (5, " ".join(f"{a} and" for a in words)),
        (6, None),
        (7, ""),
        (None, "see: ünïcode Fragen; sind andere fragen als these ones here!"),
        (8, "too short item"),
        (9, "a null id item with enough words"),
        (10, "filler " * 30_000 + ITEM),
        (1, "repeated id and nothing else in this text"),
    ]
    both = [1, 6]
    assert leaks(spark, rows) == [
        (1, both), (2, both), (3, both), (4, []), (5, []), (6, []), (7, []), (None, [5]), (8, [2]), (9, [None]), (10, both), (1, [])
    ]


def test_items_of_few_words(spark):
    items = [(1, "four short words here"), (2, "Solo"), (3, "..."), (4, "今日は、良い天気です"), (2, "two words")]
    rows = [
        (1, "before; Four short, words here"),
        (2, "four short words are not here"),
        (3, "solo " * 5000),
        (4, "two words"),
        (5, "words two"),
        (6, "solos"),
        (7, "見て。今日は、良い天気です。"),
        (8, "今日は寒い"),
        (9, "words"),
        (10, "solo and two words: four short words here"),
    ]
    expected = [(1, [1]), (2, []), (3, [2]), (4, [2]), (5, []), (6, []), (7, []), (8, []), (9, []), (10, [1, 2, 2])]
    assert leaks(spark, rows, items) == expected


def test_coverage_is_a_threshold(spark):
    rows = [(1, " ".join(ITEM.split()[:24]))]
    assert leaks(spark, rows, coverage=0.6) == [(1, [1, 6])]
    assert leaks(spark, rows, coverage=0.61) == [(1, [])]


def test_empty_tables(spark):
    assert leaks(spark, []) == []
    assert leaks(spark, [(1, ITEM)], items=[]) == [(1, [])]


def test_items_in_blocks(spark):
    items = spark.createDataFrame([(i, f"item {i} " + " ".join(f"i{i}w{k}" for k in range(10))) for i in range(50)], "item_id long, text string")
    blocks = list(d.item_blocks(items, "item_id", "text", chars=1000))
    assert len(blocks) > 3
    assert sorted(i for b in blocks for i in b.ids) == list(range(50))
