"""Line dedup against a plain loop."""

import random

import pytest

from medalith.llm import line_dedup

UPPER = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)


def plain(rows):
    """Kept text per row: lines of long keys stay only in the smallest id that holds the key."""

    def order(doc):
        return line_dedup.NO_ID if doc is None else doc

    def key(line):
        return line.strip(line_dedup.STRIPPED).translate(UPPER)

    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(order(doc), first.get(key(line), order(doc)))
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == order(doc)]
        result.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result, key=str)


def run(spark, rows, schema="doc_id long, text string"):
    found = line_dedup.dedup(spark.createDataFrame(rows, schema))
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()], key=str)


EDGES = [
    (3, "A shared line here\nown words of three\nA shared line here"),
    (1, "a SHARED line here  \n\nshort"),
    (2, "\t a shared line here\nshort\nshort"),
    (4, None),
    (5, ""),
    (6, "\n\n"),
    (None, "a shared line here\nonly without an id"),
    (None, "only without an id\nÉcole élémentaire"),
    (7, "école ÉLÉMENTAIRE\nÉcole élémentaire\nécole élémentaire"),
    (7, "écolE élémentaire\nown words of three"),
    (7, "écolE élémentaire\nown words of three"),
    (8, "x" * 200_000 + "\n" + "\n".join(f"line number {i} of many" for i in range(3000))),
    (9, "\n".join(f"line number {i} of many" for i in range(2999, -1, -1)) + "\nlast own line"),
    (10, "nine char\nnine char"),
    (11, "nine char"),
]


def test_edges(spark):
    assert run(spark, EDGES) == plain(EDGES)


def test_random_texts_with_a_hot_line(spark):
    pick = random.Random(4)
    lines = [f"common line {i}" for i in range(40)] + ["x", ""]
    rows = [(d, "\n".join(["the hot line"] + [pick.choice(lines) for _ in range(pick.randint(0, 6))])) for d in range(600)]
    pick.shuffle(rows)
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_other_columns_stay(spark):
    schema = "doc_id long, text string, doc long, body string, pos int, h1 int, lines string, dropped string, n_lines int, word int"
    rows = [(1, "a shared line here", 7, "b", 1, 2, "l", "d", 99, 5), (2, "a shared line here\nmore", 8, "c", 3, 4, "m", "e", 99, 6)]
    found = line_dedup.dedup(spark.createDataFrame(rows, schema)).orderBy("doc_id").collect()
    assert [(r.text, r.doc, r.body, r.pos, r.h1, r["lines"], r.dropped, r.n_lines, r.word) for r in found] == [
        ("a shared line here", 7, "b", 1, 2, "l", "d", 1, 5),
        ("more", 8, "c", 3, 4, "m", "e", 2, 6),
    ]


def test_bitmaps_hold_only_words_with_dropped_lines(spark):
    rows = [(1, "a shared line here"), (2, "\n" * 640 + "a shared line here")]
    bitmap = line_dedup.drop_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc, [tuple(x) for x in r.dropped]) for r in bitmap] == [(2, [(10, 1)])]


@pytest.mark.parametrize("min_chars", [1, 30])
def test_key_length_is_a_parameter(spark, min_chars):
    rows = [(1, "abc"), (2, "abc\nother")]
    found = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=min_chars)
    assert sorted(r.text for r in found.collect()) == (["abc", "other"] if min_chars == 1 else ["abc", "abc\nother"])
