"""Collocations against plain counting, and the scans' bookkeeping."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from medalith.llm import collocations

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(rows, max_words=3, min_count=10, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts.update((lang, words[i : i + k]) for i in range(len(words) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    ranked = {}
    for (lang, words), a in found.items():
        inside = [f for (other, longer), f in found.items() if other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer)))]
        if any(100 * f >= 50 * a for f in inside):
            continue
        score, _, l, r = min((10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words)))
        ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, phrases in ranked.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:top], 1)
    )


def found(spark, rows, **parameters):
    docs = spark.createDataFrame([(k % 3, t, lang, "x") for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string")
    parameters = {"slots": 1 << 15} | parameters
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(spark, docs, **parameters).collect())


def texts(seed, documents, words="a b c d e f A é 日 \x1c x's".split(" ")):
    pick = random.Random(seed)
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?", " \x0b", "; "]
    return [("".join(pick.choice(words) + pick.choice(marks) for _ in range(pick.randint(0, 40))), pick.choice(["en", "de", None, "und", ""])) for _ in range(documents)]


@pytest.mark.parametrize(("documents", "parameters"), [(120, {}), (60, {"min_count": 3, "max_words": 4, "shards": 3}), (80, {"min_count": 2, "top": 7, "shards": 1})])
def test_random_texts(spark, documents, parameters):
    rows = texts(documents, documents)
    assert found(spark, rows, **parameters) == plain(rows, **{k: v for k, v in parameters.items() if k != "shards"})


def test_edges(spark):
    rows = [(None, "en"), ("", "en"), (" \t ", "fr"), ("...", None), ("a", "en"), ("One two, three", None)] + [("Hot dog hot dog hot dog", "en")] * 40
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == [] and found(spark, [(None, None)]) == []


def test_full_table_of_slots_changes_nothing(spark):
    rows = texts(4, 60, [f"w{k}" for k in range(40)])
    assert found(spark, rows, slots=32, min_count=3) == plain(rows, min_count=3)


def test_phrase_that_gets_frequent_late(spark):
    rows = [("q r s", "en")] * 4 + [("z " * 30, "en")] * 8 + [("q r s", "en")] * 9
    assert found(spark, rows, shards=7) == plain(rows)


def test_long_rows_are_cut_at_marks():
    data = np.frombuffer(b"aa bb. cc dd. ee ff gg hh ii jj kk ll|mm. nn", dtype=np.uint8)
    offsets, rows = collocations.shorter(data, np.array([0, 38, 44]), 8)
    assert rows.tolist() == [0, 0, 1] or rows.tolist() == [0, 0, 0, 1]
    assert offsets[0] == 0 and offsets[-1] == 44 and all(data[o] == ord(".") for o in offsets[1:-1] if o != 38)
    unmarked = np.frombuffer(b"a" * 100, dtype=np.uint8)
    assert collocations.shorter(unmarked, np.array([0, 100]), 8)[0].tolist() == [0, 100]


def test_exact_scores_of_large_counts(spark):
    a, l, r = 9_000_000_000_007, 9_000_000_000_011, 9_999_999_999_999
    counts = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", l), ("en", 1, "y", r)], "lang string, words int, phrase string, n long")
    assert collocations.scored(counts).first().score == 10**6 * a * a // (l * r)


def test_different_keys_as_numpy_finds_them():
    keys = np.random.default_rng(0).integers(0, 50, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for some in (keys, keys[:1], keys[:0]):
        met, place, n = collocations.different(some)
        expected = np.unique(some, return_counts=True)
        assert (met == expected[0]).all() and (n == expected[1]).all() and (some[place] == met).all()
