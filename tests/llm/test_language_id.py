"""Language identification: held-out accuracy, evidence, and what is rejected."""

import collections
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from medalith.llm import language_id

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language_id.fit(documents.where("doc_id % 2 = 0"))


def rows(spark, data):
    made = spark.createDataFrame(data, "id long, text string, declared string, suffix string, domain string, host string")
    return made.select(F.xxhash64(*made.columns).alias("row_key"), "*")


def test_held_out_accuracy_from_text_alone(spark, documents, model):
    held_out = language_id.document_rows(documents.where("doc_id % 2 = 1"))
    blind = held_out.withColumn("declared", F.lit(None).cast("string")).withColumn("host", F.lit(None).cast("string"))
    found = language_id.identify(spark, blind, model).join(documents, F.col("id") == F.col("doc_id"))
    long = found.where("n_trigrams >= 100")
    assert long.where("language = lang").count() >= 0.98 * long.count()
    assert found.where("kept").count() >= 0.99 * found.count()


def test_pages(spark, model):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = language_id.identify(spark, language_id.page_rows(pages), model)
    declared = pages.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("lang"))
    joined = found.join(declared, F.col("id") == F.col("page_id"))
    assert joined.where("language = lang").count() >= 0.98 * pages.count()


def test_evidence_decides_where_the_text_is_silent(spark, model):
    french = "De la les que dans et pour le une des ouaireau mentaire éreaux quevi tionique"
    german = "Der die und das nicht eine auf mit enschung lichkeit erverheit einver"
    data = [(i, french, "fr", "fr", "a.org", "www.a.org") for i in range(60)]
    data += [(100 + i, german, "de", "de", "b.org", "www.b.org") for i in range(60)]
    data += [(200, "zq", "fr", "fr", "a.org", "www.a.org"), (201, "zq", "de", "de", "b.org", "www.b.org"), (202, "zq", None, None, "b.org", "new.b.org")]
    found = {r.id: r for r in language_id.identify(spark, rows(spark, data), model).collect()}
    assert (found[200].language, found[201].language, found[202].language) == ("fr", "de", "de")
    assert found[0].language == "fr" and found[100].language == "de"


def test_rejected_rows(spark, model):
    data = [
        (1, None, "en", None, None, "h"), (2, "", "en", None, None, "h"), (3, "123 --- 456 !!!", "en", None, None, "h"),
        (4, "Все люди рождаются свободными и равными в своём достоинстве и правах", None, None, None, None),
        (5, "The and that with for the ing tion of thereandthe", None, None, None, None),
        (None, "The and that with for the ing tion of thereandthe", None, None, None, None),
        (5, "The and that with for the ing tion of thereandthe", None, None, None, None),
    ]
    found = language_id.identify(spark, rows(spark, data), model).collect()
    assert sorted((r.id or 0, r.kept) for r in found) == [(0, True), (1, False), (2, False), (3, False), (4, False), (5, True), (5, True)]


def test_without_labels_or_rows(spark, model):
    none = language_id.fit(spark.createDataFrame([("a text", None), (None, "en")], "text string, lang string"))
    assert none is None
    assert [r.kept for r in language_id.identify(spark, rows(spark, [(1, "any", None, None, None, None)]), None).collect()] == [True]
    assert language_id.identify(spark, rows(spark, []), model).count() == 0


def test_page_evidence(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://www.a.Example.de/FR/x", "<HTML class=x lang='fr-FR'><script>var de=1</script><p>Bon jour</p><!-- no -->"),
            (2, "https://b.es?x=1", "<p>hola"),
            (3, None, None),
        ],
        "page_id long, url string, html string",
    )
    found = {r.id: (r.declared, r.suffix, r.domain, r.host, " ".join(r.text.split())) for r in language_id.page_rows(pages).collect()}
    assert found[1] == ("fr", "fr", "example.de", "www.a.example.de", "Bon jour")
    assert found[2] == (None, "es", "b.es", "b.es", "hola")
    assert found[3] == (None, None, None, None, "")


def test_a_language_of_copies_keeps_its_texts(spark):
    words = {"la": "lorem ipsum dolor sit amet consectetur", "qu": "runa simi kawsay wasi allpa mayu"}
    made = [(f"{words['la']} {'abcdefgh'[k]}{'xyz'[k % 3]}", "la") for k in range(8)] * 30 + [(f"{words['qu']} {k}", "qu") for k in range(9)]
    model = language_id.fit(spark.createDataFrame(made, "text string, lang string"), per_language=1)
    data = [(1, "lorem ipsum dolor sit amet", "la", None, None, "h"), (2, "runa simi kawsay wasi", "qu", None, None, "h")]
    found = language_id.identify(spark, rows(spark, data), model).collect()
    assert {r.id: (r.text_language or r.language, r.kept) for r in found} == {1: ("la", True), 2: ("qu", True)}


def test_every_label_is_a_class(spark):
    pick = random.Random(4)
    made = []
    for k in range(230):
        words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(20)]
        made += [(1000 * k + i, " ".join(pick.choices(words, k=40)), f"q{k:03}", "src") for i in range(1 + k % 3)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    found = language_id.identify(spark, language_id.document_rows(docs), language_id.fit(docs)).join(docs, F.col("id") == F.col("doc_id"))
    assert found.where("kept and language = lang").count() == found.count() == len(made)


def test_regions_of_a_language_share_its_posterior(spark):
    made = [(f"the same words of one language in every region {'abcdefgh'[k % 8]}", f"en-{('us', 'gb', 'au', 'nz')[k % 4]}") for k in range(8)]
    model = language_id.fit(spark.createDataFrame(made, "text string, lang string"))
    found = language_id.identify(spark, rows(spark, [(1, "the words of every language", "en", None, None, None)]), model).first()
    assert found.kept and found.posterior < 0.5


def test_declared_language_without_a_model_is_not_rejected(spark, model):
    russian = "Все люди рождаются свободными и равными в своём достоинстве и правах"
    data = [(1, russian, "ru", None, None, None), (2, russian, "en", None, None, None), (3, "123", "ru", None, None, None), (4, russian, "und", None, None, None)]
    assert sorted((r.id, r.kept) for r in language_id.identify(spark, rows(spark, data), model).collect()) == [(1, True), (2, False), (3, False), (4, False)]


def _plain_buckets(text):
    letters = [32, *[b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()], 32]
    codes = [(letters[i - 1] << 16) | (letters[i] << 8) | letters[i + 1] for i in range(1, len(letters) - 1) if letters[i] != 32]
    return [((code * 2654435761) % (1 << 32)) >> 16 for code in codes]


def _plain_fusion(data, model):
    """Language, posterior and the text's language of each row, by loops over rows and languages."""
    m, size, weight = language_id.PRIOR_ROWS, len(model.languages), language_id.WEIGHT
    tables = [model.row(k).astype(float).tolist() for k in range(size)]
    scores, votes = [], []
    for _, text, *_ in data:
        buckets = _plain_buckets(text)
        sums = [*[math.fsum(table[b] for b in buckets) for table in tables], -len(buckets) * math.log(language_id.BUCKETS)]
        scores.append([x * weight / (len(buckets) + weight) for x in sums])
        best = scores[-1].index(max(scores[-1]))
        votes.append(best if best < size and len(buckets) >= language_id.VOTE_TRIGRAMS else None)
    count = [votes.count(k) for k in range(size)]
    share = [(c + 1) / (sum(count) + size) for c in count]
    cast = [collections.defaultdict(lambda: [0] * size) for _ in range(4)]
    for row, vote in zip(data, votes, strict=True):
        for feature, value in enumerate(row[2:]):
            if value is not None and vote is not None:
                cast[feature][value][vote] += 1
    found = []
    for row, own, vote in zip(data, scores, votes, strict=True):
        declared, suffix, domain, host = (
            [c - (k == vote) for k, c in enumerate(cast[f][v])] if v in cast[f] else None for f, v in enumerate(row[2:])
        )
        by_domain = share if domain is None else [(c + m * p) / (sum(domain) + m) for c, p in zip(domain, share, strict=True)]
        by_host = by_domain if host is None else [(c + m * p) / (sum(host) + m) for c, p in zip(host, by_domain, strict=True)]
        prior = [*[math.log(p * (1 - language_id.UNKNOWN_PRIOR)) for p in by_host], math.log(language_id.UNKNOWN_PRIOR)]
        logs = [a + b for a, b in zip(own, prior, strict=True)]
        for others in (declared, suffix):
            if others is not None:
                rate = (sum(others) + 1) / (sum(count) + size)
                for k in range(size):
                    logs[k] += math.log((others[k] + m * rate) / (count[k] + m))
                logs[size] += math.log(rate)
        top = max(logs)
        names = [*model.languages, language_id.UNKNOWN]
        found.append((names[logs.index(top)], 1 / math.fsum(math.exp(x - top) for x in logs), None if vote is None else names[vote]))
    return found


def test_fusion_against_plain_sums(spark, documents, model):
    pick = random.Random(7)
    texts = [r.text for r in documents.where("doc_id % 40 = 1").select("text").collect()]
    data = []
    for i in range(300):
        text = pick.choice([None, "", "zq", "12 34"]) if i % 10 == 0 else pick.choice(texts)[: pick.choice([12, 60, 400])]
        domain = pick.choice([None, "a.org", "b.org", "c.org"])
        host = domain and f"{pick.choice(['www', 'm', 'x'])}.{domain}"
        data.append((i, text, pick.choice([None, "en", "fr", "de", "xx"]), pick.choice([None, "fr", "de", "org"]), domain, host))
    data += [(300, data[1][1], "only", "once", "d.org", "www.d.org")]
    found = {r.id: r for r in language_id.identify(spark, rows(spark, data), model).collect()}
    for row, (language, posterior, text_language) in zip(data, _plain_fusion(data, model), strict=True):
        r = found[row[0]]
        assert (r.language, r.text_language) == (language, text_language)
        assert r.posterior == pytest.approx(posterior, rel=1e-6)
        assert r.n_trigrams == len(_plain_buckets(row[1]))
