"""The classifier against plain loops and numeric gradients, held-out rows, and odd inputs."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medalith.llm import toxicity
from medalith.llm.words import text_bytes


def numbers_of(texts):
    return toxicity.word_numbers(*text_bytes(pa.array(texts, pa.string())))


def plain_output(model, text):
    """Every filter at every window, one word after the other."""
    words = [numbers_of([w])[0][0] for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text)]
    vectors = [model.rows[a] + model.rows[b] for a, b in words] + [np.zeros(toxicity.DIMENSIONS)] * 2
    features = []
    for width, weights, bias in zip(toxicity.WIDTHS, model.filters, model.biases, strict=True):
        for f in range(toxicity.FILTERS):
            at = [sum(vectors[i + k] @ weights[k, :, f] for k in range(width)) + bias[f] for i in range(len(words))]
            features.append(max([0.0, *at]))
    return float(np.dot(features, model.out) + model.bias)


@pytest.fixture(scope="module")
def random_model():
    model, random = toxicity.Model.start(3), np.random.default_rng(3)
    model.rows[:-1] = random.normal(0, 1, model.rows[:-1].shape)
    model.biases = [random.normal(0, 0.1, toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    model.bias = 0.25
    return model


def test_outputs_equal_plain_loops(random_model):
    texts = ["", "one", "Two words", "a b c d e", "é日本 x-y, z", " \n", "same same same", "the end " * 20, ""]
    found = random_model.outputs(*numbers_of(texts))
    assert np.allclose(found, [plain_output(random_model, t) for t in texts], atol=1e-4)
    alone = [random_model.outputs(*numbers_of([t]))[0] for t in texts]
    assert np.allclose(found, alone, atol=1e-4)


def test_words_share_the_row_of_their_beginning():
    (a, b, c), _ = numbers_of(["insulting INSULT inland"])
    assert a[1] == b[1] and a[0] != b[0] and c[1] != a[1] and numbers_of(["Insulting"])[0][0].tolist() == a.tolist()


def test_gradients(monkeypatch):
    """A small step changes the loss as numeric differences of each parameter say."""
    monkeypatch.setattr(toxicity, "DROPPED", 0.0)
    texts, labels = ["alpha beta gamma", "delta", "beta beta epsilon zeta"], np.array([1, 0, 1], dtype=np.float32)
    numbers, begin = numbers_of(texts)
    each = [numbers[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]

    def start():
        model, random = toxicity.Model.start(5), np.random.default_rng(5)
        model.rows = random.normal(0, 1, model.rows.shape)
        model.rows[-1] = 0
        model.filters = [f.astype(np.float64) for f in model.filters]
        model.biases, model.out = [b.astype(np.float64) for b in model.biases], model.out.astype(np.float64)
        return model

    def loss(model):
        p = toxicity._sigmoid(model.outputs(numbers, begin))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    seen = {}

    class Record:
        def step(self, name, values, gradient, at=slice(None)):
            seen[name] = (gradient.copy(), at)

    toxicity._batch(start(), Record(), each, labels, np.random.default_rng(0))
    for name, pick in {"filters1": lambda m: m.filters[1], "biases2": lambda m: m.biases[2], "out": lambda m: m.out, "rows": lambda m: m.rows}.items():
        gradient, at = seen[name]
        index = tuple(s // 2 for s in gradient.shape)
        place = (at[index[0]], *index[1:]) if name == "rows" else index
        sides = []
        for move in (1e-3, -1e-3):
            model = start()
            pick(model)[place] += move
            sides.append(loss(model))
        assert np.isclose(gradient[index], (sides[0] - sides[1]) / 2e-3, rtol=2e-2, atol=1e-5), name


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model, share = toxicity.fit(docs, labels)
    found = toxicity.score(spark, docs, model, share).withColumnRenamed("toxic", "flagged").join(labels, "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    caught = counts[1, 1] / (counts[1, 1] + counts.get((1, 0), 0))
    wrong = counts.get((0, 1), 0) / (counts[0, 0] + counts.get((0, 1), 0))
    assert caught >= 0.6 and wrong <= 0.01
    assert set(model.thresholds) == {"de", "en", "es", "fr"}


def test_held_out_is_the_crc(spark):
    rows = spark.range(-5, 200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def tables(spark, documents, labels):
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string, score string, label string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, lang string")


def test_labels_of_held_out_rows_and_columns_do_not_matter(spark):
    texts = ["you idiot fool", "lovely calm day"]
    documents = [(k, f"{texts[k % 2]} w{k}", None, "9", None) for k in range(120)]
    docs, labels = tables(spark, documents, [(k, 1 - k % 2, "x") for k in range(120)])
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (
        sorted((r.doc_id, r.score) for r in toxicity.score(spark, d, *toxicity.fit(d, x)).collect())
        for d, x in ((docs, labels), (docs.withColumn("lang", F.lit("en")).withColumn("label", F.col("doc_id")), wrong))
    )
    assert first == second
    held = [(k, s) for k, s in first if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all((s > 0.5) == (k % 2 == 0) for k, s in held)


def test_odd_rows(spark):
    documents = [(1, None, None, "a", "b"), (2, "", "en", "a", "b"), (None, "you fool", "en", None, None), (3, "word " * 9000, "", None, None), (3, "other", "", None, None), (3, "other", "", None, None)]
    docs, labels = tables(spark, documents, [(1, 1, "a"), (1, 0, "a"), (2, 0, None), (None, 1, None), (3, None, None), (9, 1, "x"), (9, 1, "x")])
    for chosen in (labels, labels.limit(0)):
        rows = toxicity.score(spark, docs, *toxicity.fit(docs, chosen)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(spark, docs.limit(0), *toxicity.fit(docs.limit(0), labels)).collect() == []


def test_repeated_id_does_not_fill_the_sample(spark):
    documents = [(3, f"copy {k}", "en", None, None) for k in range(400)] + [(k, f"t{k} bad" if k % 2 else f"t{k} good", "en", None, None) for k in range(100, 160)]
    docs, labels = tables(spark, documents, [(3, 1, None)] + [(k, k % 2, None) for k in range(100, 160)])
    model, share = toxicity.fit(docs, labels, sample=30)
    assert model is not None and 0 < share < 1


def test_every_labelled_text_counts(spark):
    """Long texts and texts beyond one shard are learned: the marked words stand in them only."""
    learned = [k for k in range(400) if zlib.crc32(str(k).encode()) % 3 != 1]
    documents = [(k, "calm day " * 2500 + ("vile " if k % 2 else "kind ") * 3, "en", None, None) for k in learned[:40]]
    documents += [(k, "nasty talk" if k % 2 else "plain talk", "en", None, None) for k in learned[40:]]
    docs, labels = tables(spark, documents, [(k, k % 2, None) for k in learned])
    model, share = toxicity.fit(docs, labels, sample=60)
    probes = spark.createDataFrame([(1, "calm day vile vile vile", "en"), (2, "calm day kind kind kind", "en"), (3, "nasty talk", "en"), (4, "plain talk", "en")], "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in toxicity.score(spark, probes, model, share).collect()}
    assert scores[1] > 0.5 > scores[2] and scores[3] > 0.5 > scores[4]


def test_stored_words_are_two_numbers_of_16_bits():
    numbers = np.array([[0, toxicity.BUCKETS], [toxicity.BUCKETS - 1, 2 * toxicity.BUCKETS - 1]], dtype=np.int32)
    words = toxicity.to_bytes(numbers)
    assert len(words) == 8 and (toxicity.from_bytes(words) == numbers).all()
    assert toxicity.from_bytes(b"").shape == (0, 2)


def test_no_shuffle_file_outlives_the_query_that_made_it(spark, monkeypatch):
    """The rounds of the training shuffle the same texts again and again."""
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name, None)
    inner = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *given: (seen.append(spark.conf.get(name, None)), inner(*given))[1])
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 2).alias("text"), F.lit("en").alias("lang"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    model, _ = toxicity.fit(docs, labels)
    assert model is not None and seen == ["true"]
    assert spark.conf.get(name, None) == before


def test_slots_hold_all_known_ids_and_few_others(spark):
    """Texts without a label stay out of the shuffle."""
    ids = spark.range(1000).select((F.col("id") * 7919 - 3_000_000).alias("doc_id"))
    sent = spark.sparkContext.broadcast(toxicity._slots(ids))
    others = spark.range(1000).select((F.col("id") + 10**12).alias("doc_id"))
    rows = ids.union(others).select("doc_id", F.lit("a").alias("text"), F.lit("en").alias("lang"), toxicity._slot(F.col("doc_id")).alias("slot"))
    found = {r.doc_id for r in rows.mapInArrow(toxicity._in_slots(sent), "doc_id long, text string, lang string").collect()}
    assert {r.doc_id for r in ids.collect()} <= found and len(found) < 1010


def dealt_texts(spark, count):
    """Texts as the training takes them; those with odd ids hold a marked word."""
    rows = [(f"plain w{k} talk " * (1 + k % 4) + "vile" * (k % 2), k) for k in range(count)]
    numbers, begin = numbers_of([t for t, _ in rows])
    words = [bytearray(toxicity.to_bytes(numbers[a:b])) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    frame = spark.createDataFrame([(k, w, k % 2) for (_, k), w in zip(rows, words, strict=True)], "k long, words binary, label int")
    return frame.select(F.xxhash64("k", F.lit(0)).alias("mark"), "label", "words")


def test_words_are_shuffled_once_for_all_rounds(spark, monkeypatch):
    """The frames that the rounds train on read their shards as they were dealt, each whole in a partition of its own."""
    frame, plans, partitions = type(spark.range(0)), [], []
    inner = frame.mapInArrow

    def seen(self, *given, **named):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        partitions.append([r.shards for r in self.groupBy(F.spark_partition_id()).agg(F.count_distinct("shard").alias("shards")).collect()])
        return inner(self, *given, **named)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    monkeypatch.setattr(toxicity, "STEPS", 3)
    toxicity.train(dealt_texts(spark, 100), 100, shard=10)
    assert len(plans) == toxicity.ROUNDS and not any("Exchange" in p for p in plans)
    assert partitions == [[1] * 10] * toxicity.ROUNDS


@pytest.mark.parametrize("count, shard", [(100, 30), (50, 50)])
def test_training_equals_plain_loops_over_shards(spark, monkeypatch, count, shard):
    """Every shard takes each of its texts once a pass, in the order of the round, and the changes are averaged."""
    monkeypatch.setattr(toxicity, "STEPS", 15)
    texts = dealt_texts(spark, count)
    shards = -(-count // shard)
    rounds = toxicity.ROUNDS if shards > 1 else 1
    passes = max(toxicity.ROUNDS // rounds, -(-15 * toxicity.BATCH // (rounds * count)))
    order = F.array([F.xxhash64("mark", F.lit(p), F.lit(k)) for k in range(rounds) for p in range(1, passes + 1)])
    rows = [(r.mark, r.label, toxicity.from_bytes(bytes(r.words)), r.order) for r in texts.withColumn("order", order).collect()]
    numbers = toxicity._flat(toxicity.Model.start(0), toxicity._Adagrad())
    for k in range(rounds):
        total, changed = 0.0, 0
        for own in range(shards):
            queue = sorted((r[3][k * passes + p], r[0], r[1], n) for n, r in enumerate(rows) if (r[0] >> 20) % shards == own for p in range(passes))
            model, steps = toxicity._from_flat(numbers)
            random = np.random.default_rng((k, own))
            for at in range(0, len(queue), toxicity.BATCH):
                part = queue[at : at + toxicity.BATCH]
                toxicity._batch(model, steps, [rows[n][2] for *_, n in part], np.array([label for _, _, label, _ in part], dtype=np.float32), random)
            change = (toxicity._flat(model, steps) - numbers).astype(np.float64)
            total, changed = total + change, changed + (change != 0)
        numbers = numbers + (total / np.maximum(changed, 1)).astype("<f4")
    expected, found = toxicity._from_flat(numbers)[0], toxicity.train(texts, count, shard)
    assert np.allclose(found.rows, expected.rows, atol=1e-5) and np.allclose(found.out, expected.out, atol=1e-5) and np.isclose(found.bias, expected.bias, atol=1e-5)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(found.filters, expected.filters, strict=True))
