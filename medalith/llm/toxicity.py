"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of two rows of one hashed embedding table: that of the word and that of its first ``STEM`` bytes, so
inflected forms share a row. Filters of the widths ``WIDTHS`` slide over the words of a text, a text's feature is the largest value
of each filter above zero, and a logistic output weighs the features. Gradients reach only the places where a filter is
largest; Adagrad steps.

Fitting uses every labelled text, whole and hashed to word numbers. Four fifths are dealt out once to shards by the hash of their
ids; each shard trains from the same model in a stream of batches, and the changes of the shards are averaged by parameter, in
``ROUNDS`` rounds. A fifth is kept out of training: its outputs are counted in steps of ``1 / STEP``, and from all these counts the
output is calibrated (Platt's targets, classes weighed by their share among all labels), and each language gets the threshold
with the best F1, drawn towards that of all languages where it has few texts. Language and labels never enter a score.

Scoring runs over whole texts in Arrow batches; memory follows the longest text, also in training.

Defined results: null and empty texts get the score of no words. Without labels of both classes every score is the share of the
label 1 among the labels (0 without any). Ids with contradicting labels are left out of the fit; an id that repeats in the
documents brings its least text; null ids have no labels. A language without texts kept out has the threshold of all. Equal texts
have equal scores.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm.frames import column, dealt, shuffles_go, stored
from medalith.llm.words import ALPHANUMERIC, LOWER, mix, pieces, powers, text_bytes

#: Texts of a shard, while there are at most ``SHARDS`` of them.
SHARD = 12000
SHARDS = 64
ROUNDS = 3
BUCKETS = 1 << 15
DIMENSIONS = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
STEM = 4
#: Batches of the training at least; fewer texts are passed over more often.
STEPS = 600
BATCH = 32
RATE = 0.1
#: Spread of the table at the start; rows of words that are never learned stay as small.
START = 0.01
#: Share of the words whose own row is left out in training, so that their beginnings learn too.
DROPPED = 0.5
DECISION = 0.7
#: Texts of all languages that a language's own texts are weighed against when its threshold is chosen.
PRIOR_TEXTS = 20.0
#: Outputs kept out are counted in steps of ``1 / STEP`` up to ``FARTHEST``.
STEP = 256
FARTHEST = 64.0
#: Slots of the ids that have labels, one bit each.
SLOTS = 1 << 26
#: Numbers of a model that travel in one row.
BLOCK = 1 << 16
_PAD = 2 * BUCKETS


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two rows of the embedding table for each word, and where each text's words begin (one more entry)."""
    low, high = int(offsets[0]), int(offsets[-1])
    part = LOWER[data[low:high]]
    inside = ALPHANUMERIC[part]
    border = np.zeros(high - low + 1, dtype=bool)
    border[offsets - low] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
    lengths = np.flatnonzero(inside & (~after | border[1:])) + 1 - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    value = (part[inside].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    word = mix(np.add.reduceat(value, heads)) & np.uint64(BUCKETS - 1)
    stem = mix(np.add.reduceat(np.where(place < STEM, value, np.uint64(0)), heads)) & np.uint64(BUCKETS - 1)
    return np.stack([word, stem + np.uint64(BUCKETS)], axis=1).astype(np.int32), np.searchsorted(starts, offsets - low)


def to_bytes(numbers: np.ndarray) -> bytes:
    """Word numbers as they are stored: all rows of the table but the empty one have a number of 16 bits."""
    return numbers.astype("<u2").tobytes()


def from_bytes(words: bytes) -> np.ndarray:
    return np.frombuffer(words, dtype="<u2").reshape(-1, 2).astype(np.int32)


def padded(numbers: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of several texts with empty ones behind each text, and the places of the words."""
    gap = max(WIDTHS) - 1
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    places = np.arange(len(numbers)) + gap * text
    wide = np.full((len(numbers) + gap * (len(begin) - 1), 2), _PAD, dtype=np.int32)
    wide[places] = numbers
    return wide, places


@dataclass
class Model:
    """Rows of the table (the last is zero), filters by width, output, and what the calibration adds."""

    rows: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = DECISION
    thresholds: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def start(seed: int = 0) -> Model:
        random = np.random.default_rng(seed)
        rows = random.normal(0, START, (2 * BUCKETS + 1, DIMENSIONS)).astype(np.float32)
        rows[-1] = 0
        filters = [random.normal(0, (2 / (w * DIMENSIONS)) ** 0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        out = random.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        return Model(rows, filters, [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS], out, 0.0)

    def responses(self, words: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
        """For each width, the filters at every word; ``words`` are the vectors of padded texts."""
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            total = words[places] @ weights[0]
            for k in range(1, width):
                total += words[places + k] @ weights[k]
            yield total + bias

    def vectors(self, numbers: np.ndarray) -> np.ndarray:
        return self.rows[numbers[:, 0]] + self.rows[numbers[:, 1]]

    def outputs(self, numbers: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The uncalibrated output of each text."""
        features = np.zeros((len(begin) - 1, FILTERS * len(WIDTHS)), dtype=np.float32)
        filled = np.flatnonzero(np.diff(begin))
        if len(filled):
            wide, places = padded(numbers, begin)
            found = [np.maximum.reduceat(r, begin[filled]) for r in self.responses(self.vectors(wide), places)]
            features[filled] = np.maximum(np.concatenate(found, axis=1), 0)
        return features.astype(np.float64) @ self.out.astype(np.float64) + self.bias

    def scores(self, numbers: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.outputs(numbers, begin) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class _Adagrad:
    def __init__(self):
        self.seen: dict[str, np.ndarray] = {}

    def step(self, name: str, values: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        seen = self.seen.setdefault(name, np.full(values.shape, 1e-3, dtype=np.float32))
        seen[at] += gradient * gradient
        values[at] -= RATE * gradient / np.sqrt(seen[at])


def _batch(model: Model, steps: _Adagrad, texts: list[np.ndarray], labels: np.ndarray, random: np.random.Generator) -> None:
    begin = np.cumsum([0, *map(len, texts)])
    wide, places = padded(np.concatenate(texts), begin)
    kept = random.random(len(wide)) >= DROPPED
    words = model.rows[np.where(kept, wide[:, 0], _PAD)] + model.rows[wide[:, 1]]
    best, values = [], []
    for response in model.responses(words, places):
        top = np.stack([response[a:b].argmax(axis=0) + a for a, b in zip(begin[:-1], begin[1:], strict=True)])
        best.append(top)
        values.append(np.maximum(response[top, np.arange(FILTERS)], 0))
    features = np.concatenate(values, axis=1)
    wrong = ((_sigmoid(features @ model.out + model.bias) - labels) / len(labels)).astype(np.float32)
    back = wrong[:, None] * model.out * (features > 0)
    touched, gradients = [], []
    for k, width in enumerate(WIDTHS):
        part, at = back[:, k * FILTERS : (k + 1) * FILTERS], places[best[k]]
        change = np.empty_like(model.filters[k])
        for j in range(width):
            change[j] = np.einsum("tf,tfd->df", part, words[at + j])
            touched.append((at + j).ravel())
            gradients.append((part[:, :, None] * model.filters[k][j].T[None]).reshape(-1, DIMENSIONS))
        steps.step(f"filters{k}", model.filters[k], change)
        steps.step(f"biases{k}", model.biases[k], part.sum(axis=0))
    steps.step("out", model.out, wrong @ features)
    bias = np.array([model.bias], dtype=np.float32)
    steps.step("bias", bias, wrong.sum(keepdims=True))
    model.bias = float(bias[0])
    at, gradient = np.concatenate(touched), np.concatenate(gradients)
    rows = np.concatenate([np.where(kept[at], wide[at, 0], _PAD), wide[at, 1]])
    found, place = np.unique(rows, return_inverse=True)
    summed = np.zeros((len(found), DIMENSIONS), dtype=np.float32)
    np.add.at(summed, place, np.concatenate([gradient, gradient]))
    real = found != _PAD
    steps.step("rows", model.rows, summed[real], found[real])


def _parameters(model: Model, steps: _Adagrad) -> dict[str, np.ndarray]:
    """All numbers that the training changes, by name; the bias is a copy."""
    own = {"rows": model.rows, "out": model.out, "bias": np.array([model.bias], dtype=np.float32)}
    own |= {f"filters{k}": model.filters[k] for k in range(len(WIDTHS))} | {f"biases{k}": model.biases[k] for k in range(len(WIDTHS))}
    return own | {f"seen {name}": steps.seen.setdefault(name, np.full(own[name].shape, 1e-3, dtype=np.float32)) for name in list(own)}


def _flat(model: Model, steps: _Adagrad) -> np.ndarray:
    return np.concatenate([v.ravel() for v in _parameters(model, steps).values()])


def _from_flat(numbers: np.ndarray) -> tuple[Model, _Adagrad]:
    model, steps, at = Model.start(), _Adagrad(), 0
    for name, values in _parameters(model, steps).items():
        values[...] = numbers[at : at + values.size].reshape(values.shape)
        at += values.size
        if name == "bias":
            model.bias = float(values[0])
    return model, steps


def _trained(given, seed: int):
    """Rows ``shard, label, words`` in the order of shards to each shard's changes of the numbers ``given``, in blocks."""

    def batches_of_shards(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], list[int]]]:
        shard, texts, labels = None, [], []
        for batch in rows:
            for own, label, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "label", "words")), strict=True):
                if texts and (own != shard or len(texts) == BATCH):
                    yield shard, texts, labels
                    texts, labels = [], []
                shard = own
                texts.append(from_bytes(words))
                labels.append(label)
        if texts:
            yield shard, texts, labels

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, batches in groupby(batches_of_shards(rows), key=lambda b: b[0]):
            model, steps = _from_flat(given.value)
            random = np.random.default_rng((seed, shard))
            for _, texts, labels in batches:
                _batch(model, steps, texts, np.array(labels, dtype=np.float32), random)
            change = _flat(model, steps) - given.value
            blocks = [change[a : a + BLOCK].astype("<f4").tobytes() for a in range(0, len(change), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "change"])

    return run


def _mean_change(changes: pa.Table) -> pa.Table:
    """The mean of the changes of each number, over the shards that changed it."""
    total, count = 0.0, 0
    for change in changes.column("change").to_pylist():
        own = np.frombuffer(change, dtype="<f4").astype(np.float64)
        total, count = total + own, count + (own != 0)
    mean = (total / np.maximum(count, 1)).astype("<f4").tobytes()
    return pa.table({"block": changes.column("block")[:1], "change": pa.array([mean], pa.binary())})


def train(texts: DataFrame, count: int, shard: int = SHARD, seed: int = 0) -> Model:
    """A model of ``count`` texts (``mark, label, words``, none without words); ``mark`` is a hash that orders them."""
    numbers = _flat(Model.start(seed), _Adagrad())
    shards = min(SHARDS, -(-count // shard))
    rounds = ROUNDS if shards > 1 else 1
    passes = max(ROUNDS // rounds, -(-STEPS * BATCH // (rounds * count)))
    # the words are shuffled once, whatever the rounds and passes; a round sorts the shards where they lie
    whole = dealt(texts.select("mark", "label", "words", F.pmod(F.shiftright("mark", 20), F.lit(shards)).cast("int").alias("shard")), shards, "shard")
    again = whole.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    for k in range(rounds):
        order = F.xxhash64("mark", "pass", F.lit(k))
        rows = again.sortWithinPartitions("shard", order, "mark").select("shard", "label", "words")
        given = texts.sparkSession.sparkContext.broadcast(numbers)
        changes = rows.mapInArrow(_trained(given, seed + k), "block int, change binary")
        mean = changes.groupBy("block").applyInArrow(_mean_change, "block int, change binary").orderBy("block").collect()
        numbers = numbers + np.concatenate([np.frombuffer(r.change, dtype="<f4") for r in mean])
        given.unpersist()
    return _from_flat(numbers)[0]


def calibrate(model: Model, outputs: np.ndarray, labels: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> None:
    """Scale and shift of the output: weighted logistic regression on Platt's targets, by Newton steps; ``counts`` texts each."""
    ones, size = int((labels * counts).sum()), int(counts.sum())
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (size - ones + 2))
    middle = (outputs * counts).sum() / size
    spread = np.sqrt((counts * (outputs - middle) ** 2).sum() / size) or 1.0
    x = np.stack([(outputs - middle) / spread, np.ones_like(outputs)], axis=1)
    weights = weights * counts
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        slope = x.T @ (weights * (p - targets)) + np.array([1e-3, 0]) * theta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        move = np.clip(np.linalg.solve(curve, slope), -2, 2)
        theta -= move
        if np.abs(move).max() < 1e-6:
            break
    model.scale = float(theta[0] / spread)
    model.shift = float(theta[1] - theta[0] * middle / spread)


def _f1(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the weighted hits, and all found plus all there, at each threshold."""
    found = scores[None, :] >= thresholds[:, None]
    return 2 * (found * (weights * labels)).sum(axis=1), (found * weights).sum(axis=1) + (weights * labels).sum()


def choose_thresholds(model: Model, scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, counts: np.ndarray, languages: list[str]) -> None:
    """The threshold of each language, by F1 of its texts and of ``PRIOR_TEXTS`` texts' worth of all; near ties go to ``DECISION``."""
    candidates = np.linspace(0.02, 0.98, 49)
    weights = weights * counts
    over, under = _f1(scores, labels, weights, candidates)

    def best(hits: np.ndarray, both: np.ndarray) -> float:
        f1 = hits / np.maximum(both, 1e-12)
        near = candidates[f1 >= f1.max() - 1e-9]
        return float(near[np.abs(near - DECISION).argmin()])

    model.threshold = best(over, under)
    prior = PRIOR_TEXTS / max(1, counts.sum())
    names = np.array(languages)
    for name in sorted(set(languages)):
        own = names == name
        hits, both = _f1(scores[own], labels[own], weights[own], candidates)
        model.thresholds[name] = best(hits + prior * over, both + prior * under)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in pieces(offsets):
            numbers, begin = word_numbers(data, offsets[first : last + 1])
            rows = [to_bytes(numbers[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([part.column("mark"), part.column("label"), part.column("lang"), pa.array(rows, pa.binary())], names=["mark", "label", "lang", "words"])


def _slots(known: DataFrame) -> np.ndarray:
    """Bits of the slots that ids fall into, packed; bitmaps of 4 KiB travel."""
    slot = _slot(F.col("doc_id"))
    bits = known.groupBy(F.shiftright(slot, 15).alias("bucket")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(32767))).alias("bits"))
    taken = np.zeros((SLOTS >> 15, 4096), dtype=np.uint8)
    for row in bits.collect():
        taken[row.bucket] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return taken.ravel()


def _slot(doc_id: Column) -> Column:
    return F.xxhash64(doc_id).bitwiseAND(F.lit(SLOTS - 1))


def _in_slots(taken):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.asarray(batch.column("slot"))
            yield batch.filter(pa.array((taken.value[slot >> 3] >> (slot & 7) & 1).astype(bool))).drop_columns(["slot"])

    return run


def _counted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [from_bytes(w) for w in batch.column("words").to_pylist()]
            found = np.array([model.value.outputs(t, np.array([0, len(t)]))[0] for t in texts])
            steps = np.rint(np.clip(found, -FARTHEST, FARTHEST) * STEP).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), pa.array(steps, pa.int32())], names=["label", "lang", "step"])

    return run


def _fit(docs: DataFrame, labels: DataFrame, sample: int, seed: int) -> tuple[Model | None, float]:
    known = labels.select(column(labels, "doc_id").cast("long").alias("doc_id"), column(labels, "toxic").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return None, share
    texts = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").cast("string").alias("text"), column(docs, "lang").cast("string").alias("lang"))
    # only texts whose id falls into a slot of a known one reach the shuffle; the join is exact
    slots = docs.sparkSession.sparkContext.broadcast(_slots(known))
    likely = texts.where("length(text) > 0").withColumn("slot", _slot(F.col("doc_id"))).mapInArrow(_in_slots(slots), "doc_id long, text string, lang string")
    met = likely.join(known, "doc_id")
    met = met.groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("least")).select(F.xxhash64("doc_id", F.lit(seed)).alias("mark"), "label", "least.*")
    spark = docs.sparkSession
    rows = stored(spark, met.mapInArrow(_numbered, "mark long, label int, lang string, words binary"), "toxicity-words")
    tested = F.pmod("mark", F.lit(5)) == 4
    kinds = rows.groupBy(tested.alias("tested"), "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length("words") > 0).alias("filled")).collect()
    if len({r.label for r in kinds if not r.tested}) < 2:
        return None, share
    count = sum(r.filled for r in kinds if not r.tested)
    model = train(rows.where(~tested & (F.length("words") > 0)), count, sample, seed) if count else Model.start(seed)
    # without texts of both classes kept apart the trained ones have to do
    apart = tested if len({r.label for r in kinds if r.tested}) == 2 else ~tested
    sent = spark.sparkContext.broadcast(model)
    outputs = rows.where(apart).mapInArrow(_counted(sent), "label int, lang string, step int")
    found = outputs.groupBy("label", F.coalesce("lang", F.lit("")).alias("lang"), "step").count().orderBy("label", "lang", "step").collect()
    truth, counts = np.array([r.label for r in found], dtype=np.float32), np.array([r["count"] for r in found], dtype=np.float64)
    values, languages = np.array([r.step for r in found]) / STEP, [r.lang for r in found]
    ones, size = (truth * counts).sum(), counts.sum()
    weights = np.where(truth == 1, share / max(1, ones), (1 - share) / max(1, size - ones)) * size
    calibrate(model, values, truth, weights, counts)
    choose_thresholds(model, _sigmoid(model.scale * values + model.shift), truth, weights, counts, languages)
    return model, share


def fit(docs: DataFrame, labels: DataFrame, sample: int = SHARD, seed: int = 0) -> tuple[Model | None, float]:
    """A model, or None where a class has no text to learn from, and the share of the label 1 among the labels that may be learned.

    ``sample`` is the number of texts of a shard; every labelled text is used.
    """
    with shuffles_go(docs.sparkSession):  # a round leaves nothing but its model
        return _fit(docs, labels, sample, seed)


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in pieces(offsets):
                found = model.value.scores(*word_numbers(data, offsets[first : last + 1]))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(found, pa.float64())], names=["doc_id", "lang", "score"])

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model | None, share: float = 0.0) -> DataFrame:
    """``doc_id, held_out, score, predicted, threshold, toxic``; ``toxic`` decides by the language's threshold."""
    rows = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "lang").cast("string").alias("lang"), column(docs, "text").cast("string").alias("text"))
    if model is None:
        found, threshold = rows.select("doc_id", F.lit(float(share)).alias("score")), F.lit(DECISION)
    else:
        found = rows.mapInArrow(_scores(spark.sparkContext.broadcast(model)), "doc_id long, lang string, score double")
        own = F.from_json(F.lit(json.dumps(model.thresholds)), "map<string,double>")[F.coalesce("lang", F.lit(""))]
        threshold = F.coalesce(own, F.lit(model.threshold))
    found = found.withColumn("threshold", threshold)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"),
        "threshold", (F.col("score") >= F.col("threshold")).alias("toxic"),
    )
