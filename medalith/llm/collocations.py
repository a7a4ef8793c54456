"""Phrase collocations per language, counted by dynamic itemset counting.

The documents are dealt to ``SHARDS`` shards, which are scanned in a cycle, one a step. Single words are counted from the
first step on. After each step, a longer phrase becomes active once both of its subphrases (without its last, without its
first word) have been met ``min_count`` times, and is counted from the next step on, together with everything else that
is active, until it has seen every shard once. So the lengths interleave: pairs are counted while words still are. Counts
of phrases that have not seen every shard are carried from step to step; the others stay if they are frequent.

What is active lies in a table of fixed size for each length: the step in which a slot was first taken, by the hash of
language and phrase. Scans read it to know when a phrase became active, so each phrase is counted in exactly one cycle.
Two phrases in one slot only make one of them counted without need; no result changes with the table's size.

A scan works on Arrow batches in numpy and sends one row for each different phrase of about ``PIECE`` bytes of text, so a
frequent phrase is a row per piece; sums go on per task before the shuffle. Most phrases are rare, so while they are counted
they are a key of 92 bits without text: two of 10¹⁰ phrases agree with a chance of 10⁻⁸ (within a piece, where 64 bits
are compared, two of 10⁶ with 3·10⁻⁸). Last scans bring the texts of those that were met often enough: an eighth of the
documents names most of them, the others only have to name the rest.

Scores are exact: ``floor(1000000 a a / (l r))`` in decimals of 38 digits.

Defined results: a null language is ``und``, a null text is empty, repeated rows count each time, other columns are
ignored. Without words the result is empty. Ties go by frequency, then by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.frames import column, shuffles_go, stored
from medalith.llm.words import LOWER, mix, pieces, powers, text_bytes
from medalith.session import work_dir

SHARDS = 2
#: Parts of the stored documents; a shard is some of them.
SLICES = 8
MAX_WORDS = 3
MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2000
PIECE = 2 << 20
#: Slots of the table of active phrases, one byte each, for every length but the longest.
SLOTS = 1 << 24
NEVER = 255
UNKNOWN = "und"

#: Byte tables: the marks that part pieces, and what belongs to a word.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
IN_WORD = ~BREAKS
IN_WORD[[9, 32]] = False
_BASE, _BASE_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Numbers of the bytes for the second hash.
_SECOND = mix(np.arange(256, dtype=np.uint64) + _BASE_2)
#: The second part of a key: bits of the second hash, above them the number of words, above that the step that made the phrase active.
#: A language's empty phrase counts its words.
HASH_BITS, WORDS_BITS = 28, 4


def shorter(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with rows of more than ``size`` bytes cut at marks, where no phrase goes over, and the row of each part."""
    starts, rows = [], []
    for row in np.flatnonzero(np.diff(offsets) > size).tolist():
        low, high = int(offsets[row]), int(offsets[row + 1])
        marks = np.flatnonzero(BREAKS[data[low:high]]) + low
        cuts = np.unique(marks[np.searchsorted(marks, np.arange(low + size, high, size)) % max(1, len(marks))]) if len(marks) else marks
        starts.append(cuts)
        rows.append(np.full(len(cuts), row))
    whole = np.arange(len(offsets) - 1)
    if not starts:
        return offsets, whole
    begin = np.concatenate([offsets[:-1], *starts])
    order = np.lexsort((begin, np.concatenate([whole, *rows])))
    return np.append(begin[order], offsets[-1]), np.concatenate([whole, *rows])[order]


def words_of(part: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start, length, row and two hashes of the words in lower-case bytes with rows between ``borders``; no word goes over a border."""
    inside = IN_WORD[part]
    border = np.zeros(len(part) + 1, dtype=bool)
    border[borders] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    if not len(starts):
        nothing = np.zeros(0, dtype=np.int64)
        return nothing, nothing, nothing, [np.zeros(0, dtype=np.uint64)] * 2
    lengths = np.flatnonzero(inside & (~after | border[1:])) + 1 - starts
    heads = np.cumsum(lengths) - lengths
    power = powers(int(lengths.max()))[np.arange(int(lengths.sum())) - np.repeat(heads, lengths)]
    letters, size = part[inside], lengths.astype(np.uint64) * _BASE
    hashes = [mix(np.add.reduceat(value * power, heads) + size) for value in (letters.astype(np.uint64) + np.uint64(1), _SECOND[letters])]
    return starts, lengths, np.searchsorted(borders, starts, side="right") - 1, hashes


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, a place of each and how often it occurs; ``np.unique`` gives the first places, for which its sort is stable and slow."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else order
    return ordered[first], order[first], np.diff(np.append(first, len(keys)))


def phrase_texts(part: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, words: int) -> pa.Array:
    """The phrases of ``words`` words from the words ``first`` on, joined by one blank."""
    index = (first[:, None] + np.arange(words)).ravel()
    lead = np.tile(np.arange(words) > 0, len(first)).astype(np.int64)
    size = lengths[index] + lead
    stop = np.cumsum(size)
    begin = stop - size
    text = part[np.maximum(np.arange(int(stop[-1])) + np.repeat(starts[index] - lead - begin, size), 0)]
    text[begin[lead > 0]] = 32
    offsets = np.concatenate([[0], stop[words - 1 :: words]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(text))


Found = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _marks(second: np.ndarray, words: int, active: np.ndarray | int = 0) -> np.ndarray:
    return (second >> np.uint64(64 - HASH_BITS)).astype(np.int64) | (np.asarray(active) << WORDS_BITS | words) << HASH_BITS


def _words(mark: str = "mark") -> Column:
    return F.shiftright(mark, HASH_BITS).bitwiseAND((1 << WORDS_BITS) - 1)


def _active(mark: str = "mark") -> Column:
    return F.shiftright(mark, HASH_BITS + WORDS_BITS)


class _Part:
    """The words of a part of a batch."""

    def __init__(self, part: np.ndarray, borders: np.ndarray, of_row: np.ndarray, names: pa.Array, salt: np.ndarray):
        self.part, self.names, self.salt = part, names, salt
        self.starts, self.lengths, row, (self.first, self.second) = words_of(part, borders)
        self.lang = of_row[row]
        piece = np.cumsum(BREAKS[part])[self.starts]
        self.follows = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])  # a word and the next one, in one piece

    def phrases(self, max_words: int, taken: dict[int, np.ndarray]) -> Iterator[Found]:
        """For each length: keys and marks of the phrases that may be active, where they start, and the step that made them active."""
        salt = self.salt[self.lang]
        key, mark, at = mix(self.first ^ salt), mix(self.second + salt), np.arange(len(self.starts))
        active = np.zeros(len(at), dtype=np.int64)
        yield 1, key, mark, at, active
        for words in range(2, max_words + 1):
            table = taken[words - 1]
            since = table[key & np.uint64(len(table) - 1)].astype(np.int64)
            # without its first word a phrase starts at the next place; two words have to follow each other
            both = np.flatnonzero((at[1:] == at[:-1] + 1) & (self.follows[at[:-1]] if words == 2 else True))
            active = np.maximum(since[both], since[both + 1])
            both, active = both[active < NEVER], active[active < NEVER]
            at = at[both]
            key, mark = mix(key[both] * _BASE + self.first[at + words - 1]), mix(mark[both] * _BASE_2 + self.second[at + words - 1])
            yield words, key, mark, at, active

    def texts(self, first: np.ndarray, words: int) -> pa.Array:
        return phrase_texts(self.part, self.starts, self.lengths, first, words)


Tables = dict[int, np.ndarray]


def _sent(spark: SparkSession, *tables: Tables):
    """Tables for the workers, compressed: most slots are free or alike."""
    packed = zstandard.ZstdCompressor(level=1)
    return spark.sparkContext.broadcast([{words: packed.compress(t.tobytes()) for words, t in each.items()} for each in tables])


def _received(sent) -> list[Tables]:
    unpacked = zstandard.ZstdDecompressor()
    return [{words: np.frombuffer(unpacked.decompress(t), dtype=np.uint8) for words, t in each.items()} for each in sent.value]


def _each_part(sent, found: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _received(sent)
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            names, of_row = langs.dictionary, np.asarray(langs.indices)
            salt = np.array([xxhash.xxh64_intdigest(n) for n in names.to_pylist()], dtype=np.uint64)
            data, offsets = text_bytes(batch.column("text"))
            offsets, rows = shorter(data, offsets, PIECE)
            for first, last in pieces(offsets, PIECE):
                if offsets[last] > offsets[first]:
                    bytes_, borders = LOWER[data[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first]
                    part = _Part(bytes_, borders, of_row[rows[first:last]], names, salt)
                    if len(part.starts):
                        yield from found(part, *tables)

    return run


def _scan(step: int, shards: int, max_words: int, sent):
    """``key, mark, n`` of the phrases that are active in a step; sent: a table of steps for every length but the longest."""

    def counted(part: _Part, taken: Tables) -> Iterator[pa.RecordBatch]:
        def rows(key: np.ndarray, mark: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(mark), pa.array(n, pa.int64())], names=["key", "mark", "n"])

        if step < shards:
            n = np.bincount(part.lang, minlength=len(part.salt))
            yield rows(part.salt[n > 0], _marks(part.salt, 0)[n > 0], n[n > 0])
        for words, key, mark, _, active in part.phrases(max_words, taken):
            now = (active <= step) & (step < active + shards)
            if now.any():
                met, place, n = different(key[now])
                yield rows(met, _marks(mark[now][place], words, active[now][place]), n)

    return _each_part(sent, counted)


def _named(max_words: int, sent):
    """``lang, words, phrase, key, mark`` of the phrases whose slots are wanted; sent: the tables of active and of wanted phrases."""

    def named(part: _Part, taken: Tables, wanted: Tables) -> Iterator[pa.RecordBatch]:
        def rows(lang: np.ndarray, words: int, texts: pa.Array, key: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
            columns = [part.names.take(pa.array(lang)), pa.array(np.full(len(key), words), pa.int32()), texts, pa.array(key.view(np.int64)), pa.array(mark)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "key", "mark"])

        langs = np.unique(part.lang)
        yield rows(langs, 0, pa.array([""] * len(langs)), part.salt[langs], _marks(part.salt[langs], 0))
        for words, key, mark, at, active in part.phrases(max_words, taken):
            table = wanted[words]
            often = table[key & np.uint64(len(table) - 1)] < NEVER
            met, place, _ = different(key[often])
            if len(met):
                first = at[often][place]
                yield rows(part.lang[first], words, part.texts(first, words), met, _marks(mark[often][place], words, active[often][place]))

    return _each_part(sent, named)


def _take_slots(frequent: DataFrame, taken: dict[int, np.ndarray], step: int) -> None:
    """Marks the slots of frequent phrases that were free before as taken from ``step`` on; bitmaps of 4 KiB travel."""
    size = len(next(iter(taken.values())))
    slot = F.col("key").bitwiseAND(F.lit(size - 1))
    bits = frequent.groupBy(_words().alias("words"), F.shiftright(slot, 15).alias("bucket")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(32767))).alias("bits"))
    for row in bits.collect():  # at most ``size / 32768`` a length
        begin = row.bucket << 15
        slots = taken[row.words][begin : begin + 32768]
        met = np.unpackbits(np.frombuffer(bytes(row.bits), dtype=np.uint8), bitorder="little")[: len(slots)].astype(bool)
        slots[met & (slots == NEVER)] = step


def phrase_counts(
    spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, shards: int = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """``lang, words, phrase, n`` of all phrases of up to ``max_words`` words met ``min_count`` times; the empty phrase has the number of words."""
    rows = docs.select(
        F.coalesce(column(docs, lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text")
    )
    path = work_dir(spark, "collocations")
    part = F.pmod(F.monotonically_increasing_id(), F.lit(max(SLICES, shards))).cast("int")  # copies of a row are spread
    rows.withColumn("slice", part).write.option("compression", "zstd").partitionBy("slice").parquet(path)
    dealt = spark.read.schema("lang string, text string, slice int").parquet(path)

    taken = {words: np.full(slots, NEVER, dtype=np.uint8) for words in range(1, max_words + 1)}
    step, last, pending, solid = 0, shards, None, []
    with shuffles_go(spark):
        while step < last:
            table = _sent(spark, {words: taken[words] for words in range(1, max_words)})
            met = dealt.where(F.col("slice") % shards == step % shards).select("lang", "text").mapInArrow(_scan(step, shards, max_words, table), "key long, mark long, n long")
            met = met if pending is None else met.unionByName(pending)
            step += 1
            # a phrase is solid once it has seen every shard; only the frequent ones of them are kept
            whole = _active() + shards <= step
            state = met.groupBy("key", "mark").agg(F.sum("n").alias("n")).where(~whole | (F.col("n") >= min_count) | (_words() == 0))
            state = stored(spark, state, f"collocations-{step}")
            table.destroy()
            pending, solid = state.where(~whole), [*solid, state.where(whole)]
            _take_slots(state.where((F.col("n") >= min_count) & (_words() > 0)), taken, step)
            last = max([shards, *(int(t[t < NEVER].max()) + shards for k, t in taken.items() if k < max_words and (t < NEVER).any())])
        often = reduce(DataFrame.unionByName, solid)

        def named(docs: DataFrame, phrases: DataFrame, label: str) -> DataFrame:
            wanted = {words: np.full(slots, NEVER, dtype=np.uint8) for words in taken}
            _take_slots(phrases.where(_words() > 0), wanted, 0)
            tables = _sent(spark, taken, wanted)
            texts = docs.select("lang", "text").mapInArrow(_named(max_words, tables), "lang string, words int, phrase string, key long, mark long").distinct()
            found = stored(spark, phrases.join(texts, ["key", "mark"]), label)
            tables.destroy()
            return found

        early = named(dealt.where("slice = 0"), often, "collocations-early")
        late = named(dealt.where("slice > 0"), often.join(early, ["key", "mark"], "left_anti"), "collocations-late")
        counts = early.unionByName(late).select("lang", "words", "phrase", "n")
    return counts


def _joined(words: Column, first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """``lang, words, phrase, a, l, r, score`` of phrases of two or more words, by their lowest cut."""
    long = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang", "words", "phrase", "a", "cut", _joined(F.col("w"), F.lit(1), F.col("cut")).alias("left_part"),
        _joined(F.col("w"), F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right_part"),
    )
    for side, count in (("left_part", "l"), ("right_part", "r")):
        cuts = cuts.join(counts.where("words > 0").select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    exact = {c: F.col(c).cast("decimal(20,0)") for c in "alr"}
    cuts = cuts.select("lang", "words", "phrase", "a", "cut", "l", "r", (F.lit(1000000).cast("decimal(7,0)") * exact["a"] * exact["a"]).alias("over"), (exact["l"] * exact["r"]).alias("under"))
    best = F.min(F.struct(F.expr("over div under").alias("score"), "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "words", "phrase", "a").agg(best).select("lang", "words", "phrase", "a", "best.l", "best.r", "best.score")


def not_covered(candidates: DataFrame, max_words: int = MAX_WORDS, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without those that a longer candidate holds with at least ``percent`` of their count."""
    w, k = F.split("phrase", " "), F.col("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), k - 1), lambda size: F.transform(F.sequence(F.lit(1), k - size + 1), lambda at: F.array_join(F.slice(w, at, size), " "))))
    longer = candidates.where(k > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(most, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(spark: SparkSession, docs: DataFrame, top: int = TOP, **counting) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    counts = phrase_counts(spark, docs, **counting)
    words = counts.where("words = 0").select("lang", "n")
    kept = not_covered(scored(counts), counting.get("max_words", MAX_WORDS))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
