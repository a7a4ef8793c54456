"""Jaccard self-join of documents on their sets of word shingles, by T-occurrence search.

Two documents link when 100 · |A ∩ B| ≥ 75 · |A ∪ B|, that is when they share at least T = ⌈3/7 (|A| + |B|)⌉ shingles.
The inverted lists are ordered from short to long by an estimate of their length. A document needs only the lists of
its first |A| − T + 1 shingles to meet every partner at least once (leaving out the T − 1 longest lists), so only these
are shuffled. Documents that meet there are compared by a DivideSkip search in blocks of documents: short lists are
merged with a heap, long ones are probed by binary search, and a document stays when it reaches T.

Groups of copies: equal sets are one node. Members of a list are compared with one of them, not with each other; what
the links found so far already connect is never compared, and lists that still hold several components go through
further rounds. In the last one, the members of such lists are indexed in blocks of documents of like size that share a
list, and each member outside a list's largest component searches the blocks met there. A search finds all partners of
a block at once, so no link between different components is lost and no pairs of members are ever written out.

Before any text is moved, pairs are checked by signatures: how many shingles of a set fall into each of ``SIGNATURE``
classes bounds what two sets share from above, so a pair that cannot reach T goes without a comparison.

Hot lists are split by a hash of the document, with one more list for the firsts of the splits. The list lengths come
from a table of ``SKETCH`` counters, whose size does not depend on the data; it only sets the order.

Defined results: null, empty or blank text has an empty set and no link; fewer than five words are one shingle. Rows
with a null id get their size and a null component. Rows that repeat an id are one node with all their sets.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.components import connected_components
from medalith.llm.frames import id_and_text, released, stored
from medalith.llm.words import SHINGLE_WORDS, mix, shingle_pieces, shingle_sets

PERCENT = 75
SKETCH = 1 << 22
CHUNK = 1 << 12
RANK_STEPS = 1024
SPLIT_ROWS = 2048
STAR_ROUNDS = 2
SMALL_LIST = 16
BLOCK_DOCUMENTS = 16
OPEN_BLOCK_DOCUMENTS = 1024
OPEN_BLOCK_SHINGLES = 1 << 19
SIGNATURE = 256
SIGNATURE_SIZES = 60_000
ENTRY_BUCKETS = 1024
PACKED_ENTRIES = 1 << 18


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Smallest number of shared shingles that makes sets of these sizes similar enough."""
    return -(-percent * (a + b) // (100 + percent))


# --- sizes, set signatures and list lengths: one pass over the texts ---------------------------------

_SIZES = "doc_id long, n long, sig1 long, sig2 long, parts binary, chunk int, counts binary"
_SIZE_NAMES = ["doc_id", "n", "sig1", "sig2", "parts", "chunk", "counts"]


def _signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (total[begin[1:]] - total[begin[:-1]]).view(np.int64)


def _buckets(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64(SKETCH - 1)).astype(np.int64)


def _parts(values: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """How many shingles of each row's set fall into each of ``SIGNATURE`` classes; none for enormous sets.

    Two sets share at most the sum of the smaller counts, so pairs that cannot reach T are told without their texts.
    """
    classes = (values >> np.uint64(40)).astype(np.int64) % SIGNATURE
    counts = np.bincount(np.repeat(np.arange(len(n)) * SIGNATURE, n) + classes, minlength=len(n) * SIGNATURE)
    packed, width = counts.astype("<u2").tobytes(), 2 * SIGNATURE
    return [packed[k * width : (k + 1) * width] if size <= SIGNATURE_SIZES else None for k, size in enumerate(n.tolist())]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SKETCH, dtype=np.uint32)
    for batch in batches:
        n, one, two, parts = [], [], [], []
        for _, values, begin in shingle_pieces(batch.column("text")):
            n.append(np.diff(begin))
            one.append(_signatures(values, begin))
            two.append(_signatures(mix(values ^ np.uint64(0x5851F42D4C957F2D)), begin))
            parts += _parts(values, n[-1])
            np.add.at(counts, _buckets(values), np.uint32(1))
        rows = batch.num_rows
        n, one, two = (np.concatenate([np.zeros(0, dtype=np.int64), *c]) for c in (n, one, two))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
             pa.array(parts, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
            names=_SIZE_NAMES,
        )
    filled = [i for i in range(0, SKETCH, CHUNK) if counts[i : i + CHUNK].any()]
    if filled:
        packed = [zlib.compress(counts[i : i + CHUNK].tobytes(), 1) for i in filled]
        empty = pa.nulls(len(packed), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [empty, empty, empty, empty, pa.nulls(len(packed), pa.binary()), pa.array([i // CHUNK for i in filled], pa.int32()),
             pa.array(packed, pa.binary())],
            names=_SIZE_NAMES,
        )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            counts = np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.uint32)
            total[chunk] = total[chunk] + counts if chunk in total else counts.astype(np.uint64)
    ranks = [np.round(np.log2(v + np.uint64(1)) * RANK_STEPS).astype("<u2").tobytes() for v in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(ranks, pa.binary())], names=["chunk", "ranks"])


def _list_ranks(sizes: DataFrame) -> np.ndarray:
    """The counters, added up on the executors, as ``RANK_STEPS`` steps per doubling: always ``SKETCH`` small numbers."""
    chunks = sizes.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    ranks = np.zeros(SKETCH, dtype=np.uint16)
    for row in chunks.mapInArrow(released(_added), "chunk int, ranks binary").toLocalIterator():
        ranks[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.ranks, dtype="<u2")
    return ranks


# --- entries of the inverted lists --------------------------------------------------------------------


_PACKED = "bucket int, hs array<long>, splits array<long>, doc_ids array<long>, sizes array<long>"


def _packed_entries(ranks, percent: int):
    """The short lists in which a document has to stand, many entries per row.

    An entry is a shingle hash, a split, the document, and a size. ``split`` holds the number of splits of the list and
    this document's one (``parts << 32 | part``), ``size`` the size of the set and the shingle's place in the order of
    lists (``n << 32 | place``). Entries of one bucket lie together in columns, which halves what is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks.value
        # a counter has the entries of many lists; those of a hot one stand out
        usual = 4 * 2 ** (float(rank.mean()) / RANK_STEPS)
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            size = 0
            docs = batch.column("doc_id")
            known, spread = np.asarray(docs.is_valid()), np.asarray(docs.fill_null(0))
            spread = (mix(spread.view(np.uint64)) >> np.uint64(1)).astype(np.int64)
            docs = np.asarray(docs.fill_null(0))
            for first, values, begin in shingle_pieces(batch.column("text")):
                n = np.diff(begin)
                here = slice(first, first + len(n))
                keep = np.where(known[here] & (n > 0), n - -(-percent * n // 100) + 1, 0)
                at = rank[_buckets(values)]
                # the values are sorted, so a stable sort by rank and leading bits is a sort by rank and value
                key = (at.astype(np.uint64) << np.uint64(48)) | (values >> np.uint64(16))
                begins = begin[:-1].tolist()
                order = [a + np.argsort(key[a : a + k], kind="stable")[:m] for a, k, m in zip(begins, n.tolist(), keep.tolist(), strict=True) if m]
                if not order:
                    continue
                order = np.concatenate(order)
                parts = 1 + (np.maximum(0, np.exp2(at[order] / RANK_STEPS) - usual) // SPLIT_ROWS).astype(np.int64)
                place = np.arange(len(order)) - np.repeat(np.cumsum(keep) - keep, keep)
                for into, made in zip(columns, (
                    values[order].view(np.int64), (parts << 32) | (np.repeat(spread[here], keep) % parts),
                    np.repeat(docs[here], keep), (np.repeat(n, keep) << 32) | place,
                ), strict=True):
                    into.append(made)
                size += len(order)
                if size >= PACKED_ENTRIES:
                    yield _packed(columns)
                    columns, size = [[], [], [], []], 0
            if size:
                yield _packed(columns)

    return run


def _packed(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    flat = [np.concatenate(c) for c in columns]
    bucket = (mix(flat[0].view(np.uint64) + flat[1].view(np.uint64)) % np.uint64(ENTRY_BUCKETS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    offsets = pa.array(np.append(first, len(bucket)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c[order], pa.int64())) for c in flat]
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), *lists], names=["bucket", "hs", "splits", "doc_ids", "sizes"])


def _entries(packed: DataFrame) -> DataFrame:
    """One row per entry, partitioned by the bucket that holds whole splits of lists."""
    at = packed.repartition("bucket").select("bucket", "splits", "doc_ids", "sizes", F.posexplode("hs").alias("pos", "h"))
    of = {c: F.get(f"{c}s", F.col("pos")) for c in ("split", "doc_id", "size")}
    named = at.select("bucket", "h", *[v.alias(k) for k, v in of.items()])
    return named.select(
        "bucket", "h", "split", "doc_id",
        F.expr("cast(shiftright(size, 32) as int)").alias("n"), F.expr("cast(size & 4294967295 as int)").alias("place"),
    )


def _may_link(a: str, b: str, percent: int) -> str:
    """Whether two entries of one list can still reach T, if this is the first list they share."""
    n, place = "{}n", "{}place"
    left = f"least({n.format(a)} - {place.format(a)}, {n.format(b)} - {place.format(b)})"
    return f"{100 + percent} * {left} >= {percent} * ({n.format(a)} + {n.format(b)})"


def _list_members(entries: DataFrame, percent: int) -> DataFrame:
    """``h, doc_id, n, place, partner, head``: the entries that can have a partner in their list.

    In order of size the neighbours are the best partners: when the previous one is too small and the next one too
    large for the places, so are all others. In a list of two the one pair decides. ``partner`` is the document a
    member is compared with first: the first of its split, or the one before it where the sizes differ too much.
    ``head`` marks the first member of each split of a hot list.
    """
    # the bucket follows from the others; standing last it leaves the hash as what rows are sorted by first
    split = Window.partitionBy("h", "split", "bucket").orderBy("n", "doc_id")
    me = F.struct("doc_id", "n", "place")
    placed = entries.select(
        "*",
        F.first(me).over(split.rowsBetween(Window.unboundedPreceding, 0)).alias("first"),
        F.lag(me).over(split).alias("before"),
        F.lead(me).over(split).alias("after"),
        (F.row_number().over(split) == 2).alias("second"),
        F.lead("n", 2).over(split).isNull().alias("near_end"),
        F.expr("shiftright(split, 32) > 1").alias("hot"),
    )
    smaller = F.expr(f"before.n * 100 >= {percent} * n")
    larger = F.expr(f"100 * n >= {percent} * after.n and {100 + percent} * (n - place) >= {percent} * (n + after.n)")
    two = F.expr("(before is null and near_end) or (second and after is null)")
    of_two = F.expr(
        f"(before is null and near_end and {_may_link('', 'after.', percent)}) or (second and after is null and {_may_link('', 'before.', percent)})"
    )
    useful = F.when(F.col("hot"), True).when(two, of_two).otherwise(F.coalesce(smaller, F.lit(False)) | F.coalesce(larger, F.lit(False)))
    kept = placed.where(F.coalesce(useful, F.lit(False)))
    return kept.select("h", "doc_id", "n", "place", _partner(percent).alias("partner"), F.expr("hot and before is null").alias("head"))


def _partner(percent: int) -> Column:
    first = F.when(F.expr(_may_link("", "first.", percent)), F.col("first.doc_id"))
    before = F.when(F.expr(_may_link("", "before.", percent)), F.col("before.doc_id"))
    return F.when(F.col("before").isNotNull(), F.coalesce(first, before))


def _first_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each member with its partner; the heads of the splits of one list are paired among themselves in the same way."""
    across = Window.partitionBy("h").orderBy("n", "doc_id")
    me = F.struct("doc_id", "n", "place")
    heads = members.where("head").select(
        "doc_id", "n", "place", F.first(me).over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("first"), F.lag(me).over(across).alias("before")
    )
    both = members.select("partner", "doc_id").unionByName(heads.select(_partner(percent).alias("partner"), "doc_id"))
    return both.where("partner is not null").select(F.col("partner").alias("a"), F.col("doc_id").alias("b"))


# --- DivideSkip search in blocks of documents ---------------------------------------------------------


class BlockIndex:
    """Inverted lists over the shingle sets of one block of documents."""

    def __init__(self, sets: list[tuple[int, np.ndarray]], percent: int):
        self.percent = percent
        self.ids = [doc for doc, _ in sets]
        self.sizes = np.array([len(s) for _, s in sets], dtype=np.int64)
        values = np.concatenate([s for _, s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, values))
        self.values, self.owner = values[order], owner[order]

    def search(self, query: np.ndarray) -> list[int]:
        """Ids of the documents that share enough shingles with ``query``."""
        n, p = len(query), self.percent
        fit = (100 * self.sizes >= p * n) & (100 * n >= p * self.sizes)
        if not n or not fit.any():
            return []
        need = -(-p * (self.sizes + n) // (100 + p))
        least = int(need[fit].min())
        low, high = np.searchsorted(self.values, query, "left"), np.searchsorted(self.values, query, "right")
        length = high - low
        filled = int(np.count_nonzero(length))
        if filled < least:
            return []
        # the longest lists are set aside; T - (their number) occurrences must come from the others
        by_length = np.argsort(-length, kind="stable")[:filled]
        longest = int(length[by_length[0]])
        aside = min(least - 1, int(least / (0.0085 * np.log2(longest + 1) + 1)))
        long, short = by_length[:aside], by_length[aside:]
        lists = (self.owner[low[k] : high[k]].tolist() for k in short)
        found, last, times = [], -1, 0
        for owner in heapq.merge(*lists):
            if owner != last:
                found.append((last, times))
                last, times = owner, 0
            times += 1
        found.append((last, times))
        result = []
        for owner, times in found[1:]:
            if not fit[owner] or times + aside < need[owner]:
                continue
            for done, k in enumerate(long):
                at = low[k] + np.searchsorted(self.owner[low[k] : high[k]], owner)
                times += int(at < high[k] and self.owner[at] == owner)
                if times >= need[owner] or times + aside - done - 1 < need[owner]:
                    break
            if times >= need[owner]:
                result.append(self.ids[owner])
        return result


class _Forest:
    """Which documents of a block are connected already; only links that connect more are passed on."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        above = self.above
        while (up := above.get(node, node)) != node:
            above[node] = above.get(up, up)
            node = up
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.above[max(a, b)] = min(a, b)
        return a != b


def _search(percent: int):
    """Streams blocks: first the indexed documents of a block, then the documents that search it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sets, index, forest = None, [], None, _Forest()
        for batch in batches:
            a, b = [], []
            rows = zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), batch.column("role").to_pylist(),
                       batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text")), strict=True)
            for of, part, role, doc, values in rows:
                if (of, part) != block:
                    block, sets, index, forest = (of, part), [], None, _Forest()
                if role == 0:
                    sets.append((doc, values))
                    continue
                if index is None:
                    index = BlockIndex(sets, percent) if sets else None
                    sets = []
                for other in index.search(values) if index else ():
                    if forest.join(other, doc):
                        a.append(other)
                        b.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _links(spark: SparkSession, texts: DataFrame, pairs: DataFrame, percent: int, label: str) -> DataFrame:
    """The linked ones of the pairs ``(a, b)``, found by searching ``b`` in the block that holds ``a``."""
    blocks = pairs.select("a").distinct().count() // BLOCK_DOCUMENTS + 1
    blocked = pairs.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(blocks)))
    return _block_links(spark, texts, blocked.select("block", "a").distinct(), blocked.select("block", "b").distinct(), percent, label)


def _block_links(spark: SparkSession, texts: DataFrame, indexed: DataFrame, searches: DataFrame, percent: int, label: str) -> DataFrame:
    """Links ``(a, b)`` between the documents ``(block, a)`` of each block and those ``(block, b)`` that search it.

    A block with many searches is repeated for every ``SPLIT_ROWS`` of them, so no task holds more than one block and
    that many searches.
    """
    parts = searches.groupBy("block").agg(F.expr(f"cast(count(*) div {SPLIT_ROWS} + 1 as int)").alias("parts"))
    searched = searches.join(parts, "block").select(
        "block", F.expr("cast(pmod(xxhash64(b, 1), parts) as int)").alias("part"), F.lit(1).alias("role"), F.col("b").alias("doc_id")
    )
    repeated = indexed.join(parts, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("doc_id")
    )
    rows = repeated.unionByName(searched).join(texts, "doc_id").select("block", "part", "role", "doc_id", "text")
    placed = rows.repartition("block", "part").sortWithinPartitions("block", "part", "role", "doc_id")
    return stored(spark, placed.mapInArrow(released(_search(percent)), "a long, b long"), label)


def _nodes(spark: SparkSession, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node``: equal sets share the smallest id as node; and links for ids that have several sets."""
    sized = sizes.where("doc_id is not null and n > 0").select("doc_id", "n", "sig1", "sig2").distinct()
    smallest = sized.groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("rep"))
    known = sized.join(smallest, ["n", "sig1", "sig2"]).select("doc_id", "rep")
    grouped = known.groupBy("doc_id").agg(F.when(F.count("*") == 1, F.min("rep")).otherwise(F.col("doc_id")).alias("node"), F.collect_set("rep").alias("reps"))
    nodes = stored(spark, grouped, "join-nodes")
    own = nodes.select(F.explode("reps").alias("a"), F.col("node").alias("b")).where("a <> b")
    return nodes.select("doc_id", "node"), own


def _node_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    one = nodes.select(F.col("doc_id").alias("a"), F.col("node").alias("x"))
    two = nodes.select(F.col("doc_id").alias("b"), F.col("node").alias("y"))
    named = pairs.distinct().join(one, "a").join(two, "b").where("x <> y")
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open_lists(labelled: DataFrame) -> DataFrame:
    """Members ``h, node, n, place, component`` of the lists that hold several components."""
    several = labelled.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    here = labelled.join(several.select("h"), "h", "left_semi")
    return here.select("h", "node", "component", "n", "place").distinct()


def _main_components(here: DataFrame) -> DataFrame:
    """Adds ``main``, the component with the most members of the list, and ``k``, the number of all its members."""
    shares = here.groupBy("h", "component").agg(F.count("*").alias("k"))
    main = shares.groupBy("h").agg(F.sum("k").alias("k"), F.max_by("component", F.struct("k", "component")).alias("main"))
    return here.join(main, "h")


def _comparable(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs that can reach T by the counts of their signatures."""
    known = sizes.where("n > 0").select("doc_id", "n", "parts")
    one = known.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("parts").alias("parts_a"))
    two = known.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("parts").alias("parts_b"))
    fit = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = [least_overlap(x, y, percent) for x, y in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(), strict=True)]
            keep = []
            for least, x, y in zip(need, batch.column("parts_a").to_pylist(), batch.column("parts_b").to_pylist(), strict=True):
                shared = None if x is None or y is None else np.minimum(np.frombuffer(x, "<u2"), np.frombuffer(y, "<u2")).sum(dtype=np.int64)
                keep.append(shared is None or int(shared) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").where(fit).mapInArrow(released(run), "a long, b long").distinct()


def _open_pairs(here: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs across components within the open lists: in the first turn all of a short list, and of a long one its main
    component's pick of this turn with every member outside that component."""
    outside = here.where("component <> main").select("h", "k", F.struct("node", "n", "place", "component").alias("x"))
    picks = here.where((F.col("k") > SMALL_LIST) & (F.col("component") == F.col("main"))).groupBy("h").agg(
        F.min_by(F.struct("node", "n", "place"), F.xxhash64("node", F.lit(turn))).alias("y")
    )
    pairs = outside.join(picks, "h").where(_may_link("x.", "y.", percent)).select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))
    if turn == 0:
        inside = here.where(F.col("k") <= SMALL_LIST).select("h", "main", F.struct("node", "n", "place", "component").alias("y"))
        once = F.expr("x.component <> y.component and (y.component = main or x.node < y.node) and " + _may_link("x.", "y.", percent))
        short = outside.where(F.col("k") <= SMALL_LIST).join(inside, "h").where(once)
        pairs = pairs.unionByName(short.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    return pairs.distinct()


def _open_blocks(spark: SparkSession, here: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(block, a)`` and ``(block, b)``: the members of open lists in blocks, and which member searches which block.

    A set lies in a block of its longest open list, with others of like size; long lists fill several blocks. A member
    outside the main component of a list searches those blocks of the list's members that hold another component there
    and whose sizes and places let T be reached. So every two members of different components of a list meet.
    """
    band = F.expr(f"cast(floor(ln(n) / ln(100.0D / {percent})) as int)")
    homes = here.groupBy("node", "n").agg(F.max_by("h", F.struct("k", "h")).alias("home")).withColumn("band", band)
    filled = homes.groupBy("home", "band").agg(
        F.expr(f"1 + greatest(count(*) div {OPEN_BLOCK_DOCUMENTS}, sum(n) div {OPEN_BLOCK_SHINGLES})").alias("blocks")
    )
    block = F.xxhash64("home", "band", F.expr("pmod(xxhash64(node, 2), blocks)")).alias("block")
    placed = stored(spark, homes.join(filled, ["home", "band"]).select("node", "n", block), "join-homes")
    met = here.join(placed, ["node", "n"]).groupBy("h", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least_n"), F.max("n").alias("most_n"),
        F.max(F.expr("n - place")).alias("left"),
    )
    reachable = F.expr(
        f"(low <> component or high <> component) and 100 * most_n >= {percent} * n and 100 * n >= {percent} * least_n "
        f"and {100 + percent} * least(n - place, left) >= {percent} * (n + least_n)"
    )
    searches = here.where("component <> main").join(met, "h").where(reachable).select("block", F.col("node").alias("b")).distinct()
    searches = stored(spark, searches, "join-searches")
    searched = searches.select("block").distinct()
    return placed.join(searched, "block", "left_semi").select("block", F.col("node").alias("a")).distinct(), searches


def _merged(spark: SparkSession, components: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """The components after new links, which are contracted to links between the components known so far."""
    one = components.select(F.col("node").alias("a"), F.col("component").alias("x"))
    two = components.select(F.col("node").alias("b"), F.col("component").alias("y"))
    ends = found.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    joined = connected_components(spark, ends.where("a <> b").distinct(), label)
    above = joined.select(F.col("node").alias("component"), F.col("component").alias("above"))
    moved = components.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    fresh = joined.join(components.select("node"), "node", "left_anti")
    return stored(spark, moved.unionByName(fresh.select("node", "component")), f"{label}-merged")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()


def _with_texts(spark: SparkSession, plain: DataFrame, texts: DataFrame | None, needed: DataFrame, label: str) -> DataFrame:
    """``texts`` and the texts of those documents that it lacks."""
    if texts is not None:
        needed = stored(spark, needed.join(texts.select("doc_id"), "doc_id", "left_anti"), f"{label}-missing")
        if needed.isEmpty():
            return texts
    more = stored(spark, plain.join(needed, "doc_id", "left_semi"), label)
    return more if texts is None else texts.unionByName(more)


def similar_components(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; the component is the smallest id reachable by links."""
    plain = id_and_text(docs, id_col, text_col)
    passed = stored(spark, plain.mapInArrow(released(_sizes), _SIZES), "join-sizes")
    ranks = spark.sparkContext.broadcast(_list_ranks(passed))  # SKETCH numbers of two bytes
    sizes = passed.where("chunk is null").select("doc_id", "n", "sig1", "sig2", "parts")
    nodes, links = _nodes(spark, sizes)

    entries = _entries(plain.mapInArrow(released(_packed_entries(ranks, percent)), _PACKED))
    members = stored(spark, _list_members(entries, percent), "join-members")
    ranks.destroy()
    components = connected_components(spark, links, "join-components")
    of_doc = nodes.join(components, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("component"))
    labelled = members.select("h", "doc_id", "n", "place").join(of_doc, "doc_id").drop("doc_id")
    pairs = _node_pairs(_first_pairs(members, percent), nodes)

    texts, turn = None, 0
    while True:
        pairs = stored(spark, _comparable(pairs, sizes, percent), f"join-pairs-{turn}")
        if not pairs.isEmpty():
            texts = _with_texts(spark, plain, texts, _ends(pairs), f"join-texts-{turn}")
            found = _links(spark, texts, pairs, percent, f"join-links-{turn}")
            if not found.isEmpty():
                components = _merged(spark, components, found, f"join-components-{turn}")
        labelled = labelled.drop("component").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled = stored(spark, _open_lists(labelled), f"join-lists-{turn}")
        if labelled.isEmpty():
            break
        here = _main_components(labelled)
        if turn == STAR_ROUNDS:
            # all pairs of the short lists have been compared in the first turn
            indexed, searches = _open_blocks(spark, here.where(F.col("k") > SMALL_LIST) if turn else here, percent)
            if not searches.isEmpty():
                needed = indexed.select("a").union(searches.select("b")).distinct().withColumnRenamed("a", "doc_id")
                texts = _with_texts(spark, plain, texts, needed, f"join-texts-{turn}-open")
                found = _block_links(spark, texts, indexed, searches, percent, f"join-links-{turn}-open")
                if not found.isEmpty():
                    components = _merged(spark, components, found, f"join-components-{turn}-open")
            break
        pairs = _open_pairs(here, turn, percent)
        turn += 1
    named = nodes.join(components, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    return sizes.join(named, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
