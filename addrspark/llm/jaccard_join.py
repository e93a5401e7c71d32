"""Join documents whose sets of word n-grams have a Jaccard similarity of at least 0.8.

Parity sketches. The shingles of a document are hashed into ``m`` blocks, and the
hashes of a block are XORed: a block's parity changes with every shingle that only one of two
sets has in it, so two sketches differ in at most as many blocks as the sets
differ in shingles. Sets of a and b shingles that are similar enough differ in at
most (a + b) / 9 of them. In each size band ``m`` exceeds the largest such number d, so by the
pigeonhole principle linked documents agree in at least ``m - d`` blocks. An
(band, block, parity) that two different sets share is a candidate.

A document needs ``q`` shared blocks to have any link, so its ``q - 1`` most frequent blocks
can be left out: if two sets share q blocks they share one of the others. That leaves
blocks of common passages out without losing a link, whatever their number.

Candidates are verified on the texts. A first round compares each set with the
most connected set of each block only, which makes one component of a group of copies
with as many comparisons as members. In a second round, the sets of a block that are still in
different components are compared: the few pairs of small blocks are listed, and the sets of large blocks are laid
side by side in a task, or in parts of bounded size. Their bit sketches, one
parity bit per shingle flipped, have a Hamming distance that is at most the number of
differing shingles, and only pairs whose distance allows a link are listed. What is listed is verified. So every link
between different components is seen, and pairs within a component are not listed.

Equal sets are one node throughout: a task sends the sketch of a set once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from addrspark.llm.components import components
from addrspark.llm.tables import table
from addrspark.llm.words import Words, blocks, mixed, shingles
from addrspark.operators.joins import join_splitting
from addrspark.shared import materialize

WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Sizes of a band lie within this factor, the square of the largest factor between linked sizes.
BAND = 1.5625
#: Sets of a block whose pairs are listed; of more, only pairs that may be links are.
LISTED = 24
#: Sets of a block that are compared in one task; more are dealt into parts, and each two parts are a task's work.
PART = 2048
#: Pairs that a task remembers so as not to tell them again.
TOLD = 1 << 18

_bands: list[tuple[int, int]] = []


def band_of(size: int) -> int:
    """The index of the band of a set size; bands are extended as needed."""
    while not _bands or _bands[-1][1] <= size:
        low = _bands[-1][1] if _bands else 1
        _bands.append((low, max(low + 1, int(np.ceil(low * BAND)))))
    return next(k for k, (_, high) in enumerate(_bands) if size < high)


def sketch_shape(band: int) -> tuple[int, int]:
    """Most differing shingles of a linked pair whose smaller set is in the band, and the blocks of a sketch."""
    smaller = _bands[band][1] - 1
    larger = smaller * 100 // PERCENT
    differ = (smaller + larger) * (100 - PERCENT) // (100 + PERCENT)
    return differ, differ + max(differ // 2, 4)


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles in order; fewer words than ``width`` are one shingle, none are none."""
    n = min(width, len(words))
    return np.unique(shingles(words, n) + np.uint64(width - n)) if n else words[:0]


def sketch_keys(own: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """Keys of a set's blocks in the sketch of a band, and q, the number that a linked set shares at least.

    Blocks without a shingle have no key, unless so few others are there that an empty one could be all that
    linked sets agree in.
    """
    differ, m = sketch_shape(band)
    block = ((own >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # ascending, as the set is
    starts = np.flatnonzero(np.diff(block, prepend=np.uint64(m)))
    parity = np.bitwise_xor.reduceat(mixed(own), starts)
    number, needed = block[starts], len(starts) - differ
    if needed < 1:
        empty = np.setdiff1d(np.arange(m, dtype=np.uint64), number)
        number, parity, needed = np.concatenate([number, empty]), np.concatenate([parity, np.zeros(len(empty), np.uint64)]), 1
    keys = mixed(parity ^ mixed(number + np.uint64(band << 40)))
    return keys >> np.uint64(16), needed  # 48 bits are enough for candidates, and shorter in a shuffle


def bit_sketch(own: np.ndarray) -> bytes:
    """Parity bits of a set, about three to eight times as many as shingles: each shingle flips one of them."""
    bits = 1 << int(3 * _bands[band_of(len(own))][1] + 63).bit_length()
    return np.packbits(np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def near_in_group(nodes: np.ndarray, components: np.ndarray, sizes: np.ndarray, sketches: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of different components whose sizes and sketches allow a link."""
    order = np.argsort(components, kind="stable")
    nodes, components, sizes = nodes[order], components[order], sizes[order].astype(np.int64)
    width = min(map(len, sketches))
    folded = np.zeros((len(order), width), np.uint8)
    for row, i in enumerate(order.tolist()):  # a sketch of twice as many bits is folded by a parity of its halves
        bits = np.frombuffer(sketches[i], np.uint8)
        folded[row] = np.bitwise_xor.reduce(bits.reshape(-1, width), 0)
    words, ends, out = folded.view(np.uint64), np.searchsorted(components, components, "right"), []
    for i in range(int(np.searchsorted(components, components[-1]))):
        rest = slice(int(ends[i]), None)
        distance = np.bitwise_count(words[rest] ^ words[i]).sum(1, dtype=np.int64)
        both = sizes[rest] + sizes[i]
        near = (distance * (100 + PERCENT) <= both * (100 - PERCENT)) & (100 * np.minimum(sizes[rest], sizes[i]) >= PERCENT * np.maximum(sizes[rest], sizes[i]))
        out += [(int(nodes[i]), int(n)) for n in nodes[rest][near]]
    return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j) to the pairs of each group that may be links, each pair once per task."""
    told: set[tuple[int, int]] = set()
    now, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            nodes, components, sizes, sketches = zip(*held)
            pairs = [p for p in near_in_group(np.array(nodes), np.array(components), np.array(sizes), list(sketches)) if p not in told]
            if pairs:
                if len(told) > TOLD:
                    told.clear()
                told.update(pairs)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["hub", "node"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "component", "size", "sketch")]
        for key, i, j, *row in zip(*columns):
            if (key, i, j) != now:
                yield from close()
                now, held = (key, i, j), []
            held.append(tuple(row))
    yield from close()


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    words = Words(texts)
    hashes = words.hashes
    for a, b in zip(words.first[:-1], words.first[1:]):
        yield shingle_set(hashes[a:b])


def _node(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, texts in blocks(batch.column("text").to_pylist()):
            sets = list(_sets(texts))
            yield pa.RecordBatch.from_arrays([
                batch.column("_key").slice(begin, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bit_sketch(s) if len(s) else None for s in sets], pa.binary())], names=["_key", "n_shingles", "node", "sketch"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: set[int] = set()
    for batch in batches:
        for _, texts in blocks(batch.column("text").to_pylist()):
            keys, nodes, needs, sizes = [], [], [], []
            for own in _sets(texts):
                if not len(own) or (node := _node(own)) in sent:
                    continue
                sent.add(node)
                band = band_of(len(own))
                found = [sketch_keys(own, band)]
                if band and len(own) <= (_bands[band][0] - 1) * 100 // PERCENT:  # as the larger set of a pair, too
                    k, q = sketch_keys(own, band - 1)
                    found.append((k, -q))
                for k, q in found:
                    keys.append(k)
                    nodes.append(node)
                    needs.append(q)
                    sizes.append(len(k))
            if keys:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), sizes)),
                    pa.array(np.repeat(np.array(needs, np.int32), sizes))], names=["key", "node", "needed"])


def candidate_blocks(docs: DataFrame) -> DataFrame:
    """(key, node, shared): the blocks of each set that it must be compared in; ``shared`` is its number of shared blocks.

    ``needed`` is negative for the sketch of a set as the larger one of a pair, so (node, needed) names a sketch.
    """
    sketches = docs.select("text").mapInArrow(_sketch, "key long, node long, needed int")
    of_key = Window.partitionBy("key")
    common = sketches.select(
        "*", F.count("*").over(of_key).alias("n"), F.min("node").over(of_key).alias("a"), F.max("node").over(of_key).alias("b")).where("a <> b")
    common = common.groupBy("node", "needed", "key").agg(F.max("n").alias("n"))  # a set may be sent by several tasks
    sketch = Window.partitionBy("node", "needed")
    ranked = common.select(
        "*", F.row_number().over(sketch.orderBy(F.col("n").desc(), "key")).alias("rank"), F.count("*").over(sketch).alias("shared"))
    return ranked.where(F.col("rank") >= F.abs("needed")).select("key", "node", F.col("shared").cast("int").alias("shared"))


def first_pairs(keyed: DataFrame) -> DataFrame:
    """(hub, node): each set with the most connected set of each of its blocks."""
    hubs = keyed.groupBy("key").agg(F.max(F.struct("shared", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub"))
    return join_splitting(keyed, hubs, "key").where("hub <> node").select("hub", "node").distinct()


def second_pairs(keyed: DataFrame, linked: DataFrame, tested: DataFrame, described: DataFrame) -> DataFrame:
    """(hub, node): the candidates in different components that may be links by their sketches and have not been compared."""
    rows = join_splitting(keyed, linked, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = rows.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n")).where("a <> b")
    rows = materialize(join_splitting(rows, open_keys.select("key", "n"), "key"), "jaccard-open")
    # Pairs of small groups are listed; the sets of large ones are compared in tasks, where a list would be quadratic.
    small = rows.where(F.col("n") <= LISTED)
    left, right = (small.select("key", F.col("node").alias(name), F.col("component").alias(f"_{name}")) for name in ("hub", "node"))
    listed = left.join(right, "key").where("_hub < _node").select("hub", "node")
    rows = rows.where(F.col("n") > LISTED)
    sketches = described.join(rows.select("node").distinct(), "node").groupBy("node").agg(F.min(F.struct("n_shingles", "sketch")).alias("s"))
    rows = join_splitting(rows, sketches.select("node", F.col("s.n_shingles").alias("size"), "s.sketch"), "node")
    parts = F.ceil(F.col("n") / PART)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    rows = rows.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "component", "size", "sketch")
    pairs = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_near, "hub long, node long")
    pairs = listed.unionByName(pairs).distinct()
    seen = tested.select("hub", "node").unionByName(tested.select(F.col("node").alias("hub"), F.col("hub").alias("node")))
    return pairs.join(seen, ["hub", "node"], "left_anti")


def verified(pairs: DataFrame, described: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The (u, v) of ``pairs`` (hub, node) that are links, by the texts of one document of each set.

    The texts go to the tasks of their hubs; a task holds one hub's set and streams the others past it. A hub with many
    partners is split by a part of the partners' hashes, and its text is sent to each part.
    """
    parts = 64
    pairs = pairs.withColumn("part", F.when(F.count("*").over(Window.partitionBy("hub")) > 4 * parts, F.pmod(F.xxhash64("node"), F.lit(parts))).otherwise(0))
    wanted = pairs.select(F.col("hub").alias("of"), "part", F.col("node").alias("of_node"), F.lit(1).alias("turn")).unionByName(
        pairs.select(F.col("hub").alias("of"), "part", F.col("hub").alias("of_node"), F.lit(0).alias("turn")).distinct())
    nodes = pairs.select(F.explode(F.array("hub", "node")).alias("node")).distinct()
    one = described.join(nodes, "node").groupBy("node").agg(F.min("row").alias("row"))
    texts = docs.select(_row(key).alias("row"), "text").join(one, "row").select("node", "text").dropDuplicates(["node"])
    rows = wanted.join(texts, wanted["of_node"] == texts["node"]).select("of", "part", "turn", "of_node", "text")
    rows = rows.repartition("of", "part").sortWithinPartitions("of", "part", "turn")
    return rows.mapInArrow(_compare, "u long, v long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hub, hub_set = None, None
    for batch in batches:
        of, turn, nodes = (batch.column(c).to_numpy() for c in ("of", "turn", "of_node"))
        found = []
        for begin, texts in blocks(batch.column("text").to_pylist()):
            for i, own in enumerate(_sets(texts), begin):
                if turn[i] == 0:
                    hub, hub_set = of[i], own
                elif of[i] == hub:
                    common = len(np.intersect1d(hub_set, own, assume_unique=True))
                    if 100 * common >= PERCENT * (len(hub_set) + len(own) - common):
                        found.append((int(hub), int(nodes[i])))
        if found:
            u, v = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def linked_documents(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id (the smallest key that links reach).

    Defined cases: null and empty texts, and texts of white space, have no shingles and are linked with nothing: their
    component is their own key; texts of one to four words have one shingle; equal texts are linked, and repeated
    rows get equal results; a null key is in its component but never its smallest, and alone it has a null component;
    an empty table gives an empty result. Columns other than the key and ``text`` are not read.
    """
    placed = _placed(docs, key)
    smallest = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("_key").alias("component_id"))
    placed = join_splitting(placed, smallest, "component", "left")
    return placed.select(
        F.col("_key").alias(key), "n_shingles", F.when(F.col("n_shingles") == 0, F.col("_key")).otherwise(F.col("component_id")).alias("component_id"))


def _row(key: str) -> Column:
    """Tells rows apart; equal for rows with the same key and text."""
    return F.xxhash64(F.col(key), F.col("text"))


def _placed(docs: DataFrame, key: str) -> DataFrame:
    """(_key, n_shingles, row, component) of each row; the component is a node, null without shingles."""
    kind = docs.schema[key].dataType.simpleString()
    described = docs.select(F.col(key).alias("_key"), _row(key).alias("row"), "text")
    described = materialize(_with_row(described, kind), "jaccard-sets")
    keyed = materialize(candidate_blocks(docs), "jaccard-blocks")
    tested = materialize(first_pairs(keyed), "jaccard-pairs")
    links = materialize(verified(tested, described, docs, key), "jaccard-links")
    linked = materialize(components(links), "jaccard-components")
    more = materialize(second_pairs(keyed, linked, tested, described), "jaccard-pairs")
    if not more.isEmpty():
        links = links.unionByName(materialize(verified(more, described, docs, key), "jaccard-links"))
        linked = materialize(components(links), "jaccard-components")
    return join_splitting(described, linked, "node", "left").select("_key", "n_shingles", "row", F.coalesce("component", "node").alias("component"))


def _with_row(rows: DataFrame, kind: str) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for out in _describe(iter([batch])):
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, batch.column("row").slice(at, out.num_rows)], names=["_key", "n_shingles", "node", "sketch", "row"])
                at += out.num_rows

    return rows.mapInArrow(describe, f"_key {kind}, n_shingles long, node long, sketch binary, row long")


def one_per_component(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The first row of each component by key (null last), with its columns; rows without shingles are all kept."""
    names = docs.columns
    placed = _placed(docs, key)
    order = F.struct(F.col("_key").isNull().alias("missing"), F.col("_key"), F.col("row"))
    first = placed.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first")).select("first.row", F.lit(True).alias("full"))
    bare = placed.where("component IS NULL").select("row", F.lit(False).alias("full")).distinct()
    kept = first.unionByName(bare).withColumnRenamed("row", "_of")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), _row(key).alias("_row"))
    rows = rows.join(kept, F.col("_row") == F.col("_of"))
    again = F.row_number().over(Window.partitionBy("_row").orderBy("full"))  # of equal rows one
    rows = rows.withColumn("_n", again).where("NOT full OR _n = 1")
    return rows.select(*[F.col(f"_doc.`{c}`").alias(c) for c in names])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component."""
    return linked_documents(table(spark, sf_dir, "documents"))
