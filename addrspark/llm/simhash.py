"""Near copies by SimHash fingerprints that differ in few bits, found with BK-trees.

A fingerprint has a bit set if over half of the hashes of a text's shingles have it. Equal fingerprints are one node from the
first step on, so copies cost nothing more.

Shards. Two fingerprints that differ in at most ``RADIUS`` of 64 bits agree in one of ``RADIUS + 1`` blocks of bits; all
fingerprints with the same value of a block are a shard. A shard of more than ``SHARD`` fingerprints is
divided again by the bits that its block leaves open, in the same way: those that are linked agree in one of three blocks of
these, too. The open bits become a third fewer each time, so every shard ends up within the bound, however alike
fingerprints are, and no link is lost.

Trees. A shard's fingerprints go to one task, which keeps them in a BK-tree: a child hangs on the edge that is its
distance from the parent. By the triangle inequality a search within the radius follows only edges that differ from
the distance to the node by the radius at most. Each fingerprint is looked up, then put in. A shard tells only links that connect what
was not connected in it before, so it tells fewer links than it has fingerprints, and the components are
those of all links.

The trees as a whole grow with the documents, so they are not broadcast to every task: a tree goes only to where the
fingerprints of its shard are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.llm.components import components
from addrspark.llm.tables import table
from addrspark.llm.words import blocks
from addrspark.operators.joins import join_splitting
from addrspark.shared import materialize

BITS = 64
RADIUS = 2
WIDTH = 3
SEED = 42
#: Fingerprints of a shard; of more, the shard is divided.
SHARD = 256
#: Shingles whose bits are counted at once.
COUNTED = 1 << 15


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of a text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and the six white space characters
    if not words:
        return 0
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, last = (ends - lengths).tolist(), ends[min(width, len(words)) - 1 :].tolist()
    counts, n = np.zeros(BITS, np.int64), len(last)
    for at in range(0, n, COUNTED):
        hashes = [xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in zip(starts[at : at + COUNTED], last[at : at + COUNTED])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


class BKTree:
    """Integers by their Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """The values within the radius; only edges within the radius of a node's distance are followed."""
        found, to_visit = [], [0] if self.values else []
        while to_visit:
            node = to_visit.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(self.values[node])
            edges = self.children[node]
            if len(edges) <= 2 * radius:
                to_visit += [child for edge, child in edges.items() if abs(edge - distance) <= radius]
            else:
                to_visit += [edges[edge] for edge in range(distance - radius, distance + radius + 1) if edge in edges]
        return found

    def add(self, value: int) -> None:
        node = 0
        while node < len(self.values):
            distance = (self.values[node] ^ value).bit_count()
            if not distance:
                return
            node = self.children[node].setdefault(distance, len(self.values))
        self.values.append(value)
        self.children.append({})


def shard_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links within a shard that connect all its linked values, without those that connect what others do."""
    tree, root, links = BKTree(), {}, []

    def top(v: int) -> int:
        while root[v] != v:
            root[v] = v = root[root[v]]
        return v

    for value in values:
        if value in root:
            continue
        root[value] = value
        for other in tree.near(value, radius):
            a, b = top(value), top(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((value, other))
        tree.add(value)
    return links


def divided(bits: list[int], parts: int = RADIUS + 1) -> list[list[int]]:
    """The bits in as many parts as can be told apart, each nearly as large as the others."""
    return [p.tolist() for p in np.array_split(np.array(bits, np.int64), parts) if len(p)]


def inner_masks(mask: int) -> list[int]:
    """The masks that take one part of the bits that ``mask`` leaves open, too; for 0 the first blocks."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part) for part in divided(open_bits)]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint of a shard that is divided (``mask``; 0 is all of them) in its smaller shards: the mask and the bits under it."""
    for batch in batches:
        masks, prints = (batch.column(c).to_numpy().view(np.uint64) for c in ("mask", "fp"))
        for mask in np.unique(masks).tolist():
            own = prints[masks == mask]
            for inner in inner_masks(mask):
                columns = np.full(len(own), inner, np.uint64), own & np.uint64(inner), own
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["mask", "value", "fp"])


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard to the links of each shard."""
    now, held = None, []
    sent: list[tuple[int, int]] = []

    for batch in batches:
        for mask, value, fp in zip(*[batch.column(c).to_pylist() for c in ("mask", "value", "fp")]):
            if (mask, value) != now:
                sent += shard_links(held)
                now, held = (mask, value), []
            held.append(fp % (1 << 64))
        if len(sent) >= 1 << 14:
            yield _links(sent)
            sent.clear()
    sent += shard_links(held)
    if sent:
        yield _links(sent)


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = (np.array(side, np.uint64).view(np.int64) for side in zip(*pairs))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def near_fingerprints(fingerprints: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """(u, v): links between different fingerprints (column ``fp``, long, distinct) that make the components of all links."""
    shard = max(shard, 1 << RADIUS)  # more than that have open bits for RADIUS + 1 parts
    rows, links = fingerprints.select(F.lit(0).cast("long").alias("mask"), "fp"), None
    while True:
        # Different ways to divide may lead to one mask: its shards are equal, and are sent once.
        rows = rows.mapInArrow(_shards, "mask long, value long, fp long").distinct()
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        of = F.struct("mask", "value").alias("of")
        sized = join_splitting(rows.select(of, "fp"), sizes.select(of, "n"), "of").select("of.mask", "of.value", "fp", "n")
        sized = materialize(sized, "simhash-shards")
        small = sized.where(F.col("n") <= shard).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        found = small.mapInArrow(_told, "u long, v long")
        links = found if links is None else links.unionByName(found)
        rows = sized.where(F.col("n") > shard).select("mask", "fp")
        if rows.isEmpty():
            return links


def near_copies(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, fingerprint (16 hexadecimal digits), component_id (the smallest key that links reach).

    Defined cases: null and empty texts, and texts of white space, have the fingerprint zero, which is linked like any other; a text
    of one or two words has the hash of its words; rows with equal texts have equal fingerprints, repeated rows equal results; a null key is
    in its component but never its smallest, and where all keys of a component are null, so is its component_id; an
    empty table gives an empty result. The length of a text does not matter: its shingles are counted in pieces. Columns other than
    the key and ``text`` are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks(batch.column("text").to_pylist()):
                prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("_key").slice(begin, len(texts)), pa.array(prints)], names=["_key", "fp"])

    rows = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("text")).mapInArrow(describe, f"_key {kind}, fp long")
    rows = materialize(rows, "simhash-prints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("_key").alias("least")), "simhash-nodes")
    links = materialize(near_fingerprints(nodes.select("fp")), "simhash-links")
    linked = components(links).withColumnRenamed("node", "fp")
    placed = nodes.join(linked, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    placed = materialize(placed, "simhash-components")
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_splitting(placed, smallest, "component").select("fp", "component_id")
    return join_splitting(rows, named, "fp").select(
        F.col("_key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and component."""
    return near_copies(table(spark, sf_dir, "documents"))
