"""Quality rules by an isolation forest on rule statistics.

Each document gets the statistics that quality rules look at: word count, word
length, symbols, repeated lines and words, and shares of capitals, marks and digits. Two
plain rules come first (too few words, too much repetition). The others are left to an
isolation forest: trees of random splits, in which an odd document is alone after few
splits. Statistics that tell good rows from bad ones better are drawn more often for a
split. Its anomaly score is 2 to the power of minus its mean path length over the expected
one. The threshold is the one that finds most of the bad among all that reject at most
``MAX_FALSE`` of the good.

All labelled rows count, none is a sample: one half of them, by a hash of the key, is dealt out
to the trees and gives the weights of the statistics, the other half gives the threshold. Bad rows
must be few to be isolated early, so they weigh less in a tree. A tree is grown in one task, from
its share of the rows. The trees, and counts by bins of the score, reach the driver;
documents are scored where they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.llm.running import running
from addrspark.llm.tables import table
from addrspark.llm.words import Words, blocks, mixed, shingles
from addrspark.shared import materialize

MIN_WORDS = 50
#: Percent of the words that may stand in repeated three-word windows.
MAX_REPEATED = 50
#: Share of the good sample rows that the calibrated threshold may reject.
MAX_FALSE = 0.002
#: Share of bad rows, by weight, among those that trees are grown on: they must be few to be isolated early.
CONTAMINATION = 0.015
#: Trees, the rows that each has at least (if there are so many), and levels of splits.
TREES, TREE_ROWS, DEPTH = 128, 256, 8
#: Bins of scores from 0 to 1, in which the rows for the threshold are counted.
BINS = 1 << 16
FEATURES = tuple(f"f{i}" for i in range(8))

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_bytes", "n_capitals", "n_marks", "n_digits", "n_mark_words", "n_lines")
STATISTICS = BASE + EXTRA


def _lookup(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _lookup(b"#*$%&|<>")
_CAPITAL = _lookup(bytes(range(65, 91)))
_DIGIT = _lookup(b"0123456789")
_MARK = _lookup(b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~")
_SPACE = _lookup(b" \t\n\v\f\r")


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The statistics of a block of texts."""
    words = Words(texts, lower=False)
    data, n = words.data, len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[words.offsets[1:]] - sums[words.offsets[:-1]]

    repeated = np.zeros(len(words.starts), bool)
    triples = shingles(words.hashes, 3)
    doc = words.doc
    if len(triples):
        same = doc[:-2] == doc[2:]
        at = np.flatnonzero(same)
        keyed = mixed(triples[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keyed, kind="stable")
        equal = keyed[order[1:]] == keyed[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        hits = at[twice]
        for k in range(3):
            repeated[hits + k] = True
    marked_word = np.zeros(len(words.starts), bool)
    if len(words.starts):
        marked_word = _MARK[data[words.ends - 1]]
    by_word = lambda flags: np.bincount(doc[flags], minlength=n)
    dup_lines, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        full = [line for line in text.split(b"\n") if line and not line.isspace()]
        lines[i], dup_lines[i] = len(full), len(full) - len(set(full))
    return {
        "n_words": np.diff(words.first), "word_chars": per_text(~_SPACE[data] & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOL[data]),
        "n_dup_lines": dup_lines, "n_repeat_words": by_word(repeated), "n_bytes": np.diff(words.offsets) - 1,
        "n_capitals": per_text(_CAPITAL[data]), "n_marks": per_text(_MARK[data]), "n_digits": per_text(_DIGIT[data]),
        "n_mark_words": by_word(marked_word), "n_lines": lines,
    }


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEATED * s["n_words"])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Shares, which do not grow with the length of a text; one row per text.."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    shares = [
        s["n_symbols"] / words, s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_repeat_words"] / words, s["n_capitals"] / chars,
        s["n_marks"] / chars, s["n_digits"] / chars, s["n_mark_words"] / words,
    ]
    return np.column_stack([np.log(chars / words), *[np.minimum(share, 1.0) for share in shares]])


def separation(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """How well each feature alone tells good rows from bad: from 0, not at all, to 1; ties count half."""
    n_good, n_bad = int(good.sum()), int((~good).sum())
    if not n_good or not n_bad:
        return np.ones(x.shape[1])
    out = []
    for column in x.T:
        fine, odd = np.sort(column[good]), column[~good]
        below = (np.searchsorted(fine, odd, "left") + np.searchsorted(fine, odd, "right")) / 2
        out.append(abs(2 * below.mean() / n_good - 1))
    return np.array(out)


@dataclass
class Forest:
    """Trees as heaps: the children of node i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    split: np.ndarray
    length: np.ndarray
    expected: float
    threshold: float = np.inf
    #: The labelled rows that it was grown and calibrated on.
    rows: int = 0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length) of each row."""
        out = np.empty(len(x))
        trees = np.arange(len(self.feature))[None, :]
        for begin in range(0, len(x), 4096):
            part = x[begin : begin + 4096]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                feature = self.feature[trees, node]
                inner = feature >= 0
                value = part[np.arange(len(part))[:, None], np.maximum(feature, 0)]
                node = np.where(inner, 2 * node + 1 + (value >= self.split[trees, node]), node)
            out[begin : begin + len(part)] = 2.0 ** (-self.length[trees, node].mean(1) / self.expected)
        return out


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random binary tree of n keys."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grown(x: np.ndarray, odd: np.ndarray, weight: float, weights: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree on the rows of ``x`` as arrays by node: feature, split, length. ``odd`` rows count ``weight`` each."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature, split, length = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
    waiting = [(0, 0, np.arange(len(x)))]
    while waiting:
        node, depth, own = waiting.pop()
        low, high = x[own].min(0), x[own].max(0)
        usable = np.flatnonzero(high > low)
        mass = len(own) - int(odd[own].sum()) * (1 - weight)
        length[node] = depth + _average_path(mass)
        if depth == DEPTH or mass < 2 or not len(usable):
            continue
        f = rng.choice(usable, p=weights[usable] / weights[usable].sum())
        feature[node], split[node] = f, rng.uniform(low[f], high[f])
        right = x[own, f] >= split[node]
        waiting += [(2 * node + 1, depth + 1, own[~right]), (2 * node + 2, depth + 1, own[right])]
    return feature, split, length


def _no_trees() -> Forest:
    nodes = 2 ** (DEPTH + 1) - 1
    return Forest(np.full((TREES, nodes), -1), np.zeros((TREES, nodes)), np.zeros((TREES, nodes)), 1e-9)


def grow(x: np.ndarray, weights: np.ndarray, seed: int = 11) -> Forest:
    """A forest on the rows of ``x``; each tree takes ``TREE_ROWS`` of them, each split a feature drawn by ``weights``."""
    rng, forest = np.random.default_rng(seed), _no_trees()
    rows = min(TREE_ROWS, len(x))
    forest.expected = float(max(_average_path(rows), 1e-9))
    for t in range(TREES if rows else 0):
        own = x[rng.choice(len(x), rows, replace=False)]
        forest.feature[t], forest.split[t], forest.length[t] = _grown(own, np.zeros(rows, bool), 1.0, weights, rng)
    return forest


def calibrated(x: np.ndarray, good: np.ndarray, seed: int = 11) -> Forest:
    """As ``fitted``, for some rows in memory: grow on one half of them, set the threshold on the other.

    Without rows of both kinds in each half the threshold rejects nothing.
    """
    half = np.random.default_rng(seed).permutation(len(x)) % 2 == 0
    ok, bad = np.flatnonzero(half & good), np.flatnonzero(half & ~good)
    few = np.random.default_rng(seed + 1).permutation(bad)[: max(1, int(len(ok) * CONTAMINATION / (1 - CONTAMINATION)))]
    weights = separation(x[half], good[half]) ** 4 + 0.001
    forest = grow(x[np.concatenate([ok, few])], weights, seed)
    if len(ok) and len(bad) and (~half & good).any() and (~half & ~good).any():
        scores = forest.scores(x)
        fine, odd = np.sort(scores[~half & good]), scores[~half & ~good]
        allowed = int(MAX_FALSE * len(fine))
        lowest = fine[len(fine) - 1 - allowed]
        # Between the last good row that stays and the first bad row beyond it.
        beyond = odd[odd > lowest]
        forest.threshold = float((lowest + beyond.min()) / 2) if len(beyond) else float(lowest)
    return forest


def _blocks_of(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    for begin, texts in blocks(batch.column(name).to_pylist()):
        yield begin, begin + len(texts), statistics(texts)


def _labelled(docs: DataFrame, labels: DataFrame, sample: int | None, key: str) -> DataFrame:
    """The features of the labelled rows that pass the base rules: ``_good``, ``_draw`` (a hash of the key) and ``FEATURES``."""
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_quality"))
    if sample is not None:
        known = known.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.xxhash64("text").alias("_hash"), "text")
    kind, others = rows.schema["_key"].dataType.simpleString(), ("_key", "_hash")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, s in _blocks_of(batch, "text"):
                keep = np.flatnonzero(~base_failed(s))
                own = [batch.column(c).slice(begin, end - begin).take(pa.array(keep)) for c in others]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(c) for c in features(s)[keep].T]], names=[*others, *FEATURES])

    # Texts are measured before the join, so that only numbers are shuffled.
    rows = rows.mapInArrow(measure, f"_key {kind}, _hash long, " + ", ".join(f"{c} double" for c in FEATURES)).join(known, "_key")
    # A key may stand in many rows of docs: one counts, so that the keys alone bound the rows and none displaces others.
    rows = rows.groupBy("_key").agg(F.min(F.struct("_hash", *FEATURES, "_quality")).alias("_row"))
    return rows.select((F.col("_row._quality") != 0).alias("_good"), F.xxhash64("_key", F.lit(7)).alias("_draw"), *[f"_row.{c}" for c in FEATURES])


def _separations(rows: DataFrame, n_good: int, n_bad: int) -> np.ndarray:
    """``separation`` of stored rows: good ones below each value, counted along the sorted values of a feature."""
    if not n_good or not n_bad:
        return np.ones(len(FEATURES))
    pairs = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("feature"), F.col(c).alias("value")) for i, c in enumerate(FEATURES)]))
    counts = rows.select("_good", pairs.alias("pair")).groupBy("pair.feature", "pair.value").agg(
        F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    ranks = running(counts, "feature", [F.col("value")], ["good"], 1, "quality-ranks")
    below = ranks.groupBy("feature").agg(F.sum(F.col("bad") * (2 * F.col("good_run") - F.col("good"))).alias("twice")).collect()  # a row per feature
    out = np.zeros(len(FEATURES))
    for row in below:
        out[row.feature] = abs(row.twice / n_good / n_bad - 1)
    return out


def _grown_apart(rows: DataFrame, n_good: int, n_bad: int, seed: int) -> Forest:
    """A forest on all of the stored rows, each of them in one tree at least; few rows are dealt to several trees."""
    forest = _no_trees()
    if not n_good + n_bad:
        return forest
    weights = _separations(rows, n_good, n_bad) ** 4 + 0.001
    weight = min(1.0, n_good * CONTAMINATION / (1 - CONTAMINATION) / max(n_bad, 1))
    times = min(TREES, -(-TREES * TREE_ROWS // (n_good + n_bad)))
    forest.expected = float(max(_average_path((n_good + weight * n_bad) * times / TREES), 1e-9))
    first, step = F.shiftrightunsigned("_draw", 8) % TREES, F.shiftrightunsigned("_draw", 16) % (TREES // 2) * 2 + 1  # odd: other trees each time
    dealt = rows.withColumn("_time", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    dealt = dealt.select("_good", *FEATURES, ((first + F.col("_time") * step) % TREES).cast("int").alias("tree"))

    def tree(frame):
        # In an order of their own, so that equal rows give equal trees.
        frame = frame.sort_values([*FEATURES, "_good"])
        t = int(frame["tree"].iloc[0])
        arrays = _grown(frame[list(FEATURES)].to_numpy(float), ~frame["_good"].to_numpy(bool), weight, weights, np.random.default_rng([seed, t]))
        return pd.DataFrame({"tree": [t], **{c: [a.tolist()] for c, a in zip(("feature", "split", "length"), arrays)}})

    grown = dealt.groupBy("tree").applyInPandas(tree, "tree int, feature array<int>, split array<double>, length array<double>")
    for row in grown.collect():  # TREES rows of bounded size
        forest.feature[row.tree], forest.split[row.tree], forest.length[row.tree] = row.feature, row.split, row.length
    return forest


def _threshold(rows: DataFrame, forest: Forest) -> float:
    """The score between the last good row that stays and the first bad row beyond it, both by their bins."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = forest.scores(np.column_stack([batch.column(c).to_numpy() for c in FEATURES]))
            bins = np.minimum((scores * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([batch.column("_good"), pa.array(bins)], names=["_good", "bin"])

    counts = rows.select("_good", *FEATURES).mapInArrow(scored, "_good boolean, bin long").groupBy("_good", "bin").count().collect()  # 2 * BINS at most
    found = np.zeros((2, BINS), np.int64)
    for row in counts:
        found[int(row._good), row.bin] = row["count"]
    odd, fine = found
    if not odd.any() or not fine.any():
        return np.inf
    above = np.cumsum(fine[::-1])[::-1]  # good rows in a bin or a higher one
    last = int(np.flatnonzero(above > int(MAX_FALSE * above[0]))[-1])
    beyond = np.flatnonzero(odd[last + 1:])
    return (2 * (last + 1) + (int(beyond[0]) if len(beyond) else 0)) / 2 / BINS


def fitted(docs: DataFrame, labels: DataFrame, *, sample: int | None = None, key: str = "doc_id", seed: int = 11) -> Forest:
    """A forest for ``docs`` from all labelled rows; ``sample``: from at most so many of them, by the lowest hashes of their keys.

    Labels that are null are left out; of several labels for a key the lowest counts, and of several rows that pass the
    base rules the one with the lowest hash of its text. Without rows of both kinds in each half the threshold rejects nothing.
    """
    rows = materialize(_labelled(docs, labels, sample, key), "quality-rows")
    grows = F.col("_draw") % 2 == 0
    counts = {(r.grows, r._good): r["count"] for r in rows.groupBy(grows.alias("grows"), "_good").count().collect()}
    forest = _grown_apart(rows.where(grows), counts.get((True, True), 0), counts.get((True, False), 0), seed)
    forest.rows = sum(counts.values())
    if len(counts) == 4:
        forest.threshold = _threshold(rows.where(~grows), forest)
    return forest


def judged(docs: DataFrame, forest: Forest, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, the base statistics, base_failed, anomaly and kept.

    Defined cases: null and empty texts have no words and fail the base rules; repeated rows are judged alike; a null
    key stays null; an empty table gives an empty result; texts of any length are read
    whole. Columns other than the key and ``text`` are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), "text")
    kind = rows.schema["_key"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, s in _blocks_of(batch, "text"):
                failed, scores = base_failed(s), forest.scores(features(s))
                arrays = [batch.column("_key").slice(begin, end - begin), *[pa.array(s[c].astype(np.int64)) for c in BASE], pa.array(failed),
                          pa.array(scores), pa.array(~failed & (scores <= forest.threshold))]
                yield pa.RecordBatch.from_arrays(arrays, names=["_key", *BASE, "base_failed", "anomaly", "kept"])

    schema = f"_key {kind}, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, anomaly double, kept boolean"
    return rows.mapInArrow(judge, schema).withColumnRenamed("_key", key)


def passing(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text = f"c{names.index('text')}"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, s in _blocks_of(batch, text):
                good = ~base_failed(s) & (forest.scores(features(s)) <= forest.threshold)
                yield batch.slice(begin, end - begin).filter(pa.array(good))

    return rows.mapInArrow(keep, rows.schema).toDF(*names)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their statistics and whether they are kept."""
    docs = table(spark, sf_dir, "documents")
    return judged(docs, fitted(docs, table(spark, sf_dir, "labels"))).drop("anomaly")
