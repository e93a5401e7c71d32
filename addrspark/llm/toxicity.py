"""Score texts for toxicity by a recurrent network over all overlapping windows.

The network (``gru``) is trained on a bounded sample of labelled rows. Labels are of whole texts, so the
windows of toxic texts are labelled first: byte strings of words that are much more
frequent in toxic texts than in others are looked up, and windows with a text's strongest ones are
taken as toxic, as are clean windows with such a word put in; other windows of toxic texts are left out. All windows of clean texts are clean. A text's
score is that of its worst window, brought to a probability by a logistic fit
on sample rows that the network has not seen.

Every text is scored whole, where it is: a narrow pass without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrspark.llm import gru
from addrspark.llm.tables import table
from addrspark.llm.words import Words, blocks, mixed

#: Most labelled rows of each kind that the network is fitted on, the most bytes of such a text, and windows of a clean one.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_BYTES, CLEAN_WINDOWS = 1200, 2000, 1 << 16, 6
TOXIC_WINDOWS = 8
#: Clean windows with a marked word put in, rounds and epochs of training.
IMPLANTS, ROUNDS, EPOCHS, RATE = 4000, 2, 3, 0.01
#: Lengths of the byte strings looked up, anywhere and at the beginning of words, how much more frequent they must be in toxic texts, and in what share of them.
STRINGS, BEGINNINGS, RATIO, SUPPORT = (4, 5, 6), (4, 5, 6, 7, 8), 20.0, 0.015
THRESHOLD = 0.3
BLOCK_BYTES = 1 << 22
FOLDS, HELD_OUT = 4, 2


def fold(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


class Tokens:
    """The tokens of a block of texts: words in lower case, long ones in pieces. ``first`` as in ``Words``."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        size = words.ends - words.starts
        pieces = -(-size // gru.TOKEN_BYTES)
        if (pieces > 1).any():
            part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            words.first = np.append(0, np.cumsum(pieces))[words.first]
            starts = np.repeat(words.starts, pieces) + part * gru.TOKEN_BYTES
            words.starts, words.ends = starts, np.minimum(np.repeat(words.ends, pieces), starts + gru.TOKEN_BYTES)
        self.first = words.first
        hashes = words.hashes
        order = np.argsort(hashes)
        new = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
        self.ids = np.empty(len(order), np.int64)
        self.ids[order] = np.cumsum(new) - 1
        at = order[new]
        hashes = hashes[at]
        self.buckets = (hashes >> np.uint64(64 - 12)).astype(np.int64)
        column = np.arange(gru.TOKEN_BYTES)
        data = np.append(words.data, np.zeros(gru.TOKEN_BYTES, np.uint8))
        self.chars = data[words.starts[at][:, None] + column] * (column < (words.ends - words.starts)[at][:, None])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of token ids, -1 for none, and the text of each row; texts without tokens have none."""
        n = np.diff(self.first)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - gru.WINDOW) // gru.STRIDE)), 0)
        text = np.repeat(np.arange(len(n)), count)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * gru.STRIDE
        at = (self.first[:-1][text] + begin)[:, None] + np.arange(gru.WINDOW)
        inside = at < self.first[1:][text][:, None]
        return np.where(inside, self.ids[np.minimum(at, max(0, len(self.ids) - 1))] if len(self.ids) else -1, -1), text


def _strings(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte strings and beginnings of the tokens, and the token of each."""
    hashes, owners = [], []
    for n, anchored in [(n, False) for n in STRINGS] + [(n, True) for n in BEGINNINGS]:
        places = 1 if anchored else gru.TOKEN_BYTES - n + 1
        h = np.full((len(chars), places), 2 * n + anchored, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + chars[:, k : k + places]
        real = chars[:, n - 1 : n - 1 + places] > 0
        hashes.append(mixed(h[real]))
        owners.append(np.nonzero(real)[0])
    return np.concatenate(hashes), np.concatenate(owners)


def marked_tokens(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """For each distinct token, the number of toxic texts with a string of it that is much more frequent there; 0 if it has none."""
    hashes, owners = _strings(tokens.chars)
    names, string = np.unique(hashes, return_inverse=True)
    order = np.argsort(owners, kind="stable")
    string, bounds = string[order], np.searchsorted(owners[order], np.arange(len(tokens.chars) + 1))
    counts = np.zeros((2, len(names)))
    for i in range(len(toxic)):
        own = np.unique(tokens.ids[tokens.first[i] : tokens.first[i + 1]])
        if len(own):
            counts[int(toxic[i]), np.unique(np.concatenate([string[bounds[t] : bounds[t + 1]] for t in own]))] += 1
    rate = counts / np.maximum(1, [[(~toxic).sum()], [toxic.sum()]])
    needed = max(2, SUPPORT * toxic.sum())
    marks = (counts[1] >= needed) & (rate[1] >= RATIO * (rate[0] + 0.25 / max(1, (~toxic).sum())))
    strength = np.zeros(len(tokens.chars))
    np.maximum.at(strength, owners[order], np.where(marks, counts[1], 0)[string])
    return strength


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    def worst(self, texts: list[bytes]) -> np.ndarray:
        """The largest logit of each text's windows; a text without words has that of an empty window."""
        tokens = Tokens(texts)
        inputs = gru.token_inputs(self.weights, tokens.chars, tokens.buckets)
        windows, text = tokens.windows()
        out = np.full(len(texts), np.float32(self.weights["o_b"][0]) - 8, np.float32)
        if len(windows):
            windows = np.where(windows < 0, len(inputs) - 1, windows)
            logits = gru.window_logits(self.weights, inputs, windows)
            starts = np.flatnonzero(np.diff(text, prepend=-1))
            out[text[starts]] = np.maximum.reduceat(logits, starts)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        logit = self.slope * self.worst(texts).astype(np.float64) + self.shift
        return 0.5 * np.tanh(0.5 * logit) + 0.5


def fit(texts: list[bytes], toxic: np.ndarray, seed: int = 5) -> Model:
    """Train on two thirds of the rows, bring scores to probabilities on the others."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Model(gru.initial(seed), 0.0, -3.0 if not toxic.any() else 3.0)  # nothing to learn from
    rng = np.random.default_rng(seed)
    hold = rng.permutation(len(texts)) % 3 == 0
    own = np.flatnonzero(~hold)
    tokens, labels = Tokens([texts[i] for i in own]), toxic[own]
    windows, text = tokens.windows()
    marked = marked_tokens(tokens, labels)
    found = np.where(windows >= 0, marked[windows], 0)
    most = np.zeros(len(own))
    np.maximum.at(most, text, found.max(1))
    strong = (found > 0) & (2 * found >= most[text][:, None])  # a text's strongest marks
    if not (strong.any(1) & labels[text]).any():
        strong = windows >= 0
    toxic_at = _some(np.flatnonzero(labels[text] & strong.any(1)), text, rng.random(len(text)), TOXIC_WINDOWS)
    clean_at = np.flatnonzero(~labels[text])
    # Marked words alone in clean windows: only they are what toxic windows have in common.
    source, base = rng.choice(toxic_at, IMPLANTS), windows[rng.choice(clean_at, IMPLANTS)].copy()
    row, place = np.arange(IMPLANTS), np.argmax(strong[source] * rng.random((IMPLANTS, gru.WINDOW)), 1)
    base[row, (rng.random(IMPLANTS) * (base >= 0).sum(1)).astype(np.int64)] = windows[source, place]
    toxic_windows = np.concatenate([windows[toxic_at], base])
    model, rank, start = Model(gru.initial(seed)), rng.random(len(text)), None
    per_text = max(CLEAN_WINDOWS, 2 * IMPLANTS // max(1, int((~labels).sum())))
    for _ in range(ROUNDS):  # first on any windows of clean texts, then on those that look worst
        clean = windows[_some(clean_at, text, rank, per_text)]
        target = np.append(np.ones(len(toxic_windows)), np.zeros(len(clean)))
        model.weights = start = gru.trained(
            tokens.chars, tokens.buckets, np.concatenate([toxic_windows, clean]), target, epochs=EPOCHS, rate=RATE if start is None else RATE / 2,
            seed=seed, start=start)
        inputs = gru.token_inputs(start, tokens.chars, tokens.buckets)
        rank = np.zeros(len(text))
        rank[clean_at] = -gru.window_logits(start, inputs, np.where(windows[clean_at] < 0, len(inputs) - 1, windows[clean_at]))
    rest = np.flatnonzero(hold)
    logits = np.concatenate([model.worst(block) for _, block in blocks_of([texts[i] for i in rest])]) if len(rest) else np.zeros(0)
    model.slope, model.shift = _logistic(logits.astype(np.float64), toxic[rest])
    return model


def _some(at: np.ndarray, text: np.ndarray, rank: np.ndarray, limit: int) -> np.ndarray:
    """Of the windows ``at``, the ``limit`` of each text with the lowest rank."""
    at = at[np.lexsort((rank[at], text[at]))]
    return at[np.arange(len(at)) - np.searchsorted(text[at], text[at]) < limit]


def blocks_of(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    size, block, begin = 0, [], 0
    for i, text in enumerate(texts):
        block.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            yield begin, block
            size, block, begin = 0, [], i + 1
    if block:
        yield begin, block


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit, drawn a little towards 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 0.5 * np.tanh(0.5 * (a * x + b)) + 0.5
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + 0.1 * b])
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -2, 2)
    return float(max(a, 0.05)), float(b)


def fitted(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "toxic") -> Model:
    """A model from the labelled rows outside the held-out fold, at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` of them.

    They are those with the lowest hashes of their keys. Null keys and labels are left out, of several labels of a key
    the highest counts, of several rows of a key the one with the lowest hash of its text, and texts over ``SAMPLE_BYTES`` are
    not learned from.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(F.col(key)) != HELD_OUT))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    parts = [known.where(kind).orderBy(F.xxhash64("_key"), "_key").limit(n) for kind, n in (("_label = 1", TOXIC_ROWS), ("_label <> 1", CLEAN_ROWS))]
    chosen = parts[0].unionByName(parts[1])  # a bounded table
    rows = docs.select(F.col(key).alias("_key"), "text").where(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "_key")
    # A key may stand in many rows of docs: one counts, so that the keys alone bound the rows and none displaces others.
    rows = rows.groupBy("_key").agg(F.min(F.struct(F.xxhash64("text").alias("_hash"), "text", "_label")).alias("_row")).select("_key", "_row.*")
    rows = rows.orderBy(F.xxhash64("_key"), "_key").limit(TOXIC_ROWS + CLEAN_ROWS)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("toxic", pa.bool_())]))
        model = fit([t.encode() for t in table.column("text").to_pylist()], np.array(table.column("toxic").to_pylist(), bool))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # One task trains on the bounded sample; the model, some hundred KB, comes to the driver.
    rows = rows.select("text", (F.col("_label") == 1).alias("toxic")).repartition(1)
    found = rows.mapInArrow(train, "model binary").first()
    return pickle.loads(found["model"]) if found else fit([], np.zeros(0, bool))  # without rows there may be no task


def scored(docs: DataFrame, model: Model, *, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: key, held_out, score, predicted.

    Defined cases: null and empty texts, and texts of white space, get the score of no words; a null key counts as the
    empty text for its fold; equal texts get equal scores; an empty table gives an empty result. Columns other than the
    key and ``text`` are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), (fold(F.col(key)) == HELD_OUT).alias("held_out"), "text")
    kind = rows.schema["_key"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks((t.as_py() for t in batch.column("text")), BLOCK_BYTES):
                scores = model.scores(texts)
                own = [batch.column(c).slice(begin, len(texts)) for c in ("_key", "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["_key", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, f"_key {kind}, held_out boolean, score double, predicted int").withColumnRenamed("_key", key)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their scores."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fitted(docs, table(spark, sf_dir, "labels")))
