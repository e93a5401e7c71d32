"""Runs: stretches of consecutive words that repeat one period at least four times.

A run of period q from word s to word e is the pair of its suffixes at s and s + q: they have
e - s - q words in common, the words before them differ, and so do the words after. Such a
pair of equal stretches that cannot be made longer on either side is a maximal pair. So the runs are the
maximal pairs whose distance q is short against their common length l: l + q >= max(6, 4 * q).
Multiples of a period give pairs with the same ends; the least distance is the period.

The maximal pairs come from the tree of LCP intervals, visited bottom-up from the sorted suffixes of a text.
Suffixes of different children of an interval have exactly its l words in common; they are a maximal pair if they are of
different classes by the word on their left. The list of an interval is merged from those of its children, small
ones into large ones, and each suffix of the smaller list looks up the other list within l / 3 words only, as no
farther one can be of a run. Within such a distance all occurrences of l words are multiples of their period
apart, so all but the first have the same word on their left: on the left of a suffix only the farthest one
in reach can be of another class, and on its right all are of one. So no list is walked through, and lists
are kept in order of position, with the classes beside them. Nothing is extended word by word.

Before that, texts are narrowed down with a few passes of numpy over a block of texts: only texts with
the same five words twice have suffixes to sort, and only groups of suffixes whose least distance allows a run
are visited one by one. Words are told apart by their bytes (a dictionary), not by hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from addrspark.llm.tables import table
from addrspark.llm.words import Words, blocks

#: A run has at least so many words, and so many times its period.
LEAST = 6
TIMES = 4
#: Fewest words that two suffixes of a run have in common: LEAST - 1 at period 1, (TIMES - 1) * 2 at period 2.
COMMON = 5

SCHEMA = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "runs array<struct<start:long,length:long,period:long>>"
)


class Run(NamedTuple):
    start: int
    length: int
    period: int


def word_ids(words: Words) -> np.ndarray:
    """A number for every word of a block of texts; equal words have equal numbers."""
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    data = words.data[np.cumsum(inside[:-1]).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return array.dictionary_encode().indices.to_numpy().astype(np.int64)


def repeating(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks the texts in which some ``COMMON`` consecutive words come twice, by hashes: none is missed."""
    n = len(ids) - COMMON + 1
    marked = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, bool)
    if n <= 0:
        return marked
    h = (doc[:n] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(COMMON):
        h = (h ^ (ids[k : k + n].astype(np.uint64) + np.uint64(k + 1))) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(31)
    h = h[doc[:n] == doc[COMMON - 1 :]]
    of = doc[:n][doc[:n] == doc[COMMON - 1 :]]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    marked[of[order][1:][same]] = True
    return marked


def sorted_suffixes(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, texts apart, and the ranks of all suffixes by their first 1, 2, 4, ... words.

    Prefix doubling; a round sorts only suffixes that are not alone in their group yet.
    """
    n = len(ids)
    key = doc * (int(ids.max(initial=0)) + 1) + ids
    suffixes = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[suffixes], prepend=-1))
    sizes = np.diff(starts, append=n)
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.repeat(starts, sizes)
    levels, k = [rank.astype(np.int32 if n < 1 << 31 else np.int64)], 1
    active = suffixes[np.repeat(sizes > 1, sizes)]
    while len(active):
        after = active + k
        follow = np.where(after < ends[active], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        old, new = np.flatnonzero(np.diff(group, prepend=-1)), np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(new, append=len(key))
        first = np.repeat(old, np.diff(old, append=len(key)))
        suffixes[group + np.arange(len(key)) - first] = active
        rank[active] = group + np.repeat(new, sizes) - first
        levels.append(rank.astype(levels[0].dtype))
        active = active[np.repeat(sizes > 1, sizes)]
        k *= 2
    return suffixes, levels


def common_words(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The number of words that the suffixes at ``a`` and ``b`` of the same texts have in common."""
    length = np.zeros(len(a), np.int64)
    for step in range(len(levels) - 1, -1, -1):
        at, to = a + length, b + length
        inside = np.maximum(at, to) < ends[a]
        equal = levels[step][np.minimum(at, len(ends) - 1)] == levels[step][np.minimum(to, len(ends) - 1)]
        length += np.where(inside & equal, 1 << step, 0)
    return length


def maximal_pairs(positions: list[int], common: list[int], left: Callable[[int], int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, l) with i < j: the maximal pairs of sorted suffixes whose distance is at most l / 3.

    ``common[k]`` is what the suffixes at ``positions[k]`` and ``positions[k + 1]`` have in common;
    ``left`` gives the class of a position, the word on its left.
    """
    open_intervals: list[tuple[int, list[int]]] = []  # (common words, positions of the children so far)

    def merged(a: list[int], b: list[int], length: int) -> Iterator[tuple[int, int, int]]:
        reach = length // (TIMES - 1)
        for p in b:
            at = bisect_left(a, p)
            before = bisect_left(a, p - reach, 0, at)
            if before < at and left(a[before]) != left(p):
                yield a[before], p, length
            if at < len(a) and a[at] <= p + reach and left(a[at]) != left(p):
                for other in a[at : bisect_right(a, p + reach, at)]:
                    yield p, other, length

    def join(a: list[int], b: list[int]) -> None:
        if b[0] > a[-1]:
            a.extend(b)
        elif 8 * len(b) > len(a):
            a.extend(b)
            a.sort()
        else:
            for p in b:
                insort(a, p)

    for k, p in enumerate(positions):
        node, below = [p], common[k] if k < len(common) else 0
        while open_intervals and open_intervals[-1][0] >= below and open_intervals[-1][0] > 0:
            length, held = open_intervals[-1]
            a, b = (held, node) if len(held) >= len(node) else (node, held)
            yield from merged(a, b, length)
            join(a, b)
            node = a
            open_intervals.pop()
            if length == below:
                break
        if below:
            open_intervals.append((below, node))


def runs_of(ids: np.ndarray, first: np.ndarray) -> list[list[Run]]:
    """The runs of each text, by start, then period; ``first[i] : first[i + 1]`` are the words of text i."""
    sizes = np.diff(first)
    out: list[list[Run]] = [[] for _ in sizes]
    marked = repeating(ids, np.repeat(np.arange(len(sizes)), sizes))
    chosen = np.flatnonzero(marked)
    if not len(chosen):
        return out
    ids = np.concatenate([ids[first[i] : first[i + 1]] for i in chosen])
    sizes = sizes[chosen]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    doc, ends = np.repeat(np.arange(len(sizes)), sizes), np.repeat(begin[1:], sizes)
    suffixes, levels = sorted_suffixes(ids, doc, ends)
    if len(levels) < 3:
        return out
    near = np.flatnonzero(levels[2][suffixes[1:]] == levels[2][suffixes[:-1]])  # four words in common
    common = np.zeros(len(suffixes), np.int64)  # of each suffix and the next
    common[near] = common_words(suffixes[near], suffixes[near + 1], ends, levels)
    deep = common >= COMMON
    edges = np.flatnonzero(np.diff(np.concatenate([[False], deep, [False]]).astype(np.int8)))
    low, high = edges[0::2], edges[1::2]  # suffixes low .. high of a group have COMMON words in common
    if not len(low):
        return out
    counts = high - low + 1
    of = np.repeat(np.arange(len(low)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    rows = np.arange(counts.sum()) - np.repeat(starts, counts) + np.repeat(low, counts)
    places = suffixes[rows]
    in_order = places[np.lexsort((places, of))]
    gaps = np.diff(in_order, prepend=0)
    gaps[starts] = len(ids)
    most = np.maximum.reduceat(np.where(deep[rows], common[rows], 0), starts)
    wanted = np.flatnonzero((TIMES - 1) * np.minimum.reduceat(gaps, starts) <= most)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[begin[:-1][sizes > 0]] = -1
    left = before.tolist().__getitem__ if len(wanted) else None
    periods: list[dict[tuple[int, int], int]] = [{} for _ in sizes]
    for g in wanted.tolist():
        a, b = int(low[g]), int(high[g])
        place = suffixes[a : b + 1].tolist()
        text = int(doc[place[0]])
        for i, j, length in maximal_pairs(place, common[a:b].tolist(), left):
            q = j - i
            if length + q >= max(LEAST, TIMES * q):
                stretch = (i - int(begin[text]), j + length - int(begin[text]))
                periods[text][stretch] = min(q, periods[text].get(stretch, q))
    for text, found in zip(chosen.tolist(), periods):
        out[text] = sorted((Run(a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r.start, r.period))
    return out


def longest(runs: list[Run]) -> Run | None:
    """The run that repeats its period most often; then the first, then the one of the least period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Marks words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for run in runs:
        change[run.start + run.period] += 1
        change[run.start + run.length] -= 1
    return np.cumsum(change[:n]) == 0


def described(text: bytes, words: list[bytes] | None, runs: list[Run]) -> tuple:
    """The values of SCHEMA; ``words`` are None if they are the text's own."""
    best = longest(runs)
    words = text.split() if words is None else words  # bytes are split at the same white space
    if runs:
        words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
    lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    numbers = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
    return (len(runs), *numbers, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
            [r._asdict() for r in runs])


#: From the key and the number of words of a text: the place of the original word that comes at each place, or None for all as they are.
Order = Callable[[int | None, int], "np.ndarray | None"]


def periodic_runs(docs: DataFrame, order: Order | None = None, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_runs, the run with most repeats, digests of all runs and of the text without repeats, and ``runs``.

    Defined cases: null and empty texts, and texts of white space, have no runs (four nulls, digests of nothing); a null key
    is passed to ``order`` as None; rows are worked on one by one, so repeated rows give repeated results; an empty table
    gives an empty result. A text is a unit of one task, whatever its length; texts are worked on in blocks of
    2 MB. Columns other than the key and ``text`` are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.struct([(c, pa.int64()) for c in Run._fields]))]
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key").to_pylist()
            for begin, texts in blocks(batch.column("text").to_pylist()):
                words = Words(texts, lower=False)
                ids, first, changed = word_ids(words), words.first, {}
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    places = order(keys[begin + i], b - a) if order else None
                    if places is not None:
                        ids[a:b] = ids[a:b][places]
                        own = texts[i].split()
                        changed[i] = [own[p] for p in places.tolist()]
                rows = [described(texts[i], changed.get(i), runs) for i, runs in enumerate(runs_of(ids, first))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(begin, len(texts)), *[pa.array(v, t) for v, t in zip(zip(*rows), types)]], names=["_key", *names])

    found = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("text")).mapInArrow(find, f"_key {kind}, {SCHEMA}")
    return found.select(F.col("_key").alias(key), *names)


def without_repeats(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key and text without the words that repeat a run's first period, joined by single spaces."""
    kind = docs.schema[key].dataType.simpleString()

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks(batch.column("text").to_pylist()):
                words = Words(texts, lower=False)
                out = []
                for text, runs in zip(texts, runs_of(word_ids(words), words.first)):
                    own = text.split()
                    out.append(b" ".join(own[i] for i in np.flatnonzero(kept_words(len(own), runs)).tolist()).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(begin, len(texts)), pa.array(out, pa.string())], names=["_key", "text"])

    found = docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("text")).mapInArrow(collapse, f"_key {kind}, text string")
    return found.select(F.col("_key").alias(key), "text")


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words that the query asks for: the words of every tenth hash repeat from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents."""
    return periodic_runs(table(spark, sf_dir, "documents"), repeated_tail).drop("runs")
