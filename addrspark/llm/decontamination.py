"""Find benchmark passages in documents by spaced seeds.

A seed is a mask over a few consecutive words: positions marked 1 are hashed, the
others are ignored, so a changed word at an ignored position leaves the hash as it is. The masked
hashes of all documents' words are joined to those of the benchmark. Around each hit
the document and the benchmark item are laid over each other, word by word; the best
stretch (a match counts 1, a changed word -2) is verified: it must hold ``MIN_MATCHES`` equal words, or
``WHOLE`` percent of a shorter item. The masks are chosen so that each stretch that passes holds
one of them whole, however many of its words are changed.

A benchmark of at most ``BLOCK_WORDS`` words, which is checked first, is sent to the tasks, and documents are not
shuffled. A larger one stays a table: an array of bits of bounded size tells which seeds of documents it may hold, these are
joined to its seeds by a shuffle, and the words around hits to its words. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrspark.llm.tables import n_words, table, utf8_bytes
from addrspark.llm.words import Words, blocks, mixed
from addrspark.operators.joins import join_splitting
from addrspark.shared import materialize

#: Masks of items of ``LONG`` words or more, and of shorter ones. Every pattern of equal and changed words that passes the check
#: has a place where one of them meets equal words only; tests/llm/test_decontamination.py goes through all patterns.
MASKS = ("111010011", "111010100001", "11101100001", "11110101")
SHORT_MASKS = ("111011", "11111")
LONG = 10
MIN_MATCHES = 13
WHOLE = 80
MISMATCH = 2
#: Items with fewer words say too little and are not searched for.
MIN_ITEM = 6
#: Of a benchmark that is sent to the tasks, at most: words and items, and bytes for each of these.
BLOCK_WORDS, BLOCK_BYTES = 1 << 20, 32
#: Bits of the filter of a larger benchmark's seeds, and words laid over each other in one group of hits of a text.
FILTER_BITS, GROUP_WORDS = 1 << 26, 1 << 18
#: Hits, and words laid over each other, that are worked on at once.
HITS, WORDS = 1 << 20, 1 << 22


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """One hash per window of ``len(mask)`` words, of the words at marked positions."""
    n = len(hashes) - len(mask) + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for k, bit in enumerate(mask):
            if bit == "1":
                out = out * np.uint64(0xFF51AFD7ED558CCD) + hashes[k : k + n]
    return mixed(out)


class Benchmark:
    """The seeds of some items, in order of their hashes."""

    def __init__(self, item_ids: list[int], texts: list[bytes]):
        words = Words(texts)
        self.ids = np.array(item_ids, np.int64)
        self.hashes, self.first = words.hashes, words.first
        self.seeds: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: dict[str, list[tuple[np.ndarray, int]]] = {}
        for i, (a, b) in enumerate(zip(self.first[:-1], self.first[1:])):
            if b - a < MIN_ITEM:
                continue
            for mask in MASKS if b - a >= LONG else SHORT_MASKS:
                found.setdefault(mask, []).append((seed_hashes(self.hashes[a:b], mask), i))
        for mask, parts in found.items():
            keys = np.concatenate([h for h, _ in parts])
            items = np.concatenate([np.full(len(h), i) for h, i in parts])
            at = np.concatenate([np.arange(len(h)) for h, _ in parts])
            order = np.argsort(keys, kind="stable")
            # A small table of leading bits tells most hashes apart at once.
            bits = 1 << max(16, int(len(keys)).bit_length() + 4)
            seen = np.zeros(bits, bool)
            shift = np.uint64(64 - (bits.bit_length() - 1))
            seen[(keys >> shift).astype(np.int64)] = True
            self.seeds[mask] = (keys[order], np.column_stack([items[order], at[order]]), seen)

    def overlaps(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item_id, first word in the text, length, equal words) of each verified overlap; the best per pair."""
        words = Words(texts)
        hashes, doc = words.hashes, words.doc
        found = [np.zeros((0, 3), np.int64)]
        for mask, (keys, places, seen) in self.seeds.items():
            own = seed_hashes(hashes, mask)
            if not len(own):
                continue
            shift = np.uint64(64 - (len(seen).bit_length() - 1))
            at = np.flatnonzero(seen[(own >> shift).astype(np.int64)] & (doc[: len(own)] == doc[len(mask) - 1 :]))
            low, high = np.searchsorted(keys, own[at], "left"), np.searchsorted(keys, own[at], "right")
            for begin, end in _parts(high - low, HITS):
                row, n = _ragged(high[begin:end] - low[begin:end])
                item, offset = places[low[begin:end][row] + n].T
                place = at[begin:end][row]
                found.append(_distinct(np.column_stack([doc[place], item, place - offset])))
        hits = _distinct(np.concatenate(found))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for text, item, place in hits[self._may_pass(hits, hashes, words.first)].tolist():
            a, b = int(self.first[item]), int(self.first[item + 1])
            begin, end = max(place, int(words.first[text])), min(place + b - a, int(words.first[text + 1]))
            equal = hashes[begin:end] == self.hashes[a + begin - place : a + end - place]
            first, length, matches = best_stretch(equal)
            if matches >= MIN_MATCHES or 100 * matches >= WHOLE * (b - a):
                key, value = (text, item), (matches, begin + first - int(words.first[text]), length)
                best[key] = max(best.get(key, value), value)
        return [(text, int(self.ids[item]), first, length, matches) for (text, item), (matches, first, length) in sorted(best.items())]

    def _may_pass(self, hits: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether text and item have enough equal words, in one stretch or not, as each hit lays them over each other."""
        text, item, place = hits.T
        a, size = self.first[item], self.first[item + 1] - self.first[item]
        begin, end = np.maximum(place, first[text]), np.minimum(place + size, first[text + 1])
        equal = np.zeros(len(hits), np.int64)
        for low, high in _parts(end - begin, WORDS):
            row, n = _ragged(end[low:high] - begin[low:high])
            at = begin[low:high][row] + n
            same = hashes[at] == self.hashes[at + (a - place)[low:high][row]]
            equal[low:high] = np.bincount(row[same], minlength=high - low)
        return (equal >= MIN_MATCHES) | (100 * equal >= WHOLE * size)


def _parts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a sum of ``sizes`` of at most ``limit``; a larger row is a range of its own."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(sums, sums[begin] + limit, "right")) - 1)
        yield begin, end
        begin = end


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ``sizes`` entries: the row of each entry, and its number in the row."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _distinct(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort(rows.T)]
    return rows[np.append(True, (rows[1:] != rows[:-1]).any(1))[: len(rows)]]


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, length and matches of the stretch with the largest score."""
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums - low))
    begin = int(np.flatnonzero(sums[: end + 1] == low[end])[-1])
    return begin, end - begin, int(equal[begin:end].sum())


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")


def _block(items: DataFrame, block_words: int) -> Benchmark | None:
    """All items if these are at most ``block_words`` words and items, of ``BLOCK_BYTES`` bytes each on average; else None."""
    sizes = items.agg(F.sum(n_words() + 1), F.sum(utf8_bytes())).first()
    if (sizes[0] or 0) > block_words or (sizes[1] or 0) > block_words * BLOCK_BYTES:
        return None
    rows = items.orderBy("item_id", "text").collect()
    return Benchmark([row["item_id"] for row in rows], [row["text"].encode() for row in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row and benchmark item that overlap: key, item_id, first_word, n_span, n_equal.

    Defined cases: null and empty texts overlap with nothing, nor do items with a null id or text or with fewer than
    ``MIN_ITEM`` words; repeated rows give repeated results; of several overlaps of one
    document with one item the one with most equal words is told; an empty table gives an empty
    result. Columns other than the key and ``text`` are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), "text")
    items = _items(benchmark)
    block = _block(items, block_words)
    if block is not None:
        kind = rows.schema["_key"].dataType.simpleString()
        out = rows.mapInArrow(_search(block), f"_key {kind}, item_id long, first_word long, n_span long, n_equal long")
    else:
        keyed = rows.select("_key", _text_key())
        out = join_splitting(keyed, _overlaps_by_join(rows.select("text"), items), "_text").drop("_text")
    return out.withColumnRenamed("_key", key)


def _search(block: Benchmark):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks(batch.column("text").to_pylist()):
                if hits := block.overlaps(texts):
                    text, *rest = zip(*hits)
                    keys = batch.column("_key").take(pa.array([begin + t for t in text]))
                    yield pa.RecordBatch.from_arrays(
                        [keys, *[pa.array(x, pa.int64()) for x in rest]], names=["_key", "item_id", "first_word", "n_span", "n_equal"])

    return search


def clean(docs: DataFrame, benchmark: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, with their columns."""
    names = docs.columns
    items = _items(benchmark)
    block = _block(items, block_words)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    text = f"c{names.index('text')}"
    if block is not None:
        return rows.mapInArrow(_without(block, text), rows.schema).toDF(*names)
    found = _overlaps_by_join(rows.select(F.col(text).alias("text")), items).select("_text").distinct()
    return join_splitting(rows.withColumn("_text", _text_key(text)), found, "_text", "left_anti").drop("_text").toDF(*names)


def _without(block: Benchmark, name: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in blocks(batch.column(name).to_pylist()):
                good = np.ones(len(texts), bool)
                good[[hit[0] for hit in block.overlaps(texts)]] = False
                yield batch.slice(begin, len(texts)).filter(pa.array(good))

    return keep


# A benchmark of more than one block: nothing of it is collected but an array of FILTER_BITS bits.


def _text_key(name: str = "text") -> Column:
    """Equal texts have equal keys; null stays null."""
    return F.md5(F.col(name)).alias("_text")


def _seeds(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places where mask ``k`` lies within one text, and the seeds there; a seed is of one mask."""
    mask = (MASKS + SHORT_MASKS)[k]
    own = seed_hashes(hashes, mask)
    at = np.flatnonzero(doc[: len(own)] == doc[len(mask) - 1 :]) if len(own) else np.zeros(0, np.int64)
    return at, mixed(own[at] + np.uint64(k + 1))


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, seed, word at which it begins, words of the item) of each item of ``MIN_ITEM`` words or more."""
    for batch in batches:
        for begin, texts in blocks(batch.column("text").to_pylist()):
            words = Words(texts)
            hashes, doc, sizes = words.hashes, words.doc, np.diff(words.first)
            items = batch.column("_item").slice(begin, len(texts)).to_numpy(zero_copy_only=False)
            for k in range(len(MASKS + SHORT_MASKS)):
                at, seeds = _seeds(hashes, doc, k)
                size = sizes[doc[at]]
                good = (size >= LONG) if k < len(MASKS) else (size >= MIN_ITEM) & (size < LONG)
                at, seeds, size = at[good], seeds[good], size[good]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[doc[at]], pa.int64()), pa.array(seeds.view(np.int64)), pa.array(at - words.first[doc[at]], pa.int64()),
                     pa.array(size, pa.int64())], names=["_item", "_seed", "_offset", "_size"])


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """An array of ``FILTER_BITS`` bits, as 64-bit numbers, with the bits of all seeds set; its size does not grow with them."""
    bits = seeds.select(F.shiftrightunsigned("_seed", 64 - FILTER_BITS.bit_length() + 1).alias("b"))
    words = bits.select(F.expr("shiftrightunsigned(b, 6) AS word"), F.expr("shiftleft(1L, cast(b & 63L AS int)) AS bits"))
    rows = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def _document_seeds(seen):
    """(text, seed, place) of each seed of a document that the filter may hold."""
    shift = np.uint64(64 - FILTER_BITS.bit_length() + 1)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen.value
        for batch in batches:
            for begin, texts in blocks(batch.column("text").to_pylist()):
                words = Words(texts)
                hashes, doc = words.hashes, words.doc
                for k in range(len(MASKS + SHORT_MASKS)):
                    at, seeds = _seeds(hashes, doc, k)
                    b = seeds >> shift
                    good = (bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) == 1
                    at, seeds = at[good], seeds[good]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_text").take(pa.array(begin + doc[at])), pa.array(seeds.view(np.int64)),
                         pa.array(at - words.first[doc[at]], pa.int64())], names=["_text", "_seed", "_place"])

    return found


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, item, first word, words of the item before it, hashes of words) that each hit of a text lays an item over."""
    names = ["_text", "_item", "_begin", "_skip", "_own"]
    for batch in batches:
        for key, text, hits in zip(batch.column("_text"), batch.column("text"), batch.column("_hits")):
            hashes = Words([text.as_py().encode()]).hashes
            out = []
            for hit in hits.as_py():
                begin, end = max(hit["_start"], 0), min(hit["_start"] + hit["_size"], len(hashes))
                out.append((key.as_py(), hit["_item"], begin, begin - hit["_start"], hashes[begin:end].tobytes()))
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*out))})


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = [Words([text.encode()]).hashes.tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_item"), batch.column("item_id"), pa.array(hashes, pa.binary())], names=["_item", "item_id", "_words"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, item, item_id, first word, length, equal words) of the stretches that pass."""
    names = ["_text", "_item", "item_id", "first_word", "n_span", "n_equal"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            own, item = np.frombuffer(row["_own"], np.uint64), np.frombuffer(row["_words"], np.uint64)
            first, length, matches = best_stretch(own == item[row["_skip"] : row["_skip"] + len(own)])
            if matches >= MIN_MATCHES or 100 * matches >= WHOLE * len(item):
                out.append((row["_text"], row["_item"], row["item_id"], row["_begin"] + first, length, matches))
        if out:
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*out))})


def _overlaps_by_join(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The best overlap of each different text and item: ``_text``, item_id, first_word, n_span, n_equal.

    Seeds of texts that pass a filter of the benchmark's seeds are joined to these. The hits of a text are dealt out in groups
    of about ``GROUP_WORDS`` words, each laid over the text by one task; so a text with very many hits goes to many tasks.
    """
    spark = texts.sparkSession
    items = materialize(items.withColumn("_item", F.monotonically_increasing_id()), "benchmark")
    item_seeds = materialize(
        items.select("_item", "text").mapInArrow(_item_seeds, "_item long, _seed long, _offset long, _size long"), "benchmark-seeds")
    seen = spark.sparkContext.broadcast(_filter_of(item_seeds))
    keyed = texts.where("text IS NOT NULL").select(_text_key(), "text")
    own = keyed.mapInArrow(_document_seeds(seen), "_text string, _seed long, _place long").distinct()
    hits = join_splitting(own, item_seeds, "_seed").select("_text", "_item", (F.col("_place") - F.col("_offset")).alias("_start"), "_size")
    hits = materialize(hits.distinct(), "seed-hits")
    groups = hits.groupBy("_text").agg(F.ceil(F.sum("_size") / GROUP_WORDS).alias("_groups"))
    dealt = join_splitting(hits, groups, "_text").withColumn("_group", F.pmod(F.xxhash64("_item", "_start"), "_groups"))
    dealt = dealt.groupBy("_text", "_group").agg(F.collect_list(F.struct("_item", "_start", "_size")).alias("_hits"))
    # One row of each text that has hits: of the others, only the keys are compared.
    with_hits = join_splitting(keyed, groups.select("_text"), "_text", "left_semi").groupBy("_text").agg(F.first("text").alias("text"))
    laid = join_splitting(dealt, with_hits, "_text").select("_text", "text", "_hits")
    windows = laid.mapInArrow(_windows, "_text string, _item long, _begin long, _skip long, _own binary")
    words = items.mapInArrow(_item_words, "_item long, item_id long, _words binary")
    found = join_splitting(windows, words, "_item").mapInArrow(
        _verified, "_text string, _item long, item_id long, first_word long, n_span long, n_equal long")
    best = found.groupBy("_text", "_item", "item_id").agg(F.max(F.struct("n_equal", "first_word", "n_span")).alias("best"))
    return best.select("_text", "item_id", "best.first_word", "best.n_span", "best.n_equal")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All overlaps of documents with benchmark items."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
