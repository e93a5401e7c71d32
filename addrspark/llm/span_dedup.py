"""Remove byte strings that an earlier document has, by a sparse suffix array sorted deep-shallow.

Every string of ``LENGTH`` bytes has an anchor: the gram of ``GRAM`` bytes in it with the lowest
hash. Consecutive strings mostly share their anchor, so a text is covered by records,
each an anchor with the bytes of the strings around it. Equal strings have equal anchors
at the same place, so records meet by the hash of their anchor, and no string is sent twice.

1. Texts are dealt to blocks by a hash. Each block sends short hashes of its anchors to buckets, which
   answer with those that several documents have. All others are done with.
2. Each block cuts records at its anchors that are left. Those that are alike are merged: the smallest document's one
   goes on, the others are removed there and then, so a passage that a third of
   all documents share leaves a block once. In a bucket, the suffixes at each distance before the
   anchors are sorted (``suffixes.deep_shallow``), and of equal strings all but
   those of the smallest document are removed.
3. Each block cuts the removed spans out of its texts.

All three steps take their texts from the same shuffle. What goes between blocks and
buckets is packed and compressed. The numbers of blocks and buckets follow the bytes of the
input, so that each fits a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrspark.llm.suffixes import as_words, deep_shallow
from addrspark.llm.tables import table, utf8_bytes
from addrspark.llm.words import mixed

LENGTH = 50
GRAM = 16
#: Grams in a string, and the bytes around an anchor that its strings can reach.
GRAMS = LENGTH - GRAM + 1
BEFORE = GRAMS - 1
REACH = BEFORE + LENGTH
#: Text whose anchors are searched at once. A longer text is worked on in pieces of this size.
PIECE_BYTES = 1 << 20
#: Bytes of text per block and per bucket.
BLOCK_BYTES = 1 << 22
#: A missing doc_id counts as this one, the largest.
NO_ID = (1 << 63) - 1

RECORD = np.dtype([("doc", "<u4"), ("at", "<u4"), ("first", "u1"), ("end", "u1"), ("bytes", "u1", (REACH,))])
SPAN = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])


class Pieces:
    """Parts of texts (document, offset, bytes) with the anchors of all their strings.

    Run i of consecutive strings from ``start[i]`` to ``last[i]`` has the anchor at
    ``place[i]``, with hash ``hashes[i]``; these are positions in the joined bytes ``raw``.
    """

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        lengths = np.array([len(p) for _, _, p in pieces], np.int64)
        self.raw = raw = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
        n = len(raw) - LENGTH + 1
        if n <= 0:
            self.start = self.last = self.place = self.doc = self.base = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, np.uint64)
            return
        wide = raw.astype(np.uint64)
        for size in (1, 2, 4):
            wide = wide[:-size] | (wide[size:] << np.uint64(8 * size))
        hashes = mixed(wide[:-8] * np.uint64(0x9E3779B97F4A7C15) + mixed(wide[8:]))  # of the grams at all places
        # The lowest hash of each string, the first of equal ones: hash and place in one number.
        low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= GRAMS:
            low, size = np.minimum(low[:-size], low[size:]), 2 * size
        if size < GRAMS:
            low = np.minimum(low[: len(low) - (GRAMS - size)], low[GRAMS - size :])
        anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.cumsum(lengths)
        inside = np.repeat(ends, lengths)[:n] - np.arange(n) >= LENGTH
        changes = anchor[1:] != anchor[:-1]
        self.start = np.flatnonzero(inside & np.append(True, changes | ~inside[:-1]))
        self.last = np.flatnonzero(inside & np.append(changes | ~inside[1:], True))
        self.place = anchor[self.start]
        self.hashes = hashes[self.place]
        piece = np.searchsorted(ends, self.start, "right")
        self.doc = np.array([d for d, _, _ in pieces], np.int64)[piece]
        self.base = (np.array([o for _, o, _ in pieces], np.int64) - (ends - lengths))[piece]

    def records(self, chosen: np.ndarray) -> np.ndarray:
        """The records of some runs: ``at`` is the anchor's place in the document, ``bytes[first:end]`` are those of the strings."""
        place = self.place[chosen]
        out = np.zeros(len(chosen), RECORD)
        out["doc"], out["at"] = self.doc[chosen], place + self.base[chosen]
        out["first"], out["end"] = self.start[chosen] - place + BEFORE, self.last[chosen] - place + BEFORE + LENGTH
        if len(chosen):
            padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.raw, np.zeros(LENGTH, np.uint8)])
            column = np.arange(REACH, dtype=np.uint8)
            view = np.lib.stride_tricks.sliding_window_view(padded, REACH)[place]
            out["bytes"] = view * ((column >= out["first"][:, None]) & (column < out["end"][:, None]))
        return out


def pieces_of(texts: list[bytes]) -> Iterator[Pieces]:
    """The pieces of some texts, about ``PIECE_BYTES`` at a time. The pieces of a long text overlap by less than a string."""
    waiting, size = [], 0
    for doc, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, PIECE_BYTES):
            piece = text[at : at + PIECE_BYTES + LENGTH - 1]
            waiting.append((doc, at, piece))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield Pieces(waiting)
                waiting, size = [], 0
    if waiting:
        yield Pieces(waiting)


def anchor_hashes(records: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(records["bytes"][:, BEFORE : BEFORE + GRAM]).view("<u8")
    return mixed(words[:, 0] * np.uint64(0x9E3779B97F4A7C15) + mixed(words[:, 1]))


def merged(records: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the records that go on, and of those that equal a record of a smaller document. ``owner``: doc_id of each."""
    if not len(records):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = np.zeros((len(records), -(-(REACH + 2) // 8) * 8), np.uint8)
    own[:, :REACH] = records["bytes"]
    own[:, REACH], own[:, REACH + 1] = records["first"], records["end"]
    words = own.view("<u8")
    h = np.zeros(len(records), np.uint64)
    for column in words.T:
        h = mixed(h * np.uint64(0xFF51AFD7ED558CCD) + column)
    order = np.lexsort((owner, h))
    h, rows = h[order], words[order]
    new = np.append(True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1]).any(1))
    smallest = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    gone = owner[order] > smallest
    return order[~gone], order[gone]


def removed_strings(records: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A flag per record and distance: the string that begins that far before the anchor is in a smaller document."""
    flags = np.zeros((len(records), GRAMS), bool)
    first, end = records["first"].astype(np.int64), records["end"].astype(np.int64)
    for distance in range(GRAMS):
        begin = BEFORE - distance
        own = np.flatnonzero((first <= begin) & (begin + LENGTH <= end))
        if len(own) < 2:
            continue
        order, new = deep_shallow(as_words(records["bytes"][own, begin : begin + LENGTH]))
        ids = owner[own[order]]
        smallest = np.minimum.reduceat(ids, np.flatnonzero(new))[np.cumsum(new) - 1]
        flags[own[order[ids > smallest]], distance] = True
    return flags


def spans_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans of documents, those that overlap or touch made one."""
    if not len(doc):
        return np.zeros(0, SPAN)
    order = np.lexsort((start, doc))
    doc, start, end = doc[order].astype(np.int64), start[order].astype(np.int64), end[order].astype(np.int64)
    reach = np.maximum.accumulate(end + (doc << 33))  # documents are apart by more than any length
    new = np.append(True, start[1:] + (doc[1:] << 33) > reach[:-1])
    at = np.flatnonzero(new)
    out = np.zeros(len(at), SPAN)
    out["doc"], out["start"] = doc[at], start[at]
    out["end"] = reach[np.append(at[1:], len(doc)) - 1] - (doc[at] << 33)
    return out


def _reach(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = records["at"].astype(np.int64) - BEFORE
    return records["doc"].astype(np.int64), at + records["first"], at + records["end"]


def packed(*columns: np.ndarray) -> bytes:
    """Arrays, structured ones by field, compressed together."""
    flat = [np.ascontiguousarray(c[name]) for c in columns for name in c.dtype.names] if columns[0].dtype.names else [np.ascontiguousarray(c) for c in columns]
    sizes = np.array([len(c) for c in columns], "<u4")
    return zstandard.ZstdCompressor(level=3).compress(b"".join([sizes.tobytes(), *[c.tobytes() for c in flat]]))


def unpacked(data: bytes, *kinds: np.dtype | str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes, at, out = np.frombuffer(raw, "<u4", len(kinds)).tolist(), 4 * len(kinds), []
    for n, kind in zip(sizes, map(np.dtype, kinds)):
        column = np.zeros(n, kind)
        for name in kind.names or (None,):
            part, field = (kind[name], column[name]) if name else (kind, column)
            field[...] = np.frombuffer(raw, np.uint8, n * part.itemsize, at).view(part.base).reshape(field.shape)
            at += n * part.itemsize
        out.append(column)
    return out


def _steps(sorted_numbers: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which compress better."""
    return np.diff(sorted_numbers, prepend=sorted_numbers.dtype.type(0))


class Block:
    """The texts of a block, equal ones of a doc_id once, in an order that is the same in every step."""

    def __init__(self, rows: pa.Table):
        ids, ties = rows.column("_id").to_numpy(), rows.column("_tie").to_numpy()
        order, column = np.lexsort((ties, ids)), rows.column("text")
        alike = (ids[order][1:] == ids[order][:-1]) & (ties[order][1:] == ties[order][:-1])
        a, b = column.take(pa.array(order[:-1][alike])), column.take(pa.array(order[1:][alike]))
        new = np.append(True, ~alike)[: len(order)]
        if not a.equals(b):  # different texts of one id and hash: these are told apart by themselves
            texts = column.to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], ties[i], texts[i] is not None, texts[i] or "")), np.int64)
            names = [(ids[i], ties[i], texts[i]) for i in order.tolist()]
            new = np.array([k == 0 or names[k] != names[k - 1] for k in range(len(names))], bool)
        first = order[new]
        self.ids = ids[first]
        self.doc = np.empty(len(order), np.int64)  # of each row
        self.doc[order] = np.cumsum(new) - 1
        self.texts = [column[i].as_py().encode() if column[i].is_valid else b"" for i in first.tolist()]


def _anchors_to_buckets(buckets: int):
    """A block's anchors: for each bucket the short hashes in one document, and in several."""

    def send(key: tuple, rows: pa.Table) -> pa.Table:
        block, found = Block(rows), []
        for pieces in pieces_of(block.texts):
            found.append((pieces.hashes, block.ids[pieces.doc]))
        hashes = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
        ids = np.concatenate([i for _, i in found]) if found else np.zeros(0, np.int64)
        bucket, short = hashes % np.uint64(buckets), hashes >> np.uint64(32)
        keys = (bucket << np.uint64(32)) | short
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts) if len(keys) else np.zeros(0, bool)
        keys = keys[starts]
        out = []
        at = np.flatnonzero(np.append(True, (keys[1:] >> np.uint64(32)) != (keys[:-1] >> np.uint64(32)))[: len(keys)])
        for a, b in zip(at, np.append(at[1:], len(keys))):
            own = (keys[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4")
            out.append((int(keys[a] >> np.uint64(32)), packed(_steps(own[~several[a:b]]), _steps(own[several[a:b]]))))
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int64()), "block": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "data": pa.array([d for _, d in out], pa.binary())})

    return send


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """The rows of sorted batches, a key at a time."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != now:
                if held:
                    yield now, held
                now, held = row[key], []
            held.append(row)
    if held:
        yield now, held


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's answer to each block: the short hashes that several documents have."""
    for bucket, rows in _groups(batches, "bucket"):
        parts = [[np.cumsum(c, dtype="<u4") for c in unpacked(row["data"], "<u4", "<u4")] for row in rows]
        every = np.concatenate([c for single, several in parts for c in (single, several, several)])  # in several already: counts twice
        values, counts = np.unique(every, return_counts=True)
        shared = values[counts > 1]
        answers = []
        for row, (single, several) in zip(rows, parts):
            own = np.union1d(single[_found(single, shared)], several).astype("<u4")
            if len(own):
                answers.append((row["block"], bucket, packed(_steps(own))))
        if answers:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*answers)], names=["block", "bucket", "data"])


def _found(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _records_to_buckets(buckets: int):
    """A block's records at shared anchors for the buckets, and the spans of those that are merged."""

    def send(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple[int, bool, bytes]] = []
        number = key[0].as_py()
        if len(rows) and len(answers):
            block = Block(rows)
            shared = [(unpacked(data, "<u4")[0].cumsum(dtype=np.uint64)) | np.uint64(bucket << 32)
                      for bucket, data in zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist())]
            shared = np.sort(np.concatenate(shared))
            parts = []
            for pieces in pieces_of(block.texts):
                keys = ((pieces.hashes % np.uint64(buckets)) << np.uint64(32)) | (pieces.hashes >> np.uint64(32))
                parts.append(pieces.records(np.flatnonzero(_found(keys, shared))))
            records = np.concatenate(parts) if parts else np.zeros(0, RECORD)
            stays, gone = merged(records, block.ids[records["doc"]])
            if len(gone):
                out.append((number % buckets, False, packed(spans_of(*_reach(records[gone])))))
            stays.sort()  # documents together, as they compress best
            records = records[stays]
            bucket = (anchor_hashes(records) % np.uint64(buckets)).astype(np.int64) if len(records) else np.zeros(0, np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])[: len(order)])
            for a, b in zip(edges, np.append(edges[1:], len(order))):
                own = records[order[a:b]]
                used = np.unique(own["doc"])
                out.append((int(bucket[order[a]]), True, _with_owners(block.ids[used], used, own)))
        return pa.table({"bucket": pa.array([b for b, _, _ in out], pa.int64()), "block": pa.array([number] * len(out), pa.int64()),
                         "records": pa.array([r for _, r, _ in out], pa.bool_()), "data": pa.array([d for *_, d in out], pa.binary())})

    return send


def _with_owners(ids: np.ndarray, docs: np.ndarray, records: np.ndarray) -> bytes:
    owners = packed(_steps(ids.astype("<i8")), _steps(docs.astype("<u4")))
    return np.array([len(owners)], "<u4").tobytes() + owners + packed(records)


def _owned(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Records and the doc_id of each."""
    size = int(np.frombuffer(data, "<u4", 1)[0])
    ids, docs = (c.cumsum(dtype=c.dtype) for c in unpacked(data[4 : 4 + size], "<i8", "<u4"))
    records = unpacked(data[4 + size :], RECORD)[0]
    return records, ids[np.searchsorted(docs, records["doc"])]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's records to the spans that are removed, packed for each block."""
    for bucket, rows in _groups(batches, "bucket"):
        spans = [(row["block"], row["data"]) for row in rows if not row["records"]]
        parts = [(row["block"], *_owned(row["data"])) for row in rows if row["records"]]
        if parts:
            blocks = np.repeat(np.array([b for b, _, _ in parts], np.int64), [len(r) for _, r, _ in parts])
            records, ids = np.concatenate([r for _, r, _ in parts]), np.concatenate([i for *_, i in parts])
            stays, gone = merged(records, ids)
            record, distance = np.nonzero(removed_strings(records[stays], ids[stays]))
            begin = records["at"][stays[record]].astype(np.int64) - distance
            doc, start, end = _reach(records[gone])
            of_block = np.concatenate([blocks[gone], blocks[stays[record]]])
            doc, start = np.concatenate([doc, records["doc"][stays[record]]]), np.concatenate([start, begin])
            end = np.concatenate([end, begin + LENGTH])
            order = np.argsort(of_block, kind="stable")
            edges = np.flatnonzero(np.append(True, of_block[order][1:] != of_block[order][:-1])[: len(order)])
            for a, b in zip(edges, np.append(edges[1:], len(order))):
                own = order[a:b]
                spans.append((int(of_block[own[0]]), packed(spans_of(doc[own], start[own], end[own]))))
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in spans]), pa.array([d for _, d in spans])], names=["block", "data"])


def kept_pieces(data: bytes, spans: np.ndarray) -> tuple[list[bytes], int, int]:
    """What is left of a text without its spans (apart, ascending), the bytes removed, and the number of removed runs."""
    edges = np.concatenate([[0], np.column_stack([spans["start"], spans["end"]]).ravel(), [len(data)]]).astype(np.int64).tolist()
    kept = [data[a:b] for a, b in zip(edges[0::2], edges[1::2])]
    return kept, len(data) - sum(map(len, kept)), len(spans)


def _cut_out(key: tuple, rows: pa.Table, removed: pa.Table) -> pa.Table:
    """The rows of a block without their spans."""
    block = Block(rows)
    parts = [unpacked(data, SPAN)[0] for data in removed.column("data").to_pylist()]
    spans = np.concatenate(parts) if parts else np.zeros(0, SPAN)
    spans = spans_of(spans["doc"], spans["start"], spans["end"])
    bounds = np.searchsorted(spans["doc"], np.arange(len(block.texts) + 1))
    done = []
    for i, text in enumerate(block.texts):
        kept, gone, runs = kept_pieces(text, spans[bounds[i] : bounds[i + 1]])
        done.append((len(text), gone, runs, b"".join(kept)))
    columns = list(zip(*[done[i] for i in block.doc.tolist()])) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({"_id": rows.column("_id"), **{
        name: pa.array(c, k) for name, c, k in zip(("n_bytes", "n_removed", "n_spans", "kept"), columns, kinds)}})


def text_hash() -> Column:
    """Tells most texts of one key apart; those that it doesn't are compared."""
    return F.xxhash64("text")


def without_repeats(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans, kept (the bytes that are left).

    Defined cases: null texts are empty; texts under ``LENGTH`` bytes keep everything; documents with the same key don't remove
    from each other, nor does a document from itself; a null key counts as the largest;
    repeated rows get equal results; an empty table gives an empty result. A text of any length is searched whole, a piece
    at a time. Columns other than the key and ``text`` are not read.
    """
    size = docs.agg(F.sum(utf8_bytes())).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_id"), text_hash().alias("_tie"), "text")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("_id", "_tie"), F.lit(n)))
    blocks = rows.groupBy("block")
    anchors = blocks.applyInArrow(_anchors_to_buckets(n), "bucket long, block long, data binary")
    anchors = anchors.repartition("bucket").sortWithinPartitions("bucket")
    answers = anchors.mapInArrow(_shared_anchors, "block long, bucket long, data binary")
    records = blocks.cogroup(answers.groupBy("block")).applyInArrow(_records_to_buckets(n), "bucket long, block long, records boolean, data binary")
    records = records.repartition("bucket").sortWithinPartitions("bucket")
    spans = records.mapInArrow(_removed, "block long, data binary")
    kept = blocks.cogroup(spans.groupBy("block")).applyInArrow(_cut_out, "_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return kept.select(F.nullif("_id", F.lit(NO_ID)).alias(key), "n_bytes", "n_removed", "n_spans", "kept")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings that an earlier document has."""
    rows = without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
