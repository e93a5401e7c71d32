"""Token ids in files of independent zstandard frames, with a trailing seek table.

A file is, in this order:

* data frames: each a zstandard frame by itself, of the ids of consecutive documents as
  little-endian unsigned 32-bit integers, every document closed by ``end_id``;
* an index in a skippable frame (magic 0x184D2A50): compressed rows (doc_id, flag for a
  missing doc_id, number of ids), one per document;
* a seek table in a skippable frame (magic 0x184D2A5E), by the public seekable format:
  compressed size, decompressed size and checksum (low 32 bits of XXH64 of the
  decompressed bytes) of every frame before it, and the footer.

Any zstandard program decompresses a file to all its ids. A reader that wants some
documents reads the end of the file, then only the frames that hold them, and
compares their checksums.

Documents are range-partitioned by doc_id; each task writes one file with memory for one
frame. A file's name is new for each attempt, and the manifest, a table of one row per
file, names only files of tasks that succeeded, so lost executors leave nothing wrong
behind. Files are reached through ``pyarrow.fs``, by the scheme of the folder's address.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from addrspark.llm.tables import table
from addrspark.llm.words import blocks
from addrspark.shared import materialize, new_folder

END_ID = 0
#: Bytes of ids in a frame. A longer document goes on in the next frame.
FRAME_BYTES = 1 << 20
LEVEL = 3

# Fixed values of the seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

INDEX_ROW = np.dtype([("doc_id", "<i8"), ("missing", "<u1"), ("n", "<u8")])

#: Pieces of text in each of the two parts of what a worker keeps, and new ones that are encoded as one text.
CACHE_PIECES = 1 << 19
NEW_PIECES = 1 << 7
#: Bytes of text that are encoded at once, with some 18 times as much for arrays; a longer text is worked on alone.
ENCODE_BYTES = 1 << 21


def _classes() -> np.ndarray:
    """Of each byte: 1 for ASCII letters and digits, 2 for ASCII punctuation, 4 for a line end, 8 for a space."""
    kinds = np.zeros(256, np.uint8)
    for b in range(33, 127):
        kinds[b] = 1 if chr(b).isalnum() else 2
    kinds[10], kinds[32] = 4, 8
    return kinds


_CLASSES = _classes()


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces of the joined texts begin; ``texts`` are the texts' first bytes.

    A piece begins with a text, at a space, at punctuation or a line end after a letter or digit (an ASCII one, or one of the
    letters U+00C0 to U+024F in UTF-8), and after a line end between two visible characters.
    """
    kind = _CLASSES[data]
    word_end = kind == 1
    lead, trail = data[:-1], data[1:]
    letter = (lead >= 0xC3) & (lead <= 0xC8) & (trail >= 0x80) & ~((lead == 0xC3) & ((trail == 0x97) | (trail == 0xB7)))
    word_end[1:] |= letter | ((lead == 0xC9) & (trail >= 0x80) & (trail < 0x90))
    begins = kind == 8
    begins[1:] |= ((kind[1:] == 2) | (kind[1:] == 4)) & word_end[:-1]
    begins[2:] |= (kind[1:-1] == 4) & (kind[:-2] < 4) & (kind[2:] < 4)
    begins[texts[texts < len(data)]] = True
    return np.flatnonzero(begins)


class Pieces:
    """Pieces of text and their ids, one after the other."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def add(self, pieces: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        n, size = len(self.number), self.used + len(ids)
        while n + len(pieces) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.lengths))
        while size > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.number.update(zip(pieces, range(n, n + len(pieces))))
        self.lengths[n : n + len(pieces)] = lengths
        self.starts[n : n + len(pieces)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : size] = ids
        self.used = size

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; -1 where it is not kept."""
        get = self.number.get
        return np.fromiter([get(p, -1) for p in pieces], np.int64, len(pieces))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids the pieces have, and all the ids."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[numbers] - ends + lengths, lengths)
        places += np.arange(len(places))
        return lengths, self.ids[places]


class Encoder:
    """Ids of texts by a file of the ``tokenizers`` library, as its ``encode`` gives them without special tokens added.

    A byte-level tokenizer always cuts a text at the places of ``piece_starts``, if its spaces are single ones after
    visible characters and it has no white space other than these and line ends. So such texts are cut
    there, and the library encodes each different piece once while it is kept; a block's pieces are told
    apart, looked up and put together as arrays. Other texts, texts with a special string, and all
    texts for tokenizers of other kinds are encoded whole.
    """

    _other_space = re.compile(r"[^\S \n]")
    _space = "\u0120"  # how byte-level vocabularies write a space

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts.get("pre_tokenizer") or {}
        self.by_piece = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) \
            and parts.get("normalizer") is None and parts.get("post_processor") is None
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept, self.older = Pieces(), Pieces()
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith(self._space)]] = True

    def _splits(self, text: str) -> bool:
        """Whether every space of the text follows a visible character, other white space is line ends, and no string is special."""
        return not (text.startswith(" ") or "  " in text or "\n " in text or any(s in text for s in self.special) or self._other_space.search(text))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Keep the ids of new pieces. Those with a space before them are encoded together: where an id begins with a space, a piece begins."""
        spaced = [p for p in pieces if p[0] == " "]
        bare = [p for p in pieces if p[0] != " "]
        joined = ["".join(spaced[at : at + NEW_PIECES]) for at in range(0, len(spaced), NEW_PIECES)]
        found = self.tokenizer.encode_batch_fast(joined + bare, add_special_tokens=False)
        own = [e.ids for e in found[len(joined) :]]
        ids = np.array([i for e in found[: len(joined)] for i in e.ids], np.uint32)
        lengths = np.diff(np.flatnonzero(self.opens[ids]), append=len(ids))
        self.kept.add(spaced + bare, np.concatenate([lengths, np.fromiter(map(len, own), np.int64, len(own))]),
                      np.concatenate([ids, np.array([i for e in own for i in e], np.uint32)]))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of different pieces among those kept, which they all are afterwards."""
        if len(self.kept.number) > CACHE_PIECES:
            self.kept, self.older = Pieces(), self.kept
        numbers = self.kept.numbers(pieces)
        missing = [pieces[i] for i in np.flatnonzero(numbers < 0).tolist()]
        if missing:
            before = self.older.numbers(missing)  # pieces that come again are taken over
            again = np.flatnonzero(before >= 0)
            self.kept.add([missing[i] for i in again.tolist()], *self.older.of(before[again]))
            self._learn([missing[i] for i in np.flatnonzero(before < 0).tolist()])
            numbers = self.kept.numbers(pieces)
        return numbers

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (in UTF-8) as little-endian 32-bit integers."""
        strings = [t.decode() for t in texts]
        cut = [self.by_piece and t != "" and self._splits(t) for t in strings]
        whole = iter(self.whole([t for t, c in zip(strings, cut) if not c]))
        chosen = [t for t, c in zip(texts, cut) if c]
        if not chosen:
            return list(whole)
        data = b"".join(chosen)
        ends = np.cumsum(np.fromiter(map(len, chosen), np.int64, len(chosen)))
        begins = np.concatenate([[0], ends[:-1]])
        starts = piece_starts(np.frombuffer(data, np.uint8), begins)
        buffers = [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        numbers = self._numbers(pieces.dictionary.to_pylist())
        lengths, ids = self.kept.of(numbers[pieces.indices.to_numpy()])
        at = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, np.append(begins, len(data)))].tolist()
        parts = iter([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])])
        return [next(parts) if c else next(whole) for c in cut]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FrameWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.waiting, self.size = [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((0 if doc_id is None else doc_id, doc_id is None, len(ids) // 4))
        for at in range(0, len(ids), self.frame_bytes):
            part = ids[at : at + self.frame_bytes]
            if self.size + len(part) > self.frame_bytes:
                self._close_frame()
            self.waiting.append(part)
            self.size += len(part)

    def _close_frame(self) -> None:
        if not self.size:
            return
        raw = b"".join(self.waiting)
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        self._close_frame()
        index = skippable(INDEX_MAGIC, self.compressor.compress(np.array(self.index, INDEX_ROW).tobytes()))
        self.out.write(index)
        self.frames.append((len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(skippable(SEEK_MAGIC, entries + footer))


class FrameReader:
    """Reads documents of one file; ``file`` is seekable. ``frames_read`` counts the frames decompressed."""

    def __init__(self, file):
        self.file, self.frames_read = file, 0
        size = file.seek(0, 2)
        count, _, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != FOOTER_MAGIC:
            raise ValueError("the file has no seek table")
        table_size = 12 * count
        entries = np.frombuffer(self._bytes(size - 9 - table_size, table_size), "<u4").reshape(-1, 3).astype(np.int64)
        ends = np.cumsum(entries[:, 0])
        self.frames = entries[:-1]
        self.at = ends[:-1] - self.frames[:, 0]
        self.raw_at = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        packed = self._bytes(int(ends[-2]) + 8 if count > 1 else 8, int(entries[-1, 0]) - 8)
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), INDEX_ROW)
        self.doc_at = np.concatenate([[0], np.cumsum(self.index["n"].astype(np.int64))])

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        packed, size, checksum = (int(x) for x in self.frames[k])
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.at[k]), packed), max_output_size=size)
        self.frames_read += 1
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} does not match its checksum")
        return raw

    def document(self, i: int) -> bytes:
        """The ids of the i-th document; only the frames that hold them are read."""
        begin, end = 4 * int(self.doc_at[i]), 4 * int(self.doc_at[i + 1])
        first = int(np.searchsorted(self.raw_at, begin, "right")) - 1
        parts = []
        for k in range(first, len(self.frames)):
            if self.raw_at[k] >= end:
                break
            at = int(self.raw_at[k])
            parts.append(self.frame(k)[max(0, begin - at) : end - at])
        return b"".join(parts)

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """All documents in order, with memory for one document and one frame."""
        k, raw, at = -1, b"", 0
        for doc_id, missing, n in self.index.tolist():
            need, parts = 4 * n, []
            while need:
                if at == len(raw):
                    k += 1
                    raw, at = self.frame(k), 0
                part = raw[at : at + need]
                parts.append(part)
                at, need = at + len(part), need - len(part)
            yield (None if missing else doc_id), b"".join(parts)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, *, key: str = "doc_id", end_id: int = END_ID, frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Write the ids of all documents below ``folder`` in ascending ``key``; return the manifest.

    The manifest has one row per file: part (order of the files), file, n_docs, n_tokens.
    Defined cases: a null text is empty and has the end id alone; null keys come last;
    rows with the same key are all written, in order of a hash of the text; an empty
    table gives no file. Columns other than the key and ``text`` are not read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, tokens, docs_written = TaskContext.get().partitionId(), None, 0, 0
        end = struct.pack("<I", end_id)
        encode = encoder(tokenizer)
        store, base = fs.FileSystem.from_uri(folder)
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            keys = batch.column("_key").to_pylist()
            for begin, block in blocks((text.as_py() for text in batch.column("text")), ENCODE_BYTES):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    writer = FrameWriter(store.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                for i, ids in enumerate(encode.ids(block)):
                    ids += end
                    writer.add(keys[begin + i], ids)
                    tokens += len(ids) // 4
                    docs_written += 1
        if writer is not None:
            writer.close()
            writer.out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_docs": docs_written, "n_tokens": tokens}])

    rows = docs.select(F.col(key).cast("long").alias("_key"), "text", F.xxhash64("text").alias("_tie"))
    order = [F.col("_key").asc_nulls_last(), F.col("_tie").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_key", "text")
    return rows.mapInArrow(write, "part long, file string, n_docs long, n_tokens long")


def read_tokens(manifest: DataFrame, folder: str, column: str, kind: str, of: Callable[[bytes], object]) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, and ``column``: what ``of`` makes of its ids.

    A task reads whole files, frame by frame. ``manifest`` must be a stored table.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n_files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("_before").to_pylist()):
                with store.open_input_file(f"{base}/{name}") as file:
                    rows, size = [], 0
                    for doc_id, ids in FrameReader(file).documents():
                        n = len(ids) // 4
                        rows.append((doc_id, start, n, of(ids)))
                        start, size = start + n, size + n
                        if size > 1 << 20:
                            yield _rows(rows, column)
                            rows, size = [], 0
                    if rows:
                        yield _rows(rows, column)

    schema = f"doc_id long, start long, n_tokens long, {column} {kind}"
    return files.select("file", "_before").repartition(n_files).mapInArrow(read, schema)


def _rows(rows: list[tuple], column: str) -> pa.RecordBatch:
    ids, starts, counts, values = zip(*rows)
    arrays = [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(values)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", column])


def stored_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write the token files and the manifest, by default in a new shared folder; return both."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    return materialize(write_tokens(docs, folder, tokenizer), "token-manifest"), folder


def token_summary(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files, read them back, and tell per document doc_id, start, n_tokens, ids_crc32."""
    manifest, folder = stored_tokens(docs, tokenizer)
    return read_tokens(manifest, folder, "ids_crc32", "long", zlib.crc32)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written and read back."""
    return token_summary(table(spark, sf_dir, "documents"), default_tokenizer())
