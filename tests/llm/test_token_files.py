"""Token files: exact round trips, few frames read, errors found."""

import io
import struct
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from addrspark.llm import token_files as tf


@pytest.fixture(scope="module")
def encoder():
    return tf.encoder(tf.default_tokenizer())


@pytest.fixture(scope="module")
def library():
    """The library's own call, text by text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tf.default_tokenizer())
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ALPHABET = " \n\tab1\u00e9\u00d7\u00f7\u024f\u0250'.,(\u65e5\u0301\x1c\xa0\U0001f600"


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.text(alphabet=ALPHABET, max_size=16) | st.lists(st.sampled_from(
    ["<|endoftext|> a", "it's  we'll", "a.\n", "\n\n", " x'", "l\u00e9.", "12,", "\n'", " ", "B"]), max_size=6).map("".join), max_size=4))
def test_ids_are_those_of_the_library(encoder, library, texts):
    assert encoder.ids([t.encode() for t in texts]) == [library(t) for t in texts]


def test_pieces_are_forgotten_and_learnt_again(library, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_PIECES", 20)
    encoder = tf.Encoder(tf.default_tokenizer())
    for k in range(40):
        texts = [" ".join(f"word{(i * k) % 31}{c}" for i in range(12)) for c in ("", ".", "\n", "\u00e9")]
        assert encoder.ids([t.encode() for t in texts]) == [library(t) for t in texts]
    assert len(encoder.kept.number) + len(encoder.older.number) < 200


def test_special_strings_and_empty_texts(encoder, library):
    texts = ["say <|endoftext|> now", "", "\n", "<|endoftext|>", " lead", "x  y"]
    assert encoder.ids([t.encode() for t in texts]) == [library(t) for t in texts]
    assert 50256 in np.frombuffer(encoder.ids([texts[0].encode()])[0], "<u4")


def written(docs, frame_bytes):
    out = io.BytesIO()
    writer = tf.FrameWriter(out, frame_bytes)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return out.getvalue()


DOCS = [(1, [5, 0]), (2, [0]), (3, list(range(100))), (None, [7, 7, 0]), (-5, [1, 2, 3, 0])]


@pytest.mark.parametrize("frame_bytes", [8, 40, 1 << 20])
def test_round_trip(frame_bytes):
    data = written(DOCS, frame_bytes)
    reader = tf.FrameReader(io.BytesIO(data))
    expected = [(d, np.array(ids, "<u4").tobytes()) for d, ids in DOCS]
    assert list(reader.documents()) == expected
    assert [reader.document(i) for i in range(len(DOCS))] == [ids for _, ids in expected]
    # Any zstandard reader that goes from frame to frame gets all ids.
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as stream:
        assert stream.read() == b"".join(ids for _, ids in expected)


def test_only_requested_frames_are_read():
    reader = tf.FrameReader(io.BytesIO(written([(i, [i] * 10) for i in range(100)], 40)))
    assert reader.document(70) == struct.pack("<10I", *[70] * 10)
    assert reader.frames_read == 1 and len(reader.frames) == 100


def test_checksums_and_missing_tables_are_noticed():
    data = bytearray(written(DOCS, 1 << 20))
    with pytest.raises(ValueError):
        tf.FrameReader(io.BytesIO(data[:-1] + b"\0"))
    entry = len(data) - 9 - 12 * 2  # the first frame's entry
    data[entry + 8] ^= 1
    with pytest.raises(ValueError):
        tf.FrameReader(io.BytesIO(bytes(data))).frame(0)


def test_no_documents():
    assert list(tf.FrameReader(io.BytesIO(written([], 100))).documents()) == []


def test_summary(documents, library):
    rows = [(i * 3 % 50, f"word{i} text  é\n" * (i % 5)) for i in range(50)] + [(7, None), (None, "last"), (2000, "x " * 30000), (7, "tie")]
    got = tf.token_summary(documents(rows), tf.default_tokenizer()).collect()
    ids = lambda t: library(t or "") + b"\0\0\0\0"
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows if d is not None)) + [None]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(ids(t)) // 4, zlib.crc32(ids(t))) for d, t in rows)
    assert tf.token_summary(documents([]), tf.default_tokenizer()).count() == 0
