"""Word arrays against regular expressions."""

import re
import tracemalloc

import numpy as np
from hypothesis import given, settings, strategies as st

from addrspark.llm.quality import statistics
from addrspark.llm.suffixes import as_words, deep_shallow
from addrspark.llm.words import Words, blocks, shingles

TEXT = st.text(alphabet="aAbé日 \t\n\x0b\x0c\r\x1c\xa0", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_words_of_texts(texts):
    words = Words([t.encode() for t in texts])
    hashes = words.hashes
    seen = {}
    for i, text in enumerate(texts):
        expected = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        a, b = words.first[i], words.first[i + 1]
        assert [words.data[x:y].tobytes() for x, y in zip(words.starts[a:b], words.ends[a:b])] == expected
        for word, h in zip(expected, hashes[a:b].tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_blocks_hold_all_texts_and_long_ones_alone():
    texts = ["a" * 10, None, "", "b" * 100, "c"]
    got = list(blocks(texts, 20))
    assert [begin for begin, _ in got] == [0, 3, 4]
    assert [t for _, block in got for t in block] == [b"a" * 10, b"", b"", b"b" * 100, b"c"]


def peak_mb(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_blocks_bound_the_memory_of_their_arrays():
    """Workers share an executor's memory with its heap: 93 MB with blocks of 2 MB."""
    texts = [" ".join(f"w{i * k % 977}" for i in range(300)) for k in range(1, 6000)]

    def measure():
        for _, block in blocks(texts):
            statistics(block)
    assert sum(map(len, texts)) > 1 << 22 and peak_mb(measure) < 40


def test_shingles_differ_by_order():
    h = Words([b"a b a c"]).hashes
    assert len(set(shingles(h, 2).tolist())) == 3 and len(shingles(h, 5)) == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=30, max_size=30).map(lambda b: bytes(x % 2 for x in b)) | st.just(bytes(30)) | st.just(b"\1" * 29 + b"\2"), max_size=40),
       st.integers(0, 5))
def test_deep_shallow_order(rows, shallow):
    matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 30)
    order, new = deep_shallow(as_words(matrix), shallow)
    assert [rows[i] for i in order] == sorted(rows)
    assert new.tolist() == [i == 0 or rows[order[i]] != rows[order[i - 1]] for i in range(len(rows))]
