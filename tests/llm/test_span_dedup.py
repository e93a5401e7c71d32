"""Removed bytes against a dictionary of all strings."""

import random

import pytest

from addrspark.llm import span_dedup as s


def plain(rows):
    first, out = {}, []
    ids = lambda d: s.NO_ID if d is None else d
    for d, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            first[data[i : i + 50]] = min(first.get(data[i : i + 50], ids(d)), ids(d))
    for d, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < ids(d):
                gone[i : i + 50] = b"\1" * 50
        runs = sum(g and not p for g, p in zip(gone, bytes(1) + gone))
        out.append((d, len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(map(str, out))


def found(df):
    return sorted(map(str, ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())))


def corpus():
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("ab cé") for _ in range(n))
    shared, rows = [text(n) for n in (49, 50, 51, 70, 200)], []
    for i in range(120):
        parts = [text(rng.randrange(0, 150))]
        for _ in range(rng.randrange(3)):
            whole = rng.choice(shared + [t for _, t in rows[-4:]])
            a = rng.randrange(max(1, len(whole) // 2))
            parts += [whole[a : a + rng.randrange(30, 200)], text(rng.randrange(60))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    return rows + [(200, "a" * 300), (201, "a" * 120), (201, "a" * 120), (199, "a" * 49), (7, rows[3][1]), (None, rows[3][1]), (None, shared[4]), (300, None), (301, "")]


@pytest.mark.parametrize("block, piece", [(1 << 22, 1 << 20), (1500, 130)])
def test_equal_to_all_strings(documents, monkeypatch, block, piece):
    monkeypatch.setattr(s, "BLOCK_BYTES", block)
    monkeypatch.setattr(s, "PIECE_BYTES", piece)
    rows = corpus()
    assert found(s.without_repeats(documents(rows))) == plain(rows)


def test_texts_of_one_key_and_hash(documents, monkeypatch):
    from pyspark.sql import functions as F

    rows = corpus()
    rows += [(key, f"text number {n} of some length that is over fifty bytes long") for key in (None, 1) for n in (69100, 274934, 69100)]
    monkeypatch.setattr(s, "text_hash", lambda: F.lit(1).cast("long"))
    assert found(s.without_repeats(documents(rows))) == plain(rows)


def test_empty_table(documents):
    assert s.without_repeats(documents([])).count() == 0


def test_pieces_of_long_texts_cover_every_string(monkeypatch):
    monkeypatch.setattr(s, "PIECE_BYTES", 100)
    text = random.Random(1).randbytes(1234)
    covered = set()
    for pieces in s.pieces_of([text]):
        assert (pieces.place >= pieces.start).all() and (pieces.place <= pieces.start + s.GRAMS - 1).all()
        for a, b, base in zip(pieces.start, pieces.last, pieces.base):
            covered |= set(range(a + base, b + base + 1))
    assert covered == set(range(1234 - 49))
