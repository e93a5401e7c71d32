"""Gradients by differences, accuracy on held-out rows, odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrspark.llm import gru, toxicity as t


def test_gradients():
    rng = np.random.default_rng(0)
    chars = rng.integers(97, 105, (30, gru.TOKEN_BYTES)).astype(np.uint8)
    for i in range(30):
        chars[i, rng.integers(1, 20) :] = 0
    buckets, windows = rng.integers(0, gru.WORD_BUCKETS, 30), rng.integers(0, 30, (6, gru.WINDOW))
    for row in range(6):
        windows[row, rng.integers(5, 32) :] = -1
    labels = np.array([0, 1, 0, 1, 1, 0], float)
    weights = {k: v.astype(float) for k, v in gru.initial(1).items()}
    _, grads = gru._gradients(weights, chars, buckets, windows, labels)
    for name, w in weights.items():
        at = np.unravel_index(np.argmax(np.abs(grads[name])), w.shape)
        old, sides = w[at], []
        for step in (1e-3, -1e-3):
            w[at] = old + step
            sides.append(gru._gradients(weights, chars, buckets, windows, labels)[0])
        w[at] = old
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=2e-2, abs=1e-6)


def corpus(n=700):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8)))
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.randrange(5, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text[rng.randrange(len(text))] = rng.choice(["idiot", "Moron,", "zkvx" + word(), "zkvx" + word()])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark, documents):
    rows = corpus()
    odd = [(9000, None), (9001, ""), (9002, " \n"), (None, "idiot"), (9003, "x" * 5000), (0, rows[0][1]), (9004, "la " * 20000 + "idiot moron")]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    docs = documents([r[:2] for r in rows] + odd)
    model = t.fitted(docs, labels)
    got = t.scored(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    toxic = {i: y for i, _, y in rows}
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    assert np.mean([p for y, p in held if y]) > 0.9 and np.mean([p for y, p in held if not y]) < 0.1
    scores = {r.doc_id: r.score for r in got}
    assert scores[9000] == scores[9001] == scores[9002] < 0.3 and scores[9004] > 0.3


def test_windows_cover_all_tokens():
    tokens = t.Tokens([b" ".join(b"w%d" % i for i in range(n)) for n in (0, 1, 31, 32, 33, 100)] + [b"y" * 95])
    windows, text = tokens.windows()
    for i in range(7):
        own = windows[text == i]
        assert set(own[own >= 0].tolist()) == set(tokens.ids[tokens.first[i] : tokens.first[i + 1]].tolist())
    assert np.bincount(text, minlength=7).tolist() == [0, 1, 1, 1, 2, 6, 1] and tokens.first[7] - tokens.first[6] == 5


def test_nothing_to_learn_from(spark, documents):
    docs, labels = documents([(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in t.scored(docs, t.fitted(docs, labels)).collect()] == [0]
    assert t.scored(documents([]), t.fitted(documents([]), labels)).count() == 0


def test_copies_of_a_key_displace_no_other_rows(spark, documents):
    rows = corpus(120)
    table = documents([r[:2] for r in rows])
    first = table.where((t.fold(F.col("doc_id")) != t.HELD_OUT) & (F.col("doc_id") % 4 != 0)).orderBy(F.xxhash64("doc_id")).first()
    lowest = table.where(t.fold(F.col("doc_id")) != t.HELD_OUT).orderBy(F.xxhash64("doc_id")).first()
    copies = table.where(F.col("doc_id").isin(first.doc_id, lowest.doc_id)).crossJoin(spark.range(t.TOXIC_ROWS + t.CLEAN_ROWS)).drop("id")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    plain, hot = (t.fitted(docs, labels) for docs in (table, table.unionByName(copies)))
    assert hot.slope == pytest.approx(plain.slope) and hot.slope > 0 and hot.shift == pytest.approx(plain.shift)
