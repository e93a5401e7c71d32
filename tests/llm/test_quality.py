"""Statistics against regular expressions, the forest on rows with planted junk."""

import collections
import random
import re

import numpy as np
import pytest

from addrspark.llm import quality as q


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = list(zip(words, words[1:], words[2:]))
    count = collections.Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if count[t] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))


def sentence(rng, n, junk=""):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) + junk for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randrange(60, 200)) + rng.choice(["", " 12 5", "\nA b."]), 1) for i in range(400)]
    rows += [(400 + i, sentence(rng, rng.randrange(60, 200), rng.choice(["###", "$$$"])), 0) for i in range(60)]
    return rows


def test_statistics():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n#|\t\x0b") for _ in range(rng.randrange(60))) for _ in range(300)] + ["", "\n\nx\n x\nx", "a b a b a b a"]
    s = q.statistics([t.encode() for t in texts])
    assert list(zip(*[s[c].tolist() for c in q.BASE])) == [plain(t) for t in texts]


def test_forest_and_threshold(labelled):
    s = q.statistics([t.encode() for _, t, _ in labelled])
    x, good = q.features(s), np.array([y == 1 for *_, y in labelled])
    forest = q.calibrated(x, good)
    rejected = forest.scores(x) > forest.threshold
    assert rejected[~good].mean() > 0.95 and rejected[good].mean() < 0.01
    assert (forest.scores(x) > 0).all() and (forest.scores(x) < 1).all()


def test_isolated_rows_have_short_paths():
    x = np.random.default_rng(0).normal(size=(500, 3))
    x[7] = 30
    scores = q.grow(x, np.ones(3)).scores(x)
    assert scores.argmax() == 7


def test_nothing_to_calibrate_on_rejects_nothing():
    forest = q.calibrated(np.zeros((0, 8)), np.zeros(0, bool))
    assert not (forest.scores(np.ones((3, 8))) > forest.threshold).any()


def test_query_on_tables(spark, documents, labelled):
    rows = [(i, t) for i, t, _ in labelled] + [(900, None), (901, ""), (902, "a b c " * 40), (None, labelled[0][1]), (0, labelled[0][1]), (903, "word " * 5)]
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled] + [(None, 1), (5, None)], "doc_id long, quality int")
    docs = documents(rows)
    forest = q.fitted(docs, labels)
    got = q.judged(docs, forest).collect()
    assert sorted(map(str, ((r.doc_id, *(r[c] for c in q.BASE)) for r in got))) == sorted(map(str, ((i, *plain(t)) for i, t in rows)))
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in got}
    bad = [i for i, _, y in labelled if y == 0]
    assert np.mean([kept[i] for i in bad]) < 0.1 and np.mean([kept[i] for i, _, y in labelled if y]) > 0.98
    passed = q.passing(docs, forest)
    assert passed.columns == docs.columns
    assert sorted(str(r.doc_id) for r in passed.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_empty_tables(spark, documents):
    docs, labels = documents([]), spark.createDataFrame([], "doc_id long, quality int")
    assert q.judged(docs, q.fitted(docs, labels)).count() == 0


def test_copies_of_a_key_displace_no_other_rows(spark, documents, labelled):
    rng = random.Random(8)
    rows = [(i, t) for i, t, _ in labelled] + [(1000, sentence(rng, 52))]
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled] + [(1000, 1)], "doc_id long, quality int")
    fits = [q.fitted(documents(rows + [rows[-1]] * n), labels, sample=len(rows)) for n in (0, 3 * len(rows))]
    assert np.isfinite(fits[1].threshold) and fits[0].threshold == fits[1].threshold
    assert (fits[0].feature == fits[1].feature).all() and (fits[0].split == fits[1].split).all()


def test_all_labelled_rows_count(spark, documents):
    rng = random.Random(9)
    rows = [(i, sentence(rng, 52, "###" if i % 50 == 0 else "")) for i in range(8200)]
    labels = spark.createDataFrame([(i, int(i % 50 != 0)) for i, _ in rows], "doc_id long, quality int")
    docs = documents(rows)
    forest = q.fitted(docs, labels)
    assert forest.rows == 8200 and np.isfinite(forest.threshold)
    kept = {r.doc_id: r.kept for r in q.judged(docs, forest).collect()}
    assert not any(kept[i] for i in range(0, 8200, 50)) and np.mean([kept[i] for i in range(8200) if i % 50]) > 0.98


def test_separation_of_stored_rows(spark):
    rng = np.random.default_rng(2)
    x, good = rng.integers(0, 9, (300, 8)) / 8, rng.random(300) < 0.7
    rows = spark.createDataFrame([(bool(y), *map(float, r)) for y, r in zip(good, x)], "_good boolean, " + ", ".join(f"{c} double" for c in q.FEATURES))
    assert np.allclose(q._separations(rows, int(good.sum()), int((~good).sum())), q.separation(x, good))
