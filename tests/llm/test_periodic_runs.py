"""Runs against a plain search, word by word."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from addrspark.llm import periodic_runs as pr
from addrspark.llm.queries import queries
from addrspark.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """All (start, length, period): maximal stretches by period, of which the least period is kept."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def found_runs(texts):
    words = Words([t.encode() for t in texts], lower=False)
    return [[tuple(r) for r in runs] for runs in pr.runs_of(pr.word_ids(words), words.first)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 9)), max_size=5), min_size=1, max_size=4))
def test_runs_are_those_of_a_plain_search(parts):
    texts = [" ".join(" ".join(w * k) for w, k in part) for part in parts]
    assert found_runs(texts) == [plain_runs(t.split()) for t in texts]


def test_binary_words_and_long_repeats():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab") for _ in range(400)) for _ in range(20)]
    phrase = [f"w{i}" for i in range(40)]
    texts.append(" ".join(phrase * 5 + ["x"] + phrase * 3 + ["x", "y"] * 9))
    texts.append(" ".join(rng.choice(["one two three four five six", "x", "y z"]) for _ in range(800)))
    assert found_runs(texts) == [plain_runs(t.split()) for t in texts]


def test_one_word_many_times_is_no_quadratic_work():
    n = 200_000
    assert found_runs(["a " * n, "b"]) == [[(0, n, 1)], []]
    rng = random.Random(1)
    text = "".join(f"the same five words again {rng.randrange(10**9)} " for _ in range(20_000))
    assert found_runs([text]) == [[]]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    places = pr.repeated_tail(doc_id, len(words))
    if places is not None:
        words = [words[p] for p in places]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_special_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, "a " * 9), (5, "a b " * 6 + "  A é é é é é é é"), (5, "a b " * 6),
            (6, "x " * 30_000 + "y z " * 5), (7, "x\x0by\x0cx\x1fy " * 4), (6, "x " * 7)] + [(i, f"w{i} and so on " * (i % 9)) for i in range(10, 60)]
    got = pr.periodic_runs(documents(rows), pr.repeated_tail).drop("runs").collect()
    key = lambda r: (str(r[0]), r[6], r[7])
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r[:2]) for r in rows), key=key)
    assert pr.periodic_runs(documents([])).count() == 0
    plain = {r.doc_id: r.text for r in pr.without_repeats(documents([(1, "go go go go go go on"), (2, None)])).collect()}
    assert plain == {1: "go on", 2: ""}


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op11_periodic_runs"](spark, path).collect()
    key = lambda r: r[0]
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r.n_runs for r in got) > 0


def test_order_of_the_query():
    for doc_id in range(200):
        places = pr.repeated_tail(doc_id, 50)
        if places is not None:
            assert places.max() < 50 and (places <= np.arange(50)).all()
    assert pr.repeated_tail(None, 5) is None and pr.repeated_tail(3, 0) is None
