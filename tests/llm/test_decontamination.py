"""Planted passages, whole and with changed words, against a plain search."""

import itertools
import random

import numpy as np
import pytest

from addrspark.llm import decontamination as d


def words(rng, n):
    return ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    items = [(i, words(rng, n)) for i, n in enumerate([40, 30, 20, 16, 8, 3])]
    docs, truth = [], set()
    for i in range(300):
        text = words(rng, rng.randrange(0, 120))
        if i % 3 == 0:
            item, passage = rng.choice(items)
            passage = list(passage)
            if i % 2 and len(passage) >= 20:
                for k in range(5, len(passage), 9):  # a changed word in nine
                    passage[k] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
            if len(passage) >= d.MIN_ITEM:
                truth.add((i, item))
        docs.append((i, " ".join(text).upper() if i % 4 == 0 else "\n".join(text)))
    return items, docs, truth


def bench(spark, items):
    return spark.createDataFrame([(i, None if w is None else " ".join(w), "x") for i, w in items], "item_id long, text string, doc_id string")


def test_planted_passages(spark, documents, planted):
    items, docs, truth = planted
    got = d.contaminations(documents(docs), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth
    own = {i: t.lower().split() for i, t in docs}
    for r in got:
        item = dict(items)[r.item_id]
        part = own[r.doc_id][r.first_word : r.first_word + r.n_span]
        assert len(part) == r.n_span and 0 < r.n_equal <= len(item)
        assert sum(w in item for w in part) >= r.n_equal


def test_blocks_of_the_benchmark_do_not_matter(spark, documents, planted):
    items, docs, _ = planted
    rows = lambda n: sorted(map(str, d.contaminations(documents(docs), bench(spark, items), block_words=n).collect()))
    assert rows(1) == rows(1 << 20)


def test_benchmark_beyond_one_block_is_not_sent_whole(spark, documents, planted, monkeypatch):
    """Beyond a block, the same rows by joins: also of repeated items, of texts with many hits, of null and repeated rows."""
    items, docs, _ = planted
    rng = random.Random(6)
    passage = " ".join(items[0][1])
    docs = [*docs, (None, passage), (400, passage), (400, passage), (401, None), (402, ""), (403, "x " * 3000 + passage), (404, "a b " * 500)]
    items = [*items, items[0], (0, items[1][1]), (50, ["x"] * 7), (51, ["a", "b"] * 10), (None, items[0][1]), (99, None), (98, []), (97, words(rng, 5000))]
    docs.append((405, " ".join(words(rng, 9) + items[-1][1][100:4000])))
    table, rows = documents(docs), lambda n: sorted(map(str, d.contaminations(table, bench(spark, items), block_words=n).collect()))
    kept = lambda n: sorted(map(str, d.clean(table, bench(spark, items), block_words=n).collect()))
    sent, plain_kept = rows(1 << 20), kept(1 << 20)
    monkeypatch.setattr(d, "GROUP_WORDS", 200)
    monkeypatch.setattr(d, "Benchmark", None)
    assert rows(100) == sent and len(sent) > 100
    assert kept(100) == plain_kept and d.clean(table, bench(spark, items), block_words=100).columns == table.columns
    assert d.contaminations(documents([]), bench(spark, items), block_words=100).count() == 0


def test_clean_documents_stay(spark, documents, planted):
    items, docs, truth = planted
    table = documents(docs)
    kept = d.clean(table, bench(spark, items))
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in truth}


def test_nulls_empty_and_repeats(spark, documents, planted):
    items, _, _ = planted
    passage = " ".join(items[0][1])
    docs = documents([(1, None), (2, ""), (None, passage), (3, passage), (3, passage), (4, "x " * 100000 + passage)])
    odd = bench(spark, [*items, (None, items[0][1]), (99, None), (98, [])])
    assert sorted(map(str, ((r.doc_id, r.item_id, r.first_word) for r in d.contaminations(docs, odd).collect()))) == sorted(map(str, [
        (None, 0, 0), (3, 0, 0), (3, 0, 0), (4, 0, 100000)]))
    assert d.contaminations(docs, odd.limit(0)).count() == 0 and d.clean(docs, odd.limit(0)).count() == 6
    assert d.contaminations(documents([]), odd).count() == 0


def passing(equal, size):
    """The best stretch of a pattern if the check takes it for an item of ``size`` words."""
    first, length, matches = d.best_stretch(np.array(equal, bool))
    return equal[first : first + length] if matches >= d.MIN_MATCHES or 100 * matches >= d.WHOLE * size else None


def meets(mask, pattern):
    return any(all(p or bit == "0" for bit, p in zip(mask, pattern[k:])) for k in range(len(pattern) - len(mask) + 1))


def test_masks_meet_all_patterns_that_pass():
    for size in range(d.MIN_ITEM, 16):
        masks = d.MASKS if size >= d.LONG else d.SHORT_MASKS
        for equal in itertools.product((0, 1), repeat=size):
            if 100 * sum(equal) >= d.WHOLE * size and (stretch := passing(equal, size)):
                assert any(meets(mask, stretch) for mask in masks), equal
    # From 16 words on, 13 equal words are asked for. A best stretch has sums above 0 up to each of its words: up to the 13th equal one
    # it is one of the patterns here, whatever comes after.
    starts = [((1,), 1)]
    while starts:
        pattern, total = starts.pop()
        if sum(pattern) == d.MIN_MATCHES:
            assert any(meets(mask, pattern) for mask in d.MASKS), pattern
            continue
        starts.append(((*pattern, 1), total + 1))
        if total > d.MISMATCH:
            starts.append(((*pattern, 0), total - d.MISMATCH))


@pytest.mark.parametrize("size", range(6, 21))
def test_one_and_two_changed_words(size):
    rng = random.Random(size)
    item = words(rng, size)
    bench = d.Benchmark([1], [" ".join(item).encode()])
    changes = [c for n in (0, 1, 2) for c in itertools.combinations(range(size), n)]
    texts = [" ".join(words(rng, 3) + ["changed" if k in c else w for k, w in enumerate(item)] + words(rng, 3)).encode() for c in changes]
    found = {text for text, *_ in bench.overlaps(texts)}
    assert found == {i for i, c in enumerate(changes) if passing([k not in c for k in range(size)], size)}
