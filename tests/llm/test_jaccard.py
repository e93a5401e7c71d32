"""Components against all pairs, sketches against their bounds."""

import random
import re

import numpy as np
import pytest

from addrspark.llm import components, jaccard_join as j
from addrspark.llm.words import Words


def plain_sets(rows):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def plain(rows):
    """(doc_id, set size, smallest id reachable) of each row, from all pairs."""
    sets = plain_sets(rows)
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common) and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    low = {}
    for (key, _), g in zip(rows, group):
        if key is not None:
            low[g] = min(low.get(g, key), key)
    return [(key, len(s), low.get(g)) for (key, _), s, g in zip(rows, sets, group)]


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("abcdefgh") + rng.choice("abcdefgh")
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.choice([1, 2, 4, 5, 6, 7, 12, 30, 90, 300]))]
        if i % 5 == 0:
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        rows.append(text)
        for _ in range(rng.choice([0, 0, 1, 6])):
            copy = list(rng.choice(rows[-3:]))
            for _ in range(rng.choice([0, 1, 1, 2, max(1, len(copy) // 40), max(1, len(copy) // 25)])):
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[word()], [], [copy[k], word()]])
                copy = copy or ["x"]
            rows.append(copy)
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(i, rng.choice([" ", "\n"]).join(t)) for i, t in zip(ids, rows)]


def found(df):
    return sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())))


@pytest.mark.parametrize("seed", [2, 3])
def test_equal_to_all_pairs(documents, seed):
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "One TWO"), (5004, "one two"), (5005, "two one"), (5000, "a b c d e f g h i j k")]
    assert found(j.linked_documents(documents(rows))) == sorted(map(str, plain(rows)))


def test_null_keys_and_repeats(documents):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "lonely text without any other like it"), (None, None), (9, "a B c d e f")]
    assert found(j.linked_documents(documents(rows))) == sorted(map(str, [
        (None, 2, 7), (7, 2, 7), (7, 2, 7), (None, 3, None), (None, 0, None), (9, 2, 7)]))
    assert j.linked_documents(documents([])).count() == 0


def test_one_stays(documents):
    rows = corpus(4) + [(6000, None), (6001, ""), (6002, "same text here again and again"), (6002, "same text here again and again"), (None, "same text here again and again")]
    docs = documents(rows)
    kept = j.one_per_component(docs)
    assert kept.columns == docs.columns
    expected = [key for key, n, low in plain(rows) if key == low] + [6000, 6001]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected))


def test_shared_blocks_are_enough():
    """Linked sets share at least the needed number of keys, whatever is changed."""
    rng = np.random.default_rng(7)
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**64, rng.integers(4, 400), dtype=np.uint64))
        drop = rng.integers(0, max(1, len(a) // 9) + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, rng.integers(0, len(a) // 9 + 1), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        small, large = sorted((a, b), key=len)
        band = j.band_of(len(small))
        ka, qa = j.sketch_keys(small, band)
        kb, qb = j.sketch_keys(large, band)
        assert len(np.intersect1d(ka, kb)) >= max(qa, qb) or min(qa, qb) == 1 and len(np.intersect1d(ka, kb)) >= 1
        assert j.band_of(len(large)) in (band, band + 1)


def test_short_texts_are_no_prefixes_of_longer_ones():
    sets = [set(j.shingle_set(Words([t]).hashes).tolist()) for t in (b"a b", b"a b c", b"a b c d e", b"")]
    assert [len(s) for s in sets] == [1, 1, 1, 0] and len(set().union(*sets)) == 3


def test_bit_sketches_bound_the_difference_and_miss_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[rng.integers(0, 60) :], rng.integers(0, 2**64, rng.integers(0, 40), dtype=np.uint64)])) for _ in range(60)]
    sketches = [j.bit_sketch(s) for s in sets]
    group = rng.integers(0, 20, 60)
    near = {frozenset(p) for p in j.near_in_group(np.arange(60), group, np.array([len(s) for s in sets]), sketches)}
    links = set()
    for a in range(60):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if group[a] != group[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                links.add(frozenset((a, b)))
    assert links and links <= near and len(near) < 2 * len(links) + 20
    assert all(group[min(p)] != group[max(p)] for p in near)


@pytest.mark.parametrize("part", [1, 3])
def test_parts_do_not_matter(documents, monkeypatch, part):
    monkeypatch.setattr(j, "PART", part)
    monkeypatch.setattr(j, "LISTED", 2)
    rows = corpus(5)
    assert found(j.linked_documents(documents(rows))) == sorted(map(str, plain(rows)))


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, 600 + i) for i in range(100)]
    low = {}
    for a, b in pairs:
        for x in (a, b):
            low.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: m for x, m in low.items() if x not in alone}
