"""The mix against targets shared step by step, and documents ranked in Python."""

import hashlib
import re

import pytest

from addrspark.llm import mixing


def shared_out(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] > cap * sizes[s]}
        if not above:
            target |= {s: share * weight[s] for s in free}
            break
        for s in above:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= above
    return target


def plain_mix(rows, seed=17):
    """(doc_id, size, taken) of each row, by a loop over each source's ranked documents."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    targets, out = shared_out(sizes), []
    for source, target in targets.items():
        own = [(d, size(t)) for d, t, s in rows if s == source]
        times = target / sizes[source] if sizes[source] else 0.0
        whole = min(3, int(times + 1e-9))
        p = times - whole
        rank = {}
        for d, n in own:
            u = (int(hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            rank[d, n] = u / (1 - u)
        rest, done = target - whole * sizes[source], 0
        for d, n in sorted(own, key=lambda x: rank[x]):
            more = p > 1e-9 and n > 0 and done + n / 2 <= rest
            if p > 1e-9 and n > 0:
                done += n
            out.append((d, n, n * (whole + more)))
    return targets, sizes, out


def test_targets_stop_at_three_times_the_size():
    target = shared_out({"a": 1000, "b": 10, "c": 10, "d": 400, None: 1})
    assert target["b"] == 30 and target["c"] == 30 and target[None] == 3
    assert sum(target.values()) == pytest.approx(1421)


def words(n):
    return " ".join(["w"] * n)


ROWS = [(i, words(1 + i * 7 % 90), f"s{i % 4}" if i % 3 else "big") for i in range(400)] + [
    (1000, words(5), None), (1001, None, "s1"), (1002, " \n ", "tiny"), (1003, words(2), "tiny"), (None, words(9), "s2")]


def test_equal_to_plain_mix(documents):
    targets, sizes, expected = plain_mix(ROWS)
    got = mixing.mixed(documents(ROWS)).collect()
    assert {(r.source, r.source_size): r.target for r in got} == pytest.approx({(s, sizes[s]): t for s, t in targets.items()})
    assert sorted(((r.doc_id, r.size, r.taken) for r in got), key=str) == sorted(expected, key=str)
    taken = {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r.size
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - targets[s]) <= largest for s in targets)


def test_bins_do_not_matter(documents):
    docs = documents(ROWS)
    rows = lambda bins: sorted(((r.doc_id, r.taken) for r in mixing.mixed(docs, bins=bins).collect()), key=str)
    assert rows(1) == rows(7) == rows(1 << 14)


def test_unequal_weights_keep_the_size(documents):
    from pyspark.sql import functions as F

    got = mixing.mixed(documents(ROWS), weight=F.when(F.col("doc_id") % 2 == 0, 2.0).otherwise(0.5), max_copies=100).collect()
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 100 for taken, target in by_source.values() if target > 100)


def test_repeated_rows_of_the_mix(documents):
    docs = documents(ROWS)
    copies = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
        assert r.target == "x" and r.size == "y"
    assert count == {d: n for d, n in copies.items() if n}


def test_empty_ties_and_repeats(documents):
    assert mixing.mixed(documents([])).count() == 0 and mixing.repeated(documents([])).count() == 0
    got = mixing.mixed(documents([(1, words(3)), (1, words(3)), (1, words(3)), (2, None)])).collect()
    assert sorted((r.size, r.taken) for r in got) == [(0, 0), (3, 3), (3, 3), (3, 3)]


@pytest.mark.parametrize("key", [None, 5])
def test_rows_that_are_alike_share_the_target(documents, key):
    """A key with a thousand rows: the mix comes as near to the targets as with a thousand keys, in sizes and in rows."""
    rows = [(key, words(4), "a")] * 1000 + [(10 + i, words(6), "b") for i in range(500)] + [(7, words(2000), "c")]
    docs = documents(rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    for source, largest in (("a", 4), ("b", 6), ("c", 2000)):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest and all(r.taken <= 3 * r.size for r in own)
    assert 0 < own[0].target
    repeated = mixing.repeated(docs).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in repeated} == {s: sum(r.copies for r in got if r.source == s) for s in "abc" if any(r.copies for r in got if r.source == s)}


def test_very_long_texts(documents):
    got = {r.doc_id: r for r in mixing.mixed(documents([(1, words(300_000)), (2, words(3)), (3, "x" * 1_000_000)])).collect()}
    assert (got[1].size, got[2].size, got[3].size) == (300_000, 3, 1) and got[1].taken == 300_000
