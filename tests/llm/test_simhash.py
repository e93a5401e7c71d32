"""SimHash against plain counting, trees against all pairs, components against all pairs."""

import random
import re

import xxhash
from hypothesis import given, settings, strategies as st

from addrspark.llm import simhash as sh
from addrspark.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The least key within reach of each (key, print), by all pairs of prints."""
    values = sorted({p for _, p in prints})
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                top[find(a)] = find(b)
    least = {}
    for key, p in prints:
        if key is not None:
            least[find(p)] = min(key, least.get(find(p), key))
    return {p: least.get(find(p)) for p in values}


def expected(rows):
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    of = plain_components(prints)
    return [(key, f"{p:016x}", of[p]) for key, p in prints]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB \n\té\x1c\x0bÉ", max_size=40) | st.lists(st.sampled_from(["one", "Two", "x"]), max_size=30).map(" ".join))
def test_fingerprints(text):
    assert sh.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255) | st.integers(0, (1 << 64) - 1), max_size=60), st.integers(0, 5))
def test_tree_finds_what_all_pairs_do(values, radius):
    tree = sh.BKTree()
    for v in values:
        assert sorted(tree.near(v, radius)) == sorted(o for o in set(tree.values) if (o ^ v).bit_count() <= radius)
        tree.add(v)
    assert sorted(tree.values) == sorted(set(values))


def test_shards_are_divided_without_losing_links(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(5)]
    values = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(150)}
    values |= {i for i in range(32)} | {rng.getrandbits(64) for _ in range(200)} | {(1 << 64) - 1, (1 << 63)}
    rows = spark.createDataFrame([((v - (1 << 64)) if v >> 63 else v,) for v in values], "fp long")
    of = plain_components([(v, v) for v in values])
    for shard in (20, 256):
        links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in sh.near_fingerprints(rows, shard=shard).collect()]
        assert all((u ^ v).bit_count() <= 2 and u != v for u, v in links)
        top = {v: v for v in values}

        def find(v):
            while top[v] != v:
                v = top[v]
            return v
        for u, v in links:
            a, b = find(u), find(v)
            top[max(a, b)] = min(a, b)
        assert {v: find(v) for v in values} == of


def test_special_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (None, ""), (None, "alone here"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"),
            (7, "word " * 40_000), (8, "word " * 40_001), (9, "É é " * 9), (-3, "x y z")]
    base = "the quick brown fox jumps over the lazy dog and runs on along the river side until night falls".split()
    rows += [(20 + i, " ".join(base * 6 + [f"w{i}"])) for i in range(30)]
    got = sh.near_copies(documents(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(rows), key=str)
    assert sh.near_copies(documents([])).count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op12_simhash"](spark, path).collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows))
    assert any(r.doc_id != r.component_id for r in got)
