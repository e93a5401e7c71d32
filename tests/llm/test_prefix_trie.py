"""The trie against one built of whole lists of turns."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from addrspark.llm import prefix_trie as pt, running as run
from addrspark.llm.queries import oracle_sql, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CONVERSATIONS = "conv_id long, turn long, role string, text string, hash string, depth string, `at` string"


def plain_trie(rows, rebuild):
    """rows (conv_id, turn, role, text), no two of a conversation with one turn number; ``rebuild`` gives (base, head) of a conversation."""
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is not None, r[1])):
        if conv is not None:
            turns.setdefault(conv, []).append((role or "", text or ""))
    whole = {}
    for c, own in turns.items():
        base, head = rebuild(c)
        whole[c] = tuple(turns.get(base, [])[:head] + own[head:])
    nodes = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        gain = (len(members) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
            saved[path[:d]] = saved.get(path[:d], 0) + gain
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(m for m in members if len(whole[m]) == len(path)))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children.get(path, 0), leaves[path],
                    saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def by_twenty(c):
    return c - c % 20, zlib.crc32(str(c).encode()) % 4


def found(df):
    return sorted(tuple(r) for r in df.drop("ref_conv", "ref_at").collect())


def test_random_conversations(spark):
    rng = random.Random(2)
    rows = []
    for c in rng.sample(range(200), 120):
        for turn in range(rng.randrange(7)):
            rows.append((c, turn if turn else None, rng.choice(["user", None]), rng.choice(["a b", "a", "", None]), "x", "y", "z"))
    rows.append((None, 1, "user", "of no conversation", "x", "y", "z"))
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert found(pt.prefix_trie(df, pt.twenties(df))) == plain_trie([r[:4] for r in rows], by_twenty)
    plain = spark.createDataFrame([], "conv_id long, base long, head int")
    nodes = pt.prefix_trie(df, plain)
    assert found(nodes) == plain_trie([r[:4] for r in rows], lambda c: (None, 0))
    # The stored turn that a node refers to is the last one of its smallest member's prefix.
    text = {(r.conv_id, r.at): r.hash for r in pt.stored_turns(df, 0).collect()}
    assert all((n.depth == 0) == (n.ref_conv is None) and (n.depth == 0 or (n.ref_conv, n.ref_at) in text) for n in nodes.collect())


def test_long_and_nested_conversations(spark):
    """A conversation of very many turns, chains that hang on chains, and thousands of equal conversations."""
    rows = [(7, t, "user", "again and again" if t % 3 else "x") for t in range(6000)]
    rows += [(1000 + k, t, "a", f"t{t}") for k in range(40) for t in range(k + 1)]
    rows += [(5000 + k, 0, "same", "one two three") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    none = spark.createDataFrame([], "conv_id long, base long, head int")
    got = {r[:2]: r for r in found(pt.prefix_trie(df.repartition(20), none))}
    short = [r for r in rows if r[0] != 7]
    expected = {r[:2]: r for r in plain_trie([*short, *[r for r in rows if r[0] == 7][:50]], lambda c: (None, 0))}
    assert len(got) == 1 + 6000 + 40 + 1
    for place, row in expected.items():
        if place[0] != 7:
            assert got[place] == row
    assert got[(7, 0)][3:6] == (3041, 3, 3) and got[(7, 6000)][4:6] == (0, 1) and got[(7, 1)][5] == 1


def test_equal_rows_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(1, 0, "u", "a")] * 5 + [(2, 0, "u", "a")] * 4 + [(3, None, None, None)], schema)
    none = spark.createDataFrame([], "conv_id long, base long, head int")
    got = found(pt.prefix_trie(df, none))
    assert [r[:6] for r in got] == [(1, 0, None, 3, 2, 2), (1, 1, 1, 2, 1, 1), (1, 2, 1, 2, 1, 1), (1, 3, 1, 2, 1, 1), (1, 4, 1, 2, 1, 1), (1, 5, 1, 1, 0, 1), (3, 1, 1, 1, 0, 1)]
    assert pt.prefix_trie(spark.createDataFrame([], schema), none).count() == 0


def test_running_folds(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, rng.randrange(-(1 << 62), 1 << 62), 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long, x long, one long").repartition(7)
    for base in (1, run.BASE):
        got = {(r.k, r.i): r for r in run.running(df, "k", [F.col("i")], ["x", "one"], base, "test").collect()}
        state = {}
        for k, i, x, _ in sorted(rows):
            at, fold, ones = state.get(k, (0, 0, 0))
            fold, ones = (fold * base + x) % (1 << 64), (ones * base + 1) % (1 << 64)
            r = got[(k, i)]
            assert (r.at, r.x_run % (1 << 64), r.one_run % (1 << 64)) == (at, fold, ones)
            state[k] = (at + 1, fold, ones)
    assert powers_are_right()


def powers_are_right():
    return run.powers(np.array([0, 1, 2, 70])).tolist() == [pow(run.BASE, e, 1 << 64) for e in (0, 1, 2, 70)]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = plain_trie(rows, by_twenty)
    assert found(queries()["op13_prefix_trie"](spark, path)) == expected
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet'")
        assert sorted(con.execute(oracle_sql()["op13_prefix_trie"]).fetchall()) == expected
