"""The trie of rebuilt conversations, by fingerprints that are put together from parts.

A conversation is rebuilt from the first turns of another one, its base, and its own turns after as many. The rebuilt
texts are never made. A sequence of turns has a fingerprint in a monoid: the pair of ``BASE ** length`` and the sum of
``turn hash * BASE ** (turns after it)``, modulo 2 ** 64; that of two sequences in a row is

    (p, v) . (q, w) = (p * q, v * q + w)

So a prefix of a rebuilt conversation has the fingerprint of a prefix of its base, or that of the base's head times that of a
stretch of its own turns, which is a quotient of two of its prefixes. One pass over the stored turns gives the prefixes of all
conversations; the rest is arithmetic on a few numbers per turn.

A node of the trie is a group of equal prefixes, by depth and fingerprint. Every member refers to the stored turn that it ends
with. Equality is verified: all members of a group must end with turns of the same hash and have the same
fingerprint one turn before, which by induction from the root makes them equal turn by turn, and stored turns of
one hash must have one role and text. If hashes ever fail this, all is done again with other ones, so results are right always.

A node belongs to its smallest member. The nodes of a conversation are a chain: once it is the smallest of a node, it is so in
all nodes below that it is in. So the trie is a tree of chains. What sums up over subtrees is summed along chains, and from
chain to chain by pointer doubling, in as many rounds as the nesting of chains has binary digits, whatever the depth of the trie.

A conversation or a node may hold a third of all rows. Turns and nodes are sorted by range, so a long chain is spread over tasks;
each task sums by itself, and what tasks carry over, one row per task, is added afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrspark.llm.running import BASE, INVERSE, powers, running
from addrspark.llm.tables import n_words, table, text_or_empty
from addrspark.operators.joins import join_splitting
from addrspark.shared import materialize

#: Most turns that a conversation takes from its base.
HEAD = 3
#: Bytes of a list of conversation ids that are kept in one row.
LIST_BYTES = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """(conv_id, at, hash, hash_run, words) of every turn: its place from 0, its hash and the fingerprint of the turns up to it.

    Turns come by ``turn``, null first; several of one number come in the order of their hash.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(F.lit(seed), text_or_empty("role"), text_or_empty("text")).alias("hash"), n_words().alias("words"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # so that even equal turns can be divided
    order = [F.col("turn").asc_nulls_first(), F.col("hash").asc(), F.col("row").asc()]
    return running(rows, "conv_id", order, ["hash"], BASE, "trie-turns").select("conv_id", "at", "hash", "hash_run", "words")


def one_text_per_hash(conversations: DataFrame, seed: int) -> bool:
    """Whether turns with the same hash have the same role and text."""
    turn = F.struct(text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    hashed = conversations.select(F.xxhash64(F.lit(seed), turn["role"], turn["text"]).alias("hash"), turn.alias("turn"))
    return hashed.groupBy("hash").agg(F.min("turn").alias("a"), F.max("turn").alias("b")).where("a <> b").isEmpty()


def rebuilt_prefixes(turns: DataFrame, rebuilds: DataFrame) -> DataFrame:
    """All prefixes of all rebuilt conversations: conv_id, depth, print, hash and words of the last turn, ref, ends.

    ``rebuilds`` has one row per conversation: conv_id, base, head (turns taken from the base, and left out of its own).
    ``ref`` is the stored turn (conversation, place) that the prefix ends with; ``ends`` marks the whole conversation.
    """
    first = F.when(F.col("at") < HEAD, F.struct("at", "hash", "hash_run", "words"))
    heads = turns.groupBy("conv_id").agg((F.max("at") + 1).alias("n"), F.sort_array(F.collect_list(first)).alias("turns"))
    heads = materialize(heads.join(rebuilds, "conv_id", "left"), "trie-heads")
    bases = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("turns").alias("base_turns"))
    plan = heads.join(bases, "base", "left").select(
        "conv_id", "base", "n", "turns", "base_turns", F.least(F.coalesce("head", F.lit(0)), F.lit(HEAD)).cast("int").alias("head"),
        F.coalesce("base_n", F.lit(0)).alias("base_n"))
    plan = plan.withColumn("taken", F.least("head", "base_n").cast("int"))

    def product(turns: str, count: str) -> Column:
        return F.when(F.col(count) > 0, F.get(F.col(turns), F.col(count) - 1)["hash_run"]).otherwise(F.lit(0).cast("long"))

    plan = plan.select(
        "conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
        F.slice("base_turns", F.lit(1), F.col("taken")).alias("head_turns"), product("base_turns", "taken").alias("head_print"),
        F.when(F.col("n") > F.col("head"), product("turns", "head")).otherwise(F.lit(0).cast("long")).alias("own_print"))
    plan = materialize(plan, "trie-plan")
    top = plan.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("print"), F.lit(0).cast("long").alias("hash"),
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("struct<conv_id:bigint,at:bigint>").alias("ref"), (F.col("length") == 0).alias("ends"))
    head = plan.select("conv_id", "base", "length", F.explode("head_turns").alias("t")).select(
        "conv_id", (F.col("t.at") + 1).alias("depth"), F.col("t.hash_run").alias("print"), "t.hash", "t.words",
        F.struct(F.col("base").alias("conv_id"), F.col("t.at").alias("at")).alias("ref"), (F.col("t.at") + 1 == F.col("length")).alias("ends"))

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(c).to_numpy() for c in ("steps", "hash_run", "head_print", "own_print")}
            front = column["head_print"].view(np.uint64) - column["own_print"].view(np.uint64)
            prints = (front * powers(column["steps"]) + column["hash_run"].view(np.uint64)).view(np.int64)
            kept = [batch.column(c) for c in ("conv_id", "depth")], [batch.column(c) for c in ("hash", "words", "at", "ends")]
            yield pa.RecordBatch.from_arrays([*kept[0], pa.array(prints), *kept[1]], names=["conv_id", "depth", "print", "hash", "words", "at", "ends"])

    own = join_splitting(turns, plan.select("conv_id", "head", "taken", "length", "head_print", "own_print"), "conv_id").where("at >= head")
    own = own.select("*", (F.col("at") - F.col("head") + 1).alias("steps"))
    own = own.select("*", (F.col("taken") + F.col("steps")).alias("depth"))
    own = own.select("conv_id", "depth", "hash", "words", "at", (F.col("depth") == F.col("length")).alias("ends"), "steps", "hash_run", "head_print", "own_print")
    own = own.mapInArrow(combined, "conv_id long, depth long, print long, hash long, words long, at long, ends boolean").select(
        "conv_id", "depth", "print", "hash", "words", F.struct("conv_id", "at").alias("ref"), "ends")
    return top.unionByName(head).unionByName(own)


def _before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the print of the prefix that is one turn shorter; for the root, its own."""
    for batch in batches:
        prints, hashes = (batch.column(c).to_numpy().view(np.uint64) for c in ("print", "hash"))
        before = ((prints - hashes) * np.uint64(INVERSE)).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])


def grouped_prefixes(prefixes: DataFrame) -> tuple[DataFrame, bool]:
    """The nodes (depth, print, before, conv_id, n_convs, words, n_ends, end, ref), and whether every group was found equal."""
    prefixes = prefixes.select("conv_id", "depth", "print", "hash", "words", "ends", F.col("ref.conv_id").alias("ref_conv"), F.col("ref.at").alias("ref_at"))
    nodes = prefixes.groupBy("depth", "print").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("hash").alias("hash"), F.max("hash").alias("hash_b"),
        F.min("words").alias("words"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("end"),
        F.min(F.struct("ref_conv", "ref_at")).alias("ref"))
    schema = ("depth long, print long, conv_id long, n_convs long, hash long, hash_b long, words long, n_ends long, end long, "
              "ref struct<ref_conv:bigint,ref_at:bigint>, before long")
    nodes = materialize(nodes.mapInArrow(_before, schema), "trie-nodes")
    # Members with equal prints and equal last turns have equal prints one turn before, as the base can be divided by.
    return nodes.drop("hash", "hash_b"), nodes.where("hash <> hash_b").isEmpty()


def chain_totals(chains: DataFrame, columns: list[str]) -> DataFrame:
    """(conv_id, *columns): sums over each chain and all chains below it; ``chains`` has conv_id, above (null at the root), columns."""
    state = materialize(chains.select("conv_id", "above", *columns), "trie-chains")
    while not state.where("above IS NOT NULL").isEmpty():
        # The sums of a chain cover its 2 ** k nearest levels; those of the chains 2 ** k below cover the next ones.
        below = state.where("above IS NOT NULL").groupBy(F.col("above").alias("conv_id")).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        up = state.where("above IS NOT NULL").select(F.col("conv_id").alias("above"), F.col("above").alias("_above"))
        state = join_splitting(state.join(below, "conv_id", "left"), up, "above", "left")
        state = state.select("conv_id", F.col("_above").alias("above"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in columns])
        state = materialize(state, "trie-chains")
    return state.drop("above")


def member_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) of rows (owner, depth, conv_id): ids in order, joined by commas.

    Sorted by range, so that a node's ids are spread over tasks, which write them out in pieces; a task digests the pieces of its nodes as they come.
    """
    schema = "owner long, depth long, first long, ids string"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, size, out = None, None, [], 0, []
        for batch in batches:
            for owner, depth, conv in zip(*[batch.column(c).to_pylist() for c in ("owner", "depth", "conv_id")]):
                if (owner, depth) != now or size > LIST_BYTES:
                    if ids:
                        out.append((*now, first, ",".join(ids)))
                    now, first, ids, size = (owner, depth), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield _rows(out)
                out = []
        if ids:
            yield _rows([(*now, first, ",".join(ids))])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["owner", "depth", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for owner, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("owner", "depth", "ids")]):
                if (owner, depth) != now:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = (owner, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield _digests(out)
        if now:
            yield _digests([(*now, state.hexdigest())])

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["owner", "depth", "ends_sha256"])

    order = ["owner", "depth", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, schema)
    pieces = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return pieces.mapInArrow(digest, "owner long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuilds: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    ``rebuilds`` (conv_id, base, head) has at most one row per conversation: the first ``head`` turns, at most ``HEAD``, of the conversation
    ``base`` come before the own turns after as many. Conversations without a row there are their own turns. Per node: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and ref_conv, ref_at: a stored turn that it ends with.

    Defined cases: null roles and texts are empty; a null turn comes first; turns of one number come in the order of a hash of role and
    text, and equal rows are as many turns; rows without conv_id are in no conversation; a conversation with nothing left is a
    member of the root only; an empty table gives an empty result. Columns other than conv_id, turn, role and text are not read.
    """
    seed = 0
    while True:
        turns = stored_turns(conversations, seed)
        prefixes = materialize(rebuilt_prefixes(turns, rebuilds), "trie-prefixes")
        nodes, equal = grouped_prefixes(prefixes)
        if equal and one_text_per_hash(conversations, seed):
            break
        seed += 1
    place = F.struct("depth", "print").alias("place")
    owners = nodes.select(place, F.col("conv_id").alias("parent_conv_id"))
    up = F.struct((F.col("depth") - 1).alias("depth"), F.col("before").alias("print")).alias("place")
    nodes = join_splitting(nodes.withColumn("place", up), owners, "place", "left").drop("place")
    # A node's owner and depth name it, as its owner has one prefix of each length.
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    nodes = materialize(nodes, "trie-nodes")
    sums = ["leaves", "saved"]
    start = F.when(F.col("parent_conv_id") != F.col("conv_id"), F.struct(F.col("parent_conv_id").alias("above"), (F.col("depth") - 1).alias("depth")))
    chains = nodes.groupBy("conv_id").agg(F.min(start).alias("start"), *[F.sum(c).alias(c) for c in sums])
    chains = materialize(chains.select("conv_id", "start.above", F.col("start.depth").alias("at_depth"), *sums), "trie-chains")
    totals = chain_totals(chains, sums)
    hung = chains.where("above IS NOT NULL").select("conv_id", "above", "at_depth").join(totals, "conv_id")
    hung = hung.groupBy(F.col("above").alias("conv_id"), F.col("at_depth").alias("depth")).agg(*[F.sum(c).alias(f"hung_{c}") for c in sums])
    steps = nodes.select("conv_id", "depth", *sums).join(hung, ["conv_id", "depth"], "left")
    steps = steps.select("conv_id", "depth", *[(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).alias(c) for c in sums])
    subtree = running(steps, "conv_id", [F.col("depth").desc()], sums, 1, "trie-sums")
    subtree = subtree.select("conv_id", "depth", F.col("leaves_run").alias("n_leaves"), F.col("saved_run").alias("saved_tokens"))
    several = nodes.where("n_ends > 1").select(place, F.col("conv_id").alias("owner"))
    ends = join_splitting(prefixes.where("ends").select(place, "conv_id"), several, "place").select("owner", "place.depth", "conv_id")
    digests = member_digests(ends).withColumnRenamed("owner", "conv_id")
    nodes = nodes.join(subtree, ["conv_id", "depth"]).join(digests, ["conv_id", "depth"], "left")
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string"), 256)).otherwise(NOTHING)
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", one).alias("ends_sha256"),
        "ref.ref_conv", "ref.ref_at")


def twenties(conversations: DataFrame) -> DataFrame:
    """The rebuilds that the query asks for: heads of 0 to 3 turns, by a hash, from the conversation whose id is the next lower multiple of 20."""
    ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("head"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations as rebuilt by ``twenties``."""
    conversations = table(spark, sf_dir, "conversations")
    return prefix_trie(conversations, twenties(conversations)).drop("ref_conv", "ref_at")


#: The same on small tables: every prefix is a list of turns. A checksum is made bit by bit.
OP13_SQL = r"""
WITH RECURSIVE
convs AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc(conv_id, digits, i, c) AS (
    SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM convs
    UNION ALL
    SELECT conv_id, digits, i + 1, list_reduce(
        list_concat([xor(c, CAST(ascii(substr(digits, i + 1, 1)) AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)
    FROM crc WHERE i < length(digits)),
heads AS (SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 4 AS h FROM crc WHERE i = length(digits)),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns
    FROM convs c JOIN heads USING (conv_id) LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (
    SELECT conv_id, depth, turns[1:depth] AS p, depth = len(turns) AS ends
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)),
groups AS (
    SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends,
        CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].text, '[^\x20\x09-\x0D]+')) END AS words
    FROM members GROUP BY depth, p),
nodes AS (
    SELECT n.*, u.conv_id AS parent_conv_id FROM groups n LEFT JOIN groups u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth),
above AS (SELECT n_children, n_convs, words, p[1:k] AS p, k AS depth FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM counted)),
sums AS (
    SELECT depth, p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM above GROUP BY depth, p)
SELECT conv_id, CAST(c.depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM counted c JOIN sums s ON s.depth = c.depth AND s.p = c.p
"""
