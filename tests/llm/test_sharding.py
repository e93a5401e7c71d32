"""Jump hashing against the published loop, shards against Python."""

import zlib

import numpy as np

from addrspark.llm import sharding


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_equal_to_the_published_loop():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


ROWS = [(i, f"text {i % 40} é") for i in range(500)] + [(3, "again"), (3, "again"), (None, "no id"), (501, None), (502, "")]


def test_shards(documents):
    got = sharding.sharded(documents(ROWS), 16, bins=8).collect()
    assert len(got) == len(ROWS)
    by_key = {}
    for r in got:
        assert by_key.setdefault(r.doc_id, r.shard) == r.shard
        assert r.grown_shard in (r.shard, 16)
    text = lambda r: (len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(x[0]), *text(x)) for x in ROWS)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard != r.shard for r in got)
    assert 0 < moved < 3 * len(ROWS) / 17


def test_reruns_agree_and_empty(documents):
    rows = lambda: sorted(map(str, sharding.sharded(documents(ROWS)).collect()))
    assert rows() == rows()
    assert sharding.sharded(documents([])).count() == 0


def test_written_shards(spark, documents, tmp_path):
    docs = documents([r for r in ROWS if r[0] is not None][:60])
    sharding.write_shards(docs, str(tmp_path / "out"), 4, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    expected = {r.doc_id: r.shard for r in sharding.sharded(docs, 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == expected and back.count() == 60
