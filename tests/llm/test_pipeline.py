"""Every stage against a plain version on its own input, and the whole run."""

import collections
import re

import duckdb
import pytest

import corpus_pipeline as pipeline
from addrspark.llm import quality, token_files
from addrspark.shared import materialize
from test_jaccard import plain as plain_components
from test_mixing import plain_mix

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The stored tables before each stage and after the last."""
    tables = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF_DIR), "test-stage"))
    return tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    forest, expected = quality.fitted(stages[0], labels), []
    for row in rows(stages[0]):
        s = quality.statistics([(row[1] or "").encode()])
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        count = collections.Counter(zip(words, words[1:], words[2:]))
        repeated = {i + k for i, t in enumerate(zip(words, words[1:], words[2:])) if count[t] > 1 for k in range(3)}
        passes = len(words) >= 50 and 100 * len(repeated) <= 50 * len(words)
        if passes and forest.scores(quality.features(s))[0] <= forest.threshold:
            expected.append(row)
    assert rows(stages[1]) == expected and 0 < len(expected) < stages[0].count()


def test_near_duplicates(stages):
    before = rows(stages[1])
    kept = {key for key, n, low in plain_components([(r[0], r[1]) for r in before]) if n == 0 or key == low}
    assert rows(stages[2]) == [r for r in before if r[0] in kept]


def test_decontamination(stages):
    items = duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    own = lambda t: f" {' '.join(t.lower().split())} "
    dirty = {r[0] for r in rows(stages[2]) if any(own(t) in own(r[1]) for (t,) in items)}
    assert dirty and rows(stages[3]) == [r for r in rows(stages[2]) if r[0] not in dirty]


def test_mix(stages):
    docs = {r[0]: r for r in rows(stages[3])}
    _, _, mixed = plain_mix([(r[0], r[1], r[3]) for r in docs.values()])
    expected = [docs[d] for d, size, taken in mixed for _ in range(taken // size if size else 0)]
    assert rows(stages[4]) == sorted(expected, key=str)


def test_tokens(stages):
    encode, at = token_files.encoder(token_files.default_tokenizer()), 0
    got = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows(stages[4]))
    texts = {r[0]: r[1] for r in rows(stages[4])}
    for r in got:
        assert r.start == at and r.n_tokens == len(encode.whole([texts[r.doc_id]])[0]) // 4 + 1
        at += r.n_tokens


def test_run(spark, stages):
    assert rows(pipeline.run(spark, SF_DIR)) == rows(stages[-1])
