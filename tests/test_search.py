"""Searches through indexes: the same rows as a scan, and little read."""

import random

import pytest
from pyspark.sql import functions as F

from addrspark.functions.names import contains_text
from addrspark.operators.search_index import TextIndex, literal_pieces
from addrspark.plans import addresses as adr
from addrspark.plans.search import AddressIndex


def scans(df):
    """(folder, rows, files) of every parquet scan that a query has made."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        found = []
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            folder = node.relation().location().rootPaths().apply(0).toString()
            found.append((folder, metrics.get("numOutputRows").get().value(), metrics.get("numFiles").get().value()))
        children = node.children()
        for i in range(children.size()):
            found += walk(children.apply(i))
        return found

    return walk(df._jdf.queryExecution().executedPlan())


TEXTS = ["ул Ленина", "УЛ ЛЕНИНСКАЯ", "a.b", "a b", "ab", "x", "", None, "50% off_now", "ΑΣ. ΑΣ", "straße", "line\nbreak", "a\\b"]
PARTS = ["ленин", "УЛ", "л", "a b", "a.b", "ab", "", "%", "a%b", "_", "0\\%", "ας", "ße", "e\nb", "нин ", "zzz", "lenin", "%ленин%ск%"]


def test_pieces_between_wildcards():
    assert literal_pieces("a%bc_d") == ["a", "bc", "d"] and literal_pieces("50\\%x") == ["50", "x"] and literal_pieces("%_") == []


def test_equal_to_a_scan(spark, tmp_path):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abAB .") for _ in range(rng.randrange(12))) for _ in range(200)]
    rows = spark.createDataFrame([(i, t, "other") for i, t in enumerate(texts)], "key long, name string, text2 string")
    index = TextIndex.build(rows, "name", str(tmp_path / "i"), buckets=5)
    assert index.buckets == 5 and index.columns == ["key", "text2"]
    for part in PARTS + ["ab", "aB ", "b", "A.a", "  "]:
        expected = sorted(r.key for r in rows.where(contains_text("name", part)).collect())
        assert sorted(r.key for r in index.search(part).collect()) == expected, part
    both = rows.where(contains_text("name", "ab") & contains_text("name", "b a"))
    assert sorted(r.key for r in index.search("ab", "b a").collect()) == sorted(r.key for r in both.collect())


def test_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], "key long, name string")
    assert TextIndex.build(rows, "name", str(tmp_path / "i"), buckets=2).search("abc").count() == 0


@pytest.fixture(scope="module")
def index(stored, tmp_path_factory):
    return AddressIndex.build(stored, str(tmp_path_factory.mktemp("address-index")), buckets=16)


def test_a_search_reads_the_postings_of_its_rarest_grams(index):
    """Of the postings, only the buckets of the grams are read, and of the texts only those of the candidates' buckets."""
    total = index.addresses.postings.count()
    read = scans(index.addresses.candidates("ustomer#000000052"))
    (folder, rows, files), = [s for s in read if s[0].endswith("postings")]
    assert files <= 4 and rows < total / 3
    assert index.addresses.candidates("qqq").isEmpty()


def test_searches_of_addresses(stored, index):
    def rows(df):
        return sorted(map(tuple, df.collect()))

    for part in ("Customer#00000005", "asia", "a", "ASIA, ", "nowhere"):
        assert rows(index.search_view(part, 10_000)) == rows(adr.search_view(stored, part, 10_000))
    for parts in (["asia", "customer#00000005"], ["asia, ", "5, д. 4"], ["45"], ["д. 45"], ["корп. f"], ["%#%, д. 4%"], [""], ["5, ", "1 с"]):
        assert rows(index.search_full_address(parts, 10_000)) == rows(adr.search_full_address(stored, parts, 10_000)), parts
    assert rows(index.find_houses(stored, "customer#0000000", "45")) == rows(adr.find_houses(stored, "customer#0000000", "45"))
