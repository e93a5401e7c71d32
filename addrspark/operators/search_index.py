"""An inverted index of n-grams for searches of text parts.

A text is found by a part if the part is in it, whatever the case. Then all n-grams inside the part are among those of the text. The
index holds, for every gram, the numbers of the texts that have it (its postings), and how many they are. A search takes the
rarest grams of the part, intersects their postings and compares only the texts that are left; so its work follows the
number of texts with the rarest gram, not the number of texts. A part that is shorter than a gram is found through all grams
that hold it: padding gives every character of a text a gram.

Stored as parquet folders below one base, each dealt to buckets by a hash that is a folder name, so that a search reads
the buckets of its grams only:

========= ===============================================================
texts     ``id``, the text, and the columns that name its row; by id
postings  ``gram``, ``id``; by gram, sorted by gram
counts    ``gram``, ``n``; by gram
about     one row: the schema of the texts, the number of buckets
========= ===============================================================

The index is of the texts as they were when it was built: after a load, build it again.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from addrspark.functions.names import contains_text
from addrspark.functions.text import REPLACEMENT, SEPARATORS, ngrams

GRAM = 3
#: Grams of a part whose postings are intersected: the rarest ones.
INTERSECTED = 4
POSTINGS, COUNTS = "id long, gram string, bucket int", "gram string, n long, bucket int"


def folded(text: Column | str) -> Column:
    """The form that grams are made of: lower case as a comparison without case sees it, then separators replaced, one character for one."""
    return F.regexp_replace(F.lower(text), SEPARATORS, REPLACEMENT)


def gram_list(text: Column | str) -> Column:
    """The different padded grams of a text."""
    return F.array_distinct(F.split(ngrams(folded(text), GRAM), " "))


def inner_grams(text: Column) -> Column:
    """The grams inside a text, without padding; none if it is shorter than a gram."""
    form = folded(text)
    starts = F.sequence(F.lit(1), F.length(form) - GRAM + 1)
    return F.when(F.length(form) < GRAM, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(starts, lambda i: F.substring(form, i, F.lit(GRAM)))))


def literal_pieces(part: str) -> list[str]:
    """What a text must hold to match a part: the pieces between its wildcards."""
    return [piece for piece in re.split(r"\\.|[%_]", part, flags=re.DOTALL) if piece]


def bucket_of(column: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


class TextIndex:
    """A stored index; ``columns`` name the rows of the indexed texts."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        about = spark.read.parquet(f"{base}/about").first()
        self.buckets = about.buckets
        schemas = {"texts": T.StructType.fromJson(json.loads(about.texts)), "postings": POSTINGS, "counts": COUNTS}
        self.texts, self.postings, self.counts = (spark.read.schema(schema).parquet(f"{base}/{name}") for name, schema in schemas.items())
        self.columns = [c for c in self.texts.columns if c not in ("id", "text", "bucket")]

    @classmethod
    def build(cls, rows: DataFrame, text: str, base: str, buckets: int = 64) -> TextIndex:
        """Index the column ``text`` of ``rows`` with the other columns; null texts are not found by any part and left out.

        ``buckets`` should give a bucket of the postings some hundred megabytes; a frequent gram makes its bucket larger, and such a
        gram is read only by parts that have no rarer one.
        """
        others = [c for c in rows.columns if c != text]
        rows = rows.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), *others)
        rows = rows.withColumn("id", F.monotonically_increasing_id()).select("id", "text", *others, bucket_of("id", buckets).alias("bucket"))
        rows.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{base}/texts")
        # The numbers are read back: they are those of this one run.
        spark = rows.sparkSession
        stored = spark.read.schema(rows.schema).parquet(f"{base}/texts")
        grams = stored.select("id", F.explode(gram_list("text")).alias("gram")).withColumn("bucket", bucket_of("gram", buckets))
        grams.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "gram", "id").write.partitionBy("bucket").parquet(f"{base}/postings")
        postings = spark.read.schema(POSTINGS).parquet(f"{base}/postings")
        counts = postings.groupBy("bucket", "gram").agg(F.count("*").alias("n"))
        counts.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{base}/counts")
        spark.createDataFrame([(rows.schema.json(), buckets)], "texts string, buckets int").coalesce(1).write.parquet(f"{base}/about")
        return cls(spark, base)

    def _of_grams(self, table: DataFrame, grams: list[str]) -> DataFrame:
        """Rows of the grams; only their buckets are read, and in them the row groups that may hold them."""
        numbers = self.spark.createDataFrame([(g,) for g in grams], "gram string").select(bucket_of("gram", self.buckets)).collect()
        return table.where(F.col("bucket").isin(sorted({n for n, in numbers})) & F.col("gram").isin(grams))

    def candidates(self, part: str) -> DataFrame | None:
        """Ids of the texts that may match a part; None if all may."""
        pieces = literal_pieces(part)
        if not pieces:
            return None
        parts = self.spark.createDataFrame([(p,) for p in pieces], "part string").select(inner_grams(F.col("part")).alias("g"), folded("part").alias("f"))
        parts = parts.collect()
        grams = sorted({g for row in parts for g in row.g})
        if not grams:  # all pieces are shorter than a gram: the union of the grams that hold the longest one
            longest = max((row.f for row in parts), key=len)
            found = self.counts.where(F.col("gram").contains(longest)).select("bucket", "gram")
            return self.postings.join(found, ["bucket", "gram"], "left_semi").select("id").distinct()
        counts = {row.gram: row.n for row in self._of_grams(self.counts, grams).collect()}  # a row for each gram of the part
        if len(counts) < len(grams):
            return self.postings.where("false").select("id")
        rarest = sorted(grams, key=lambda g: (counts[g], g))[:INTERSECTED]
        lists = self._of_grams(self.postings, rarest).groupBy("id").agg(F.count("*").alias("n"))
        return lists.where(F.col("n") == len(rarest)).select("id")

    def search(self, *parts: str) -> DataFrame:
        """The rows whose text matches all parts, as ``contains_text`` does: the columns and ``text``."""
        lists = [ids for ids in map(self.candidates, parts) if ids is not None]
        rows = self.texts
        if lists:
            ids = reduce(lambda a, b: a.join(b, "id", "left_semi"), lists).withColumn("bucket", bucket_of("id", self.buckets))
            rows = rows.join(ids, ["bucket", "id"], "left_semi")
        for part in parts:
            rows = rows.where(contains_text("text", part))
        return rows.select(*self.columns, "text")
