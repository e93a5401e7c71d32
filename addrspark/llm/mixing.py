"""Mix sources to target weights by Pareto order sampling.

Each source gets a target number of words. A document is expected to be taken
``weight * target / weighted size`` times, ``weight`` being 1 unless a column gives
it. The whole copies of that number are certain. The rest is an inclusion
probability below 1, and the documents of a source are ranked by

    (u / (1 - u)) / (p / (1 - p))

with a uniform number u that depends on the document and the seed alone (Pareto
order sampling): the random odds over the inclusion odds. The first ranks, until the words that are
still wanted are reached, get one more copy, so the sample has a fixed size in words
and unequal probabilities.

No source is gathered anywhere. The ranks of a source fall into bins by their
leading bits; sums of the bins, made before any shuffle, tell in which bin the cut
lies, and only the rows of that bin, those that are alike as one, are put in order. The cut is one row per source, so
documents are decided where they are, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from addrspark.llm.running import running
from addrspark.llm.tables import n_words, table
from addrspark.shared import materialize

#: Weights of the sources in order of their names, repeated; as the contract fixes them.
WEIGHTS = (1, 2, 3)
#: No document is taken more often, no target exceeds so many times the source's size.
MAX_COPIES = 3
#: Bins of the ranks of one source. The rows of one bin are put in order by one task.
BINS = 1 << 14


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the key: 52 bits of an MD5 sum; the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Target words of each source; ``sizes`` has one row (source, source_size) per source.

    The sources share the words of all by weight. A target above ``max_copies`` times
    its source's size stops there, and the excess is shared again by weight. With the
    sources in order of ``max_copies * size / weight``, those that stop are the first
    ones: after j stops the others get ``left / weights left`` per weight, and the
    right j is the first where that is not above the next source's limit. One row per
    source is put in order, not one per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("_weight", cycle).withColumn("_cap", F.col("source_size").cast("double") * max_copies)
    order = [F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onwards = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(onwards)
    leveled = capped.withColumn("_level", level)
    stands = F.col("_level") <= F.col("_cap") / F.col("_weight")
    common = F.max(F.when(stands, F.col("_level"))).over(everything)  # of the first that stands: levels fall from there
    leveled = leveled.withColumn("_common", common)
    target = F.least(F.col("_cap"), F.coalesce(F.col("_common") * F.col("_weight"), F.col("_cap")))
    return leveled.select("source", "source_size", target.alias("target"))


def _expected(max_copies: int) -> tuple[Column, Column]:
    """Certain copies and the inclusion probability of one more, of rows joined to the plan."""
    times = F.coalesce(F.col("_w") * F.col("target") / F.nullif(F.col("_weighted"), F.lit(0.0)), F.lit(0.0))
    whole = F.least(F.floor(times), F.lit(max_copies)).cast("long")
    return whole, F.when(whole >= max_copies, 0.0).otherwise(times - F.floor(times))


def _ranked(rows: DataFrame, seed: int, max_copies: int) -> DataFrame:
    """With ``_whole`` and ``_rank``, the order in which documents get one more copy; null if they can't."""
    u = uniform(F.col("_key"), seed)
    whole, p = _expected(max_copies)
    rows = rows.withColumn("_whole", whole).withColumn("_p", p)
    odds = (u / (1 - u)) * ((1 - F.col("_p")) / F.col("_p"))
    return rows.withColumn("_rank", F.when((F.col("_p") > 0) & (F.col("size") > 0), odds))


def _place() -> Column:
    return F.struct(F.col("_rank"), F.col("_key"), F.col("size"))


def mix_plan(
    rows: DataFrame, *, seed: int = 17, max_copies: int = MAX_COPIES, weights: tuple[int, ...] = WEIGHTS, bins: int = BINS,
) -> DataFrame:
    """One row per source: source_size, target, ``_cut``, the place of the last documents with one more copy, and of the
    ``_alike`` rows in that place ``_in``, the number that get one.

    ``rows`` has (_key, source, size, _w) for every document.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("_w") * F.col("size")).alias("_weighted"))
    plan = _with(sums, targets(sums.select("source", "source_size"), weights, max_copies).drop("source_size"))
    plan = materialize(plan, "mix-targets")
    ranked = _ranked(_with(rows, plan), seed, max_copies)
    ranked = ranked.withColumn("_bin", F.floor(F.col("_rank") / (F.col("_rank") + 1) * bins).cast("int"))
    in_bin = ranked.groupBy("source", "_bin").agg(
        F.sum(F.when(F.col("_rank").isNotNull(), F.col("size")).otherwise(0)).alias("_words"),
        F.sum(F.col("_whole") * F.col("size")).alias("_certain"), F.max("target").alias("_target"))
    up_to = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    in_bin = in_bin.withColumn("_before", F.coalesce(F.sum("_words").over(up_to), F.lit(0)))
    in_bin = in_bin.withColumn("_rest", F.col("_target") - F.sum("_certain").over(Window.partitionBy("source")))
    in_bin = in_bin.where(F.col("_bin").isNotNull() & (F.col("_words") > 0) & (F.col("_before") <= F.col("_rest")))
    # Of the bins that begin before the cut, the last two hold it: a document is in if its middle is.
    back = Window.partitionBy("source").orderBy(F.col("_bin").desc())
    near = in_bin.withColumn("_back", F.row_number().over(back)).where("_back <= 2")
    near = near.select(F.col("source").alias("_source"), F.col("_bin").alias("_of_bin"), "_before", "_rest")
    # Rows that are alike are one group, however many they are.
    groups = ranked.groupBy("source", "_bin", "_rank", "_key", "size").agg(F.count("*").alias("_n"))
    groups = groups.join(near, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bin") == F.col("_of_bin")))
    earlier = Window.partitionBy("source", "_bin").orderBy(*[F.col(c).asc() for c in ("_rank", "_key", "size")]).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.col("_before") - F.coalesce(F.sum(F.col("size") * F.col("_n")).over(earlier), F.lit(0))
    groups = groups.withColumn("_in", F.least(F.floor(left / F.col("size") + 0.5), F.col("_n")))
    cuts = groups.where("_in > 0").groupBy("source").agg(F.max(F.struct(_place().alias("cut"), "_in", F.col("_n").alias("_alike"))).alias("_last"))
    cuts = cuts.select("source", F.col("_last.cut").alias("_cut"), "_last._in", "_last._alike")
    return materialize(_with(plan, cuts, "left"), "mix-plan")


def _with(rows: DataFrame, by_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table with one row per source; null is a source. Adaptive execution broadcasts it if measured as small."""
    other = by_source.withColumnRenamed("source", "_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _sized(docs: DataFrame, key: str, source: str, size: Column | None, weight: Column | None) -> list[Column]:
    return [
        F.col(key).alias("_key"), F.col(source).alias("source"), (n_words() if size is None else size).cast("long").alias("size"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("_w"),
    ]


def _decided(rows: DataFrame, plan: DataFrame, seed: int, max_copies: int) -> DataFrame:
    """With ``copies``. Where only some of the rows in the last place get one more, these rows alone are stored and numbered."""
    joined = _ranked(_with(rows, plan), seed, max_copies)

    def copies(more: Column) -> Column:
        return F.when(F.col("size") > 0, F.col("_whole") + F.coalesce(more, F.lit(False)).cast("long")).otherwise(F.lit(0).cast("long"))

    ranked = F.col("_rank").isNotNull()
    decided = joined.withColumn("copies", copies(ranked & (_place() <= F.col("_cut"))))
    if plan.where("_in < _alike").isEmpty():
        return decided
    some = F.coalesce(ranked & (F.col("_in") < F.col("_alike")) & _place().eqNullSafe(F.col("_cut")), F.lit(False))
    alike = materialize(joined.where(some).withColumn("_of", F.xxhash64("source")).withColumn("_n", F.monotonically_increasing_id()), "mix-alike")
    numbered = running(alike, "_of", [F.col("_n")], [], 1, "mix-numbered")
    return decided.where(~some).unionByName(numbered.withColumn("copies", copies(F.col("at") < F.col("_in"))).drop("at", "_of", "_n"))


def mixed(
    docs: DataFrame, *, key: str = "doc_id", source: str = "source", size: Column | None = None, weight: Column | None = None,
    seed: int = 17, max_copies: int = MAX_COPIES, weights: tuple[int, ...] = WEIGHTS, bins: int = BINS,
) -> DataFrame:
    """One row per row of ``docs``: key, source, size, source_size, target, copies, taken.

    ``size`` is the number of words of ``text`` unless given. Defined cases: a null
    text has size 0 and, as any document without words, is taken 0 times; null sources
    are one source, last in order; rows with the same key have the same random number
    and are ranked by size, and of rows that are alike in key and size as many as are wanted get
    one more copy; a null key is a key of its own; an empty table gives an empty result. Columns other than
    key, source and text are not read. ``weight`` must not be negative; what the limit
    of ``max_copies`` cuts off is not given to other documents of the source.
    """
    rows = materialize(docs.select(*_sized(docs, key, source, size, weight)), "mix-sizes")
    plan = mix_plan(rows, seed=seed, max_copies=max_copies, weights=weights, bins=bins)
    rows = _decided(rows, plan, seed, max_copies)
    return rows.select(
        F.col("_key").alias(key), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, *, key: str = "doc_id", source: str = "source", seed: int = 17, max_copies: int = MAX_COPIES,
             weights: tuple[int, ...] = WEIGHTS, bins: int = BINS) -> DataFrame:
    """The mix itself: the rows of ``docs`` with their columns, each as often as it is taken."""
    rows = materialize(docs.select(*_sized(docs, key, source, None, None)), "mix-sizes")
    plan = mix_plan(rows, seed=seed, max_copies=max_copies, weights=weights, bins=bins)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *_sized(docs, key, source, None, None))
    chosen = _decided(whole, plan, seed, max_copies).where("copies > 0")
    return chosen.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes from each."""
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = """
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
    SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
        ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM sums),
leveled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted),
plan AS (
    SELECT source, source_size, least(cap, coalesce(
        (max(CASE WHEN level <= cap / weight THEN level END) OVER ()) * weight, cap)) AS target FROM leveled),
expected AS (
    SELECT s.doc_id, s.source, s.size, p.source_size, p.target,
        coalesce(p.target / nullif(p.source_size, 0)::DOUBLE, 0) AS times,
        (('0x' || substr(md5('17:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
parts AS (
    SELECT *, least(floor(times), 3)::BIGINT AS whole, CASE WHEN times >= 3 THEN 0 ELSE times - floor(times) END AS p FROM expected),
ranked AS (
    SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS rank,
        target - sum(whole * size) OVER (PARTITION BY source) AS rest FROM parts),
summed AS (
    SELECT *, sum(CASE WHEN rank IS NULL THEN 0 ELSE size END) OVER (
        PARTITION BY source ORDER BY rank ASC NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN rank IS NOT NULL AND upto - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
