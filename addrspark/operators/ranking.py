"""Row numbers in groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

#: Most pieces that rows are parted into to be numbered, and sampled keys per piece.
MOST_PIECES = 256
SAMPLED = 20


def ascending(*names: str) -> list[Column]:
    """Sort keys with missing values last."""
    return [F.col(name).asc_nulls_last() for name in names]


def listed(df: DataFrame, ids: object, *names: str) -> DataFrame:
    """Sorted if the query was asked for a list of objects to read.

    The same query over a table of ids, or over all, is the input of further work;
    sorting it would be one more shuffle of everything.
    """
    return df.orderBy(*ascending(*names)) if isinstance(ids, list) else df


def _literal(value: object, kind: T.DataType) -> Column:
    if isinstance(value, list):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def _less(fields: list[T.StructField], bound: Row) -> Column:
    """Whether a row comes before a bound by the given columns, missing values last."""
    less = F.lit(False)
    for field in reversed(fields):
        column, value = F.col(f"`{field.name}`"), bound[field.name]
        if value is None:
            less = column.isNotNull() | less
        else:
            value = _literal(value, field.dataType)
            less = F.coalesce(column < value, F.lit(False)) | (column.eqNullSafe(value) & less)
    return less


def _piece(fields: list[T.StructField], bounds: list[Row], first: int = 0) -> Column:
    """The number of bounds that a row does not come before: a tree of comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(_less(fields, bounds[middle]), _piece(fields, bounds[:middle], first)).otherwise(
        _piece(fields, bounds[middle + 1 :], first + middle + 1))


def range_bounds(df: DataFrame, columns: list[str], pieces: int) -> list[Row]:
    """Rows of ``columns`` that part ``df`` into about equal pieces in order, missing values last.

    They come from a sample of a bounded number of rows, those with the lowest hashes, so they are the same each time.
    """
    keys = df.select(*[F.col(f"`{c}`") for c in columns])
    sample = keys.orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in columns])).limit(SAMPLED * pieces)
    ordered = sample.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in columns]).collect()
    if len(ordered) < SAMPLED * pieces:  # all rows: too few to be parted
        return []
    return ordered[SAMPLED::SAMPLED]


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "num") -> DataFrame:
    """Add the row number of each row in its group ``by``, from 1, in ``order``.

    A window over the group alone would sort the whole group in one task. Here a sample of the keys gives bounds of ranges,
    by group and order, so that a large group lies in many pieces. Each piece is numbered by itself, and adds the sizes of its group's pieces
    before it: these are counted from the keys alone, and as a bound lies in one group, there is at most one such number per bound.
    So whole rows are shuffled once, and nothing is stored. ``order`` must be unique in a group; ``df`` is read
    three times and must give the same rows each time.
    """
    pieces = min(MOST_PIECES, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = [*by, *order]
    bounds = range_bounds(df, columns, pieces)
    if not bounds:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*ascending(*order))).cast("bigint"))
    rows = df.withColumn("_piece", _piece([df.schema[c] for c in columns], bounds))
    sizes = rows.groupBy(*by, "_piece").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_piece").alias("_of_piece"), F.sum("_rows").over(before).alias("_before"),
    ).where(F.col("_before").isNotNull())
    same = F.col("_piece") == F.col("_of_piece")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    in_piece = Window.partitionBy(*by, "_piece").orderBy(*ascending(*order))
    return (
        rows.withColumn("_in_piece", F.row_number().over(in_piece))
        .join(F.broadcast(offsets), same, "left")  # at most MOST_PIECES rows
        .withColumn(name, F.coalesce("_before", F.lit(0).cast("bigint")) + F.col("_in_piece"))
        .drop("_piece", "_of_piece", "_before", "_in_piece", *[f"_by_{c}" for c in by])
    )


def first_per_group(df: DataFrame, by: list[str], order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group.

    Spark keeps only ``limit`` rows per group before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(*ascending(*order))
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit).drop("_rank")
