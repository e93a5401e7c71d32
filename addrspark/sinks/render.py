"""Rows as lines of text: CSV, TSV, and rows and statements of SQL inserts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from addrspark.operators.ranking import numbered


@dataclass(frozen=True)
class Dialect:
    """How one output format writes a row."""

    quote: str
    separator: str
    null: str
    false: str
    true: str
    escapes: tuple[tuple[str, str], ...]
    row_start: str = ""
    row_end: str = ""
    name_quote: str | None = None
    lower_names: bool = False

    @property
    def inserts(self) -> bool:
        return self.name_quote is not None


# The output formats. The backslash is escaped first.
CSV = Dialect('"', ",", "\\N", "0", "1", (("\\", "\\\\"), ('"', '\\"')))
TSV = Dialect("", "\t", "\\N", "0", "1", (("\\", "\\\\"), ("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")))
MYSQL = Dialect('"', ", ", "NULL", "0", "1", (("\\", "\\\\"), ('"', '\\"')), "\t(", ")", "`")
POSTGRES = Dialect("'", ", ", "NULL", "'0'", "'1'", (("\\", "\\\\"), ("'", "\\'")), "\t(", ")", '"', True)
# As POSTGRES, for servers where a backslash in a text is an ordinary character.
POSTGRES_STANDARD = Dialect("'", ", ", "NULL", "'0'", "'1'", (("'", "''"),), "\t(", ")", '"', True)
DIALECTS = {"csv": CSV, "tsv": TSV, "mysql": MYSQL, "psql": POSTGRES, "psql_standard": POSTGRES_STANDARD}
BATCH_SIZE = 500


def rendered_value(field: T.StructField, dialect: Dialect) -> Column:
    """One value as text, never NULL."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BooleanType):
        value = F.when(column, F.lit(dialect.true)).otherwise(F.lit(dialect.false))
    else:
        value = column.cast("string")
        if isinstance(field.dataType, T.StringType):
            for found, replacement in dialect.escapes:
                value = F.replace(value, F.lit(found), F.lit(replacement))
        value = F.concat(F.lit(dialect.quote), value, F.lit(dialect.quote))
    return F.when(column.isNull(), F.lit(dialect.null)).otherwise(value)


def rendered_row(schema: T.StructType, dialect: Dialect) -> Column:
    """A row as one line, without its end."""
    values = F.concat_ws(dialect.separator, *[rendered_value(field, dialect) for field in schema.fields])
    return F.concat(F.lit(dialect.row_start), values, F.lit(dialect.row_end))


def insert_head(table: str, columns: list[str], dialect: Dialect) -> str:
    """First line of an INSERT statement."""
    quote = dialect.name_quote
    if dialect.lower_names:
        table, columns = table.lower(), [column.lower() for column in columns]
    names = f"{quote}, {quote}".join(columns)
    return f"INSERT INTO {quote}{table}{quote} ({quote}{names}{quote}) VALUES \n"


def row_lines(df: DataFrame, dialect: Dialect, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``line`` per row; columns in ``keep`` stay beside it and are not written."""
    schema = T.StructType([field for field in df.schema.fields if field.name not in keep])
    return df.select(*keep, rendered_row(schema, dialect).alias("line"))


def insert_statements(
    df: DataFrame, table: str, dialect: Dialect, order: list[str], by: tuple[str, ...] = (),
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """INSERT statements of ``batch_size`` rows, numbered from 0 inside ``by``.

    The rows are numbered without gathering a region; a group is one statement.
    """
    schema = T.StructType([field for field in df.schema.fields if field.name not in by])
    numbers = numbered(df, list(by), order, "_number")
    lines = numbers.select(
        *by,
        F.floor((F.col("_number") - 1) / batch_size).cast("bigint").alias("batch"),
        F.struct("_number", rendered_row(schema, dialect).alias("line")).alias("_row"),
    )
    rows = F.array_sort(F.collect_list("_row"))
    body = F.array_join(F.transform(rows, lambda row: row["line"]), ",\n")
    head = insert_head(table, schema.names, dialect)
    return lines.groupBy(*by, "batch").agg(F.concat(F.lit(head), body, F.lit(";\n")).alias("statement"))
