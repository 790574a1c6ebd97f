"""Tab- and comma-separated table files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.decode import export_text
from daybook.plans.books import Books, default_of
from daybook.schema import CONFIG, TABLES, Table, incremental_columns

NULL_MARK = "ñ"


def _columns(table: Table, incremental: bool) -> list[tuple[str, str]]:
    if incremental:
        return incremental_columns(table)
    return [(c, table.type(c)) for c in table.columns]


def _text_schema(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in columns])


def _typed(name: str, sql_type: str) -> Column:
    """NULL for the null mark and for unreadable values; missing text is ''."""
    c = F.col(f"`{name}`")
    if sql_type == "string":
        return F.when(c == NULL_MARK, None).otherwise(F.coalesce(c, F.lit(""))).alias(name)
    kept = F.when(c != NULL_MARK, F.trim(c))
    return kept.try_cast(sql_type).alias(name)


def read_table(spark: SparkSession, path: str, table: Table | str,
               incremental: bool = False) -> DataFrame:
    """A tab-separated file with a header row, typed by the table definition.

    Quotes are ordinary characters. The file is read as text first so that one unreadable
    value costs that value and not its row.
    """
    table = TABLES[table] if isinstance(table, str) else table
    columns = _columns(table, incremental)
    raw = spark.read.csv(path, sep="\t", header=True, quote="", schema=_text_schema(columns),
                         enforceSchema=True, mode="PERMISSIVE")
    return raw.select(*[_typed(name, sql_type) for name, sql_type in columns])


def read_export(spark: SparkSession, path: str, table: Table | str,
                incremental: bool = False) -> DataFrame:
    """A raw tab-separated export, typed by the table definition.

    Lines still hold the envelope, entities and break markers of the export. Columns are cut
    first, so that a cleaned value cannot hold a separator; there is no header row.
    """
    table = TABLES[table] if isinstance(table, str) else table
    columns = _columns(table, incremental)
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(</?ENVELOPE>)?\s*$"))
    cells = F.split(F.regexp_replace("value", r"</?ENVELOPE>", ""), "\t")
    named = lines.select(*[
        export_text(F.coalesce(F.get(cells, F.lit(i)), F.lit(""))).alias(name) for i, (name, _) in enumerate(columns)])
    return named.select(*[_typed(name, sql_type) for name, sql_type in columns])


def read_csv(spark: SparkSession, path: str, table: Table | str,
             incremental: bool = False) -> DataFrame:
    """A CSV file written by the CSV sink: header, doubled quotes, empty = NULL."""
    table = TABLES[table] if isinstance(table, str) else table
    columns = _columns(table, incremental)
    raw = spark.read.csv(path, header=True, quote='"', escape='"', schema=_text_schema(columns),
                         multiLine=False, mode="PERMISSIVE")
    return raw.select(*[
        F.coalesce(F.col(f"`{n}`"), default_of(t)).alias(n) if t == "string"
        else F.trim(F.col(f"`{n}`")).try_cast(t).alias(n)
        for n, t in columns])


def open_csv(spark: SparkSession, folder: str, views: bool = True) -> Books:
    """All tables from ``folder/<table>.csv``, registered as views.

    The run state is declared with its columns but, having no file of its own, is empty.
    """
    def reader(name: str):
        return lambda: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", name)

    books = Books(spark, {
        CONFIG.name: spark.createDataFrame([], CONFIG.schema), **{n: reader(n) for n in TABLES}})
    if views:
        books.create_views()
    return books
