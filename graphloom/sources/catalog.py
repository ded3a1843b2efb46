"""Catalogue sources (S4, S5): table and column listings as DataFrames.

A live database exports ``INFORMATION_SCHEMA`` style tables; here they can come from such
an export (any readable table with the columns below), from the Spark catalog, or from the
schemas of DataFrames. Keys (primary/foreign) always arrive as exported tables.

Schemas:
  tables   (table_name, table_type, pos)                   -- pos: listing order
  columns  (table_name, column_name, data_type, ordinal)
  pk       (table_name, column_name)                       -- one row per key column
  fk       (table_name, column_name, ref_table, ref_column, pos)
  datatypes(xsd, source_type)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from graphloom.session import values

TABLES_SCHEMA = "table_name string, table_type string, pos int"
COLUMNS_SCHEMA = "table_name string, column_name string, data_type string, ordinal int"
PK_SCHEMA = "table_name string, column_name string"
FK_SCHEMA = "table_name string, column_name string, ref_table string, ref_column string, pos int"
DATATYPES_SCHEMA = "xsd string, source_type string"


def cat_tables(spark: SparkSession, frames: dict, table_type: str = "BASE TABLE", extra=()) -> DataFrame:
    """S4 from named DataFrames; ``extra`` adds (name, type) rows such as views."""
    rows = [(n, table_type) for n in frames] + list(extra)
    rows = [(n, t, i) for i, (n, t) in enumerate(rows, 1)]
    return values(spark, rows, TABLES_SCHEMA)


def cat_columns(spark: SparkSession, frames: dict, extra=()) -> DataFrame:
    """S5 from DataFrame schemas (type names as Spark prints them)."""
    rows = [
        (n, f.name, f.dataType.simpleString(), i)
        for n, df in frames.items()
        for i, f in enumerate(df.schema.fields, 1)
    ] + list(extra)
    return values(spark, rows, COLUMNS_SCHEMA)


def cat_from_spark(spark: SparkSession, database: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S4 + S5 from the Spark catalog (tables and views of one database)."""
    tables, columns = [], []
    for t in spark.catalog.listTables(database):
        kind = "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "BASE TABLE"
        tables.append((t.name, kind, len(tables) + 1))
        for i, c in enumerate(spark.catalog.listColumns(t.name, database), 1):
            columns.append((t.name, c.name, c.dataType, i))
    return values(spark, tables, TABLES_SCHEMA), values(spark, columns, COLUMNS_SCHEMA)


def datatype_lookup(spark: SparkSession, lookup: dict) -> DataFrame:
    """``{xsd_iri: [source types]}`` -> rows (xsd, source_type)."""
    return values(spark, [(x, s) for x, ss in lookup.items() for s in ss], DATATYPES_SCHEMA)
