"""Table scan with a projection list and a predicate, pushed to the source.

A source is a Parquet/ORC path, a table in the Spark catalog, or a JDBC table; the
projection and the predicate are ordinary DataFrame operations, so Catalyst hands them
to the scan (Parquet ``PushedFilters``/``ReadSchema``, JDBC ``WHERE`` and column list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, table: str, fmt: str | None = None, options: dict | None = None) -> DataFrame:
    """Open a table: ``fmt`` ``parquet``/``orc``/``csv``/``json`` reads a path, ``jdbc`` reads
    ``table`` through the JDBC ``options`` (url, user, ...), ``None`` names a catalog table."""
    options = dict(options or {})
    if fmt is None:
        return spark.table(table)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=table, **options).load()
    return spark.read.format(fmt).options(**options).load(table)


def scan(df: DataFrame, select: list[str | Column] | None = None, where: str | Column | None = None) -> DataFrame:
    """Predicate first, then projection; both reach the source scan."""
    if where is not None:
        df = df.where(F.expr(where) if isinstance(where, str) else where)
    if select:
        df = df.select(*select)
    return df
