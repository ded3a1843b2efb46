"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.session import materialize

#: A word: a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the lineage is cut, a
    lost executor loses nothing, and the read-back carries exact size statistics."""
    return materialize(df, name)


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_long(hex_text: Column, start: int, digits: int) -> Column:
    """Digits of a hexadecimal text as a non-negative long (up to 15 digits)."""
    return F.conv(F.substring(hex_text, start, digits), 16, 10).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, ... in the given order, without a single-task sort.

    Rows are range-partitioned by the order and staged with their partition number; the
    partitions' row counts (as many rows as partitions) give each partition its offset.
    """
    parts = stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(offsets, "_part").withColumn(name, F.col("_before") + place - 1).drop("_part", "_before")
