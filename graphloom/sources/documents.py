"""Mapping documents (S6, S10): JSON text <-> mapping tables.

Document shape (keys are data, so the reader declares the schema instead of inferring it):

    {"metadata": {"database": db},
     "schema": {tbl: {"classname", "identifier", "subClassOf", "link_table", "include",
                      "attributes": {col: {"property", "datatype", "subPropertyOf", "include"}},
                      "relations": {col: {"property", "subPropertyOf", "targettable",
                                          "targetclassname", "include"}}}}}
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTR_T = "struct<datatype:string, include:boolean, property:string, subPropertyOf:string>"
REL_T = ("struct<include:boolean, property:string, subPropertyOf:string, targetclassname:string, "
         "targettable:string>")
TABLE_T = (f"struct<attributes:map<string,{ATTR_T}>, classname:string, identifier:string, include:boolean, "
           f"link_table:boolean, relations:map<string,{REL_T}>, subClassOf:string>")
DOC_T = f"struct<metadata:struct<database:string>, schema:map<string,{TABLE_T}>>"


def parse_mapping(docs: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents (one JSON text per row) -> (db, map_class, map_attr, map_rel)."""
    d = docs.select(F.from_json(F.col(col), DOC_T).alias("d"))
    db = d.select(F.col("d.metadata.database").alias("db"))
    tables = d.select(F.explode("d.schema").alias("tbl", "t"))
    map_class = tables.select(
        "tbl", F.col("t.classname").alias("classname"), F.col("t.identifier").alias("identifier"),
        F.col("t.subClassOf").alias("sub_class_of"), F.coalesce("t.link_table", F.lit(False)).alias("link_table"),
        F.coalesce("t.include", F.lit(True)).alias("include"),
        F.lit(False).alias("unique_key"),  # not carried by documents: no uniqueness assumed
    )
    map_attr = tables.select("tbl", F.explode("t.attributes").alias("col", "a")).select(
        "tbl", "col", F.col("a.property").alias("property"), F.col("a.datatype").alias("datatype"),
        F.col("a.subPropertyOf").alias("sub_property_of"), F.coalesce("a.include", F.lit(True)).alias("include"),
    )
    map_rel = tables.select("tbl", F.explode("t.relations").alias("col", "r")).select(
        "tbl", "col", F.col("r.property").alias("property"), F.col("r.targettable").alias("target_table"),
        F.col("r.targetclassname").alias("target_class"), F.col("r.subPropertyOf").alias("sub_property_of"),
        F.coalesce("r.include", F.lit(True)).alias("include"),
    )
    return db, map_class, map_attr, map_rel


def load_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Read mapping documents (one per file, read whole) into mapping tables."""
    return parse_mapping(spark.read.text(path, wholetext=True))


def _sorted_map(entries, key: str):
    """Map from collected (key, value) structs with keys in ascending order (values may be
    maps, which are not orderable, so the sort compares keys only)."""
    cmp = lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)
    return F.map_from_entries(F.array_sort(F.collect_list(entries), cmp))


def mapping_document(db: str, map_class: DataFrame, map_attr: DataFrame, map_rel: DataFrame) -> DataFrame:
    """S10 + O1: one row ``value`` holding the JSON document, keys sorted, nulls written."""
    attrs = map_attr.groupBy("tbl").agg(_sorted_map(F.struct("col", F.struct(
        "datatype", "include", "property", F.col("sub_property_of").alias("subPropertyOf"))), "col").alias("attributes"))
    rels = map_rel.groupBy("tbl").agg(_sorted_map(F.struct("col", F.struct(
        "include", "property", F.col("sub_property_of").alias("subPropertyOf"),
        F.col("target_class").alias("targetclassname"), F.col("target_table").alias("targettable"),
    )), "col").alias("relations"))
    empty_a = F.create_map().cast(f"map<string,{ATTR_T}>")
    empty_r = F.create_map().cast(f"map<string,{REL_T}>")
    tables = map_class.join(attrs, "tbl", "left").join(rels, "tbl", "left").select(
        "tbl", F.struct(
            F.coalesce("attributes", empty_a).alias("attributes"), "classname", "identifier", "include",
            "link_table", F.coalesce("relations", empty_r).alias("relations"),
            F.col("sub_class_of").alias("subClassOf"),
        ).alias("t"),
    )
    doc = tables.agg(_sorted_map(F.struct("tbl", "t"), "tbl").alias("schema")).select(
        F.struct(F.struct(F.lit(db).alias("database")).alias("metadata"), "schema").alias("d")
    )
    return doc.select(F.to_json("d", {"ignoreNullFields": "false"}).alias("value"))


def write_mapping(db: str, map_class: DataFrame, map_attr: DataFrame, map_rel: DataFrame, path: str,
                  mode: str = "error") -> str:
    """Write the mapping document as one text file (catalogue-sized)."""
    mapping_document(db, map_class, map_attr, map_rel).coalesce(1).write.mode(mode).text(path)
    return path
