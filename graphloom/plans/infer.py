"""Mapping inference and review (M1-M6): catalogue tables in, mapping tables out.

All steps are set-based over the catalogue of every table at once; the result is three
small DataFrames (see ``graphloom.mapping``) that later jobs read or collect as metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom import model as M
from graphloom.functions.names import (
    attribute_name,
    class_name,
    layer_attribute_name,
    layer_class_name,
    relation_name,
)
from graphloom.mapping import MAP_REL_SCHEMA
from graphloom.operators import catalog as C
from graphloom.session import values


def split_by_hints(columns: DataFrame, hints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6: columns highlighted in a model are relations, the rest attributes."""
    keys = ["table_name", "column_name"]
    h = hints.select(*keys).distinct()
    return columns.join(h, keys, "left_semi"), columns.join(h, keys, "left_anti")


def infer_relations(columns: DataFrame, fk: DataFrame, strip_table_prefix: bool = False) -> DataFrame:
    """M2 (keys known): FK target of each column; the first FK of a column wins."""
    first = fk.groupBy("table_name", "column_name").agg(
        F.min_by("ref_table", F.struct("pos", "ref_table")).alias("target_table")
    )
    return columns.join(first, ["table_name", "column_name"]).select(
        F.col("table_name").alias("tbl"),
        F.col("column_name").alias("col"),
        relation_name(F.col("column_name")).alias("property"),
        "target_table",
        class_name(F.col("target_table"), strip_table_prefix).alias("target_class"),
        F.lit(None).cast("string").alias("sub_property_of"),
        F.lit(True).alias("include"),
    )


def infer_guessed_relations(rel_columns: DataFrame, table_names: list[str], threshold: float = 2.5,
                            strip_table_prefix: bool = False) -> DataFrame:
    """M2 (only hints known): target table guessed by name (A4); unsure guesses are excluded."""
    rels = rel_columns.select("table_name", "column_name", relation_name(F.col("column_name")).alias("rel"))
    guess = C.guess_table(rels, table_names, threshold, strip_table_prefix)
    return rels.join(guess, "rel").select(
        F.col("table_name").alias("tbl"),
        F.col("column_name").alias("col"),
        F.col("rel").alias("property"),
        "target_table",
        class_name(F.col("target_table"), strip_table_prefix).alias("target_class"),
        F.lit(None).cast("string").alias("sub_property_of"),
        (~F.col("unsure")).alias("include"),
    )


def infer_attributes(attr_columns: DataFrame, datatypes: DataFrame, technical=("TimeStamp",)) -> DataFrame:
    """M3: valid columns minus technical ones, typed through the XSD lookup."""
    cols = C.drop_technical(attr_columns, technical)
    return C.as_xsd(cols, datatypes).select(
        F.col("table_name").alias("tbl"),
        F.col("column_name").alias("col"),
        attribute_name(F.col("column_name")).alias("property"),
        "datatype",
        F.lit(None).cast("string").alias("sub_property_of"),
        F.lit(True).alias("include"),
    )


def infer_mapping(tables: DataFrame, columns: DataFrame, pk: DataFrame, fk: DataFrame, datatypes: DataFrame,
                  allow_prefixes=None, deny_prefixes=None, strip_table_prefix: bool = False,
                  hints: DataFrame | None = None, technical=("TimeStamp",), guess_threshold: float = 2.5,
                  drop_primary: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M1: catalogue -> (map_class, map_attr, map_rel).

    Tables: F12 filter; class name L2; identifier A3; link table = name starts ``ktbl``.
    Without hints, relations are the foreign keys (M2) and attributes every other column,
    the primary key included (Q3). With hints (M6), hinted columns are relations whose
    target is guessed (A4) and the rest are attributes.
    """
    kept = C.filter_tables(tables, allow_prefixes, deny_prefixes).select("table_name")
    cols = columns.join(kept, "table_name", "left_semi")
    ident = C.identifier_of(cols, pk)
    map_class = kept.join(ident, "table_name", "left").select(
        F.col("table_name").alias("tbl"),
        class_name(F.col("table_name"), strip_table_prefix).alias("classname"),
        F.col("identifier"),
        F.lit(None).cast("string").alias("sub_class_of"),
        F.lower(F.col("table_name")).startswith("ktbl").alias("link_table"),
        F.lit(True).alias("include"),
        F.coalesce(F.col("unique_key"), F.lit(False)).alias("unique_key"),
    )
    if hints is None:
        map_rel = infer_relations(cols, fk, strip_table_prefix)
        attr_cols = C.list_columns(cols, pk, fk, keys=False, drop_primary=drop_primary)
    else:
        rel_cols, attr_cols = split_by_hints(cols, hints)
        # the candidate list is the catalogue's table names (metadata, one per table)
        names = [r[0] for r in C.filter_tables(tables, allow_prefixes, deny_prefixes)
                 .orderBy("pos").select("table_name").collect()]
        map_rel = infer_guessed_relations(rel_cols, names, guess_threshold, strip_table_prefix)
    map_attr = infer_attributes(attr_cols, datatypes, technical)
    return map_class, map_attr, map_rel


def infer_layer_mapping(layers: DataFrame, fields: DataFrame, datatypes: DataFrame,
                        pattern: str = "[a-z][A-Z][a-z]*") -> tuple[DataFrame, DataFrame, DataFrame]:
    """M4: layers (layer, fid_column) and fields (layer, field_name, field_type) -> mapping.

    F13 keeps layers whose name fully matches ``pattern``; class name L5; every field an
    attribute named by L4 (layer form); superclass ``geo:Feature``; no relations.
    """
    kept = C.filter_layers(layers, pattern)
    map_class = kept.select(
        F.col("layer").alias("tbl"),
        layer_class_name(F.col("layer")).alias("classname"),
        F.col("fid_column").alias("identifier"),
        F.lit(M.GEO_FEATURE).alias("sub_class_of"),
        F.lit(False).alias("link_table"),
        F.lit(True).alias("include"),
        F.lit(False).alias("unique_key"),
    )
    f = fields.join(kept.select("layer"), "layer", "left_semi")
    typed = C.as_xsd(f, datatypes, type_col="field_type")
    map_attr = typed.select(
        F.col("layer").alias("tbl"),
        F.col("field_name").alias("col"),
        layer_attribute_name(F.col("field_name")).alias("property"),
        "datatype",
        F.lit(None).cast("string").alias("sub_property_of"),
        F.lit(True).alias("include"),
    )
    map_rel = values(layers.sparkSession, [], MAP_REL_SCHEMA)
    return map_class, map_attr, map_rel


OVERRIDES_SCHEMA = "tbl string, col string, field string, action string, value string"


def apply_overrides(frame: DataFrame, overrides: DataFrame, keys=("tbl", "col"), excluded_only: bool = True) -> DataFrame:
    """M5: review edits as data.

    ``overrides`` rows (tbl, col, field, action, value): ``set`` a value (cast to the
    field's type), ``invert`` a boolean, or ``confirm`` a guess (``?x?`` -> ``x``). With
    ``excluded_only`` (the default scope) only rows whose ``include`` is false are edited.
    """
    keys = list(keys)
    ov = overrides.select(*keys, "field", "action", "value")
    edits = ov.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("field", F.struct("action", "value")))).alias("_edits")
    )
    joined = frame.join(edits, keys, "left")
    in_scope: Column = F.col("_edits").isNotNull()
    if excluded_only and "include" in frame.columns:
        in_scope = in_scope & ~F.col("include")
    out = []
    for f in frame.schema.fields:
        c = F.col(f.name)
        if f.name in keys:
            out.append(c)
            continue
        e = F.col("_edits")[f.name]
        edited = F.when(e["action"] == "set", e["value"].cast(f.dataType))
        if isinstance(f.dataType, T.BooleanType):
            edited = edited.when(e["action"] == "invert", ~c)
        if isinstance(f.dataType, T.StringType):
            edited = edited.when(
                (e["action"] == "confirm") & C.is_guess(c), F.substring(c, F.lit(2), F.length(c) - 2)
            )
        edited = edited.otherwise(c)
        value = F.when(in_scope & e.isNotNull(), edited).otherwise(c)
        if f.name == "unique_key":  # an identifier that was edited is no declared key any more
            moved = in_scope & F.col("_edits")["identifier"].isNotNull()
            value = F.when(moved & e.isNull(), F.lit(False)).otherwise(value)
        out.append(value.alias(f.name))
    return joined.select(*out)
