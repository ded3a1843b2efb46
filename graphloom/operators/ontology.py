"""Ontology triples from mapping tables (T9-T12) and cross-reference properties.

Inputs are the mapping DataFrames (``map_class``, ``map_attr``, ``map_rel``) or decoded
rule tables; every class, attribute and relation of every table is handled by one
``inline`` per frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.functions.names import class_name, layer_class_name, title_case, xref_property_iri
from graphloom.operators.triples import (
    comment_of,
    domain_of,
    emit,
    iri_triple,
    label_of,
    range_of,
    subclass_of,
    subproperty_of,
    type_of,
)

# Comment wording of generated properties ({prop}, {cls}, {target} are filled).
ATTR_COMMENT = "Attribuut '{prop}' behorende tot class '{cls}'"
REL_COMMENT = "Relatie '{prop}' tussen classen '{cls}' en '{target}'"
INV_COMMENT = "Relatie '{cls}' (inverse) tussen classen '{target}' en '{cls}'"
XREF_LABEL = "Relatie tussen {src} and {tgt}"
INV_LABEL = "{cls} (inverse)"


def _fmt(template: str, **cols) -> F.Column:
    """Fill ``{name}`` slots of a fixed template with columns."""
    import re

    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts.append(F.lit(template[pos:m.start()]))
        parts.append(cols[m.group(1)])
        pos = m.end()
    parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def included_classes(map_class: DataFrame) -> DataFrame:
    """included classes; link tables left out."""
    return map_class.where(F.col("include") & ~F.col("link_table"))


def class_triples(map_class: DataFrame, ns: str, lang: str = M.DEFAULT_LANG) -> DataFrame:
    """Type owl:Class, label, optional subClassOf."""
    cls = F.concat(F.lit(ns), F.col("classname"))
    return emit(included_classes(map_class), [
        type_of(cls, M.OWL_CLASS),
        label_of(cls, F.col("classname"), lang),
        subclass_of(cls, F.col("sub_class_of")),
    ])


def _with_class(frame: DataFrame, map_class: DataFrame) -> DataFrame:
    cls = included_classes(map_class).select("tbl", "classname")
    return frame.where(F.col("include")).join(cls, "tbl")


def datatype_property_triples(map_class: DataFrame, map_attr: DataFrame, ns: str,
                              lang: str = M.DEFAULT_LANG) -> DataFrame:
    """Type, domain, range, label (title case), comment, optional subPropertyOf."""
    df = _with_class(map_attr, map_class)
    node = F.concat(F.lit(ns), F.lower(F.col("classname")), F.lit("_"), F.lower(F.col("property")))
    cls = F.concat(F.lit(ns), F.col("classname"))
    return emit(df, [
        type_of(node, M.OWL_DATATYPEPROPERTY),
        domain_of(node, cls),
        range_of(node, F.col("datatype")),
        label_of(node, title_case(F.col("property")), lang),
        comment_of(node, _fmt(ATTR_COMMENT, prop=F.col("property"), cls=F.col("classname")), lang),
        subproperty_of(node, F.col("sub_property_of")),
    ])


def object_property_triples(map_class: DataFrame, map_rel: DataFrame, ns: str,
                            lang: str = M.DEFAULT_LANG) -> DataFrame:
    """T11 (forward) and T12 (inverse) object properties of every included relation.

    Several relations between the same pair of classes share one inverse property; the
    caller's set semantics (X1) keep it once.
    """
    df = _with_class(map_rel, map_class)
    cls = F.concat(F.lit(ns), F.col("classname"))
    tgt = F.concat(F.lit(ns), F.col("target_class"))
    fwd = F.concat(F.lit(ns), F.lower(F.col("classname")), F.lit("_"), F.lower(F.col("property")))
    inv = F.concat(F.lit(ns), F.lower(F.col("target_class")), F.lit("_inv_"), F.lower(F.col("classname")))
    return emit(df, [
        type_of(fwd, M.OWL_OBJECTPROPERTY),
        domain_of(fwd, cls),
        range_of(fwd, tgt),
        label_of(fwd, title_case(F.col("property")), lang),
        comment_of(fwd, _fmt(REL_COMMENT, prop=F.col("property"), cls=F.col("classname"),
                             target=F.col("target_class")), lang),
        subproperty_of(fwd, F.col("sub_property_of")),
        type_of(inv, M.OWL_OBJECTPROPERTY),
        domain_of(inv, tgt),
        range_of(inv, cls),
        label_of(inv, _fmt(INV_LABEL, cls=title_case(F.col("classname"))), lang),
        comment_of(inv, _fmt(INV_COMMENT, cls=F.col("classname"), target=F.col("target_class")), lang),
    ])


def rule_class(model: F.Column, db: F.Column, tbl: F.Column, prefix_rule_dbs=()) -> F.Column:
    """Class of a rule term: L2 for ``sql`` models (with the table-prefix rule for the listed
    databases), L5 for layers."""
    strip = db.isin(list(prefix_rule_dbs)) if prefix_rule_dbs else F.lit(False)
    return F.when(model == "sql", class_name(tbl, strip)).otherwise(layer_class_name(tbl))


def xref_property_triples(rules: DataFrame, xref_ns: str, lang: str = M.DEFAULT_LANG) -> DataFrame:
    """Per decoded rule (src_class, tgt_class, tgt_prop, src_ns, tgt_ns): type, domain,
    range, label of the cross-reference property (single slash between namespace and class)."""
    rel = xref_property_iri(xref_ns, F.col("src_class"), F.col("tgt_class"), F.col("tgt_field"))
    return emit(rules, [
        iri_triple(rel, M.RDF_TYPE, M.OWL_OBJECTPROPERTY),
        domain_of(rel, F.concat(F.col("src_ns"), F.col("src_class"))),
        range_of(rel, F.concat(F.col("tgt_ns"), F.col("tgt_class"))),
        label_of(rel, _fmt(XREF_LABEL, src=F.col("src_class"), tgt=F.col("tgt_class")), lang),
    ])
