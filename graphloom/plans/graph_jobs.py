"""Graph-to-graph jobs: cross-reference (G1, T16), enrichment (G2), type alignment (G3),
merge (X2) and ontology (M7).

Rule documents are configuration; they become small DataFrames decoded by Spark
expressions (L12, L13) and are broadcast into the data joins. The driver only reads the
base IRI of each input graph (one row, O2) and the decoded rule rows to unroll templates.
"""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.functions.names import concept_class_name, relation_name, xref_property_iri
from graphloom.functions.rules import decode_concept_property, decode_concept_subtype, decode_rule, source_of
from graphloom.operators import enrich as EN
from graphloom.operators import ontology as O
from graphloom.operators import patterns as P
from graphloom.operators.metadata import base_of, refresh_metadata, with_metadata
from graphloom.operators.sets import as_set, named, stage, union_all
from graphloom.operators.triples import empty_triples
from graphloom.session import values


LOG = logging.getLogger(__name__)


# ---- graph identity ----------------------------------------------------------------------


def graph_identity(graph: DataFrame, known=None) -> dict:
    """O2 + L14: base IRI, kind, source name and schema namespace of a graph (one row)."""
    row = base_of(graph).select(
        "base", "kind", source_of(F.col("base")).alias("src")
    ).first()
    if row is None:
        raise ValueError("graph has no subject typed owl:Ontology or void:Dataset")
    if row.src is None or not row.src.db:
        raise ValueError(f"cannot determine the source of namespace {row.base}")
    if known is not None and row.src.db not in known:
        raise ValueError(f"source not supported: {row.src.db}")
    return {
        "base": row.base,
        "kind": row.kind,
        "db": row.src.db,
        "root": row.src.base,
        "schema_ns": f"{row.src.base}schema/{row.src.db}/",
        "data_ns": f"{row.src.base}{row.src.db}/",
    }


# ---- cross-reference (G1) -----------------------------------------------------------------

XREF_RULES_SCHEMA = "db string, rule_pos int, source string, target string"


def xref_rules(spark: SparkSession, doc: dict, report: bool = False) -> DataFrame:
    """Rule document ``{db: [{source, target}]}`` -> decoded rows; undecodable rules are
    dropped (Q18) and, with ``report``, logged (the rule list is configuration-sized)."""
    rows = [(db, i, r.get("source"), r.get("target")) for db, rs in doc.items() for i, r in enumerate(rs)]
    df = values(spark, rows, XREF_RULES_SCHEMA)
    dec = df.select("db", "rule_pos", "source", "target", decode_rule(F.col("source")).alias("src"),
                    decode_rule(F.col("target")).alias("tgt"))
    ok = F.col("src").isNotNull() & F.col("tgt").isNotNull()
    if report:
        for r in dec.where(~ok).select("db", "rule_pos", "source", "target").collect():
            LOG.warning("skipped undecodable cross-reference rule %s[%d]: %s -> %s", r.db, r.rule_pos, r.source,
                        r.target)
    return dec.where(ok).drop("source", "target")


def _rule_frame(rules: DataFrame, src_db: str, tgt_db: str, src_ns: str, tgt_ns: str, xref_ns: str,
                prefix_rule_dbs=()) -> DataFrame:
    r = rules.where((F.col("db") == src_db) & (F.col("tgt.db") == tgt_db))
    src_class = O.rule_class(F.col("src.model"), F.lit(src_db), F.col("src.tbl"), prefix_rule_dbs)
    tgt_class = O.rule_class(F.col("tgt.model"), F.lit(tgt_db), F.col("tgt.tbl"), prefix_rule_dbs)
    return r.select(
        F.concat_ws("/", F.lit(src_db), F.col("rule_pos").cast("string")).alias("rule_id"),
        src_class.alias("src_class_name"),
        tgt_class.alias("tgt_class_name"),
        F.col("tgt.prop").alias("tgt_field"),
        F.concat(F.lit(src_ns), src_class).alias("src_class"),
        F.concat(F.lit(src_ns), F.lower(src_class), F.lit("_"), F.lower(F.col("src.prop"))).alias("src_prop"),
        F.concat(F.lit(tgt_ns), F.lower(tgt_class), F.lit("_"), F.lower(F.col("tgt.prop"))).alias("tgt_prop"),
        xref_property_iri(xref_ns, src_class, tgt_class, F.col("tgt.prop")).alias("rel"),
    )


def _terms(spark: SparkSession, terms: list[tuple[str, str]], prefix_rule_dbs=()) -> tuple[set[str], set[str]]:
    """Class and predicate names (without namespace) that rule terms ``(db, term)`` name."""
    t = decode_rule(F.col("term"))
    cls = O.rule_class(t["model"], F.col("db"), t["tbl"], prefix_rule_dbs)
    rows = values(spark, terms, "db string, term string").where(t.isNotNull()).select(
        cls.alias("cls"), F.concat(F.lower(cls), F.lit("_"), F.lower(t["prop"])).alias("p")).collect()  # rule-sized
    return {r.cls for r in rows if r.cls is not None}, {r.p for r in rows if r.p is not None}


def _xref_terms(doc: dict) -> list[tuple[str, str]]:
    """The terms of all cross-reference rules; a target is a term of the source that it names."""
    terms = [(db, r.get("source")) for db, rs in doc.items() for r in rs]
    targets = [r.get("target") for rs in doc.values() for r in rs]
    return terms + [(re.split("[:.]", t)[1], t) for t in targets if t and re.match("[^:.]*:[^:.]*[.]", t)]


def xref(src_graph: DataFrame, tgt_graph: DataFrame, rules_doc: dict, backlinks: bool = False,
         ts: int | None = None, known=None, prefix_rule_dbs=(), base: str = M.DEFAULT_BASE) -> DataFrame:
    """G1: link two graphs of one kind. Datasets -> instance links (J6 + J7); ontologies ->
    cross-reference properties (T16). With ``backlinks`` the target's rules run the other way."""
    spark = src_graph.sparkSession
    classes, predicates = _terms(spark, _xref_terms(rules_doc), prefix_rule_dbs)
    src_graph, tgt_graph = stage(named(src_graph, classes, predicates), "xref-source"), stage(named(tgt_graph, classes, predicates), "xref-target")
    a, b = graph_identity(src_graph, known), graph_identity(tgt_graph, known)
    if a["kind"] != b["kind"]:
        raise ValueError("graphs are of different kinds")
    if a["db"] == b["db"]:
        raise ValueError("graphs are of the same source")
    for g in (a, b):
        if g["db"] not in rules_doc:
            raise ValueError(f"source not in the rules: {g['db']}")
    rules = xref_rules(spark, rules_doc, report=True)
    xref_ns = f"{base}schema/xref/"
    directions = [(a, b, src_graph, tgt_graph)] + ([(b, a, tgt_graph, src_graph)] if backlinks else [])
    out = []
    if a["kind"] == M.VOID_DATASET:
        for s, t, sg, tg in directions:
            rf = _rule_frame(rules, s["db"], t["db"], s["schema_ns"], t["schema_ns"], xref_ns, prefix_rule_dbs)
            out.append(P.link(sg, tg, rf))
        body = reduce(DataFrame.unionByName, out)
        name, is_onto = "XREF", False
    else:
        for s, t, _, _ in directions:
            # ontology bases are the schema namespaces themselves (no trailing slash doubled, Q12)
            rf = _rule_frame(rules, s["db"], t["db"], s["schema_ns"], t["schema_ns"], xref_ns, prefix_rule_dbs)
            out.append(O.xref_property_triples(
                rf.select(F.col("src_class_name").alias("src_class"), F.col("tgt_class_name").alias("tgt_class"),
                          "tgt_field", F.lit(s["schema_ns"]).alias("src_ns"), F.lit(t["schema_ns"]).alias("tgt_ns")),
                xref_ns))
        body = reduce(DataFrame.unionByName, out)
        name, is_onto = "EXTRA", True
    if ts is None:
        return as_set(body)
    return with_metadata(body, xref_ns, ts, name, is_ontology=is_onto)


# ---- enrichment (G2) ----------------------------------------------------------------------


def enrich_graph(graph: DataFrame, rules_doc: dict, ts: int | None = None, known=None,
                 prefix_rule_dbs=(), base: str = M.DEFAULT_BASE) -> DataFrame:
    """J5 bindings of the source classes and attributes of all rules in one pass -> T13
    branches; X1; header. Rules of the graph's own source apply."""
    spark = graph.sparkSession
    classes, predicates = _terms(spark, [(db, term) for db, rs in rules_doc.items() for r in rs for term in r.get("source") or ()], prefix_rule_dbs)
    graph = stage(named(graph, classes, predicates), "enrich-input")
    g = graph_identity(graph, known)
    rules = rules_doc.get(g["db"], [])
    rows = [(g["db"], i, term) for i, r in enumerate(rules) for term in r["source"]]
    patterns, targets = [], {}
    if rows:
        dec = values(spark, rows, "db string, rule_pos int, term string").select(
            "rule_pos", decode_rule(F.col("term")).alias("t"),
            O.rule_class(decode_rule(F.col("term"))["model"], F.col("db"), decode_rule(F.col("term"))["tbl"],
                         prefix_rule_dbs).alias("cls"),
        ).collect()  # rule-sized: one row per source term
        by_rule: dict[int, list] = {}
        bad = {r.rule_pos for r in dec if r.t is None}
        for pos in sorted(bad):  # Q18: skipped and reported
            LOG.warning("skipped enrichment rule %d of %s: undecodable source term", pos, g["db"])
        for r in dec:
            if r.rule_pos not in bad:
                by_rule.setdefault(r.rule_pos, []).append(r)
        for pos, terms in sorted(by_rule.items()):
            cls = terms[0].cls
            attrs = [t.t.prop for t in terms]
            missing = _template_vars(rules[pos]["target"]) - {f"[{a}]" for a in attrs}
            if missing:  # Q17: such a leaf can never be filled; its triples are left out
                LOG.warning("enrichment rule %d of %s uses unbound variables %s", pos, g["db"], sorted(missing))
            patterns.append((pos, g["schema_ns"] + cls, [f"{g['schema_ns']}{cls.lower()}_{a.lower()}" for a in attrs]))
            targets[pos] = (rules[pos]["target"], {f"[{a}]": F.col(f"v{i}") for i, a in reversed(list(enumerate(attrs)))})
    body = EN.enrich_all(P.stars(graph, patterns), targets, g["data_ns"]) if patterns else empty_triples(spark)
    if ts is None:
        return as_set(body)
    return with_metadata(body, f"{base}schema/extra/", ts, "EXTRA")


def _template_vars(target: dict) -> set:
    """Variables named in the leaf template of a nested target."""
    level = target
    while isinstance(level.get("tail"), dict):
        level = level["tail"]
    tail = level.get("tail")
    return set(EN.VAR.findall(tail)) if isinstance(tail, str) and level.get("type") != "URIRef" else set()


# ---- type alignment (G3) -----------------------------------------------------------------

CONCEPT_SCHEMA = ("db string, tbl string, rule_pos int, concept string, property string, "
                  "subtypes array<struct<pos:int, name:string, type_id:string>>")


def concept_rules(spark: SparkSession, doc: dict, db: str, style: str = "versioned",
                  prefix_len: int = 0) -> DataFrame:
    """Concept document ``{db: {table: [{otl_concept, property, subtypes}]}}`` -> decoded rows
    (rule_key, tbl, rule_pos, concept, relation, subtypes(pos, tbl, id)) for one source."""
    rows = [
        (db, tbl, i, r["otl_concept"], r["property"],
         [(j, s.get("name"), s.get("type_id")) for j, s in enumerate(r.get("subtypes", []))])
        for tbl, rs in doc.get(db, {}).items() for i, r in enumerate(rs)
    ]
    df = values(spark, rows, CONCEPT_SCHEMA)
    prop = decode_concept_property(F.col("property"), F.col("db"), F.col("tbl"), style)
    subs = F.transform(F.col("subtypes"), lambda s: F.struct(
        s["pos"].alias("pos"),
        decode_concept_subtype(s["type_id"], F.col("db"), style)["tbl"].alias("tbl"),
        decode_concept_subtype(s["type_id"], F.col("db"), style)["id"].alias("id")))
    rel = relation_name(prop)
    return df.where(prop.isNotNull()).select(
        F.concat_ws("/", F.col("tbl"), rel).alias("rule_key"), "tbl", "rule_pos", "concept",
        rel.alias("relation"), subs.alias("subtypes"),
    ).withColumn("prefix_len", F.lit(prefix_len))


def _concept_terms(spark: SparkSession, doc: dict, id_property: str, style: str, prefix_len: int) -> tuple[set[str], set[str]]:
    """Class and predicate names (without namespace) that the concept rules of any source name."""
    if not doc:
        return set(), set()
    rules = reduce(DataFrame.unionByName, [concept_rules(spark, doc, db, style, prefix_len) for db in doc])
    cls = concept_class_name(F.col("tbl"), prefix_len)
    refs = F.transform("subtypes", lambda s: F.concat(F.lower(concept_class_name(s["tbl"], prefix_len)), F.lit("_" + id_property)))
    rows = rules.select(cls.alias("cls"), F.concat(F.lower(cls), F.lit("_"), F.col("relation")).alias("p"), refs.alias("refs")).collect()  # rule-sized
    return {r.cls for r in rows if r.cls is not None}, {p for r in rows for p in [r.p, *(r.refs or ())] if p is not None}


def align_graph(graph: DataFrame, doc: dict, id_property: str = "id", ts: int | None = None,
                concept_ns: str = "http://example.org/otl#", style: str = "versioned", prefix_len: int = 0,
                known=None, base: str = M.DEFAULT_BASE) -> DataFrame:
    """A6 dictionary -> J8 two-hop chain (instance -relation-> target -id-> value) ->
    J9 ``rdf:type`` to the concept; all rules in one join."""
    spark = graph.sparkSession
    graph = stage(named(graph, *_concept_terms(spark, doc, id_property, style, prefix_len)), "align-input")
    g = graph_identity(graph, known)
    rules = concept_rules(spark, doc, g["db"], style, prefix_len)
    cmap = P.concept_map(rules)
    src_cls = concept_class_name(F.col("tbl"), prefix_len)
    ref_cls = concept_class_name(F.col("ref_table"), prefix_len)
    chain_rules = rules.select("rule_key", "tbl", "relation").distinct().join(
        cmap.select("rule_key", "ref_table").distinct(), "rule_key"
    ).select(
        "rule_key",
        F.concat(F.lit(g["schema_ns"]), src_cls).alias("src_class"),
        F.concat(F.lit(g["schema_ns"]), F.lower(src_cls), F.lit("_"), F.col("relation")).alias("src_prop"),
        F.concat(F.lit(g["schema_ns"]), F.lower(ref_cls), F.lit("_" + id_property)).alias("ref_prop"),
    )
    body = P.align(P.chain(graph, chain_rules), cmap, concept_ns)
    if ts is None:
        return as_set(body)
    return with_metadata(body, f"{base}schema/otl/", ts, "OTL")


# ---- merge (X2) and ontology (M7) ---------------------------------------------------------


def merge_graphs(graphs: list[DataFrame], ts: int) -> DataFrame:
    """Set union of at least two graphs, then the header refresh (T15) for the base (O2)."""
    if len(graphs) < 2:
        raise ValueError("merging needs at least two graphs")
    return refresh_metadata(union_all(graphs), ts)


def ontology(map_class: DataFrame, map_attr: DataFrame, map_rel: DataFrame, cfg: M.GraphConfig,
             ts: int | None = None) -> DataFrame:
    """M7: T9-T12 over included classes (F10) and included attributes/relations."""
    ns = cfg.schema_ns
    body = union_all([
        O.class_triples(map_class, ns, cfg.label_lang),
        O.datatype_property_triples(map_class, map_attr, ns, cfg.label_lang),
        O.object_property_triples(map_class, map_rel, ns, cfg.label_lang),
    ])
    if ts is None:
        return as_set(body)
    return with_metadata(body, ns, ts, cfg.db, is_ontology=True)


__all__ = ["align_graph", "concept_rules", "enrich_graph", "graph_identity", "merge_graphs", "ontology", "xref",
           "xref_rules"]
