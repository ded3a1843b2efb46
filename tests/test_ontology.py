"""Ontology (M7: T9-T12) and cross-reference schema (T16) against brute-force DuckDB SQL
over the same mapping tables."""

import duckdb

from graphloom import model as M
from graphloom.plans import graph_jobs as G
from graphloom.plans import tpch
from tests.conftest import SF001, rows

NS = "http://example.org/linked_data/schema/lake/"
TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({c}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
         "lambda w: upper(w[1]) || w[2:]), '')")


def _row(s, p, o, kind="iri", dt="NULL", lang="NULL"):
    return f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{kind}' AS o_kind, {dt}::VARCHAR AS o_datatype, {lang}::VARCHAR AS o_lang"


def ontology_sql():
    cls = f"'{NS}' || classname"
    att = f"'{NS}' || lower(classname) || '_' || lower(property)"
    fwd = att
    inv = f"'{NS}' || lower(target_class) || '_inv_' || lower(classname)"
    tgt = f"'{NS}' || target_class"
    C = "FROM mc WHERE include AND NOT link_table"
    A = "FROM ma JOIN (SELECT tbl, classname FROM mc WHERE include AND NOT link_table) USING (tbl) WHERE ma.include"
    R = "FROM mr JOIN (SELECT tbl, classname FROM mc WHERE include AND NOT link_table) USING (tbl) WHERE mr.include"
    parts = [
        _row(cls, M.RDF_TYPE, f"'{M.OWL_CLASS}'") + " " + C,
        _row(cls, M.RDFS_LABEL, "classname", "literal", lang="'nl'") + " " + C,
        _row(cls, M.RDFS_SUBCLASSOF, "sub_class_of") + " " + C + " AND sub_class_of IS NOT NULL",
        _row(att, M.RDF_TYPE, f"'{M.OWL_DATATYPEPROPERTY}'") + " " + A,
        _row(att, M.RDFS_DOMAIN, cls) + " " + A,
        _row(att, M.RDFS_RANGE, "datatype") + " " + A,
        _row(att, M.RDFS_LABEL, TITLE.format(c="property"), "literal", lang="'nl'") + " " + A,
        _row(att, M.RDFS_COMMENT, "'Attribuut ''' || property || ''' behorende tot class ''' || classname || ''''",
             "literal", lang="'nl'") + " " + A,
        _row(fwd, M.RDF_TYPE, f"'{M.OWL_OBJECTPROPERTY}'") + " " + R,
        _row(fwd, M.RDFS_DOMAIN, cls) + " " + R,
        _row(fwd, M.RDFS_RANGE, tgt) + " " + R,
        _row(fwd, M.RDFS_LABEL, TITLE.format(c="property"), "literal", lang="'nl'") + " " + R,
        _row(fwd, M.RDFS_COMMENT, "'Relatie ''' || property || ''' tussen classen ''' || classname || ''' en ''' "
             "|| target_class || ''''", "literal", lang="'nl'") + " " + R,
        _row(inv, M.RDF_TYPE, f"'{M.OWL_OBJECTPROPERTY}'") + " " + R,
        _row(inv, M.RDFS_DOMAIN, tgt) + " " + R,
        _row(inv, M.RDFS_RANGE, cls) + " " + R,
        _row(inv, M.RDFS_LABEL, TITLE.format(c="classname") + " || ' (inverse)'", "literal", lang="'nl'") + " " + R,
        _row(inv, M.RDFS_COMMENT, "'Relatie ''' || classname || ''' (inverse) tussen classen ''' || target_class "
             "|| ''' en ''' || classname || ''''", "literal", lang="'nl'") + " " + R,
    ]
    return "SELECT DISTINCT * FROM (" + "\nUNION ALL\n".join(parts) + ")"


def test_ontology_matches_sql(spark):
    m = tpch.mapping(spark, SF001)
    mc, ma, mr = m.to_frames(spark)
    got = rows(G.ontology(mc, ma, mr, M.GraphConfig("lake")))
    con = duckdb.connect()
    con.register("mc", mc.toPandas())
    con.register("ma", ma.toPandas())
    con.register("mr", mr.toPandas())
    want = sorted(tuple(r) for r in con.execute(ontology_sql()).fetchall())
    assert got == want
    assert (NS + "Customer", M.RDF_TYPE, M.OWL_CLASS, "iri", None, None) in got
    assert (NS + "customer_c_acctbal", M.RDFS_LABEL, "C_Acctbal", "literal", None, "nl") in got


def test_ontology_header_counts_itself(spark):
    m = tpch.mapping(spark, SF001)
    mc, ma, mr = m.to_frames(spark)
    g = G.ontology(mc, ma, mr, M.GraphConfig("lake"), ts=0)
    n = g.count()
    cnt = g.where(f"p = '{M.VOID_TRIPLES}'").first()
    assert int(cnt.o) == n and cnt.s == NS
    assert g.where(f"s = '{NS}' and o = '{M.OWL_ONTOLOGY}'").count() == 1


def test_xref_schema_between_ontologies(spark):
    lake, store = M.GraphConfig("lake"), M.GraphConfig("store")
    m = tpch.mapping(spark, SF001)
    a = G.ontology(*m.to_frames(spark), lake, ts=0)
    b = G.ontology(*m.to_frames(spark), store, ts=0)
    doc = {"lake": [{"source": "sql:lake.orders/o_custkey", "target": "sql:store.customer/c_custkey"}],
           "store": [{"source": "sql:store.customer/c_custkey", "target": "sql:lake.orders/"}]}
    g = G.xref(a, b, doc, backlinks=True)
    xns = "http://example.org/linked_data/schema/xref/"
    got = rows(g)
    fwd = xns + "orders_customer-c_custkey"
    back = xns + "customer_orders"  # empty target field: no suffix
    assert (fwd, M.RDFS_DOMAIN, lake.schema_ns + "Orders", "iri", None, None) in got
    assert (fwd, M.RDFS_RANGE, store.schema_ns + "Customer", "iri", None, None) in got
    assert (fwd, M.RDFS_LABEL, "Relatie tussen Orders and Customer", "literal", None, "nl") in got
    assert (back, M.RDFS_DOMAIN, store.schema_ns + "Customer", "iri", None, None) in got
    assert len(got) == 8


def test_xref_rejects_mixed_kinds(spark):
    import pytest

    m = tpch.mapping(spark, SF001)
    onto = G.ontology(*m.to_frames(spark), M.GraphConfig("lake"), ts=0)
    from graphloom.plans.tpch_queries import graph_of

    data = graph_of(spark, SF001, ["region"], cfg=M.GraphConfig("store"))
    with pytest.raises(ValueError):
        G.xref(onto, data, {"lake": [], "store": []})
