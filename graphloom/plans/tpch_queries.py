"""Registered queries over the test tables: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole tables; parameters (areas, rules, timestamps) are job config.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.operators import closure as R
from graphloom.operators.filters import Area, in_box, in_box_text
from graphloom.operators.sets import as_set
from graphloom.operators.triples import instance_triples
from graphloom.plans import tpch
from graphloom.plans.table_graph import closure_with_secondary, table_graph

CFG = tpch.CONFIG
HEADER_TS = 0  # header timestamps are parameters; fixed so results are reproducible

# Job parameters of the area queries (box in metres; unset bounds take the default extent).
ORDERS_AREA = Area(x0=100000, y0=0, x1=110000, y1=1e15)  # every order key
DEEP_FROM = 1024
PART_AREA = Area(x0=920, y0=10, x1=950, y1=30)
PART_CONTEXT = "PROMO"


def _t(spark, sf_dir, name):
    return tpch.table(spark, sf_dir, name)


def order_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 roots: orders whose (price, key) coordinates lie in the box (columns in metres)."""
    orders = _t(spark, sf_dir, "orders")
    return in_box(orders, "o_totalprice", "o_orderkey", ORDERS_AREA, unit=1.0)


def q_root_in_box(spark, sf_dir):
    from graphloom.sources.tables import scan

    return scan(order_roots(spark, sf_dir), select=[F.col("o_orderkey").alias("id")])


def q_root_in_box_text(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("prfid"),
        F.col("p_name").alias("code"),
        F.col("p_type").alias("context"),
        F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("x"),
        F.col("p_size").cast("string").alias("y"),
    )
    hit = in_box_text(part, "x", "y", PART_AREA, "context", PART_CONTEXT)
    return hit.select(F.col("prfid").alias("id"), F.col("code").alias("archiefcode"))


def q_instance_triples(spark, sf_dir):
    from dataclasses import replace

    from graphloom.plans.table_graph import instance_set

    m = tpch.mapping(spark, sf_dir)
    frames = [(_t(spark, sf_dir, t), replace(m.table(t), rels=())) for t in ("orders", "customer")]
    return instance_set(frames, CFG)


def q_link_triples(spark, sf_dir):
    m = tpch.mapping(spark, sf_dir)
    return as_set(instance_triples(_t(spark, sf_dir, "customer"), m.table("customer"), CFG,
                                   attributes=False, header=False))


def _sources(spark, sf_dir):
    return tpch.tables(spark, sf_dir, ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"])


def _roots(spark, sf_dir):
    return R.refs(order_roots(spark, sf_dir), "orders", "o_orderkey")


def q_closure_keys(spark, sf_dir):
    m = tpch.mapping(spark, sf_dir)
    res = R.closure(spark, _sources(spark, sf_dir), m, _roots(spark, sf_dir))
    return res.visited


def q_closure_capped(spark, sf_dir):
    m = tpch.mapping(spark, sf_dir)
    res = R.closure(spark, _sources(spark, sf_dir), m, _roots(spark, sf_dir), max_rounds=2)
    return res.visited


def q_reach_deep(spark, sf_dir):
    """R1 on a hierarchy: every order key points to half of it, so keys are up to 10 and more
    hops from the roots."""
    from graphloom.mapping import Mapping, Rel, TableMap

    nodes = _t(spark, sf_dir, "orders").select("o_orderkey", F.expr("o_orderkey DIV 2").alias("parent"))
    tm = TableMap("node", "Node", "o_orderkey", rels=(Rel("parent", "parent", "node", "Node"),))
    roots = R.refs(nodes.where(F.col("o_orderkey") >= DEEP_FROM), "node", "o_orderkey")
    return R.closure(spark, {"node": nodes}, Mapping("lake", {"node": tm}), roots).visited


def q_text_key_graph(spark, sf_dir):
    """T1, T5, T6, J1 on text keys with blanks around them: customers and their segments."""
    from graphloom.mapping import Mapping, Rel, TableMap
    from graphloom.plans.table_graph import table_graph

    key = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))
    customers = _t(spark, sf_dir, "customer").select("c_custkey", key.alias("segment"))
    segments = customers.select(F.col("segment").alias("code")).distinct()
    m = Mapping("lake", {
        "customer": TableMap("customer", "Customer", "c_custkey", rels=(Rel("segment", "segment", "segment", "Segment"),)),
        "segment": TableMap("segment", "Segment", "code"),
    })
    roots = R.refs(customers, "customer", "c_custkey")
    return table_graph(spark, {"customer": customers, "segment": segments}, m, CFG, roots, "customer")


def q_table_graph(spark, sf_dir):
    m = tpch.mapping(spark, sf_dir)
    return table_graph(spark, _sources(spark, sf_dir), m, CFG, _roots(spark, sf_dir), "orders",
                       secondary=[("lineitem", "l_orderkey")], header_ts=HEADER_TS)


def q_table_graph_keys(spark, sf_dir):
    m = tpch.mapping(spark, sf_dir)
    res = closure_with_secondary(spark, _sources(spark, sf_dir), m, _roots(spark, sf_dir), "orders",
                                 secondary=[("lineitem", "l_orderkey")])
    return res.visited


# ---- graphs built from the test tables ---------------------------------------------------


def flat(tm):
    """A table mapping whose foreign-key columns are also plain attributes (integer literals),
    as a graph that carries the key values themselves."""
    from dataclasses import replace

    from graphloom.mapping import Attr

    extra = tuple(Attr(r.col, r.property, M.XSD_INTEGER) for r in tm.included_rels())
    return replace(tm, attrs=tm.attrs + extra, rels=())


def graph_of(spark, sf_dir, tables, cfg=CFG, flat_keys=False, relations=True, header=True):
    """Instance triples of whole tables (T1-T6), plus the header triples (without count)."""
    from graphloom.operators.metadata import header_triples

    m = tpch.mapping(spark, sf_dir)
    parts = []
    for t in tables:
        tm = flat(m.table(t)) if flat_keys else m.table(t)
        parts.append(instance_triples(_t(spark, sf_dir, t), tm, cfg, relations=relations))
    if header:
        parts.append(header_triples(spark, cfg.data_ns, HEADER_TS, cfg.db))
    return reduce(DataFrame.unionByName, parts)


def q_scope_by_codes(spark, sf_dir):
    from graphloom.operators.patterns import codes_of

    sup = graph_of(spark, sf_dir, ["supplier"], flat_keys=True, header=False)
    codes = codes_of(sup, CFG.schema_ns + "Supplier", CFG.schema_ns + "supplier_s_nationkey")
    cust = _t(spark, sf_dir, "customer")
    scoped = R.scope_roots(cust, F.col("c_nationkey").cast("string"), codes)
    return scoped.select(F.col("c_custkey").alias("id"))


def q_star_bindings(spark, sf_dir):
    from graphloom.operators.patterns import star

    from graphloom.operators.sets import stage

    g = stage(graph_of(spark, sf_dir, ["customer", "orders"], header=False))
    return star(g, CFG.schema_ns + "Customer", [
        ("segment", CFG.schema_ns + "customer_c_mktsegment"),
        ("balance", CFG.schema_ns + "customer_c_acctbal"),
        ("ordered", CFG.schema_ns + "customer_inv_orders"),
    ])


ENRICH_CHAIN_RULES = {"lake": [{
    "source": ["sql:lake.customer/c_acctbal", "sql:lake.customer/c_nationkey"],
    "target": {"head": M.SF + "Point", "property": M.GEO_HASGEOMETRY, "type": "URIRef",
               "tail": {"head": M.GEO_WKTLITERAL, "property": M.GEO_ASWKT, "type": "Literal",
                        "tail": "POINT ([c_acctbal] [c_nationkey])"}},
}]}
ENRICH_LITERAL_RULES = {"lake": [
    {"source": ["sql:lake.customer/c_mktsegment"],
     "target": {"head": M.XSD_STRING, "property": "http://example.org/vocab/segmentLabel", "type": "Literal",
                "tail": "Segment [c_mktsegment] of [c_mktsegment]"}},
    {"source": ["sql:lake.customer/c_acctbal"],
     "target": {"head": M.XSD_DOUBLE, "property": "http://example.org/vocab/balance", "type": "Literal",
                "tail": "[c_acctbal] EUR"}},
    {"source": ["sql:lake.customer/c_name"],
     "target": {"head": "http://example.org/vocab/Named", "property": "http://example.org/vocab/naming",
                "type": "URIRef", "tail": "ignored [c_name]"}},
]}


def q_enrich_chain(spark, sf_dir):
    from graphloom.plans.graph_jobs import enrich_graph

    g = graph_of(spark, sf_dir, ["customer"], flat_keys=True)
    return enrich_graph(g, ENRICH_CHAIN_RULES)


def q_enrich_literal(spark, sf_dir):
    from graphloom.plans.graph_jobs import enrich_graph

    g = graph_of(spark, sf_dir, ["customer"], flat_keys=True)
    return enrich_graph(g, ENRICH_LITERAL_RULES)


# Orders are linked to customers on the customer key (a many-to-one match). A link on a
# 25-value key such as the nation key would emit every customer x supplier pair of a
# nation, i.e. output quadratic in the data, so the fixture does not use one.
XREF_RULES = {
    "lake": [{"source": "sql:lake.orders/o_custkey", "target": "sql:store.customer/c_custkey"},
             {"source": "sql:lake.bad rule", "target": "sql:store.customer/c_custkey"}],
    "store": [{"source": "sql:store.customer/c_custkey", "target": "sql:lake.orders/o_custkey"}],
}
STORE = M.GraphConfig("store")


def _xref_graphs(spark, sf_dir):
    src = graph_of(spark, sf_dir, ["orders"], flat_keys=True)
    tgt = graph_of(spark, sf_dir, ["customer"], cfg=STORE, flat_keys=True)
    return src, tgt


def q_xref_links(spark, sf_dir):
    from graphloom.plans.graph_jobs import xref

    src, tgt = _xref_graphs(spark, sf_dir)
    return xref(src, tgt, XREF_RULES, backlinks=False)


def q_xref_backlinks(spark, sf_dir):
    from graphloom.plans.graph_jobs import xref

    src, tgt = _xref_graphs(spark, sf_dir)
    return xref(src, tgt, XREF_RULES, backlinks=True, ts=HEADER_TS)


CONCEPT_RULES = {"lake": {"customer": [
    {"otl_concept": "Inland", "property": "lake-1.0-customer-c_nationkey",
     "subtypes": [{"name": "n2", "type_id": "lake-1.0-nation-2"}, {"name": "n3", "type_id": "lake-1.0-nation-3"}]},
    {"otl_concept": "Coastal", "property": "lake-1.0-customer-c_nationkey",
     "subtypes": [{"name": "n3", "type_id": "lake-1.0-nation-3"}, {"name": "n7", "type_id": "lake-1.0-nation-7"},
                  {"name": "none", "type_id": ""}]},
    {"otl_concept": "Unused", "property": "lake-1.0-customer-c_nationkey", "subtypes": []},
    {"otl_concept": "Other", "property": "lake-2.0-orders-o_custkey", "subtypes": []},
]}}


def q_align_types(spark, sf_dir):
    from graphloom.plans.graph_jobs import align_graph

    g = graph_of(spark, sf_dir, ["customer", "nation"])
    return align_graph(g, CONCEPT_RULES, id_property="n_nationkey")


def q_merge_graphs(spark, sf_dir):
    from graphloom.operators.metadata import with_metadata
    from graphloom.plans.graph_jobs import merge_graphs

    a = with_metadata(graph_of(spark, sf_dir, ["customer", "nation"], header=False), CFG.data_ns, 100, CFG.db)
    b = with_metadata(graph_of(spark, sf_dir, ["customer"], header=False), CFG.data_ns, 200, CFG.db)
    return merge_graphs([a, b], 300)


def q_with_header(spark, sf_dir):
    from graphloom.operators.metadata import with_metadata

    return with_metadata(graph_of(spark, sf_dir, ["nation"], header=False), CFG.data_ns, HEADER_TS, CFG.db)


def q_melt_fields(spark, sf_dir):
    from graphloom.operators.features import melt_fields

    orders = _t(spark, sf_dir, "orders")
    fields = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return melt_fields(orders.withColumnRenamed("o_orderkey", "fid"), fields)


def q_ntriples_roundtrip(spark, sf_dir):
    """S9 then S7: texts with line feeds and quotes, written as N-Triples files and read back."""
    from graphloom.operators.triples import iri_triple, lang_triple, typed_triple

    docs = _t(spark, sf_dir, "documents")
    s = F.concat(F.lit(CFG.data_ns + "doc/"), F.col("doc_id").cast("string"))
    from graphloom.functions.lexical import strip_ws
    from graphloom.operators.triples import emit

    g = emit(docs, [
        lang_triple(s, CFG.schema_ns + "documents_text", strip_ws(F.col("text")), F.col("lang")),
        typed_triple(s, CFG.schema_ns + "documents_source", F.col("source"), M.XSD_STRING),
        iri_triple(s, M.RDF_TYPE, CFG.schema_ns + "Documents"),
        typed_triple(s, CFG.schema_ns + "documents_n_chars", F.col("n_chars").cast("string"), M.XSD_INTEGER),
    ])
    return _written_and_read(spark, g)


def q_bnode_roundtrip(spark, sf_dir):
    """S9 then S8: a graph of blank nodes, several part files; every conversation is a node with
    its turns in order. One node is one node in all files: turns are counted by it."""
    from graphloom.operators.triples import emit, iri_triple, typed_triple

    turns = _t(spark, sf_dir, "conversations")
    node = F.concat(F.lit("_:conv"), F.col("conv_id").cast("string"))
    mark = lambda t: t.withField("o_kind", F.lit(M.KIND_BNODE))
    s = F.concat(F.lit(CFG.data_ns + "turn/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    g = emit(turns, [
        mark(iri_triple(s, CFG.schema_ns + "turn_of", node)),
        typed_triple(node, CFG.schema_ns + "conversation_turn", F.col("turn").cast("string"), M.XSD_INTEGER),
        typed_triple(s, CFG.schema_ns + "turn_text", F.col("text"), M.XSD_STRING),
    ])
    back = _written_and_read(spark, g.repartition(7, "o"))
    of = back.where(F.col("p") == CFG.schema_ns + "turn_of").select("s", F.col("o").alias("node"))
    text = back.where(F.col("p") == CFG.schema_ns + "turn_text").select(F.col("s").alias("t"), "o")
    spoken = of.join(text, F.col("s") == F.col("t")).groupBy("node").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length("o")).alias("n_chars"))
    numbered = back.where(F.col("p") == CFG.schema_ns + "conversation_turn").groupBy(F.col("s").alias("n"))
    turns_of = numbered.agg(F.count(F.lit(1)).alias("n_turns"), F.max(F.col("o").cast("long")).alias("last_turn"))
    label = F.regexp_extract("node", "^_:f[0-9a-f]+_(.*)$", 1)
    return spoken.join(turns_of, F.col("node") == F.col("n")).select(label.alias("label"), "n_texts", "n_chars", "n_turns", "last_turn")


def _written_and_read(spark, g):
    import uuid

    from graphloom.session import checkpoint_dir
    from graphloom.sources.ntriples import read_triples, write_triples

    base = f"{checkpoint_dir(spark).rstrip('/')}/graphloom-{uuid.uuid4().hex}"
    return read_triples(spark, write_triples(g, f"{base}/graph"))


def q_namespaces(spark, sf_dir):
    from graphloom.functions.rules import schema_ns_of, source_of

    pages = _t(spark, sf_dir, "pages")
    ns = F.concat(
        F.lit(M.DEFAULT_BASE),
        F.when(F.col("url").startswith("https"), F.lit("schema/")).otherwise(F.lit("")),
        F.regexp_extract(F.col("url"), r"^https?://[^/]+/([a-z]*)", 1), F.lit("/"),
    )
    src = source_of(ns)
    return pages.select(
        "page_id", ns.alias("ns"), src["base"].alias("base"), src["is_schema"].alias("is_schema"),
        src["db"].alias("db"), schema_ns_of(ns).alias("schema_ns"),
    )


def q_event_triples(spark, sf_dir):
    """T1-T6 over the whole events table: fractional wall-clock timestamps, a JSON text
    column, and a relation whose name drops its ``_id`` suffix (``user_id`` -> ``user``)."""
    from graphloom.plans.table_graph import instance_set
    m = tpch.mapping(spark, sf_dir)
    return instance_set([(_t(spark, sf_dir, "events"), m.table("events"))], CFG)


def q_event_user_triples(spark, sf_dir):
    """X1 with a declared key that does not hold: events by ``user_id``, said to be unique."""
    from dataclasses import replace

    from graphloom.plans.table_graph import instance_set

    tm = replace(tpch.mapping(spark, sf_dir).table("events"), identifier="user_id", unique_key=True)
    return instance_set([(_t(spark, sf_dir, "events"), tm)], CFG)


def q_class_pairs(spark, sf_dir):
    """Distinct (subject, value) of a class and one property, over orders and customers."""
    from graphloom.operators.patterns import pairs

    g = graph_of(spark, sf_dir, ["customer", "orders"], header=False)
    return pairs(g, CFG.schema_ns + "Orders", CFG.schema_ns + "orders_o_orderpriority")


def q_multi_read(spark, sf_dir):
    """S9 then S8: two graphs written as N-Triples files, read back as one graph (set)."""
    import uuid

    from graphloom.operators.sets import as_set
    from graphloom.session import checkpoint_dir
    from graphloom.sources.ntriples import read_triples, write_triples

    base = f"{checkpoint_dir(spark).rstrip('/')}/graphloom-{uuid.uuid4().hex}"
    a = write_triples(graph_of(spark, sf_dir, ["customer"], header=False), f"{base}/customer")
    b = write_triples(graph_of(spark, sf_dir, ["nation", "customer"], header=False), f"{base}/nation")
    return as_set(read_triples(spark, [a, b]))


FEATURE_AREA = Area(x0=-500, y0=-500, x1=10.3, y1=470.456)
LABEL_AREA = Area(x0=-10, y0=-10, x1=10, y1=10)
LINE_AREA = Area(x0=0, y0=-1, x1=100, y1=1)


def _layers(spark, sf_dir, names):
    from dataclasses import replace

    ls = tpch.layers(spark, sf_dir)
    m = tpch.layer_mapping(spark, sf_dir)
    return {n: ls[n] for n in names}, replace(m, tables={n: m.tables[n] for n in names})


def q_feature_in_area(spark, sf_dir):
    from graphloom.operators.features import in_scope

    ls, _ = _layers(spark, sf_dir, ["pEmbedding", "vPart"])
    parts = [in_scope(df, FEATURE_AREA).select(F.lit(n).alias("layer"), "fid") for n, df in ls.items()]
    return reduce(DataFrame.unionByName, parts)


def q_feature_triples(spark, sf_dir):
    from graphloom.plans.layer_graph import layer_graph

    ls, m = _layers(spark, sf_dir, ["pLabel"])
    return layer_graph(spark, ls, m, tpch.GIS, LABEL_AREA)


def q_layer_graph(spark, sf_dir):
    from graphloom.plans.layer_graph import layer_graph

    ls, m = _layers(spark, sf_dir, ["pEmbedding", "vPart"])
    return layer_graph(spark, ls, m, tpch.GIS, FEATURE_AREA, ts=HEADER_TS)


def q_geometry_triples(spark, sf_dir):
    from graphloom.plans.layer_graph import layer_graph

    ls, m = _layers(spark, sf_dir, ["pPart"])
    return layer_graph(spark, ls, m, tpch.GIS, LINE_AREA, features=False)


QUERIES = {
    "root_in_box": q_root_in_box,
    "root_in_box_text": q_root_in_box_text,
    "instance_triples": q_instance_triples,
    "link_triples": q_link_triples,
    "closure_keys": q_closure_keys,
    "closure_capped": q_closure_capped,
    "table_graph": q_table_graph,
    "table_graph_keys": q_table_graph_keys,
    "scope_by_codes": q_scope_by_codes,
    "star_bindings": q_star_bindings,
    "enrich_chain": q_enrich_chain,
    "enrich_literal": q_enrich_literal,
    "xref_links": q_xref_links,
    "xref_backlinks": q_xref_backlinks,
    "align_types": q_align_types,
    "merge_graphs": q_merge_graphs,
    "with_header": q_with_header,
    "melt_fields": q_melt_fields,
    "reach_deep": q_reach_deep,
    "text_key_graph": q_text_key_graph,
    "ntriples_roundtrip": q_ntriples_roundtrip,
    "bnode_roundtrip": q_bnode_roundtrip,
    "event_user_triples": q_event_user_triples,
    "namespaces": q_namespaces,
    "feature_in_area": q_feature_in_area,
    "feature_triples": q_feature_triples,
    "layer_graph": q_layer_graph,
    "geometry_triples": q_geometry_triples,
    "event_triples": q_event_triples,
    "class_pairs": q_class_pairs,
    "multi_read": q_multi_read,
}
