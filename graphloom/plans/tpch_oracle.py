"""Oracle SQL (DuckDB dialect) for the registered queries, written independently of the
Spark code: same tables, same parameters, plain SQL (CTEs, UNION, recursion).

Lexical forms in DuckDB: ``CAST(x AS VARCHAR)`` prints integers and doubles as Python does;
timestamps use ``strftime``; text is stripped with a regex.
"""

from __future__ import annotations

NS = "http://example.org/linked_data/lake/"
SCH = "http://example.org/linked_data/schema/lake/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
XSD = "http://www.w3.org/2001/XMLSchema#"
NULL = "CAST(NULL AS VARCHAR)"

INT, DBL, STR, TS = "integer", "double", "string", "dateTime"
PY_SPACE = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def lex(col: str, kind: str) -> str:
    if kind == STR:
        return f"regexp_replace({col}, '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"
    if kind == TS:
        return (f"CASE WHEN date_part('microseconds', {col}) % 1000000 <> 0 "
                f"THEN strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S') END")
    return f"CAST({col} AS VARCHAR)"


def iri(cls: str, key_text: str, ns: str = NS) -> str:
    return f"('{ns}r' || sha1({key_text} || '{cls}'))"


def row(s, p, o, kind="iri", dt=None, lang=None, src="") -> str:
    dt_sql = f"'{dt}'" if dt else NULL
    lang_sql = f"'{lang}'" if lang else NULL
    return f"SELECT {s} AS s, {p} AS p, {o} AS o, '{kind}' AS o_kind, {dt_sql} AS o_datatype, {lang_sql} AS o_lang {src}"


# Test tables: (class, key SQL text, attributes [(col, kind)], relations [(col, target class)])
LINEITEM_KEY = (
    "sha1(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
    "CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), "
    "CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), l_returnflag, l_linestatus, "
    "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')))"
)
TABLES = {
    "region": ("Region", "CAST(r_regionkey AS VARCHAR)", [("r_name", STR), ("r_regionkey", INT)], []),
    "nation": ("Nation", "CAST(n_nationkey AS VARCHAR)", [("n_name", STR), ("n_nationkey", INT)],
               [("n_regionkey", "Region", "region")]),
    "customer": ("Customer", "CAST(c_custkey AS VARCHAR)",
                 [("c_acctbal", DBL), ("c_custkey", INT), ("c_mktsegment", STR), ("c_name", STR)],
                 [("c_nationkey", "Nation", "nation")]),
    "supplier": ("Supplier", "CAST(s_suppkey AS VARCHAR)", [("s_acctbal", DBL), ("s_name", STR), ("s_suppkey", INT)],
                 [("s_nationkey", "Nation", "nation")]),
    "part": ("Part", "CAST(p_partkey AS VARCHAR)",
             [("p_brand", STR), ("p_name", STR), ("p_partkey", INT), ("p_retailprice", DBL), ("p_size", INT),
              ("p_type", STR)], []),
    "orders": ("Orders", "CAST(o_orderkey AS VARCHAR)",
               [("o_orderdate", TS), ("o_orderkey", INT), ("o_orderpriority", STR), ("o_orderstatus", STR),
                ("o_totalprice", DBL)], [("o_custkey", "Customer", "customer")]),
    "events": ("Events", "CAST(event_id AS VARCHAR)",
               [("event_id", INT), ("event_type", STR), ("props", STR), ("ts", TS), ("value", DBL)],
               [("user_id", "Customer", "customer", "user")]),
    "lineitem": ("Lineitem", LINEITEM_KEY,
                 [("l_discount", DBL), ("l_extendedprice", DBL), ("l_linenumber", INT), ("l_linestatus", STR),
                  ("l_quantity", DBL), ("l_returnflag", STR), ("l_shipdate", TS), ("l_tax", DBL)],
                 [("l_orderkey", "Orders", "orders"), ("l_partkey", "Part", "part"),
                  ("l_suppkey", "Supplier", "supplier")]),
}


def instance_sql(table: str, src: str | None = None, attributes=True, relations=True, header=True) -> str:
    """UNION ALL of T2-T6 rows of one table (``src`` defaults to the table itself)."""
    cls, key, attrs, rels = TABLES[table]
    src = src or table
    s = iri(cls, key)
    frm = f"FROM (SELECT *, {s} AS _s, {key} AS _k FROM {src}) t"
    parts = []
    if header:
        parts.append(row("_s", f"'{RDF_TYPE}'", f"'{SCH}{cls}'", src=frm))
        parts.append(row("_s", f"'{RDFS_LABEL}'", f"'{cls} ' || _k", "literal", lang="nl", src=frm))
    if attributes:
        for col, kind in attrs:
            parts.append(row("_s", f"'{SCH}{cls.lower()}_{col}'", lex(col, kind), "literal", dt=XSD + kind,
                             src=frm + f" WHERE {col} IS NOT NULL"))
    if relations:
        for col, tcls, _, *prop in rels:
            tgt = iri(tcls, f"CAST({col} AS VARCHAR)")
            name = prop[0] if prop else col  # relation name (L3): a trailing id is dropped
            parts.append(row("_s", f"'{SCH}{cls.lower()}_{name}'", tgt, src=frm + f" WHERE {col} IS NOT NULL"))
            parts.append(row(tgt, f"'{SCH}{tcls.lower()}_inv_{cls.lower()}'", "_s",
                             src=frm + f" WHERE {col} IS NOT NULL"))
    return "\nUNION ALL\n".join(parts)


ORDER_ROOTS = ("SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 100000 AND 110000 "
               "AND o_orderkey BETWEEN 0 AND 1000000000000000")

EDGES = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, {key} AS id, '{tt}' AS dst_tbl, CAST({col} AS VARCHAR) AS dst_id FROM {t} "
    f"WHERE {col} IS NOT NULL"
    for t, (cls, key, attrs, rels) in TABLES.items()
    if t != "events"
    for col, tcls, tt, *_ in rels
)


def reach_sql(roots: str, max_depth: int = 9) -> str:
    """Keys reachable from ``roots(tbl, id)`` within ``max_depth`` hops (visited = depth <= cap-1)."""
    return f"""reach(tbl, id, depth) AS (
  SELECT tbl, id, 0 FROM ({roots}) r0
  UNION
  SELECT e.dst_tbl, e.dst_id, r.depth + 1 FROM reach r JOIN edges e ON e.tbl = r.tbl AND e.id = r.id
  WHERE r.depth < {max_depth}
)"""


CLOSURE_KEYS = f"""WITH RECURSIVE edges AS ({EDGES}),
{reach_sql("SELECT 'orders' AS tbl, CAST(o_orderkey AS VARCHAR) AS id FROM (" + ORDER_ROOTS + ")")}
SELECT DISTINCT tbl, id FROM reach"""

CLOSURE_CAPPED = f"""WITH RECURSIVE edges AS ({EDGES}),
{reach_sql("SELECT 'orders' AS tbl, CAST(o_orderkey AS VARCHAR) AS id FROM (" + ORDER_ROOTS + ")", 1)}
SELECT DISTINCT tbl, id FROM reach"""

# R2: primary closure from the order roots, then lineitem rows of visited orders as roots.
_SECONDARY_ROOTS = (
    "SELECT 'orders' AS tbl, CAST(o_orderkey AS VARCHAR) AS id FROM (" + ORDER_ROOTS + ") "
    "UNION SELECT 'lineitem', " + LINEITEM_KEY + " FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) IN "
    "(SELECT CAST(o_orderkey AS VARCHAR) FROM (" + ORDER_ROOTS + "))"
)
TABLE_GRAPH_VISITED = f"""edges AS ({EDGES}),
{reach_sql(_SECONDARY_ROOTS)},
visited AS (SELECT DISTINCT tbl, id FROM reach)"""

TABLE_GRAPH_KEYS = f"WITH RECURSIVE {TABLE_GRAPH_VISITED}\nSELECT tbl, id FROM visited"


def _visited_src(t: str) -> str:
    cls, key, _, _ = TABLES[t]
    return f"(SELECT * FROM {t} WHERE {key} IN (SELECT id FROM visited WHERE tbl = '{t}'))"


DCT = "http://purl.org/dc/terms/"


def header_sql(base: str, name: str, ts_text: str, kind: str = "dataset") -> str:
    typ = "http://www.w3.org/2002/07/owl#Ontology" if kind == "ontology" else "http://rdfs.org/ns/void#Dataset"
    title = f"Linked Data Project - {name.upper()}"
    d_nl = f"Triples van deze {kind}, afgeleid uit tabellen."
    d_en = f"Triples of this {kind}, derived from tables."
    rows = [
        (RDF_TYPE, typ, "iri", None, None),
        (DCT + "modified", ts_text, "literal", XSD + "dateTime", None),
        (DCT + "creator", "http://example.org/agents/Publisher", "iri", None, None),
        (DCT + "publisher", "http://example.org/agents/Publisher", "iri", None, None),
        (DCT + "rightsHolder", "http://example.org/agents/Owner", "iri", None, None),
        (DCT + "language", "http://id.loc.gov/vocabulary/iso639-1/nl", "iri", None, None),
        (DCT + "title", title, "literal", None, "nl"),
        (DCT + "title", title, "literal", None, "en"),
        (DCT + "subject", "http://example.org/topics/Asset_management", "iri", None, None),
        (DCT + "description", d_nl, "literal", None, "nl"),
        (DCT + "description", d_en, "literal", None, "en"),
    ]
    return "\nUNION ALL\n".join(row(f"'{base}'", f"'{p}'", f"'{o}'", k, dt, lang) for p, o, k, dt, lang in rows)


def with_header_sql(body_ctes: str, body: str, base: str, name: str, ts_text: str, kind: str = "dataset") -> str:
    return f"""{body_ctes}
body AS (SELECT DISTINCT * FROM ({body}) b0 UNION SELECT * FROM ({header_sql(base, name, ts_text, kind)}) h0)
SELECT * FROM body
UNION ALL
SELECT '{base}', 'http://rdfs.org/ns/void#triples', CAST(count(*) + 1 AS VARCHAR), 'literal',
       '{XSD}nonNegativeInteger', {NULL} FROM body"""


_TG_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
TABLE_GRAPH = with_header_sql(
    f"WITH RECURSIVE {TABLE_GRAPH_VISITED},",
    "\nUNION ALL\n".join(instance_sql(t, _visited_src(t)) for t in _TG_TABLES),
    NS, "lake", "1970-01-01T00:00:00",
)

ORACLE = {
    "root_in_box": ORDER_ROOTS.replace("SELECT o_orderkey", "SELECT o_orderkey AS id"),
    "root_in_box_text": """SELECT p_partkey AS id, p_name AS archiefcode FROM part
WHERE p_type = 'PROMO'
  AND try_cast(replace(replace(CAST(p_retailprice AS VARCHAR), '.', ','), ',', '.') AS DECIMAL(18,0)) BETWEEN 920 AND 950
  AND try_cast(CAST(p_size AS VARCHAR) AS DECIMAL(18,0)) BETWEEN 10 AND 30""",
    "instance_triples": "SELECT DISTINCT * FROM (" + instance_sql("orders", relations=False) + "\nUNION ALL\n"
    + instance_sql("customer", relations=False) + ") u",
    "link_triples": "SELECT DISTINCT * FROM (" + instance_sql("customer", attributes=False, header=False) + ") u",
    "closure_keys": CLOSURE_KEYS,
    "closure_capped": CLOSURE_CAPPED,
    "table_graph": TABLE_GRAPH,
    "table_graph_keys": TABLE_GRAPH_KEYS,
}


# ---- second batch ---------------------------------------------------------------------------

NS_STORE = "http://example.org/linked_data/store/"
SCH_STORE = "http://example.org/linked_data/schema/store/"
XREF_NS = "http://example.org/linked_data/schema/xref/"
SF = "http://www.opengis.net/ont/sf#"
GEO = "http://www.opengis.net/ont/geosparql#"
CUST = iri("Customer", "CAST(c_custkey AS VARCHAR)")


def _distinct(*selects: str) -> str:
    return "SELECT DISTINCT * FROM (" + "\nUNION ALL\n".join(selects) + ") u"


SCOPE_BY_CODES = """SELECT c_custkey AS id FROM customer
WHERE CAST(c_nationkey AS VARCHAR) IN (SELECT CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_nationkey IS NOT NULL)
   OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey IS NOT NULL)"""

STAR_BINDINGS = f"""SELECT DISTINCT {iri("Customer", "CAST(c.c_custkey AS VARCHAR)")} AS s,
  {lex("c.c_mktsegment", STR)} AS segment, CAST(c.c_acctbal AS VARCHAR) AS balance,
  {iri("Orders", "CAST(o.o_orderkey AS VARCHAR)")} AS ordered
FROM customer c JOIN orders o ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)
WHERE c.c_mktsegment IS NOT NULL AND c.c_acctbal IS NOT NULL"""

_POINT_NODE = f"('{NS}r' || sha1(s || '{SF}Point'))"
ENRICH_CHAIN = f"""WITH c AS (SELECT DISTINCT {CUST} AS s, CAST(c_acctbal AS VARCHAR) AS a, CAST(c_nationkey AS VARCHAR) AS n
           FROM customer WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL),
n AS (SELECT s, {_POINT_NODE} AS node, 'POINT (' || a || ' ' || n || ')' AS wkt FROM c)
{_distinct(row("node", f"'{RDF_TYPE}'", f"'{SF}Point'", src="FROM n"),
           row("s", f"'{GEO}hasGeometry'", "node", src="FROM n"),
           row("node", f"'{GEO}asWKT'", "wkt", "literal", dt=GEO + "wktLiteral", src="FROM n"))}"""

_NAMED_NODE = f"('{NS}r' || sha1(s || 'http://example.org/vocab/Named'))"
ENRICH_LITERAL = f"""WITH c AS (SELECT {CUST} AS s, {lex("c_mktsegment", STR)} AS seg, CAST(c_acctbal AS VARCHAR) AS bal,
                  c_name FROM customer)
{_distinct(
    row("s", "'http://example.org/vocab/segmentLabel'", "'Segment ' || seg || ' of ' || seg", "literal",
        dt=XSD + "string", src="FROM c WHERE seg IS NOT NULL"),
    row("s", "'http://example.org/vocab/balance'", "bal", "literal", dt=XSD + "double",
        src="FROM c WHERE bal IS NOT NULL"),
    row(_NAMED_NODE, f"'{RDF_TYPE}'", "'http://example.org/vocab/Named'", src="FROM c WHERE c_name IS NOT NULL"),
    row("s", "'http://example.org/vocab/naming'", _NAMED_NODE, src="FROM c WHERE c_name IS NOT NULL"))}"""

_ORDER_LAKE = iri("Orders", "CAST(o.o_orderkey AS VARCHAR)")
_CUST_STORE = iri("Customer", "CAST(c.c_custkey AS VARCHAR)", NS_STORE)
_XJOIN = "FROM orders o JOIN customer c ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)"
XREF_LINKS = _distinct(row(_ORDER_LAKE, f"'{XREF_NS}orders_customer-c_custkey'", _CUST_STORE, src=_XJOIN))
XREF_BACKLINKS = with_header_sql(
    "WITH", _distinct(row(_ORDER_LAKE, f"'{XREF_NS}orders_customer-c_custkey'", _CUST_STORE, src=_XJOIN),
                      row(_CUST_STORE, f"'{XREF_NS}customer_orders-o_custkey'", _ORDER_LAKE, src=_XJOIN)),
    XREF_NS, "XREF", "1970-01-01T00:00:00")

ALIGN_TYPES = f"""SELECT DISTINCT {iri("Customer", "CAST(c.c_custkey AS VARCHAR)")} AS s, '{RDF_TYPE}' AS p,
  'http://example.org/otl#' || m.concept AS o, 'iri' AS o_kind, {NULL} AS o_datatype, {NULL} AS o_lang
FROM customer c JOIN nation n ON CAST(c.c_nationkey AS VARCHAR) = CAST(n.n_nationkey AS VARCHAR)
JOIN (VALUES ('2', 'Inland'), ('3', 'Coastal'), ('7', 'Coastal')) m(id, concept)
  ON CAST(n.n_nationkey AS VARCHAR) = m.id"""

MERGE_GRAPHS = with_header_sql("WITH", instance_sql("customer") + "\nUNION ALL\n" + instance_sql("nation"),
                               NS, "lake", "1970-01-01T00:05:00")
WITH_HEADER = with_header_sql("WITH", instance_sql("nation"), NS, "lake", "1970-01-01T00:00:00")

MELT_FIELDS = "\nUNION ALL\n".join(
    f"SELECT o_orderkey AS fid, '{c}' AS field, {lex(c, k)} AS value, '{t}' AS datatype FROM orders "
    f"WHERE {c} IS NOT NULL"
    for c, k, t in [("o_custkey", INT, "bigint"), ("o_orderstatus", STR, "string"), ("o_totalprice", DBL, "double"),
                    ("o_orderdate", TS, "timestamp_ntz"), ("o_orderpriority", STR, "string")]
)

_DOC = f"('{NS}doc/' || CAST(doc_id AS VARCHAR))"
NTRIPLES_ROUNDTRIP = "\nUNION ALL\n".join([
    f"SELECT {_DOC} AS s, '{SCH}documents_text' AS p, {lex('text', STR)} AS o, 'literal' AS o_kind, "
    f"{NULL} AS o_datatype, lang AS o_lang FROM documents WHERE text IS NOT NULL",
    row(_DOC, f"'{SCH}documents_source'", "source", "literal", dt=XSD + "string",
        src="FROM documents WHERE source IS NOT NULL"),
    row(_DOC, f"'{RDF_TYPE}'", f"'{SCH}Documents'", src="FROM documents"),
    row(_DOC, f"'{SCH}documents_n_chars'", "CAST(n_chars AS VARCHAR)", "literal", dt=XSD + "integer",
        src="FROM documents WHERE n_chars IS NOT NULL"),
])

_NSP = "'^(.*/linked_data/)(schema/)?([a-z]*)/?'"
NAMESPACES = f"""SELECT page_id, ns, regexp_extract(ns, {_NSP}, 1) AS base,
  regexp_extract(ns, {_NSP}, 2) <> '' AS is_schema, regexp_extract(ns, {_NSP}, 3) AS db,
  CASE WHEN regexp_extract(ns, {_NSP}, 3) <> ''
       THEN regexp_extract(ns, {_NSP}, 1) || 'schema/' || regexp_extract(ns, {_NSP}, 3) || '/' END AS schema_ns
FROM (SELECT page_id, 'http://example.org/linked_data/' || CASE WHEN starts_with(url, 'https') THEN 'schema/' ELSE '' END
             || regexp_extract(url, '^https?://[^/]+/([a-z]*)', 1) || '/' AS ns FROM pages) t"""

# ---- feature layers -------------------------------------------------------------------------

NS_GIS = "http://example.org/linked_data/gis/"
SCH_GIS = "http://example.org/linked_data/schema/gis/"
_EX = "CAST(floor(CAST(embedding[1] AS DOUBLE) * 10000) AS BIGINT)"
_EY = "CAST(floor(CAST(embedding[2] AS DOUBLE) * 10000) AS BIGINT)"
_PRICE = "CAST(p_retailprice AS VARCHAR)"
LAYER_EMB = (f"SELECT vec_id AS fid, 'POINT (' || CAST({_EX} AS VARCHAR) || ' ' || CAST({_EY} AS VARCHAR) || ')' AS wkt, "
             f"{_EX} AS cx, {_EY} AS cy, label FROM embeddings")
LAYER_PART = (f"SELECT p_partkey AS fid, 'POLYGON ((0 0, ' || p_size || ' 0, ' || p_size || ' ' || {_PRICE} || ', 0 ' "
              f"|| {_PRICE} || ', 0 0))' AS wkt, p_size / 2.0 AS cx, p_retailprice / 2.0 AS cy, p_name, p_size, "
              f"p_retailprice FROM part")
LAYER_LABEL = ("SELECT doc_id AS fid, CASE WHEN quality = 1 AND toxic = 1 THEN NULL ELSE 'POINT (' || quality || ' ' "
               "|| toxic || ')' END AS wkt, quality AS cx, toxic AS cy, CASE WHEN toxic = 1 THEN -333 ELSE quality END "
               "AS quality, toxic, CASE WHEN quality = 0 THEN 'Geen informatie' WHEN toxic = 1 THEN '-777' "
               "ELSE 'q' || quality END AS note FROM labels")


def _in_area(x0, y0, x1, y1):
    return f"fid > 0 AND wkt IS NOT NULL AND cx BETWEEN {x0} AND {x1} AND cy BETWEEN {y0} AND {y1}"


FEATURE_AREA = _in_area(-500, -500, 10.3, 470.456)
FEATURE_IN_AREA = (f"SELECT 'pEmbedding' AS layer, fid FROM ({LAYER_EMB}) e WHERE {FEATURE_AREA}\nUNION ALL\n"
                   f"SELECT 'vPart' AS layer, fid FROM ({LAYER_PART}) p WHERE {FEATURE_AREA}")


def feature_sql(layer_sql: str, layer: str, cls: str, gtype: str, sfc: str, where: str,
                attrs: list[tuple[str, str, str, str]], features: bool = True) -> list[str]:
    """T7 + T8 rows of one layer; attrs = (column, property, xsd kind, sentinel test)."""
    s = f"('{NS_GIS}r' || sha1(CAST(fid AS VARCHAR) || '{layer}{cls}'))"
    g = f"('{NS_GIS}r' || sha1('{gtype}' || wkt))"
    src = f"FROM ({layer_sql}) l WHERE {where}"
    out = []
    if features:
        out.append(row(s, f"'{RDF_TYPE}'", f"'{SCH_GIS}{cls}'", src=src))
        out.append(row(s, f"'{RDFS_LABEL}'", f"'{cls} ' || CAST(fid AS VARCHAR) || ' ({gtype})'", "literal",
                       lang="nl", src=src))
        for col, prop, kind, keep in attrs:
            out.append(row(s, f"'{SCH_GIS}{cls.lower()}_{prop}'", lex(col, kind), "literal", dt=XSD + kind,
                           src=src + f" AND {col} IS NOT NULL AND {keep}"))
    out += [
        row(g, f"'{RDF_TYPE}'", f"'{SF}{sfc}'", src=src),
        row(g, f"'{RDFS_LABEL}'", f"'{sfc} Geometry'", "literal", lang="nl", src=src),
        row(s, f"'{GEO}hasGeometry'", g, src=src),
        row(g, f"'{GEO}asWKT'", "wkt", "literal", dt=GEO + "wktLiteral", src=src),
    ]
    return out


_NUM_SENT = "NOT ({c} IN (-111, -222, -333, -444, -555, -666, -777, -888, -999))"
_TXT_SENT = ("NOT ({c} IN ('-111', '-222', '-333', '-444', '-555', '-666', '-777', '-888', '-999', "
             "'Niet van toepassing', 'Geen informatie'))")
FEATURE_TRIPLES = _distinct(*feature_sql(
    LAYER_LABEL, "pLabel", "Label", "POINT", "Point", _in_area(-10, -10, 10, 10),
    [("quality", "quality", INT, _NUM_SENT.format(c="quality")), ("toxic", "toxic", INT, _NUM_SENT.format(c="toxic")),
     ("note", "note", STR, _TXT_SENT.format(c="note"))]))

_LAYER_BODY = _distinct(
    *feature_sql(LAYER_EMB, "pEmbedding", "Embedding", "POINT", "Point", FEATURE_AREA,
                 [("label", "label", INT, _NUM_SENT.format(c="label"))]),
    *feature_sql(LAYER_PART, "vPart", "Part", "POLYGON", "Polygon", FEATURE_AREA,
                 [("p_name", "p-name", STR, _TXT_SENT.format(c="p_name")),
                  ("p_size", "p-size", INT, _NUM_SENT.format(c="p_size")),
                  ("p_retailprice", "p-retailprice", DBL, _NUM_SENT.format(c="p_retailprice"))]))
LAYER_GRAPH = with_header_sql("WITH", _LAYER_BODY, NS_GIS, "gis", "1970-01-01T00:00:00")

LAYER_POINT = "SELECT p_partkey AS fid, 'POINT (' || p_size || ' 0)' AS wkt, p_size AS cx, 0 AS cy FROM part"
GEOMETRY_TRIPLES = _distinct(*feature_sql(LAYER_POINT, "pPart", "Part", "POINT", "Point", _in_area(0, -1, 100, 1), [],
                                          features=False))

CLASS_PAIRS = f"""SELECT DISTINCT {iri("Orders", "CAST(o_orderkey AS VARCHAR)")} AS s, {lex("o_orderpriority", STR)} AS o,
  'literal' AS o_kind, '{XSD}string' AS o_datatype, {NULL} AS o_lang
FROM orders WHERE o_orderpriority IS NOT NULL"""

MULTI_READ = _distinct(instance_sql("customer"), instance_sql("nation"))

ORACLE.update({
    "event_triples": "SELECT DISTINCT * FROM (" + instance_sql("events") + ") u",
    "class_pairs": CLASS_PAIRS,
    "multi_read": MULTI_READ,
    "scope_by_codes": SCOPE_BY_CODES,
    "star_bindings": STAR_BINDINGS,
    "enrich_chain": ENRICH_CHAIN,
    "enrich_literal": ENRICH_LITERAL,
    "xref_links": XREF_LINKS,
    "xref_backlinks": XREF_BACKLINKS,
    "align_types": ALIGN_TYPES,
    "merge_graphs": MERGE_GRAPHS,
    "with_header": WITH_HEADER,
    "melt_fields": MELT_FIELDS,
    "ntriples_roundtrip": NTRIPLES_ROUNDTRIP,
    "namespaces": NAMESPACES,
    "feature_in_area": FEATURE_IN_AREA,
    "feature_triples": FEATURE_TRIPLES,
    "layer_graph": LAYER_GRAPH,
    "geometry_triples": GEOMETRY_TRIPLES,
})

ORACLE["reach_deep"] = """WITH RECURSIVE reach(id) AS (
  SELECT o_orderkey FROM orders WHERE o_orderkey >= 1024
  UNION
  SELECT o.o_orderkey // 2 FROM reach r JOIN orders o ON o.o_orderkey = r.id
)
SELECT 'node' AS tbl, CAST(id AS VARCHAR) AS id FROM reach"""

_SEG = "(SELECT *, ' ' || c_mktsegment || '  ' AS seg FROM customer)"
_CUST_IRI, _SEG_IRI = iri("Customer", "CAST(c_custkey AS VARCHAR)"), iri("Segment", "seg")
ORACLE["text_key_graph"] = "\nUNION\n".join([
    row(_CUST_IRI, f"'{RDF_TYPE}'", f"'{SCH}Customer'", src=f"FROM {_SEG} t"),
    row(_CUST_IRI, f"'{RDFS_LABEL}'", "'Customer ' || CAST(c_custkey AS VARCHAR)", "literal", lang="nl", src=f"FROM {_SEG} t"),
    row(_CUST_IRI, f"'{SCH}customer_segment'", _SEG_IRI, src=f"FROM {_SEG} t"),
    row(_SEG_IRI, f"'{SCH}segment_inv_customer'", _CUST_IRI, src=f"FROM {_SEG} t"),
    row(_SEG_IRI, f"'{RDF_TYPE}'", f"'{SCH}Segment'", src=f"FROM {_SEG} t"),
    row(_SEG_IRI, f"'{RDFS_LABEL}'", "'Segment ' || seg", "literal", lang="nl", src=f"FROM {_SEG} t"),
])

ORACLE["bnode_roundtrip"] = """SELECT 'conv' || conv_id AS label, count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars,
       count(DISTINCT turn) AS n_turns, max(turn)::BIGINT AS last_turn
FROM conversations GROUP BY conv_id"""

TABLES["events_by_user"] = ("Events", "CAST(user_id AS VARCHAR)", *TABLES["events"][2:])
ORACLE["event_user_triples"] = "SELECT DISTINCT * FROM (" + instance_sql("events_by_user", "events") + ") u"
