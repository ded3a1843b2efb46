"""Edge cases of single operators (F6, Q13, T8 sharing, L11, T15, X5, J5 multiplication)."""

from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.mapping import Attr, TableMap
from graphloom.operators import enrich as EN
from graphloom.operators import features as FE
from graphloom.operators import metadata as MD
from graphloom.operators import patterns as P
from graphloom.operators import sets as X
from graphloom.operators.filters import Area, drop_sentinels
from graphloom.operators.triples import emit, iri_triple, typed_triple
from tests.conftest import rows

CFG = M.GraphConfig("gis")


def test_sentinels_numeric_and_text(spark):
    df = spark.createDataFrame([(1, -333.0, "-333", "Geen informatie"), (2, 5.0, "x", "ok")],
                               "id int, n double, t string, u string")
    got = rows(drop_sentinels(df, ["n", "t", "u"]))
    assert got == [(1, None, None, None), (2, 5.0, "x", "ok")]


def _layer(spark, data):
    return spark.createDataFrame(data, "fid bigint, wkt string, name string")


def test_feature_scope_and_rejects(spark):
    layer = _layer(spark, [(0, "POINT (1 1)", "zero"), (1, "POINT (1 1)", "a"), (2, None, "nogeom"),
                           (3, "POINT (50 50)", "far"), (4, "CIRCULARSTRING (0 0, 1 1, 2 0)", "odd"),
                           (5, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))", "Niet van toepassing")])
    area = Area(0, 0, 10, 10)
    assert sorted(r.fid for r in FE.in_scope(layer, area).collect()) == [1, 5]
    assert [r.fid for r in FE.rejected(layer).collect()] == [4]
    tm = TableMap("pThing", "Thing", "fid", attrs=(Attr("name", "name", M.XSD_STRING),))
    g = FE.feature_triples(layer, "pThing", tm, CFG, area)
    subjects = {r.s for r in g.where(f"p = '{M.RDF_TYPE}' and o = '{CFG.schema_ns}Thing'").collect()}
    assert len(subjects) == 2
    names = {r.o for r in g.where(f"p = '{CFG.schema_ns}thing_name'").collect()}
    assert names == {"a"}  # the sentinel phrase is skipped
    labels = {r.o for r in g.where(f"p = '{M.RDFS_LABEL}'").collect()}
    assert {"Thing 1 (POINT)", "Thing 5 (POLYGON)", "Point Geometry", "Polygon Geometry"} <= labels


def test_equal_geometries_share_a_node(spark):
    layer = _layer(spark, [(1, "POINT (1 1)", "a"), (2, "POINT (1 1)", "b")])
    tm = TableMap("pThing", "Thing", "fid")
    g = X.as_set(FE.feature_triples(layer, "pThing", tm, CFG, Area(0, 0, 10, 10), features=False))
    assert g.where(f"p = '{M.GEO_HASGEOMETRY}'").select("o").distinct().count() == 1
    assert g.where(f"p = '{M.GEO_ASWKT}'").count() == 1


def test_template_fill(spark):
    df = spark.createDataFrame([("http://x/s", "1.5", "7")], "s string, a string, b string")
    vals = {"[a]": F.col("a"), "[b]": F.col("b")}
    text = df.select(EN.fill_template("P ([a] [b]) [a]", M.GEO_WKTLITERAL, vals)).first()[0]
    assert text == "P (1.5 7) 1.5"
    raw = df.select(EN.fill_template("[b] and [a]", M.XSD_DOUBLE, vals)).first()[0]
    assert raw == "7"  # non-text datatype: the first variable's raw value
    missing = df.select(EN.fill_template("[zz] x", M.XSD_STRING, vals)).first()[0]
    assert missing is None
    target = {"head": "http://x/A", "property": "http://x/p", "type": "URIRef",
              "tail": {"head": "http://x/B", "property": "http://x/q", "type": "URIRef", "tail": "ignored"}}
    t = EN.enrich(df, target, "http://x/", ["a", "b"])
    assert t.count() == 4 and t.where("p = 'http://x/q'").count() == 1


def test_refresh_metadata_single_modified_and_count(spark):
    base = CFG.data_ns
    g1 = MD.with_metadata(emit(spark.range(3), [typed_triple(F.concat(F.lit("http://x/"), F.col("id")),
                                                              "http://x/p", F.lit("v"), M.XSD_STRING)]),
                          base, 0, "gis")
    g2 = MD.with_metadata(emit(spark.range(5), [iri_triple(F.concat(F.lit("http://x/"), F.col("id")),
                                                            "http://x/q", F.lit("http://x/o"))]), base, 10, "gis")
    merged = MD.refresh_metadata(X.union_all([g1, g2]), 99)
    mods = merged.where(f"p = '{M.DCTERMS}modified'").collect()
    assert len(mods) == 1 and mods[0].o == "1970-01-01T00:01:39"
    cnt = merged.where(f"p = '{M.VOID_TRIPLES}'").collect()
    assert len(cnt) == 1 and int(cnt[0].o) == merged.count()


def test_delete_pattern(spark):
    g = X.as_set(emit(spark.range(2), [
        iri_triple(F.lit("http://x/a"), "http://x/p", F.concat(F.lit("http://x/"), F.col("id"))),
        iri_triple(F.lit("http://x/b"), "http://x/q", F.lit("http://x/c"))]))
    assert X.delete(g, p="http://x/p").count() == 1
    assert X.delete(g, s="http://x/a", o="http://x/1").count() == 2


def test_star_multiplies_multi_values(spark):
    cls = "http://x/C"
    g = emit(spark.range(1), [
        iri_triple(F.lit("http://x/s"), M.RDF_TYPE, cls),
        typed_triple(F.lit("http://x/s"), "http://x/p", F.lit("1"), M.XSD_STRING),
        typed_triple(F.lit("http://x/s"), "http://x/p", F.lit("2"), M.XSD_STRING),
        typed_triple(F.lit("http://x/s"), "http://x/q", F.lit("a"), M.XSD_STRING),
        typed_triple(F.lit("http://x/s"), "http://x/q", F.lit("b"), M.XSD_STRING),
        typed_triple(F.lit("http://x/t"), "http://x/p", F.lit("9"), M.XSD_STRING),  # untyped subject
    ])
    got = rows(P.star(g, cls, [("p", "http://x/p"), ("q", "http://x/q")]))
    assert got == [("http://x/s", "1", "a"), ("http://x/s", "1", "b"), ("http://x/s", "2", "a"),
                   ("http://x/s", "2", "b")]


def _star_graph(spark, hub=3000):
    """A hub with ``hub`` values of p and 40 of q, a third of all triples or more; small subjects."""
    iri = lambda a, c: F.concat(F.lit(a), c.cast("string"))
    one = lambda s, p, o: F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"))
    i = F.col("id")
    small = spark.range(500).select(F.inline(F.array(
        one(iri("http://x/", i), M.RDF_TYPE, iri("http://x/C", i % 2)), one(iri("http://x/", i), "http://x/p", iri("v", i % 7)),
        one(iri("http://x/", i), "http://x/p", iri("w", i)), one(iri("http://x/", F.when(i % 3 > 0, i).otherwise(F.lit(1))), "http://x/q", iri("q", i % 5)))))
    big = spark.range(hub).select(F.inline(F.array(
        one(F.lit("http://x/hub"), M.RDF_TYPE, F.lit("http://x/C0")), one(F.lit("http://x/hub"), "http://x/p", iri("p", i)), one(F.lit("http://x/hub"), "http://x/q", iri("q", i % 40)))))
    rest = [F.lit(M.KIND_LITERAL).alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang")]
    return small.unionByName(big).distinct().select("*", *rest)


def test_hub_values_are_spread_without_changing_the_result(spark):
    g = _star_graph(spark)
    props = [("p", "http://x/p"), ("q", "http://x/q")]
    plain, spread = rows(P.star(g, "http://x/C0", props)), rows(P.star(g, "http://x/C0", props, least=300))
    assert spread == plain and len(plain) == len(set(plain)) and sum(r[0] == "http://x/hub" for r in plain) == 3000 * 40
    assert P.hubs(g, ["http://x/p", "http://x/q"], 300) == [("http://x/p", "http://x/hub", 3000)]
    out = P.stars(g, [(0, "http://x/C0", [p for _, p in props])], 300)
    text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "hashpartitioning(rule_id" in text and "cell" in text  # a hub's slices go to different tasks


def test_hubs_in_several_properties_make_a_grid(spark):
    g = _star_graph(spark, 900)
    rules = [(0, "http://x/C0", ["http://x/p", "http://x/q"]), (1, "http://x/C0", ["http://x/q", "http://x/p", "http://x/q"]), (2, "http://x/C1", ["http://x/p"]), (3, "http://x/C0", [])]
    a, b = P.stars(g, rules), P.stars(g, rules, least=20)
    assert rows(a.select(*[F.coalesce(c, F.lit("-")) for c in a.columns])) == rows(b.select(*[F.coalesce(c, F.lit("-")) for c in b.columns]))
    counts = {r.rule_id: r.n for r in a.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    hub = {0: 900 * 40, 1: 900 * 40 * 40}
    assert all(counts[i] > n for i, n in hub.items()) and counts[3] == 251


def test_fifty_enrichment_rules_are_one_scan(spark):
    from graphloom.plans.graph_jobs import enrich_graph
    from graphloom.plans.tpch_queries import graph_of
    from tests.conftest import SF001

    g = graph_of(spark, SF001, ["region"])
    rule = lambda i: {"source": ["sql:lake.region/r_name"] + ["sql:lake.region/r_regionkey"] * (i % 2),
                      "target": {"head": f"http://x/H{i}", "property": "http://x/p", "type": "URIRef",
                                 "tail": {"head": M.XSD_STRING, "property": f"http://x/name{i}", "type": "Literal", "tail": f"{i} [r_name]"}}}
    plans = {}
    for n in (2, 50):
        out = enrich_graph(g, {"lake": [rule(i) for i in range(n)]})
        assert out.count() == 5 * 3 * n
        text = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
        text = text[text.index("== Initial Plan ==") if "== Initial Plan ==" in text else 0:]
        plans[n] = (text.count("FileScan"), text.count("Join"), text.count("Exchange"))
    assert plans[2] == plans[50] and plans[50][0] == 1


def test_link_matches_datatype_and_skips_empty(spark):
    src = emit(spark.range(1), [
        iri_triple(F.lit("http://a/1"), M.RDF_TYPE, "http://a/C"),
        typed_triple(F.lit("http://a/1"), "http://a/k", F.lit("5"), M.XSD_INTEGER),
        iri_triple(F.lit("http://a/2"), M.RDF_TYPE, "http://a/C"),
        typed_triple(F.lit("http://a/2"), "http://a/k", F.lit(""), M.XSD_INTEGER),
    ])
    tgt = emit(spark.range(1), [
        typed_triple(F.lit("http://b/1"), "http://b/k", F.lit("5"), M.XSD_INTEGER),
        typed_triple(F.lit("http://b/2"), "http://b/k", F.lit("5"), M.XSD_STRING),
        typed_triple(F.lit("http://b/3"), "http://b/k", F.lit(""), M.XSD_INTEGER),
    ])
    rules = spark.createDataFrame([("r", "http://a/C", "http://a/k", "http://b/k", "http://x/rel")],
                                  "rule_id string, src_class string, src_prop string, tgt_prop string, rel string")
    got = [(r.s, r.o) for r in P.link(src, tgt, rules).collect()]
    assert got == [("http://a/1", "http://b/1")]


def test_undecodable_enrichment_rule_is_skipped(spark):
    from graphloom.plans.graph_jobs import enrich_graph
    from graphloom.plans.tpch_queries import graph_of
    from tests.conftest import SF001

    g = graph_of(spark, SF001, ["region"])
    target = {"head": M.XSD_STRING, "property": "http://x/name", "type": "Literal", "tail": "[r_name]"}
    doc = {"lake": [{"source": ["not a rule"], "target": target},
                    {"source": ["sql:lake.region/r_name"], "target": target}]}
    out = enrich_graph(g, doc)
    assert out.count() == 5 and {r.p for r in out.collect()} == {"http://x/name"}
