"""Guards for what one task holds and what jobs write: staged graphs and set operations."""

import pytest
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom import session
from graphloom.operators.sets import as_set
from graphloom.plans import graph_jobs as G, tpch_queries as Q
from tests.conftest import SF001, rows
from tests.test_plans import plan

DATA, SCHEMA = Q.CFG.data_ns, Q.CFG.schema_ns


@pytest.fixture
def staged(monkeypatch):
    """The frames that a job stages, by name."""
    kept = {}
    write = session.materialize

    def keep(df, name="part"):
        kept[name] = df
        return write(df, name)

    monkeypatch.setattr(session, "materialize", keep)
    return kept


def _graph(spark):
    """Two customers, one of them with a second type, a nation and triples no rule names."""
    iri = lambda s, p, o: (s, p, o, M.KIND_IRI, None, None)
    text = lambda s, p, o: (s, p, o, M.KIND_LITERAL, M.XSD_STRING, None)
    c1, c2, n = DATA + "Customer/1", DATA + "Customer/2", DATA + "Nation/a"
    own = [
        iri(DATA, M.RDF_TYPE, M.VOID_DATASET), iri(c1, M.RDF_TYPE, SCHEMA + "Customer"), iri(c2, M.RDF_TYPE, SCHEMA + "Customer"),
        iri(c1, M.RDF_TYPE, SCHEMA + "Client"), iri(n, M.RDF_TYPE, SCHEMA + "Nation"),
        iri(c1, SCHEMA + "customer_c_nationkey", n), iri(c2, SCHEMA + "customer_c_nationkey", n), text(n, SCHEMA + "nation_n_nationkey", "3"),
        text(c1, SCHEMA + "customer_c_name", "One"), text(n, SCHEMA + "nation_n_name", "N"), text(c2, "plain", "x"),
    ]
    return spark.createDataFrame(own, M.TRIPLE_SCHEMA)


def test_alignment_stages_named_triples_without_a_sort(spark, staged):
    got = G.align_graph(_graph(spark), Q.CONCEPT_RULES, id_property="n_nationkey")
    assert [(s, o) for s, _, o, *_ in rows(got)] == [(DATA + f"Customer/{i}", "http://example.org/otl#Coastal") for i in (1, 2)]
    assert "Sort" not in plan(spark, staged["align-input"])
    held = {(r.p, r.o) for r in staged["align-input"].collect()}
    assert {p for p, _ in held} == {M.RDF_TYPE, SCHEMA + "customer_c_nationkey", SCHEMA + "nation_n_nationkey"}
    assert {o for p, o in held if p == M.RDF_TYPE} == {M.VOID_DATASET, SCHEMA + "Customer"}


def test_enrichment_stages_named_triples_without_a_sort(spark, staged):
    got = G.enrich_graph(_graph(spark), {"lake": [{"source": ["sql:lake.customer/c_name"], "target": {
        "head": M.XSD_STRING, "property": "http://example.org/vocab/label", "type": "Literal", "tail": "[c_name]!"}}]})
    assert [r[2] for r in rows(got)] == ["One!"]
    assert "Sort" not in plan(spark, staged["enrich-input"])
    assert {r.p for r in staged["enrich-input"].collect()} == {M.RDF_TYPE, SCHEMA + "customer_c_name"}


def _tree(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()


def test_a_set_is_compared_after_triples_are_dealt_out(spark):
    """Aggregation before the shuffle would hold every triple of a task."""
    g = _graph(spark)
    lines = _tree(spark, as_set(g.unionByName(g)))
    below = lines[next(i for i, x in enumerate(lines) if "Exchange" in x):]
    assert any("Aggregate" in x for x in lines) and not any("Aggregate" in x for x in below)
    assert rows(as_set(g.unionByName(g))) == rows(g)
    for c in ("p", "o_kind"):  # the same of triples that share a column
        lines = _tree(spark, as_set(g.withColumn(c, F.lit("x"))))
        assert len([x for x in lines if "Exchange" in x]) == 1


def test_rows_with_keys_that_may_repeat_are_spread(spark):
    """One table file is one task; its triples are compared in as many as there are partitions, and
    the triples of a hot key are collapsed before they are shuffled."""
    from graphloom.mapping import Attr, Mapping, Rel, TableMap
    from graphloom.plans.table_graph import instance_set

    df = spark.range(0, 4000, numPartitions=1).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), F.col("id").alias("n"), F.array("id").alias("nested"))
    tm = TableMap("t", "Thing", "k", attrs=(Attr("n", "n", M.XSD_INTEGER),), rels=(Rel("k", "k", "t", "Thing"),))
    got = instance_set([(df, Mapping("lake", {"t": tm}).table("t"))], Q.CFG)
    lines = _tree(spark, got)
    exchanges = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert len(exchanges) == 2 and "REPARTITION_BY_NUM" in lines[exchanges[1]]
    assert any("Aggregate" in x for x in lines[exchanges[0]:exchanges[1]])
    hot, single = 1334, 1333  # rows of the hot key; keys of one row; rows without a key give nothing
    assert got.count() == (4 + hot) + 5 * single
    assert got.distinct().count() == got.count()


def test_links_stage_named_triples_without_a_sort(spark, staged):
    src, tgt = Q._xref_graphs(spark, SF001)
    got = G.xref(src, tgt, Q.XREF_RULES, backlinks=True)
    own = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    for name, predicate, cls in [("xref-source", SCHEMA + "orders_o_custkey", SCHEMA + "Orders"), ("xref-target", Q.STORE.schema_ns + "customer_c_custkey", Q.STORE.schema_ns + "Customer")]:
        assert "Sort" not in plan(spark, staged[name])
        kinds = {(r.p, r.o if r.p == own else None) for r in staged[name].select("p", F.when(F.col("p") == own, F.col("o")).alias("o")).distinct().collect()}
        assert kinds == {(own, M.VOID_DATASET), (own, cls), (predicate, None)}
    n = spark.read.parquet(f"{SF001}/orders.parquet").join(spark.read.parquet(f"{SF001}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey")).count()
    assert got.count() == 2 * n


def test_a_rule_of_another_source_does_not_hide_triples(spark, staged):
    """What a graph is shows after it was read: terms of all sources of the rules are staged."""
    src, tgt = Q._xref_graphs(spark, SF001)
    rules = {"other": [{"source": "sql:other.x/y", "target": "sql:lake.orders/o_totalprice"}, {"source": None}], **Q.XREF_RULES}
    assert rows(G.xref(src, tgt, rules)) == rows(G.xref(src, tgt, Q.XREF_RULES))
