"""Sources and sinks: mapping documents (S6, S10, O1) and N-Triples/N-Quads."""

import json
import os

from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.operators.triples import iri_triple, lang_triple, typed_triple, emit
from graphloom.plans import tpch
from graphloom.sources import documents as D
from graphloom.sources import ntriples as NT
from tests.conftest import SF001, rows


def test_mapping_roundtrip(spark, tmp_path):
    m = tpch.mapping(spark, SF001)
    mc, ma, mr = m.to_frames(spark)
    path = D.write_mapping("lake", mc, ma, mr, str(tmp_path / "lake.json"))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    text = open(os.path.join(path, files[0])).read()
    doc = json.loads(text)
    assert doc["metadata"]["database"] == "lake"
    assert list(doc["schema"]) == sorted(doc["schema"])  # keys sorted
    cust = doc["schema"]["customer"]
    assert list(cust) == sorted(cust) and cust["subClassOf"] is None  # nulls written
    assert cust["relations"]["c_nationkey"]["targettable"] == "nation"
    db, mc2, ma2, mr2 = D.load_mapping(spark, path)
    assert db.first().db == "lake"
    cols = [c for c in mc.columns if c != "unique_key"]  # uniqueness is inferred, not documented
    assert rows(mc2.select(cols)) == rows(mc.select(cols)) and rows(ma2) == rows(ma) and rows(mr2) == rows(mr)


def _sample(spark):
    df = spark.createDataFrame([(1, 'say "hi"\nnext\\line\tend', "en")], "k int, t string, lang string")
    s = F.lit("http://x/a")
    return emit(df, [
        lang_triple(s, "http://x/p", F.col("t"), F.col("lang")),
        typed_triple(s, "http://x/q", F.lit("1.5"), M.XSD_DOUBLE),
        iri_triple(s, "http://x/r", F.lit("http://x/b")),
        iri_triple(F.lit("_:b1"), "http://x/r", F.lit("_:b2")).withField("o_kind", F.lit(M.KIND_BNODE)),
    ])


def test_ntriples_write_read(spark, tmp_path):
    g = _sample(spark)
    path = NT.write_triples(g, str(tmp_path / "g"))
    assert path.endswith(".nt")
    back = NT.read_triples(spark, path)
    got = rows(back.where("o_kind <> 'bnode' and not s like '_:%'"))
    assert got == rows(g.where("o_kind <> 'bnode' and not s like '_:%'"))
    b = back.where("s like '_:%'").first()
    assert b.o.startswith("_:f") and b.s.startswith("_:f") and b.o_kind == "bnode"


def test_nquads_and_rejects(spark, tmp_path):
    g = _sample(spark)
    path = NT.write_triples(g, str(tmp_path / "q"), fmt="nquads", graph="http://x/graph")
    assert path.endswith(".nq")
    back = NT.read_triples(spark, path, with_graph=True)
    assert {r.g for r in back.collect()} == {"http://x/graph"}
    lines = spark.createDataFrame([("<http://x/a> <http://x/p> .",), ("# comment",), ("",),
                                   ('<http://x/a> <http://x/p> "v\\u00e9" .',)], "value string")
    ok, bad = NT.parse_lines(lines)
    assert [r.o for r in ok.collect()] == ["vé"]
    assert bad.count() == 1


def test_multiread_keeps_blank_nodes_apart(spark, tmp_path):
    g = _sample(spark).where("s like '_:%'")
    p1 = NT.write_triples(g, str(tmp_path / "a"))
    p2 = NT.write_triples(g, str(tmp_path / "b"))
    both = NT.read_triples(spark, [p1, p2])
    assert both.select("s").distinct().count() == 2


def test_long_literal_line(spark):
    text = "x" * 40000 + '"' + "y" * 100
    df = spark.createDataFrame([(text,)], "t string")
    g = emit(df, [lang_triple(F.lit("http://x/a"), "http://x/p", F.col("t"), "en")])
    back, bad = NT.parse_lines(NT.to_lines(g))
    assert back.first().o == text and bad.count() == 0


def test_write_graph_with_header(spark, tmp_path):
    from graphloom.plans import tpch_queries as Q
    from graphloom.operators.metadata import with_metadata

    body = Q.graph_of(spark, SF001, ["nation"], header=False)
    base = "http://example.org/linked_data/lake/"
    for fmt in ("ntriples", "parquet"):
        path = NT.write_graph(body, str(tmp_path / f"g-{fmt}"), base, 0, "lake", fmt=fmt)
        back = NT.read_triples(spark, path) if fmt == "ntriples" else spark.read.parquet(path)
        want = with_metadata(body, base, 0, "lake")
        assert rows(back.select(*M.TRIPLE_COLUMNS)) == rows(want)


def test_write_table_graph_job_equals_query(spark, tmp_path):
    import __spark_entry__ as E
    from graphloom.plans import tpch
    from graphloom.plans import tpch_queries as Q
    from graphloom.plans.table_graph import write_table_graph

    m = tpch.mapping(spark, SF001)
    path = write_table_graph(spark, Q._sources(spark, SF001), m, Q.CFG, Q._roots(spark, SF001), "orders",
                             str(tmp_path / "lake"), ts=Q.HEADER_TS, secondary=[("lineitem", "l_orderkey")],
                             fmt="parquet")
    written = spark.read.parquet(path)
    assert rows(written) == rows(E.queries()["table_graph"](spark, SF001))
