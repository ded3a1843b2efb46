"""Checked keys (X1), counts taken while writing (A1, T14), one evaluation of a merge (X2), stored
graphs (T15)."""

import logging
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.mapping import Attr, TableMap
from graphloom.operators import metadata as MD
from graphloom.operators import sets as X
from graphloom.operators.triples import emit, iri_triple, typed_triple
from graphloom.plans.graph_jobs import merge_graphs
from graphloom.plans.table_graph import instance_set, repeated_keys
from graphloom.session import materialize_counted
from tests.conftest import rows

CFG = M.GraphConfig("t")
BASE = "http://x/base"


def _table(name, key="id"):
    return TableMap(name, name.title(), key, attrs=(Attr("v", "v", M.XSD_STRING),), unique_key=True)


def test_a_broken_declared_key_is_found_and_deduplicated(spark, caplog):
    good = spark.createDataFrame([(1, "a"), (2, "a"), (None, "x"), (None, "x")], "id long, v string")
    bad = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "id long, v string")
    frames = [(good, _table("good")), (bad, _table("bad")), (bad, replace(_table("other"), unique_key=False))]
    assert repeated_keys(frames) == {1}
    with caplog.at_level(logging.WARNING):
        out = instance_set(frames, CFG)
    assert "declared key id of table bad is not unique" in caplog.text and "good" not in caplog.text
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) == 2 * 3 + 2 * (2 + 2 + 1 + 2)
    # the good table still passes without a shuffle of its own; unchecked declarations are believed
    assert instance_set(frames[:1], CFG)._jdf.queryExecution().toString().count("Exchange") == 0
    assert instance_set(frames[1:2], CFG, check_keys=False).count() == 3 * 4


def _graph(spark, ids, base=BASE, ts=5):
    s = F.concat(F.lit("http://x/"), F.col("id").cast("string"))
    body = emit(spark.createDataFrame([(i,) for i in ids], "id long"), [iri_triple(s, M.RDF_TYPE, "http://x/C"), typed_triple(s, "http://x/v", F.lit("1"), M.XSD_INTEGER)])
    return MD.with_metadata(body, base, ts, "t")


def test_counts_are_taken_while_writing(spark):
    frame, n = materialize_counted(spark.range(0, 1000, 1, 7).where("id % 3 = 0").repartition(5))
    assert n == frame.count() == 334
    assert materialize_counted(spark.range(0))[1] == 0
    g = _graph(spark, [1, 2, 2, 3])
    count = [r.o for r in g.where(F.col("p") == M.VOID_TRIPLES).collect()]
    assert count == [str(g.count())] == [str(6 + MD.HEADER_SIZE + 1)]


def test_a_merge_evaluates_its_inputs_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    graphs = [_graph(spark, [1, 2]), _graph(spark, [2, 3], ts=6)]
    total = sum(g.count() for g in graphs)
    out = merge_graphs([g.mapInPandas(counted, M.TRIPLE_SCHEMA) for g in graphs], 9)
    got = [tuple(r) for r in out.collect()]
    assert read.value == total
    assert len(got) == len(set(got)) and [r[2] for r in got if r[1] == M.VOID_TRIPLES] == [str(len(got))]
    assert sum(r[1] == M.DCTERMS + "modified" for r in got) == 1
    assert sorted(got, key=str) == sorted(map(tuple, MD.refresh_metadata(X.merge(graphs), 9).collect()), key=str)


def test_a_refresh_rewrites_one_partition(spark, tmp_path):
    import os

    g = X.union_all([_graph(spark, [1, 2]), _graph(spark, [2, 4], ts=6)])
    path = MD.store_graph(g, str(tmp_path / "g"), 9)
    assert rows(MD.read_store(spark, path).select("s", "p", "o")) == rows(MD.refresh_metadata(g, 9).select("s", "p", "o"))
    files = lambda: {f: os.path.getmtime(os.path.join(path, MD.REST, f)) for f in os.listdir(os.path.join(path, MD.REST))}
    before = files()
    MD.refresh_store(spark, path, 11)
    assert files() == before
    assert rows(MD.read_store(spark, path).select("s", "p", "o")) == rows(MD.refresh_metadata(g, 11).select("s", "p", "o"))
    with pytest.raises(ValueError, match="no subject typed"):
        MD.store_graph(g.where("false"), str(tmp_path / "empty"), 9)
