"""Closure invariants (R1, R2, J1-J3, X3, X4) on the small test tables."""

from pyspark.sql import functions as F

from graphloom.operators import closure as R
from graphloom.plans import tpch
from graphloom.plans.table_graph import closure_with_secondary
from tests.conftest import SF001, rows


def _sources(spark):
    return tpch.tables(spark, SF001, ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"])


def test_closure_monotone_and_capped(spark):
    m = tpch.mapping(spark, SF001)
    roots = R.refs(tpch.table(spark, SF001, "orders").where("o_orderkey < 40"), "orders", "o_orderkey")
    full = R.closure(spark, _sources(spark), m, roots)
    one = R.closure(spark, _sources(spark), m, roots, max_rounds=1)
    two = R.closure(spark, _sources(spark), m, roots, max_rounds=2)
    v_full, v1, v2 = set(rows(full.visited)), set(rows(one.visited)), set(rows(two.visited))
    assert v1 == set(rows(roots)) and v1 <= v2 <= v_full
    assert {t for t, _ in v_full} == {"orders", "customer", "nation", "region"}
    assert one.frontier.count() > 0  # found in the last allowed round, not expanded
    assert full.frontier.count() == 0 and full.rounds == 4


def test_missing_keys_count_as_visited(spark):
    m = tpch.mapping(spark, SF001)
    roots = spark.createDataFrame([("customer", "999999999")], R.REFS_SCHEMA)
    res = R.closure(spark, _sources(spark), m, roots)
    assert rows(res.visited) == [("customer", "999999999")] and res.rounds == 1


def test_empty_roots(spark):
    m = tpch.mapping(spark, SF001)
    roots = spark.createDataFrame([], R.REFS_SCHEMA)
    res = closure_with_secondary(spark, _sources(spark), m, roots, "orders", [("lineitem", "l_orderkey")])
    assert res.visited.count() == 0  # Q10: empty result, no error


def test_reference_set_ops(spark):
    a = spark.createDataFrame([("t", "1"), ("t", "2"), ("u", "1")], R.REFS_SCHEMA)
    b = spark.createDataFrame([("t", "2"), ("u", "3")], R.REFS_SCHEMA)
    assert rows(R.union_refs(a, b)) == [("t", "1"), ("t", "2"), ("u", "1"), ("u", "3")]
    assert rows(R.minus_refs(a, b)) == [("t", "1"), ("u", "1")]


def test_scope_roots_empty_codes_means_all(spark):
    cust = tpch.table(spark, SF001, "customer")
    none = spark.createDataFrame([], "code string")
    assert R.scope_roots(cust, F.col("c_nationkey").cast("string"), none).count() == cust.count()
    codes = spark.createDataFrame([("1",)], "code string")
    got = R.scope_roots(cust, F.col("c_nationkey").cast("string"), codes)
    assert got.count() == cust.where("c_nationkey = 1").count()


def test_self_referencing_hierarchy(spark):
    from graphloom.mapping import Mapping, Rel, TableMap

    # node i points to parent i // 2: a chain of rounds over one table
    nodes = spark.range(1, 65).selectExpr("id", "CASE WHEN id > 1 THEN id DIV 2 END AS parent")
    tm = TableMap("node", "Node", "id", rels=(Rel("parent", "parent", "node", "Node"),), unique_key=True)
    m = Mapping("t", {"node": tm})
    roots = spark.createDataFrame([("node", "64"), ("node", "37")], R.REFS_SCHEMA)
    res = R.closure(spark, {"node": nodes}, m, roots)
    got = sorted(int(r.id) for r in res.visited.collect())
    want = sorted({64, 32, 16, 8, 4, 2, 1, 37, 18, 9})
    assert got == want and res.rounds == 6
    capped = R.closure(spark, {"node": nodes}, m, roots, max_rounds=3)
    assert sorted(int(r.id) for r in capped.visited.collect()) == sorted({64, 32, 16, 37, 18, 9})
    assert sorted(int(r.id) for r in capped.frontier.collect()) == [4, 8]


def _chain(spark, n, link="k"):
    """Node i points to node i - 1."""
    from graphloom.mapping import Mapping, Rel, TableMap

    own = {"k": "id", "text": "concat('n', id)", "padded": "concat('0', id)"}[link]
    nodes = spark.range(0, n, 1, 4).selectExpr(f"{own} AS id", f"CASE WHEN id > 0 THEN {own.replace('id', '(id - 1)')} END AS next")
    tm = TableMap("node", "Node", "id", rels=(Rel("next", "next", "node", "Node"),), unique_key=True)
    return {"node": nodes}, Mapping("t", {"node": tm})


def test_long_chain_with_a_bounded_plan(spark):
    """The plan of a round and the number of runs stay small however deep the closure is."""
    sources, m = _chain(spark, 150)
    reach = R.Reach(spark, sources, m)
    lengths, runs = [], []
    new = reach._new

    def seen(keys, tables=None):
        out = new(keys, tables)
        lengths.append(len(spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")))
        runs.append(len(reach.runs))
        return out
    reach._new = seen
    reach.expand(reach.typed(spark.createDataFrame([("node", "149")], R.REFS_SCHEMA)))
    assert reach.rounds == 150 and reach.visited_keys().distinct().count() == 150
    assert max(runs) <= 2 * R.FAN and max(lengths[100:]) <= 1.5 * max(lengths[20:60])


def test_key_types(spark):
    """Numbers are compared as numbers only where every key and foreign key is a whole number;
    text that is not a number's plain form is visited but matches nothing."""
    for link, root, want in (("k", "3", {"0", "1", "2", "3"}), ("text", "n3", {"n0", "n1", "n2", "n3"}), ("padded", "03", {"00", "01", "02", "03"})):
        sources, m = _chain(spark, 5, link)
        res = R.closure(spark, sources, m, spark.createDataFrame([("node", root)], R.REFS_SCHEMA))
        assert {r.id for r in res.visited.collect()} == want
        assert res.reach.native["node"] == (link == "k")
    sources, m = _chain(spark, 5)
    res = R.closure(spark, sources, m, spark.createDataFrame([("node", "03"), ("node", "x"), ("node", "1")], R.REFS_SCHEMA))
    assert sorted(r.id for r in res.visited.collect()) == ["0", "03", "1", "x"]


def test_large_frontiers_join_and_small_ones_are_literals(spark, monkeypatch):
    sources, m = _chain(spark, 400)
    roots = spark.range(0, 400, 2).selectExpr("'node' AS tbl", "cast(id AS string) AS id")
    want = sorted(str(i) for i in range(399))
    for small in (512, 10):
        monkeypatch.setattr(R, "SMALL", small)
        assert sorted(r.id for r in R.closure(spark, sources, m, roots).visited.collect()) == want


def test_secondary_rows_of_a_repeated_key(spark):
    """A child whose key does not fix its row is closed by key, one whose key does by its rows."""
    from graphloom.mapping import Mapping, Rel, TableMap

    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 2, 30), (None, 1, 40)], "name string, p long, d long")
    thing = spark.createDataFrame([(i,) for i in (10, 20, 30, 40)], "id long")
    tables = {"parent": TableMap("parent", "P", "id", unique_key=True), "thing": TableMap("thing", "T", "id", unique_key=True)}
    rels = (Rel("p", "p", "parent", "P"), Rel("d", "d", "thing", "T"))
    roots = spark.createDataFrame([("parent", "1")], R.REFS_SCHEMA)
    for row_key, want in ((False, {"10", "20"}), (True, {"10"})):
        m = Mapping("t", {**tables, "child": TableMap("child", "C", "name", rels=rels, row_key=row_key)})
        res = closure_with_secondary(spark, {"parent": parent, "child": child, "thing": thing}, m, roots, "parent", [("child", "p")])
        got = {(r.tbl, r.id) for r in res.visited.collect()}
        assert {i for t, i in got if t == "thing"} == want and ("child", "a") in got and ("child", "b") not in got
        assert res.tables() == ["child", "parent", "thing"]


def test_a_child_reached_by_two_foreign_keys(spark):
    from graphloom.mapping import Mapping, Rel, TableMap

    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(10, 1, 9), (11, 9, 1), (12, 1, 1), (13, 9, 9)], "id long, p long, q long")
    tables = {"parent": TableMap("parent", "P", "id", unique_key=True), "child": TableMap("child", "C", "id", unique_key=True, rels=(Rel("p", "p", "parent", "P"),))}
    roots = spark.createDataFrame([("parent", "1")], R.REFS_SCHEMA)
    res = closure_with_secondary(spark, {"parent": parent, "child": child}, Mapping("t", tables), roots, "parent", [("child", "p"), ("child", "q")])
    assert sorted(r.id for r in res.visited.where("tbl = 'child'").collect()) == ["10", "11", "12"]
    assert sorted(r.id for r in res.reach.rows_of("child").collect()) == [10, 11, 12]
