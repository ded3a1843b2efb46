"""Catalogue operators and mapping inference (M rows of the inventory), checked against
brute-force DuckDB SQL and hand-worked values on the catalogue of the 14 test tables."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from graphloom.operators import catalog as C
from graphloom.plans import infer, tpch
from tests.conftest import SF001, rows


@pytest.fixture(scope="module")
def cat(spark):
    return tpch.catalogue(spark, SF001)


@pytest.fixture(scope="module")
def dcat(cat):
    con = duckdb.connect()
    for k in ("tables", "columns", "pk", "fk"):
        con.register(f"cat_{k}", cat[k].toPandas())
    return con


def test_identifier_of(cat, dcat):
    got = rows(C.identifier_of(cat["columns"], cat["pk"]).select("table_name", "identifier"))
    want = sorted(dcat.execute("""
        SELECT t.table_name, COALESCE(CASE WHEN k.n = 1 THEN k.c END,
                                      CASE WHEN EXISTS (SELECT 1 FROM cat_columns x WHERE x.table_name = t.table_name
                                                        AND x.column_name = 'id') THEN 'id' END)
        FROM (SELECT DISTINCT table_name FROM cat_columns) t
        LEFT JOIN (SELECT table_name, count(*) n, min(column_name) c FROM cat_pk GROUP BY 1) k USING (table_name)
    """).fetchall())
    assert got == want
    ident = dict(got)
    assert ident["lineitem"] is None and ident["conversations"] is None and ident["labels"] is None
    assert ident["customer"] == "c_custkey"


def test_foreign_keys_and_inverse(cat, dcat):
    assert rows(C.foreign_keys(cat["fk"])) == sorted(
        dcat.execute("SELECT table_name, column_name, ref_table, ref_column FROM cat_fk").fetchall())
    inv = rows(C.inverse_foreign_keys(cat["fk"]).where(F.col("parent_table") == "customer")
               .select("foreign_table", "foreign_column"))
    assert inv == [("events", "user_id"), ("orders", "o_custkey")]


def test_non_key_columns(cat, dcat):
    got = rows(C.list_columns(cat["columns"], cat["pk"], cat["fk"], keys=False).select("table_name", "column_name"))
    want = sorted(dcat.execute("""SELECT table_name, column_name FROM cat_columns c WHERE NOT EXISTS
        (SELECT 1 FROM cat_fk f WHERE f.table_name = c.table_name AND f.column_name = c.column_name)""").fetchall())
    assert got == want
    assert ("customer", "c_custkey") in got  # primary key stays an attribute (Q3)


def test_table_filters(spark, cat):
    kept = [r[0] for r in C.filter_tables(cat["tables"], deny_prefixes=["_TMP"]).orderBy("pos").collect()]
    assert kept == tpch.TABLES
    allow = [r[0] for r in C.filter_tables(cat["tables"], allow_prefixes=["or", "_TMP"]).collect()]
    assert sorted(allow) == ["_TMP_orders", "orders"]


GUESSES = {
    "customer": ("customer", False),
    "order": ("?orders?", True),
    "part": ("?part?", True),
    "cust": ("?part?", True),
    "user": ("?customer/part/orders/pages?", True),
    "item": ("?part/lineitem/pages?", True),
}


def test_guess_table(spark, cat):
    rels = spark.createDataFrame([(r,) for r in GUESSES], "rel string")
    tables = tpch.TABLES  # listing order
    got = {r.rel: (r.target_table, r.unsure) for r in C.guess_table(rels, tables).collect()}
    assert got == GUESSES
    z = {r.rel: r.z for r in C.guess_table(rels, tables).collect()}
    assert abs(z["customer"] - 3.0447) < 1e-3 and abs(z["order"] - 2.4495) < 1e-3


def test_infer_mapping(spark):
    m = tpch.mapping(spark, SF001)
    c = m.table("customer")
    assert (c.classname, c.identifier, c.link_table) == ("Customer", "c_custkey", False)
    assert [a.col for a in c.attrs] == ["c_acctbal", "c_custkey", "c_mktsegment", "c_name"]
    assert [(r.col, r.property, r.target_table, r.target_class) for r in c.rels] == [
        ("c_nationkey", "c_nationkey", "nation", "Nation")]
    assert m.table("lineitem").identifier.startswith("sha1(")  # review override (M5)
    assert m.table("events").rels[0].property == "user"
    assert "_TMP_orders" not in m.tables and "orders_view" not in m.tables
    emb = {a.col: a.datatype for a in m.table("embeddings").attrs}
    assert emb["embedding"].endswith("#anyType")


def test_infer_with_hints(spark, cat):
    pk = {(t, c) for t, c in tpch.PRIMARY_KEYS}
    hints = spark.createDataFrame(
        [(t, c) for t, c, _, _ in cat["columns"].collect() if c.endswith("key") and (t, c) not in pk],
        "table_name string, column_name string")
    mc, ma, mr = infer.infer_mapping(cat["tables"], cat["columns"], cat["pk"], cat["fk"], cat["datatypes"],
                                     deny_prefixes=["_TMP"], hints=hints)
    got = {(r.tbl, r.col): (r.target_table, r.include) for r in mr.collect()}
    assert got[("customer", "c_nationkey")][1] in (True, False)
    assert all(t.startswith("?") != inc for t, inc in got.values())  # unsure guesses are excluded
    attrs = {(r.tbl, r.col) for r in ma.collect()}
    assert ("customer", "c_nationkey") not in attrs and ("customer", "c_name") in attrs


def test_apply_overrides(spark):
    frame = spark.createDataFrame(
        [("t", "a", "?orders?", False), ("t", "b", "x", False), ("t", "c", "y", True)],
        "tbl string, col string, target_table string, include boolean")
    ov = spark.createDataFrame(
        [("t", "a", "target_table", "confirm", None), ("t", "a", "include", "invert", None),
         ("t", "b", "target_table", "set", "z"), ("t", "c", "target_table", "set", "w")],
        infer.OVERRIDES_SCHEMA)
    got = rows(infer.apply_overrides(frame, ov))
    # default scope: excluded rows only, so the included row c is untouched
    assert got == [("t", "a", "orders", True), ("t", "b", "z", False), ("t", "c", "y", True)]
    got_all = rows(infer.apply_overrides(frame, ov, excluded_only=False))
    assert ("t", "c", "w", True) in got_all


def test_layer_mapping(spark):
    m = tpch.layer_mapping(spark, SF001)
    assert set(m.tables) == {"pEmbedding", "vPart", "pLabel", "pPart"}  # 'Invalid' fails the name filter
    v = m.table("vPart")
    assert v.classname == "Part" and v.identifier == "fid" and v.sub_class_of.endswith("#Feature")
    assert {a.col: a.property for a in v.attrs}["p_retailprice"] == "p-retailprice"


def test_database_pairs(spark):
    from graphloom.plans.graph_jobs import xref_rules

    doc = {"lake": [{"source": "sql:lake.orders/o_custkey", "target": "sql:store.customer/c_custkey"},
                    {"source": "sql:lake.orders/o_custkey", "target": "sql:store.customer/c_name"},
                    {"source": "broken", "target": "sql:store.customer/c_custkey"}],
           "store": [{"source": "sql:store.customer/c_custkey", "target": "gdb:.pLayer"}]}
    got = rows(C.database_pairs(xref_rules(spark, doc)))
    assert got == [("lake", "store")]


def test_sql_catalogue_equivalence(cat):
    # the column catalogue equals the Parquet schemas read by DuckDB (names and order)
    con = duckdb.connect()
    got = pd.DataFrame(cat["columns"].collect(), columns=["table_name", "column_name", "data_type", "ordinal"])
    for t in tpch.TABLES:
        want = [r[0] for r in con.execute(f"DESCRIBE SELECT * FROM '{SF001}/{t}.parquet'").fetchall()]
        assert got[got.table_name == t].sort_values("ordinal").column_name.tolist() == want


def test_table_info_two_key_join(spark):
    cols = spark.createDataFrame([("t", "a", 56, 56), ("t", "b", 167, 167), ("t", "c", 167, 300)],
                                 "table_name string, column_name string, system_type_id int, user_type_id int")
    types = spark.createDataFrame([(56, 56, "int"), (167, 167, "varchar"), (167, 300, "code_t")],
                                  "system_type_id int, user_type_id int, type_name string")
    assert rows(C.table_info(cols, types)) == [("t", "a", "int"), ("t", "b", "varchar"), ("t", "c", "code_t")]


def test_technical_columns_dropped(spark):
    cols = spark.createDataFrame([("t", "TimeStamp"), ("t", "name")], "table_name string, column_name string")
    assert rows(C.drop_technical(cols)) == [("t", "name")]


def test_concept_rule_levelled_style(spark):
    from graphloom.functions import rules as R

    df = spark.createDataFrame([("src-niv2---processfunction-parent_id--code-", "src-location-17")], "p string, s string")
    r = df.select(R.decode_concept_property(F.col("p"), F.lit("src"), F.lit("ProcessFunction"), "levelled").alias("p"),
                  R.decode_concept_subtype(F.col("s"), F.lit("src"), "levelled").alias("s")).first()
    assert r.p == "parent_id" and tuple(r.s) == ("location", "17")


def test_joins_over_raw_system_tables(spark):
    """J10 to J12 against SQL over the same tables: composite keys, alias types, equal names."""
    import duckdb

    from graphloom.session import values

    raw = {
        "tables": ("object_id int, name string", [(1, "orders"), (2, "customer"), (3, "region"), (4, "orders"), (5, "line")]),
        "columns": ("object_id int, column_id int, name string, system_type_id int, user_type_id int",
                    [(1, 1, "id", 56, 56), (1, 2, "cust", 56, 56), (1, 3, "code", 167, 300), (2, 1, "id", 56, 56), (2, 2, "region", 56, 56), (2, 3, "note", 99, 99),
                     (3, 1, "id", 56, 56), (4, 1, "id", 167, 167), (4, 2, "part", 56, 56), (5, 1, "o_id", 167, 167), (5, 2, "o_part", 56, 56), (9, 1, "gone", 56, 56)]),
        "types": ("system_type_id int, user_type_id int, name string", [(56, 56, "int"), (167, 167, "varchar"), (167, 300, "code_t")]),
        "constraints": ("object_id int, name string", [(100, "FK_orders_customer"), (101, "FK_customer_region"), (102, "FK_line_orders"), (103, "FK_self")]),
        "key_columns": ("constraint_id int, position int, parent_id int, parent_column_id int, referenced_id int, referenced_column_id int",
                        [(100, 1, 1, 2, 2, 1), (101, 1, 2, 2, 3, 1), (102, 1, 5, 1, 4, 1), (102, 2, 5, 2, 4, 2), (103, 1, 3, 1, 3, 1), (104, 1, 9, 1, 3, 1)]),
    }
    con, f = duckdb.connect(), {}
    for name, (schema, data) in raw.items():
        f[name] = values(spark, data, schema)
        con.execute(f"CREATE TABLE {name} ({schema.replace(' string', ' varchar')})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)

    def same(frame, sql):
        assert rows(frame) == sorted(con.execute(sql).fetchall())
        assert "SortMergeJoin" not in frame._jdf.queryExecution().toString()

    same(C.described_columns(f["tables"], f["columns"], f["types"]), """
        SELECT t.object_id, t.name, c.name, y.name FROM tables t, columns c, types y
        WHERE t.object_id = c.object_id AND c.system_type_id = y.system_type_id AND c.user_type_id = y.user_type_id""")
    same(C.key_links(f["tables"], f["columns"], f["key_columns"]), """
        SELECT k.constraint_id, k.position, a.name, x.name, b.name, z.name FROM key_columns k, tables a, columns x, tables b, columns z
        WHERE a.object_id = k.parent_id AND x.object_id = a.object_id AND x.column_id = k.parent_column_id
          AND b.object_id = k.referenced_id AND z.object_id = b.object_id AND z.column_id = k.referenced_column_id""")
    same(C.inverse_key_links(f["tables"], f["columns"], f["constraints"], f["key_columns"]), """
        SELECT f.name, a.name, x.name, b.name, z.name FROM constraints f, key_columns k, tables a, columns x, tables b, columns z
        WHERE f.object_id = k.constraint_id AND k.position = 1 AND a.object_id = k.parent_id AND x.object_id = a.object_id AND x.column_id = k.parent_column_id
          AND b.object_id = k.referenced_id AND z.object_id = b.object_id AND z.column_id = k.referenced_column_id""")
    export = C.foreign_keys_of(f["tables"], f["columns"], f["key_columns"])
    assert [r.pos for r in export.orderBy("pos").collect()] == list(range(1, 6))
    assert ("orders", "cust", "customer", "id") in {tuple(r)[:4] for r in export.collect()}
