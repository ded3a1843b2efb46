"""Mapping model: which tables become classes, which columns attributes or relations.

The mapping is catalogue-sized metadata (one row per table or column, never per data row).
It lives as three DataFrames (``map_class``, ``map_attr``, ``map_rel``, schemas below) for
the set-based inference jobs, and as small Python objects for building select lists: a
plan needs column names at construction time, exactly like a schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from graphloom.session import values

MAP_CLASS_SCHEMA = (
    "tbl string, classname string, identifier string, sub_class_of string, link_table boolean, include boolean, "
    "unique_key boolean"
)
MAP_ATTR_SCHEMA = "tbl string, col string, property string, datatype string, sub_property_of string, include boolean"
MAP_REL_SCHEMA = (
    "tbl string, col string, property string, target_table string, target_class string, "
    "sub_property_of string, include boolean"
)


@dataclass(frozen=True)
class Attr:
    col: str
    property: str
    datatype: str
    sub_property_of: str | None = None
    include: bool = True


@dataclass(frozen=True)
class Rel:
    col: str
    property: str
    target_table: str
    target_class: str
    sub_property_of: str | None = None
    include: bool = True


@dataclass(frozen=True)
class TableMap:
    tbl: str
    classname: str
    identifier: str | None
    sub_class_of: str | None = None
    link_table: bool = False
    include: bool = True
    attrs: tuple[Attr, ...] = ()
    rels: tuple[Rel, ...] = ()
    unique_key: bool = False  # identifier is a declared single-column primary key
    row_key: bool = False  # rows with equal keys are equal (a key over all columns); they may repeat

    def included_attrs(self) -> list[Attr]:
        """attributes with ``include``."""
        return [a for a in self.attrs if a.include]

    def included_rels(self) -> list[Rel]:
        """relations with ``include``."""
        return [r for r in self.rels if r.include]


@dataclass(frozen=True)
class Mapping:
    db: str
    tables: dict = field(default_factory=dict)  # tbl -> TableMap, insertion-ordered

    def classes(self, link_table: bool = False, include_excluded: bool = False) -> list[str]:
        """included classes; link tables left out unless asked for."""
        return [
            t
            for t, m in self.tables.items()
            if (include_excluded or m.include) and (link_table or not m.link_table)
        ]

    def table(self, tbl: str) -> TableMap:
        return self.tables[tbl]

    def with_table(self, tm: TableMap) -> "Mapping":
        tables = dict(self.tables)
        tables[tm.tbl] = tm
        return replace(self, tables=tables)

    # ---- DataFrame form -------------------------------------------------------------

    def to_frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        cls = [
            (m.tbl, m.classname, m.identifier, m.sub_class_of, m.link_table, m.include, m.unique_key)
            for m in self.tables.values()
        ]
        att = [
            (m.tbl, a.col, a.property, a.datatype, a.sub_property_of, a.include)
            for m in self.tables.values()
            for a in m.attrs
        ]
        rel = [
            (m.tbl, r.col, r.property, r.target_table, r.target_class, r.sub_property_of, r.include)
            for m in self.tables.values()
            for r in m.rels
        ]
        return (
            values(spark, cls, MAP_CLASS_SCHEMA),
            values(spark, att, MAP_ATTR_SCHEMA),
            values(spark, rel, MAP_REL_SCHEMA),
        )

    @staticmethod
    def from_frames(db: str, map_class: DataFrame, map_attr: DataFrame, map_rel: DataFrame) -> "Mapping":
        """Collect catalogue-sized mapping tables into plan metadata (ordered by table, column).

        The three tables come back in one job (a union of JSON rows), not three."""
        import json

        from pyspark.sql import functions as F

        def tagged(tag, df, cols):
            return df.select(F.lit(tag).alias("kind"), F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
                             .alias("row"))

        cls_cols = [c for c in MAP_CLASS_SCHEMA.replace(",", " ").split()[::2] if c in map_class.columns]
        rows = (tagged("c", map_class, cls_cols)
                .unionByName(tagged("a", map_attr, ["tbl", "col", "property", "datatype", "sub_property_of",
                                                    "include"]))
                .unionByName(tagged("r", map_rel, ["tbl", "col", "property", "target_table", "target_class",
                                                   "sub_property_of", "include"]))
                .collect())
        got = {"c": [], "a": [], "r": []}
        for r in rows:
            got[r.kind].append(json.loads(r.row))
        attrs: dict[str, list[Attr]] = {}
        for r in sorted(got["a"], key=lambda x: (x["tbl"], x["col"])):
            attrs.setdefault(r["tbl"], []).append(
                Attr(r["col"], r["property"], r["datatype"], r["sub_property_of"], bool(r["include"])))
        rels: dict[str, list[Rel]] = {}
        for r in sorted(got["r"], key=lambda x: (x["tbl"], x["col"])):
            rels.setdefault(r["tbl"], []).append(
                Rel(r["col"], r["property"], r["target_table"], r["target_class"], r["sub_property_of"],
                    bool(r["include"])))
        tables = {}
        for r in sorted(got["c"], key=lambda x: x["tbl"]):
            tables[r["tbl"]] = TableMap(
                r["tbl"], r["classname"], r["identifier"], r["sub_class_of"], bool(r["link_table"]),
                bool(r["include"]), tuple(attrs.get(r["tbl"], [])), tuple(rels.get(r["tbl"], [])),
                bool(r.get("unique_key") or False),
            )
        return Mapping(db, tables)
