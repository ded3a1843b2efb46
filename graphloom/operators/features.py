"""Feature layers -> triples.

A layer is a DataFrame with ``fid BIGINT``, ``wkt STRING`` (geometry as WKT text, null when
absent) and one column per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.functions.geometry import geometry_type, sf_class
from graphloom.functions.hashing import node_hash
from graphloom.functions.lexical import lexical
from graphloom.mapping import TableMap
from graphloom.operators.filters import Area, not_sentinel, within
from graphloom.operators.triples import emit, iri_triple, label_of, type_of, typed_triple
from graphloom.session import values


def scan_layer(df: DataFrame, fid: str | Column, wkt: Column | None, fields: list[str]) -> DataFrame:
    """A table as a layer: ``fid``, ``wkt`` and the named fields (projection pushed down)."""
    fid_c = F.col(fid) if isinstance(fid, str) else fid
    wkt_c = wkt if wkt is not None else F.lit(None).cast("string")
    return df.select(fid_c.cast("bigint").alias("fid"), wkt_c.alias("wkt"), *fields)


def melt_fields(df: DataFrame, fields: list[str], id_col: str = "fid") -> DataFrame:
    """S3: one row per non-null field: (id, field, value as lexical text, datatype name)."""
    structs = [
        F.struct(F.lit(f).alias("field"), lexical(F.col(f), df.schema[f].dataType).alias("value"),
                 F.lit(df.schema[f].dataType.simpleString()).alias("datatype"))
        for f in fields
    ]
    return df.select(F.col(id_col), F.inline(F.array(*structs))).where(F.col("value").isNotNull())


def in_scope(layer: DataFrame, area: Area) -> DataFrame:
    """F8 (fid > 0), F9 (geometry present), F3 (point or centroid inside the area)."""
    return within(layer.where((F.col("fid") > 0) & F.col("wkt").isNotNull()), "wkt", area)


def _feature_iri(cfg: M.GraphConfig, layer_name: str, tm: TableMap) -> Column:
    return F.concat(F.lit(cfg.data_ns), node_hash(F.col("fid").cast("string"), F.lit(layer_name + tm.classname)))


def _geometry_iri(cfg: M.GraphConfig) -> Column:
    return F.concat(F.lit(cfg.data_ns), node_hash(F.col("_gtype"), F.col("wkt")))


def _bind_iris(df: DataFrame, layer_name: str, tm: TableMap, cfg: M.GraphConfig) -> DataFrame:
    """Feature and geometry IRIs as columns, hashed once per row before the generator."""
    return df.withColumn("_fs", _feature_iri(cfg, layer_name, tm)).withColumn("_gs", _geometry_iri(cfg))


def typed_layer(layer: DataFrame, area: Area) -> DataFrame:
    """In-scope features with their geometry type; unknown types are left out (Q13, see
    ``rejected``)."""
    return in_scope(layer, area).withColumn("_gtype", geometry_type(F.col("wkt"))).where(
        sf_class(F.col("_gtype")).isNotNull()
    )


def rejected(layer: DataFrame) -> DataFrame:
    """Features (fid > 0, with geometry) whose geometry type has no Simple Features class:
    they cannot be placed in an area nor typed, so they are reported instead of emitted."""
    return layer.where((F.col("fid") > 0) & F.col("wkt").isNotNull() & sf_class(geometry_type(F.col("wkt"))).isNull())


def feature_structs(layer: DataFrame, layer_name: str, tm: TableMap, cfg: M.GraphConfig) -> list[Column]:
    """Type, label ``Class fid (GTYPE)``, one typed literal per non-null, non-sentinel
    included field (F6)."""
    s = F.col("_fs")
    structs = [
        type_of(s, cfg.schema_ns + tm.classname),
        label_of(s, F.concat(F.lit(tm.classname + " "), F.col("fid").cast("string"), F.lit(" ("), F.col("_gtype"),
                             F.lit(")")), cfg.label_lang),
    ]
    for a in tm.included_attrs():
        if a.col not in layer.columns:
            continue
        dtype = layer.schema[a.col].dataType
        c = F.col(a.col)
        lex = F.when(not_sentinel(c, dtype), lexical(c, dtype))
        pred = f"{cfg.schema_ns}{tm.classname.lower()}_{a.property.lower()}"
        structs.append(typed_triple(s, pred, lex, a.datatype))
    return structs


def geometry_structs(layer_name: str, tm: TableMap, cfg: M.GraphConfig) -> list[Column]:
    """Geometry node (shared by equal geometries): type, label, hasGeometry, asWKT."""
    s, g = F.col("_fs"), F.col("_gs")
    sfc = sf_class(F.col("_gtype"))
    return [
        type_of(g, F.concat(F.lit(M.SF), sfc)),
        label_of(g, F.concat(sfc, F.lit(" Geometry")), cfg.label_lang),
        iri_triple(s, M.GEO_HASGEOMETRY, g),
        typed_triple(g, M.GEO_ASWKT, F.col("wkt"), M.GEO_WKTLITERAL),
    ]


def feature_triples(layer: DataFrame, layer_name: str, tm: TableMap, cfg: M.GraphConfig, area: Area,
                    features: bool = True, geometry: bool = True) -> DataFrame:
    """T7 + T8 of one layer in one pass (one scan, one ``inline``)."""
    if tm.identifier is None:
        return values(layer.sparkSession, [], M.TRIPLE_SCHEMA)
    df = _bind_iris(typed_layer(layer, area), layer_name, tm, cfg)
    structs = (feature_structs(df, layer_name, tm, cfg) if features else []) + (
        geometry_structs(layer_name, tm, cfg) if geometry else [])
    return emit(df, structs)
