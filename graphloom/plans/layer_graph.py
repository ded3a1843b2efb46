"""Layer -> graph job (R3): every included layer -> T7 + T8 in one pass each -> X1 -> header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from graphloom import model as M
from graphloom.mapping import Mapping
from graphloom.operators.features import feature_triples
from graphloom.operators.filters import Area
from graphloom.operators.metadata import with_metadata
from graphloom.operators.sets import as_set
from graphloom.operators.triples import empty_triples


def layer_graph(spark: SparkSession, layers: dict, mapping: Mapping, cfg: M.GraphConfig, area: Area = Area(),
                ts: int | None = None, features: bool = True, geometry: bool = True) -> DataFrame:
    """Union of per-layer projections over the included layers (F10), as a set."""
    parts = [
        feature_triples(layers[name], name, mapping.tables[name], cfg, area, features, geometry)
        for name in mapping.classes()
        if name in layers
    ]
    body = reduce(DataFrame.unionByName, parts) if parts else empty_triples(spark)
    if ts is None:
        return as_set(body)
    return with_metadata(body, cfg.data_ns, ts, cfg.db)
