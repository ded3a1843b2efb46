"""Table -> graph job (R2): roots, closure, secondary tables, one emission, header.

Plan shape
1. Roots: an area filter on the primary table (F1/F2), pushed to the scan; keys only.
2. R1 closure over key and FK columns, frontier written per round (see ``closure``).
3. Each secondary table is seeded by J2 (child rows whose FK is a visited primary key),
   together with the unfinished frontier, and closed again with the shared visited set. The
   rows' own relations are followed in that pass; a derived key is made only for its IRIs.
4. T1-T6 once per table over ``visited ⋉ table`` (one scan per table, one ``inline``),
   union, X1, then the header (T14).
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.mapping import Mapping
from graphloom.operators import closure as R
from graphloom.operators.metadata import with_metadata
from graphloom.operators.sets import set_union, spread
from graphloom.operators.triples import (
    attr_predicate,
    empty_triples,
    instance_triples,
    inverse_predicate,
    key_column,
    key_text,
    needed_columns,
)

LOG = logging.getLogger(__name__)


def closure_with_secondary(spark: SparkSession, sources: dict, mapping: Mapping, roots: DataFrame,
                           primary: str, secondary=(), max_rounds: int | None = None) -> R.ClosureResult:
    """R2: primary closure, then each secondary ``(table, fk_column)`` in the listed order."""
    res = R.closure(spark, sources, mapping, roots, max_rounds=max_rounds)
    for child, fk in secondary:
        res.reach.seed_children(child, fk, primary, max_rounds)
    return res


def repeated_keys(frames: list[tuple[DataFrame, object]]) -> set[int]:
    """Places of the frames in which a declared key is not unique: keys are counted, by
    themselves, in one job for all frames."""
    keyed = [df.select(F.lit(i).alias("frame"), key_text(df, key_column(df, tm), tm).alias("key")) for i, (df, tm) in enumerate(frames) if tm.unique_key]
    if not keyed:
        return set()
    counts = reduce(DataFrame.unionByName, keyed).where(F.col("key").isNotNull()).groupBy("frame", "key").agg(F.count(F.lit(1)).alias("n"))
    return {r.frame for r in counts.where("n > 1").select("frame").distinct().collect()}  # a row for each table at most


def instance_set(frames: list[tuple[DataFrame, object]], cfg: M.GraphConfig, check_keys: bool = True) -> DataFrame:
    """T1-T6 of several tables as one set (X1), deduplicating only where rows can coincide.

    Triples of a table whose identifier is a declared primary key are already distinct and
    cannot meet triples of another table (subjects and inverse predicates carry the class
    name), provided no other table maps to the same class; those skip the dedup shuffle.
    A declaration is checked first (``repeated_keys``): a key that repeats is reported, and
    its table is deduplicated like any other. The rows of such tables are spread first, so no
    task holds all triples of a table file.
    """
    names = [tm.classname for _, tm in frames]
    preds = [_predicates(df, tm, cfg) for df, tm in frames]
    seen: dict[str, int] = {}
    for ps in preds:
        for p in set(ps):
            seen[p] = seen.get(p, 0) + 1
    alone = [tm.unique_key and names.count(tm.classname) == 1 and len(ps) == len(set(ps)) and all(seen[p] == 1 for p in ps)
             for (_, tm), ps in zip(frames, preds, strict=True)]
    if check_keys and any(alone):
        places = [i for i, ok in enumerate(alone) if ok]
        for k in sorted(repeated_keys([frames[i] for i in places])):
            alone[places[k]] = False
            LOG.warning("declared key %s of table %s is not unique", frames[places[k]][1].identifier, frames[places[k]][1].tbl)
    parts = []
    for (df, tm), ok in zip(frames, alone, strict=True):
        if not ok and tm.identifier is not None:
            df = spread(df.select(*needed_columns(df, tm)))
        parts.append((instance_triples(df, tm, cfg), ok))
    return set_union(parts)


def _predicates(df: DataFrame, tm, cfg: M.GraphConfig) -> list[str]:
    """Predicates one row of ``tm`` can emit besides type and label. When they are pairwise
    distinct (no two columns with one property name, no two relations to one class sharing
    their inverse) and no other table emits any of them, one row's triples are distinct and
    disjoint from every other table's."""
    preds = [attr_predicate(cfg, tm.classname, a.property) for a in tm.included_attrs() if a.col in df.columns]
    for r in tm.included_rels():
        if r.col in df.columns:
            preds += [attr_predicate(cfg, tm.classname, r.property), inverse_predicate(cfg, r.target_class, tm.classname)]
    return preds


def emit_visited(spark: SparkSession, sources: dict, mapping: Mapping, cfg: M.GraphConfig,
                 res: R.ClosureResult) -> DataFrame:
    """T1-T6 once over every visited row of every table, as a set."""
    # the closure has checked that source and mapping are there
    frames = [(res.reach.rows_of(t), mapping.tables[t]) for t in res.tables()]
    if not frames:
        return empty_triples(spark)
    return instance_set(frames, cfg)


def table_graph(spark: SparkSession, sources: dict, mapping: Mapping, cfg: M.GraphConfig, roots: DataFrame,
                primary: str, secondary=(), max_rounds: int | None = None, header_ts: int | None = None,
                header_text: M.HeaderText = M.HeaderText()) -> DataFrame:
    """R2 end to end: instance triples of everything reachable, as a set, plus the header."""
    res = closure_with_secondary(spark, sources, mapping, roots, primary, secondary, max_rounds)
    if max_rounds is not None and not res.frontier.isEmpty():
        raise ValueError(f"the graph reaches further than {max_rounds} rounds")
    body = emit_visited(spark, sources, mapping, cfg, res)
    if header_ts is None:
        return body
    return with_metadata(body, cfg.data_ns, header_ts, cfg.db, text=header_text, assume_set=True)


def write_table_graph(spark: SparkSession, sources: dict, mapping: Mapping, cfg: M.GraphConfig, roots: DataFrame,
                      primary: str, path: str, ts: int, secondary=(), max_rounds: int | None = None, fmt: str = "ntriples",
                      header_text: M.HeaderText = M.HeaderText()) -> str:
    """R2 as a batch job: the instance set is written once to ``path`` (N-Triples, N-Quads
    or Parquet) and the header with its count is appended (S9 + T14)."""
    from graphloom.sources.ntriples import write_graph

    body = table_graph(spark, sources, mapping, cfg, roots, primary, secondary, max_rounds)
    return write_graph(body, path, cfg.data_ns, ts, cfg.db, fmt, text=header_text)
