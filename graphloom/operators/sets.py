"""Set operations on graphs (X1, X2 core, X5) and the triple count (A1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom import model as M


def as_set(df: DataFrame) -> DataFrame:
    """Each triple once (nulls compare equal). Triples are dealt out before they are
    compared, so a task holds a shuffle partition of them, and not all that a table file gives:
    most triples occur once, and aggregating them before the shuffle would hold them for
    nothing. Where a few triples come from very many rows, see ``collapsed``. Subject and object
    deal them out: a column that is one value in all rows is no key of the comparison, and Spark
    would shuffle once more for it."""
    return df.select(*M.TRIPLE_COLUMNS).repartition("s", "o").dropDuplicates(M.TRIPLE_COLUMNS)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to as many tasks as the session has shuffle partitions, by all their plain
    columns, so that the rows of a hot key are dealt out as well."""
    columns = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def collapsed(df: DataFrame) -> DataFrame:
    """``as_set`` of triples that many rows may repeat (a hot key): they are aggregated before
    the shuffle, too. The rows they are made of should be ``spread``."""
    return df.select(*M.TRIPLE_COLUMNS).dropDuplicates(M.TRIPLE_COLUMNS)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [d.select(*M.TRIPLE_COLUMNS) for d in dfs])


def merge(dfs: list[DataFrame]) -> DataFrame:
    """X2 (data part): set union of graphs."""
    return as_set(union_all(dfs))


def delete(df: DataFrame, s: str | None = None, p=None, o: str | None = None) -> DataFrame:
    """Remove triples matching a pattern; ``None`` is a wildcard; ``p`` may be a list."""
    cond: Column = F.lit(True)
    if s is not None:
        cond = cond & (F.col("s") == s)
    if p is not None:
        cond = cond & (F.col("p").isin(list(p)) if isinstance(p, (list, tuple, set)) else F.col("p") == p)
    if o is not None:
        cond = cond & (F.col("o") == o)
    return df.where(~cond)


def count_triples(df: DataFrame) -> DataFrame:
    """A1: one row ``n``: the number of triples plus one (the count triple counts itself)."""
    return df.agg((F.count(F.lit(1)) + F.lit(1)).alias("n"))


def set_union(parts: list[tuple[DataFrame, bool]]) -> DataFrame:
    """Set union of triple frames, deduplicating only where duplicates can exist.

    Each part is ``(frame, is_set)``. Frames flagged ``is_set`` must already be sets and be
    disjoint from every other part (e.g. instances of a table keyed by a declared primary
    key, whose class name no other part uses): they pass through without a shuffle. The
    remaining frames are deduplicated together (X1); keys may be hot in them.
    """
    clean = [d.select(*M.TRIPLE_COLUMNS) for d, ok in parts if ok]
    rest = [d for d, ok in parts if not ok]
    if rest:
        clean.append(collapsed(union_all(rest)))
    return union_all(clean)


def stage(df: DataFrame, name: str = "graph") -> DataFrame:
    """Store a graph once (Parquet in the checkpoint folder), so that repeated pattern scans do
    not recompute it. Triples are written as they come: a sort by predicate would hold all
    triples of a task, and a table file of a few MB gives one task a gigabyte of them. A job
    that knows which terms it can meet stages ``named`` triples only."""
    from graphloom.session import materialize

    return materialize(df.select(*M.TRIPLE_COLUMNS), name)


def named(graph: DataFrame, classes: set[str], predicates: set[str]) -> DataFrame:
    """The triples that patterns over these classes and predicates can meet, whatever the
    graph's namespace (it is not known before the graph is read): names are compared by what
    follows the last ``/``. The types that tell what a graph is (O2) are among them."""
    tail = lambda c: F.substring_index(c, "/", -1)
    tails = lambda names: sorted({n.rsplit("/", 1)[-1] for n in names})
    typed = F.col("o").isin(M.OWL_ONTOLOGY, M.VOID_DATASET) | tail(F.col("o")).isin(tails(classes))
    return graph.where(((F.col("p") == M.RDF_TYPE) & typed) | tail(F.col("p")).isin(tails(predicates)))
