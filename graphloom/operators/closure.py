"""Reference sets and the reachability closure.

A reference set is a DataFrame ``(tbl STRING, id STRING)``: keys are compared by their
lexical text (Q7). Inside the closure a key keeps its table's own type: ``(tbl, k BIGINT,
c STRING)`` has the number in ``k`` where the table's key and every foreign key to it are
whole numbers, and the text in ``c`` otherwise. Numbers are equal exactly if their texts are,
and a bare key column lets filters and run-time Bloom filters reach the scan.

The closure is level-synchronous: every round expands the whole frontier of every table at
once, one job whatever the number of tables.

Scale notes
* A round reads key and foreign-key columns only. The keys of a small frontier go into the
  scan as literals (pushed to Parquet statistics or a JDBC query); a larger one is a semi-join,
  which Spark broadcasts or shuffles by its size.
* A table that is expanded again gets its adjacency (key, foreign keys) written once, sorted
  by key, so a later round reads the row groups of its keys only.
* The visited set is a list of written runs. ``FAN`` runs of like size are merged into one, so
  the plan and the reads of a round grow with the logarithm of what was visited, not with
  the number of rounds.
* Hot targets (one customer referenced by a third of the orders) collapse in the partial
  aggregate of ``distinct`` before the shuffle; after it every key is unique.
* Every frontier is written to the shared checkpoint folder: an executor loss re-reads files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.mapping import Mapping
from graphloom.operators.triples import key_column, key_text, link_text
from graphloom.session import materialize, values

REFS_SCHEMA = "tbl string, id string"
TYPED_SCHEMA = "tbl string, k bigint, c string"

SMALL = 512  # keys of a table that go into its scan as literals; also what the driver sees of them
FAN = 8  # runs of like size that are merged


def refs(df: DataFrame, tbl: str, id_col: str | Column) -> DataFrame:
    """Reference set of one table from a key column (lexical text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    bound = df.select(c.alias("_k"))
    return bound.select(F.lit(tbl).alias("tbl"), link_text("_k", bound.schema["_k"].dataType).alias("id")).where(F.col("id").isNotNull()).distinct()


def union_refs(a: DataFrame, b: DataFrame) -> DataFrame:
    """X3."""
    return a.unionByName(b).distinct()


def minus_refs(a: DataFrame, b: DataFrame) -> DataFrame:
    """X4."""
    return a.join(b, ["tbl", "id"], "left_anti")


def semi(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """Rows whose key text is in ``ids(id)``."""
    return df.join(ids.select(F.col("id").alias("_ref_id")), key == F.col("_ref_id"), "left_semi")


def secondary_roots(child: DataFrame, child_tbl: str, child_key: Column, fk: str,
                    parent_ids: DataFrame) -> DataFrame:
    """Child rows whose foreign key is a visited parent key -> child reference set."""
    dtype = child.select(F.col(fk).alias("_k")).schema["_k"].dataType
    hit = child.join(parent_ids.select(F.col("id").alias("_pid")), link_text(fk, dtype) == F.col("_pid"), "left_semi")
    return hit.select(F.lit(child_tbl).alias("tbl"), child_key.alias("id")).where(F.col("id").isNotNull()).distinct()


def scope_roots(roots: DataFrame, code_col: Column, codes: DataFrame) -> DataFrame:
    """Keep roots whose code is in ``codes(code)``; an empty code set means no filter."""
    codes = materialize(codes.select("code").distinct(), "codes")
    if codes.isEmpty():
        return roots
    return roots.join(codes.select(F.col("code").alias("_code")), code_col == F.col("_code"), "left_semi")


def integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


class Reach:
    """The state of a closure over one set of sources: visited runs, frontier, adjacency.

    ``expand`` follows relations from new roots; ``seed_children`` starts from child rows of
    visited parents (J2). Both may be called again and share what was visited before.
    """

    def __init__(self, spark: SparkSession, sources: dict, mapping: Mapping):
        self.spark, self.sources, self.mapping = spark, sources, mapping
        self.runs: list[tuple[int, DataFrame]] = []  # (rows, typed keys); their union was visited
        self.frontier = values(spark, [], TYPED_SCHEMA)
        self.rounds = 0
        self.left_over = False  # whether the frontier may hold keys
        self.seen: set[str] = set()  # tables with visited keys
        self.alone: dict[str, DataFrame] = {}  # child tables reached by ``seed_children`` only: their rows
        self.native = {t: self._is_native(t) for t in mapping.tables}
        self.adjacency: dict[str, DataFrame | None] = {}
        self.uses: dict[str, int] = {}

    # ---- keys ---------------------------------------------------------------------------

    def _relations_to(self, tbl: str) -> list[tuple[str, str]]:
        return [(t, r.col) for t, df in self.sources.items() if t in self.mapping.tables
                for r in self.mapping.tables[t].included_rels() if r.target_table == tbl and r.col in df.columns]

    def _is_native(self, tbl: str) -> bool:
        tm, df = self.mapping.tables[tbl], self.sources.get(tbl)
        if df is None or tm.identifier not in df.columns or not integral(df.schema[tm.identifier].dataType):
            return False
        return all(integral(self.sources[t].schema[c].dataType) for t, c in self._relations_to(tbl))

    def typed(self, refs_: DataFrame) -> DataFrame:
        """(tbl, id) -> typed keys. Text that is not the plain form of a number stays text."""
        numbers = [t for t, n in self.native.items() if n]
        k = F.when(F.col("tbl").isin(numbers), F.expr("try_cast(id AS bigint)")) if numbers else F.lit(None).cast("bigint")
        k = F.when(k.cast("string") == F.col("id"), k)
        return refs_.select("tbl", k.alias("k"), F.when(k.isNull(), F.col("id")).alias("c"))

    @staticmethod
    def text(keys: DataFrame) -> DataFrame:
        return keys.select("tbl", F.coalesce(F.col("k").cast("string"), F.col("c")).alias("id"))

    def _key(self, df: DataFrame, tbl: str) -> Column:
        tm = self.mapping.tables[tbl]
        key = key_column(df, tm)
        return key.cast("bigint") if self.native[tbl] else key_text(df, key, tm)

    # ---- one step -----------------------------------------------------------------------

    def edges(self, tbl: str, df: DataFrame) -> DataFrame | None:
        """``key`` and the foreign keys ``r0, r1, ...`` of every row with a key."""
        rels = [r for r in self.mapping.tables[tbl].included_rels() if r.col in df.columns]
        if self.mapping.tables[tbl].identifier is None or not rels:
            return None
        links = [F.col(r.col).cast("bigint") if self.native.get(r.target_table) else link_text(r.col, df.schema[r.col].dataType) for r in rels]
        keyed = df.select(self._key(df, tbl).alias("key"), *[c.alias(f"r{i}") for i, c in enumerate(links)])
        return keyed.where(F.col("key").isNotNull())

    def targets(self, tbl: str, edges: DataFrame) -> DataFrame:
        """Typed keys that the rows of ``edges`` point to."""
        rels = [r for r in self.mapping.tables[tbl].included_rels() if r.col in self.sources[tbl].columns]
        none = {"k": F.lit(None).cast("bigint"), "c": F.lit(None).cast("string")}
        each = [F.struct(F.lit(r.target_table).alias("tbl"), *[(F.col(f"r{i}") if (n == "k") == bool(self.native.get(r.target_table)) else x).alias(n) for n, x in none.items()])
                for i, r in enumerate(rels)]
        return edges.select(F.inline(F.array(*each))).where(F.col("k").isNotNull() | F.col("c").isNotNull())

    def _adjacent(self, tbl: str) -> DataFrame | None:
        """The table's edges: from the table at first, from a sorted copy when it is met again."""
        if tbl not in self.adjacency:
            self.adjacency[tbl] = self.edges(tbl, self.sources[tbl])
        self.uses[tbl] = self.uses.get(tbl, 0) + 1
        if self.uses[tbl] == 2 and self.adjacency[tbl] is not None:
            by_key = self.adjacency[tbl].repartitionByRange("key").sortWithinPartitions("key")
            self.adjacency[tbl] = materialize(by_key, f"edges-{tbl}")
        return self.adjacency[tbl]

    def _step(self, tbl: str, keys: list | None) -> DataFrame | None:
        """Targets of the frontier's keys of one table; ``keys`` holds them if they are few."""
        edges = self._adjacent(tbl)
        if edges is None:
            return None
        name = "k" if self.native[tbl] else "c"
        if keys is not None:
            hit = edges.where(F.col("key").isin(keys))
        else:
            ids = self.frontier.where((F.col("tbl") == tbl) & F.col(name).isNotNull()).select(F.col(name).alias("_key"))
            hit = edges.join(ids, F.col("key") == F.col("_key"), "left_semi")
        return self.targets(tbl, hit)

    def _present(self) -> tuple[int, dict[str, list | None]]:
        """Size of the frontier, and its tables with their keys where these are few."""
        some = self.frontier.limit(SMALL + 1).collect()
        if len(some) <= SMALL:
            found: dict[str, list | None] = {}
            for r in some:
                found.setdefault(r.tbl, []).append(r.k if self.native.get(r.tbl) else r.c)
            return len(some), {t: [k for k in ks if k is not None] for t, ks in sorted(found.items())}
        counts = {r.tbl: r.n for r in self.frontier.groupBy("tbl").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each table
        return sum(counts.values()), dict.fromkeys(sorted(counts))

    # ---- the visited set ------------------------------------------------------------------

    def _add_run(self, n: int, keys: DataFrame) -> None:
        tier = lambda rows: max(rows, 1).bit_length() // FAN.bit_length()
        self.runs.append((n, keys))
        while len(like := [r for r in self.runs if tier(r[0]) == tier(self.runs[-1][0])]) >= FAN:
            merged = materialize(reduce(DataFrame.unionByName, [k for _, k in like]), "visited")
            self.runs = [r for r in self.runs if all(r is not x for x in like)] + [(sum(r for r, _ in like), merged)]

    def _new(self, keys: DataFrame, tables=None) -> DataFrame:
        """Keys that were not visited; with ``tables``, those are all that can occur."""
        out = keys.distinct()
        if not self.runs:
            return out
        seen = reduce(DataFrame.unionByName, [k for _, k in self.runs])
        if tables is not None:
            seen = seen.where(F.col("tbl").isin(sorted(tables)))
        seen = seen.select(F.col("tbl").alias("_t"), F.col("k").alias("_k"), F.col("c").alias("_c"))
        same = (F.col("tbl") == F.col("_t")) & F.col("k").eqNullSafe(F.col("_k")) & F.col("c").eqNullSafe(F.col("_c"))
        return out.join(seen, same, "left_anti")

    def visited_keys(self, tbl: str | None = None) -> DataFrame:
        """Typed keys visited so far (of one table)."""
        parts = [k for _, k in self.runs]
        if tbl is not None:
            parts = [k.where(F.col("tbl") == tbl) for k in parts]
        for t, rows in self.alone.items():
            if tbl in (None, t):
                key = self._key(rows, t)
                pair = [key.alias("k"), F.lit(None).cast("string").alias("c")] if self.native[t] else [F.lit(None).cast("bigint").alias("k"), key.alias("c")]
                own = rows.select(F.lit(t).alias("tbl"), *pair)
                parts.append(own.where(F.col("k").isNotNull() | F.col("c").isNotNull()).distinct())
        return reduce(DataFrame.unionByName, parts) if parts else values(self.spark, [], TYPED_SCHEMA)

    def rows_of(self, tbl: str) -> DataFrame:
        """``visited semi-join table``."""
        if tbl in self.alone:
            return self.alone[tbl]
        df, name = self.sources[tbl], "k" if self.native[tbl] else "c"
        ids = self.visited_keys(tbl).where(F.col(name).isNotNull()).select(F.col(name).alias("_key"))
        return df.join(ids, self._key(df, tbl) == F.col("_key"), "left_semi")

    # ---- rounds -----------------------------------------------------------------------------

    def expand(self, roots: DataFrame | None, max_rounds: int | None = None, found: DataFrame | None = None) -> None:
        """Follow relations from typed ``roots`` and the frontier left over until nothing is new,
        or for ``max_rounds``. ``found`` are targets of rows that count as expanded in round one."""
        if roots is not None:
            self.frontier = materialize(self._new(roots.unionByName(self.frontier)), "frontier")
        rounds, known_empty = 0, roots is None and not self.left_over
        self.left_over = False
        while max_rounds is None or rounds < max_rounds:
            n, present = (0, {}) if known_empty else self._present()
            known_empty = False
            if not present and found is None:
                break
            unknown = [t for t in present if t not in self.sources or t not in self.mapping.tables]
            if unknown:
                raise ValueError(f"keys of tables without a source or mapping were reached: {', '.join(unknown)}")
            rounds += 1
            self.seen.update(present)
            if n:
                self._add_run(n, self.frontier)
            steps = [x for x in (self._step(t, keys) for t, keys in present.items()) if x is not None] + ([found] if found is not None else [])
            found = None
            if not steps:
                self.frontier = values(self.spark, [], TYPED_SCHEMA)
                break
            reached = {r.target_table for t in [*present, *self.alone] for r in self.mapping.tables[t].included_rels()}
            self.frontier = materialize(self._new(reduce(DataFrame.unionByName, steps), reached), "frontier")
        else:
            self.left_over = True  # a bound ended it
        self.rounds += rounds

    def seed_children(self, child: str, fk: str, parent: str, max_rounds: int | None = None) -> None:
        """J2 and its closure: child rows whose foreign key is a visited key of ``parent``.

        Where a child's key fixes its row, and nothing else can reach the child, the rows found
        by the foreign key are all there is: their relations are followed in the same pass, and
        their keys are made only when they are asked for.
        """
        df, tm = self.sources[child], self.mapping.tables[child]
        parents = self.visited_keys(parent)
        if self.native.get(parent) and integral(df.schema[fk].dataType):
            ids, link = parents.where(F.col("k").isNotNull()).select(F.col("k").alias("_parent")), F.col(fk).cast("bigint")
        else:
            ids, link = self.text(parents).select(F.col("id").alias("_parent")), link_text(fk, df.schema[fk].dataType)
        rows = df.join(ids, link == F.col("_parent"), "left_semi")
        if (tm.unique_key or tm.row_key) and tm.identifier is not None and not self._relations_to(child) and child not in self.seen:
            self.seen.add(child)
            edges = self.edges(child, rows)
            self.alone[child] = rows
            self.expand(None, max_rounds, None if edges is None else self.targets(child, edges))
            return
        if child in self.alone:  # reached by a second foreign key: its keys count from now on
            keys = materialize(self.visited_keys(child), "visited")
            del self.alone[child]
            self._add_run(keys.count(), keys)
        name = "k" if self.native[child] else "c"
        key = self._key(rows, child)
        seeds = rows.select(F.lit(child).alias("tbl"), *[(key if n == name else F.lit(None).cast(t)).alias(n) for n, t in (("k", "bigint"), ("c", "string"))])
        self.expand(seeds.where(F.col(name).isNotNull()), max_rounds)


@dataclass
class ClosureResult:
    reach: Reach

    @property
    def visited(self) -> DataFrame:
        """(tbl, id) of keys expanded (emitted)."""
        return Reach.text(self.reach.visited_keys())

    @property
    def frontier(self) -> DataFrame:
        """(tbl, id) discovered but not expanded within the caller's round bound."""
        return Reach.text(self.reach.frontier)

    @property
    def rounds(self) -> int:
        return self.reach.rounds

    def tables(self) -> list[str]:
        return sorted(self.reach.seen)


def closure(spark: SparkSession, sources: dict, mapping: Mapping, roots: DataFrame, max_rounds: int | None = None) -> ClosureResult:
    """Follow included relations forward from ``roots`` until nothing is new.

    Only a caller's ``max_rounds`` ends it earlier; what was found but not expanded then is
    the result's ``frontier``. A visited key of a table that has no source or no mapping
    fails the job.

    ``sources`` maps table name -> DataFrame. Round k expands the frontier (keys first seen in
    round k-1): rows of each frontier table yield their relation targets; targets not yet
    visited form the next frontier. Keys without a matching row are still visited, so the loop
    ends. Per round the driver sees the frontier's table names, and its keys if they are few.
    """
    reach = Reach(spark, sources, mapping)
    reach.expand(reach.typed(roots.select("tbl", "id")), max_rounds)
    return ClosureResult(reach)
