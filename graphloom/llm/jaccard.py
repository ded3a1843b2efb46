"""N-gram Jaccard join with count-vector R-trees.

A set's n-grams are hashed into groups; the counts of the groups are a point. Two sets share
at most the sum of the coordinate minima of their points, and two nodes of a tree at most the
sum of the minima of their upper corners. A tree is joined with itself from the root down:
pairs of nodes, then of points, whose bound is below what the threshold asks of their sizes
are dropped, and the pairs that survive are verified on their full sets.

Where the trees stand: points of unrelated texts overlap in every coordinate, so a tree over
all texts would open nearly all pairs of its nodes. Texts are therefore first dealt to
blocks, without losing a link: n-grams are ordered by the count of a second, finer grouping
(rare ones first); a set of n gives its first n - ceil(t n) + 1 n-grams as keys, and two linked
sets always share one of those. All blocks with the same least class make up one group, and
each group gets its own tree:

1.  One pass gives each row its class (128-bit hash of the set) and sums the fine groups.
2.  A second pass gives keys and points; blocks with several classes name their members' group.
3.  Points have about a sixteenth as many coordinates as their set has n-grams: with fewer, points
    of unrelated long texts are too alike to be told apart. The points of a group are joined by their tree; what the surviving pairs connect becomes a
    group of its own, the other members go. (Groups of over ``POINTS`` members skip this.)
4.  Each class first meets one of its groups. Groups are cut by hash into tiles of about ``TILE``
    sets, each with one common member; every tile is joined by its tree with its full sets. Only
    links between parts not yet connected are verified and returned, so a tile returns fewer
    links than it has members.
5.  Components of these links end most groups. Where a group still holds several components, all
    pairs of its tiles are joined, between components only.

No pair is ever returned that is not needed, no group is held by one task beyond two tiles,
and no link between different texts is lost.

Defined cases: null, empty and wordless texts have an empty set and are linked with nothing;
fewer words than an n-gram count as one n-gram; equal sets are one class whatever the ids; a
null id never names a component while another id is in reach; rows that repeat are rows of
their own; an empty table gives no rows; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import stage
from graphloom.llm.components import components
from graphloom.llm.near import _class_of as class_of
from graphloom.llm.near import shingle_set

LEAST_BITS, MOST_BITS = 6, 12  # a point has 64 to 4,096 coordinates, about a sixteenth of its set's size
FINE = 1 << 16  # groups whose sums order the n-grams; the driver holds one number for each
FANOUT = 16
TILE = 512  # sets of a tile
POINTS = 4096  # members of a group whose points are joined before any sets are fetched
_AT_ONCE = 1 << 15  # pairs whose bounds are computed at once


def bits_of(size: int) -> int:
    """The resolution of a set's point. Sets that can be linked differ by one step at most."""
    return min(max((size - 1) // 16, 0).bit_length(), MOST_BITS) if size > 16 << LEAST_BITS else LEAST_BITS


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts of the groups of a set's n-gram hashes; a group is named by the upper bits."""
    bits = bits_of(len(shingles))
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.int32)


def folded(point_: np.ndarray, bits: int) -> np.ndarray:
    """A point with fewer coordinates: neighbouring groups are added."""
    return point_.reshape(1 << bits, -1).sum(axis=1, dtype=np.int32)


def candidate_pairs(points: list[np.ndarray], sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that no bound drops: a tree for each resolution joins the points of that
    resolution with each other and with the folded points of the next one."""
    bits = np.array([len(p).bit_length() - 1 for p in points])
    for level in sorted(set(bits.tolist())):
        at = np.flatnonzero((bits == level) | (bits == level + 1))
        if len(at) < 2:
            continue
        finer = bits[at] > level
        for a, b in CountTree(np.array([folded(points[i], level) for i in at]), sizes[at]).pairs(percent):
            own = ~(finer[a] & finer[b])
            if own.any():
                yield at[a[own]], at[b[own]]


class CountTree:
    """An R-tree over points: level 0 holds the points in tree order, each level above the
    upper corners and least sizes of ``FANOUT`` neighbours."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        slab = FANOUT * FANOUT
        by_size = np.argsort(sizes, kind="stable")
        wide = points.var(axis=0).argmax()
        self.order = np.concatenate([s[np.argsort(points[s, wide], kind="stable")] for s in np.split(by_size, range(slab, len(sizes), slab))])
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            corner, least = self.levels[-1]
            starts = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts)))

    def _fit(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of a level may hold linked sets: overlap <= sum of the minima."""
        corner, least = self.levels[level]
        out, step = np.empty(len(a), bool), max(1, (_AT_ONCE << LEAST_BITS) // corner.shape[1])
        for i in range(0, len(a), step):
            x, y = a[i:i + step], b[i:i + step]
            most = np.minimum(corner[x], corner[y]).sum(axis=1, dtype=np.int64)
            out[i:i + step] = (100 + percent) * most >= percent * (least[x] + least[y])
        return out

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places in the given order (first < second in tree order) that no bound drops."""
        a, b = np.triu_indices(len(self.levels[-1][1]))
        yield from self._below(len(self.levels) - 1, a, b, percent)

    def _below(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if level == 0:
            apart = a < b
            a, b = a[apart], b[apart]
        fit = self._fit(level, a, b, percent)
        a, b = a[fit], b[fit]
        if level == 0:
            if len(a):
                yield self.order[a], self.order[b]
            return
        count = len(self.levels[level - 1][1])
        step = max(1, _AT_ONCE // (FANOUT * FANOUT))
        one, two = (x.ravel() for x in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
        for i in range(0, len(a), step):
            x = (a[i:i + step, None] * FANOUT + one).ravel()
            y = (b[i:i + step, None] * FANOUT + two).ravel()
            keep = (x < count) & (y < count) & (x <= y)
            yield from self._below(level - 1, x[keep], y[keep], percent)


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def forest(sets: list[np.ndarray], percent: int, parts: list[int] | None = None, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (places) that connect what linked sets connect, as few as that takes. ``parts``
    are connected from the start; with ``sides``, only pairs of different sides are compared."""
    sizes = np.array([len(s) for s in sets], np.int64)
    first: dict[int, int] = {}
    parent = [first.setdefault(p, i) for i, p in enumerate(parts)] if parts else list(range(len(sets)))
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(ids, np.cumsum(sizes)[:-1])
    marked, marks = -1, np.zeros(len(words), bool)
    out = []
    for left, right in candidate_pairs([point(s) for s in sets], sizes, percent):
        for labels in (parts, sides):
            if labels:
                of = np.array(labels)
                apart = of[left] != of[right]
                left, right = left[apart], right[apart]
        order = np.argsort(left, kind="stable")
        for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
            a, b = _root(parent, i), _root(parent, j)
            if a == b:
                continue
            if marked != i:
                marks[own[marked]] = False
                marks[own[i]] = True
                marked = i
            both = int(np.count_nonzero(marks[own[j]]))
            if 100 * both >= percent * (len(own[i]) + len(own[j]) - both):
                parent[a] = b
                out.append((i, j))
    return out


_FACTS = "doc_id long, text_hash long, n long, hi long, lo long, sums binary"


def _facts(k: int):
    """Size and class of each row's set; a last row (n = -1) has the sums of the fine groups."""
    names, kinds = [c.split()[0] for c in _FACTS.split(", ")], [pa.int64()] * 5 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(FINE, np.int64)
        for batch in batches:
            n, hi, lo = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k)
                a, b = class_of(s) if len(s) else (None, None)
                n.append(len(s))
                hi.append(b)
                lo.append(a)
                np.add.at(sums, (s >> np.uint64(48)).astype(np.int64), 1)
            made = [pa.array(x, pa.int64()) for x in (n, hi, lo)] + [pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *made], names=names)
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, None, -1, None, None, sums.tobytes()), kinds, strict=True)], names=names)
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(FINE, np.int64)
    for batch in batches:
        for x in batch.column("sums"):
            sums += np.frombuffer(x.as_py(), np.int64)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["fine", "n"])


def rarity(facts: DataFrame) -> np.ndarray:
    """The sum of each fine group over all rows."""
    out = np.zeros(FINE, np.int64)
    for r in facts.where("n = -1").select("sums").mapInArrow(_summed, "fine long, n long").groupBy("fine").agg(F.sum("n").alias("n")).collect():  # FINE rows at most
        out[r["fine"]] = r["n"]
    return out


def keys_of(shingles: np.ndarray, sums: np.ndarray, percent: int) -> np.ndarray:
    """The rarest n-grams of a set, one more than it may miss of a set it is linked with."""
    n = len(shingles)
    count = n - -(-percent * n // 100) + 1
    return shingles[np.lexsort((shingles, sums[(shingles >> np.uint64(48)).astype(np.int64)]))[:count]]


def packed(counts: np.ndarray) -> bytes:
    """Counts as bytes, with the width of one count before them."""
    kind = np.uint8 if counts.max(initial=0) < 1 << 8 else np.int32
    return bytes([kind().itemsize]) + counts.astype(kind).tobytes()


def unpacked(point_: bytes) -> np.ndarray:
    return np.frombuffer(point_, np.uint8 if point_[0] == 1 else np.int32, offset=1).astype(np.int32)


_KEYED = "hi long, lo long, n long, keys array<long>, point binary"


def _keys(k: int, sums: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # a task's own copies give keys once
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            out = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k)
                if not len(s) or (of := class_of(s)) in seen:
                    continue
                seen.add(of)
                out.append((of[1], of[0], len(s), keys_of(s, sums, percent).astype(np.int64), packed(point(s))))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in _KEYED.split(", ")])
    return run


def classes_of(facts: DataFrame) -> DataFrame:
    """node, hi, lo, n, doc_id (the smallest) of every class, and one of its rows (text_hash, of)."""
    rows = facts.where("n > 0")
    one = rows.groupBy("hi", "lo").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"))
    return stage(one.withColumn("node", F.monotonically_increasing_id()), "classes")


def groups_of(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """(pivot, node): the members of every group, a group for each least class of a block."""
    members = keyed.select("lo", F.explode("keys").alias("key"))
    blocks = members.groupBy("key").agg(F.min("lo").alias("pivot"), F.max("lo").alias("last")).where("pivot < last").select(F.col("key").alias("of"), "pivot")
    named = members.join(blocks, F.col("key") == F.col("of")).select("pivot", "lo").distinct()
    twice = classes.groupBy("lo").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("lo").alias("pivot"), "lo")  # classes that share half a hash
    return stage(named.unionByName(twice).join(classes.select("lo", "node"), "lo").select("pivot", "node"), "groups")


def _runs(batches: Iterator[pa.RecordBatch], by: list[str], columns: list[str]) -> Iterator[list[tuple] | None]:
    """The rows of each run that agrees in ``by``; None at the end of each batch."""
    key, held = None, []
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in by), strict=True)
        for now, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if now != key:
                yield held
                key, held = now, []
            held.append(row)
        yield None
    yield held


def _parted(percent: int):
    """Joins the points of each group by their tree and returns what the pairs left connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for held in _runs(batches, ["pivot"], ["node", "n", "point"]):
            if held is None:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["pivot", "node"])
                out = []
                continue
            rows = {x[0]: x for x in held}
            nodes = sorted(rows)
            if len(nodes) < 2:
                continue
            points, sizes = [unpacked(rows[x][2]) for x in nodes], np.array([rows[x][1] for x in nodes], np.int64)
            parent = list(range(len(nodes)))
            for left, right in candidate_pairs(points, sizes, percent):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    a, b = _root(parent, i), _root(parent, j)
                    parent[max(a, b)] = min(a, b)
            roots = [_root(parent, i) for i in range(len(nodes))]
            several = {r for i, r in enumerate(roots) if r != i}
            out += [(nodes[r], nodes[i]) for i, r in enumerate(roots) if r in several]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["pivot", "node"])
    return run


def narrowed(groups: DataFrame, keyed: DataFrame, classes: DataFrame, percent: int, most: int) -> DataFrame:
    """The groups without the members that no bound of their points lets be linked, cut into
    what the other pairs connect. Groups of over ``most`` members stay as they are."""
    sizes = groups.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("pivot").alias("of"), "m")
    sized = stage(groups.join(sizes, F.col("pivot") == F.col("of")).select("pivot", "node", (F.col("m") > most).alias("large")), "sized")
    wanted = classes.join(sized.where("NOT large").select("node").distinct(), "node", "left_semi").select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "node")
    points = keyed.join(wanted, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo"))).select("node", "n", "point").dropDuplicates(["node"])
    small = sized.where("NOT large").select("pivot", "node").join(points, "node")
    cut = small.repartition("pivot").sortWithinPartitions("pivot").mapInArrow(_parted(percent), "pivot long, node long")
    # the names of large groups are halves of hashes, those of cut ones are nodes: kept apart by the flag
    named = cut.select(F.lit(False).alias("large"), "pivot", "node").unionByName(sized.where("large").select("large", "pivot", "node"))
    return stage(named.select(F.when(F.col("large"), F.xxhash64("pivot")).otherwise(F.col("pivot")).alias("pivot"), "node").distinct(), "narrowed")


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            at, held = [], []
            for i, (node, hi, lo, text) in enumerate(zip(*(batch.column(c) for c in ("node", "hi", "lo", "text")), strict=True)):
                if node.as_py() in seen:
                    continue
                s = shingle_set(text.as_py(), k)
                if class_of(s) == (lo.as_py(), hi.as_py()):
                    seen.add(node.as_py())
                    at.append(i)
                    held.append(s.tobytes())
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("node").take(take), pa.array(held, pa.binary()), batch.column("targets").take(take)], names=["node", "shingles", "targets"])
    return run


def with_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (node and others) with the full set of each class as ``shingles``; the texts are
    those with the class's least text hash, so only what is needed is shuffled as a set."""
    others = [c for c in rows.columns if c != "node"]
    targets = rows.groupBy("node").agg(F.collect_list(F.struct(*others)).alias("targets"))  # as many as a set has keys, at most
    wanted = classes.select("node", "hi", "lo", "text_hash").join(targets, "node").withColumnRenamed("text_hash", "_hash")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(wanted, F.col("text_hash") == F.col("_hash"))
    kind = f"node long, shingles binary, targets {targets.schema['targets'].dataType.simpleString()}"
    found = texts.select("node", "hi", "lo", "targets", "text").mapInArrow(_sets(k), kind)
    return found.select("node", "shingles", F.inline("targets"))


def _joined(percent: int, by: list[str], parted: bool):
    """Joins every run of rows that agree in ``by`` (sorted) by its tree; the rows of a run
    are held, which is two tiles at most."""
    def links(held: list[tuple]) -> list[tuple[int, int]]:
        rows = list({x[0]: x for x in held}.values())
        if len(rows) < 2:
            return []
        sets = [np.frombuffer(x[1], np.uint64) for x in rows]
        found = forest(sets, percent, [x[2] for x in rows] if parted else None, [x[3] for x in rows] if parted else None)
        return [(rows[i][0], rows[j][0]) for i, j in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        made = lambda out: pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
        for held in _runs(batches, by, ["node", "shingles", *(["part", "side"] if parted else [])]):
            if held is None:
                yield made(out)
                out = []
            else:
                out += links(held)
        yield made(out)
    return run


def _tiled(groups: DataFrame, tile: int) -> DataFrame:
    """(pivot, node, tiles, tile, common) of every group with several members."""
    sizes = groups.groupBy("pivot").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("common")).where("m > 1")
    sizes = sizes.select(F.col("pivot").alias("of"), F.ceil(F.col("m") / tile).cast("int").alias("tiles"), "common")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile")
    return stage(groups.join(sizes, F.col("pivot") == F.col("of")).select("pivot", "node", "tiles", own, "common"), "tiled")


def links_of(groups: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int, tile: int) -> DataFrame:
    """Links (a, b) that connect all that links between members of a group connect.

    First every class meets one of its groups only, tile by tile. Most groups then are in one
    component; of the others all pairs of tiles are joined, between components only.
    """
    first = _tiled(groups.groupBy("node").agg(F.min("pivot").alias("pivot")), tile)
    common = first.where("tiles > 1 AND node = common").select("pivot", "node", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    by = ["pivot", "tile"]
    alone = with_sets(docs, classes, first.select("pivot", "node", "tile").unionByName(common), k)
    links = stage(alone.repartition(*by).sortWithinPartitions(*by).mapInArrow(_joined(percent, by, False), "a long, b long"), "links")
    labels = stage(components(links), "labels").select(F.col("node").alias("_n"), "component")
    parted = groups.join(labels, F.col("node") == F.col("_n"), "left").select("pivot", "node", F.coalesce("component", "node").alias("part"))
    parted = stage(parted, "parted")
    several = parted.groupBy("pivot").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select(F.col("pivot").alias("of"))
    open_ = parted.join(several, F.col("pivot") == F.col("of"), "left_semi")
    if open_.isEmpty():
        return links
    tiled = _tiled(open_.select("pivot", "node"), tile).select(F.col("pivot").alias("of"), F.col("node").alias("_n"), "tiles", F.col("tile").alias("side"))
    every = open_.join(tiled, (F.col("pivot") == F.col("of")) & (F.col("node") == F.col("_n")))
    every = every.select("pivot", "node", "part", "side", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    # on the diagonal every member is a side of its own
    side = F.when(F.col("side") == F.col("other"), F.col("node")).otherwise(-1 - F.col("side"))
    across = every.select("pivot", F.least("side", "other").alias("t1"), F.greatest("side", "other").alias("t2"), "node", "part", side.alias("side"))
    by = ["pivot", "t1", "t2"]
    more = with_sets(docs, classes, across, k).repartition(*by).sortWithinPartitions(*by).mapInArrow(_joined(percent, by, True), "a long, b long")
    return stage(links.unionByName(more), "links")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, tile: int = TILE, most: int = POINTS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: sets of k-word n-grams are linked at
    100 * intersection >= percent * union; a component is named by its smallest id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = stage(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_facts(k), _FACTS), "facts")
    classes = classes_of(facts)
    keyed = stage(docs.select("text").mapInArrow(_keys(k, rarity(facts), percent), _KEYED), "keyed")
    groups = narrowed(groups_of(keyed, classes), keyed, classes, percent, most)
    links = links_of(groups, docs, classes, k, percent, tile)
    labels = stage(components(links), "labels").select(F.col("node").alias("_n"), "component")
    named = classes.join(labels, F.col("node") == F.col("_n"), "left").select("hi", "lo", "doc_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = named.join(least, "component").select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "component_id")
    out = facts.where("n >= 0").join(names, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def jaccard_report(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
