"""Line deduplication with an edit-distance join on segments.

Lines of at least ``LEAST`` characters that are within ``EDITS`` edits of one another belong
to one class (transitively); shorter lines only with equal ones. Of each class the first line
(smallest document id, then place) stays in the corpus, blank lines always stay.

1.  A line is split into EDITS + 1 even segments; two lines within EDITS edits share one of
    them. A line is indexed under (its length, segment number, segment) and probes, for its
    own and each smaller length in reach, the substrings whose place the edits allow.
2.  Every index bucket links its hits to a pivot; pairs are verified by a banded bit-parallel
    edit distance, and the links make first classes. Most buckets then hold one class.
3.  The others are joined pivot by pivot: the members of all its open buckets are cut by hash
    into tiles, and every pair of tiles compares, inside a task, lengths and parities of
    characters and of pairs of neighbours, which EDITS edits can change only so far. Members
    without a candidate in another class go; the others' lines travel once for each pair of
    tiles, and a task returns only links that connect something new: fewer than it has
    members, never pairs.

Lines are known by a 64-bit hash. Hashes that two different lines share are found first, by a
second hash, and those lines (about n * n / 2^65 of n) are known by the second one.

Defined cases: a null text has no lines; an empty one has one blank line; equal rows are
treated alike; rows that share an id count as one document, a null id is the last one; an
empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import stage
from graphloom.llm.components import components
from graphloom.llm.near import _mixed, _root, _runs

EDITS = 2
LEAST = 16
SMALL = 512  # lines of a tile
_SECOND = "\u0001"  # before a line for its second hash
_BLOCK = 128  # rows of a tile that are compared at once
_CHARS = 1 << 18  # characters whose substrings are hashed at once, or one longer line
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # of the rolling hash; odd, so that it can be inverted


def line_hash(line: Column, clash: frozenset[int] = frozenset()) -> Column:
    h = F.xxhash64(line)
    return F.when(h.isin(*clash), _second(line)).otherwise(h) if clash else h


def _second(line: Column) -> Column:
    return F.xxhash64(F.concat(F.lit(_SECOND), line))


def _xx(line: str) -> int:
    h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def _node(line: str, clash: frozenset[int]) -> int:
    """The same 64-bit hash as ``line_hash``."""
    h = _xx(line)
    return _xx(_SECOND + line) if h in clash else h


def segments(length: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the i-th even part of lines; the last parts take the remainder."""
    size, more = length // parts, length % parts
    return i * size + np.maximum(i - (parts - more), 0), size + (i >= parts - more)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def probed(lines: list[str], edits: int, index_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line number, bucket, indexed) of the probes of lines: for a line's own and each
    smaller length in reach, the substrings of the places that the edits left and right of a
    segment allow; its own segments are indexed. Substrings are hashed by differences of
    rolling sums; lines of one bucket by chance only cost a comparison."""
    size_of = np.array([len(x) for x in lines], np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    power, back = _powers(_BASE, len(codes) + 1), _powers(pow(_BASE, -1, 1 << 64), len(codes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(codes + _ODD) * power[:-1], dtype=np.uint64)])
    first = np.cumsum(size_of) - size_of
    numbers, buckets, own = [], [], []
    for shorter in range(1 if index_only else edits + 1):
        n = size_of - shorter
        for i in range(edits + 1):
            start, size = segments(n, edits + 1, i)
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + edits - i)
            for shift in [0] if index_only else range(low, high + 1):
                at = start + shift
                good = np.flatnonzero((at >= 0) & (at + size <= size_of) & (n > edits))
                left = first[good] + at[good]
                text = (sums[left + size[good]] - sums[left]) * back[left]
                buckets.append(_mixed(text ^ _mixed(n[good].astype(np.uint64) * _ODD + np.uint64(i))))
                numbers.append(good)
                own.append(np.full(len(good), shorter == 0 and shift == 0))
    return np.concatenate(numbers), np.concatenate(buckets).view(np.int64), np.concatenate(own)


def probes(line: str, edits: int) -> list[tuple[int, bool]]:
    """(bucket, indexed) of one line."""
    _, buckets, own = probed([line], edits, False)
    return list(zip(buckets.tolist(), own.tolist(), strict=True))


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance of two texts is at most ``limit``: bit-parallel over the
    2 * limit + 1 diagonals around the main one, after equal ends are cut off."""
    if abs(len(a) - len(b)) > limit:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest common beginning
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:  # longest common end
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid:] == b[len(b) - mid:] else (low, mid - 1)
    a, b = a[:len(a) - low], b[:len(b) - low]
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m == 0 or limit == 0:
        return n <= limit
    band, top = (1 << 2 * limit + 1) - 1, 2 * limit
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    up, down = band & ~((1 << limit) - 1), 0  # vertical steps +1 and -1 of the column before
    score = min(limit, m)  # of the lowest cell in the band, then of the last row
    for j in range(1, n + 1):
        shift = j - limit - 1  # row of the band's first bit, from 0
        same = at.get(b[j - 1], 0)
        same = (same >> shift if shift >= 0 else same << -shift) & band
        diagonal = ((((same & up) + up) ^ up) | same | down) & band  # no cost along the diagonal
        right = down | (band & ~(diagonal | up))
        left = diagonal & up
        if j + limit <= m:
            score += 1 - (diagonal >> top & 1)
            if score > 2 * limit + n - m:
                return False
        else:
            row = m - j + limit
            if row < 0:
                return False
            score += (right >> row & 1) - (left >> row & 1)
            if score - (n - j) > limit:
                return False
        up = left | (band & ~((diagonal >> 1) | right))
        down = (diagonal >> 1) & right
    return score <= limit


def _blocks(lines: Iterator[str]) -> Iterator[list[str]]:
    held, chars = [], 0
    for line in lines:
        if held and chars + len(line) > _CHARS:
            yield held
            held, chars = [], 0
        held.append(line)
        chars += len(line)
    if held:
        yield held


def _probing(edits: int, least: int, index_only: bool, clash: frozenset[int]):
    def new(texts: pa.Array, nodes: dict[str, int]) -> Iterator[str]:
        for text in texts:
            for line in (text.as_py() or "").split("\n"):
                if len(line) >= least and line not in nodes and line.strip():
                    nodes[line] = _node(line, clash)
                    yield line

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes: dict[str, int] = {}
            for lines in _blocks(new(batch.column("text"), nodes)):
                numbers, buckets, _ = probed(lines, edits, index_only)
                own = np.array([nodes[x] for x in lines], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(own[numbers])], names=["bucket", "node"])
    return run


def _verified(edits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [within(x, y, edits) for x, y in zip(batch["line_a"], batch["line_b"], strict=True)]
            yield batch.loc[np.array(good, bool), ["a", "b"]]
    return run


def verified(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) whose lines are within the edits."""
    one = lines.select(F.col("node").alias("a"), F.col("line").alias("line_a"))
    two = lines.select(F.col("node").alias("b"), F.col("line").alias("line_b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(_verified(edits), "a long, b long")


def bags(line: str) -> tuple[int, int]:
    """Parities of a line's characters and of its pairs of neighbours, 64 kinds each. An edit
    changes at most two characters' and four pairs' counts."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    pairs = (codes[:-1] * _ODD + codes[1:]) * _ODD >> np.uint64(58)
    odd = [np.bincount(x.astype(np.int64), minlength=64) & 1 for x in (codes % np.uint64(64), pairs)]
    packed = np.packbits(np.array(odd, np.uint8), axis=1, bitorder="little").view(np.int64)
    return int(packed[0, 0]), int(packed[1, 0])


def _bagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [bags(line) for line in batch["line"]]
        yield batch[["node", "line"]].assign(bag_a=[a for a, _ in found], bag_b=[b for _, b in found])


_RUN = ["pivot", "t1", "t2"]
_ALIVE = "pivot long, t1 int, t2 int, node long, of long, side long, size int, bag_a long, bag_b long"
_FACTS = ["node", "of", "side", "size", "bag_a", "bag_b"]


def _alike(held: dict[str, np.ndarray], edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i < j) of two sides and two classes whose lengths and parities allow the edits."""
    size, of, side = held["size"].astype(np.int64), held["of"], held["side"]
    a, b = held["bag_a"].view(np.uint64), held["bag_b"].view(np.uint64)  # signed numbers would be counted by their magnitude
    for i in range(0, len(size), _BLOCK):
        x, y = slice(i, i + _BLOCK), slice(i, None)
        fit = (of[x, None] != of[None, y]) & (side[x, None] != side[None, y]) & (np.abs(size[x, None] - size[None, y]) <= edits)
        fit &= (np.bitwise_count(a[x, None] ^ a[None, y]) <= 2 * edits) & (np.bitwise_count(b[x, None] ^ b[None, y]) <= 4 * edits)
        left, right = np.nonzero(np.triu(fit, 1))
        if len(left):
            yield left + i, right + i


def _alive(edits: int):
    """The members of each pair of tiles that have a candidate in another class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, [*_RUN, *_FACTS]):
            keep = np.zeros(table.num_rows, bool)
            for a, b in _alike({c: table.column(c).to_numpy() for c in _FACTS}, edits):
                keep[a] = keep[b] = True
            yield from table.filter(pa.array(keep)).to_batches()
    return run


def _linked(edits: int):
    """Verified links of each pair of tiles, as many as connect its classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, [*_FACTS, "line"]):
            held = {c: table.column(c).to_numpy() for c in _FACTS}
            lines = table.column("line").to_pylist()
            first: dict[int, int] = {}
            parent = [first.setdefault(c, i) for i, c in enumerate(held["of"].tolist())]
            out = []
            for left, right in _alike(held, edits):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    a, b = _root(parent, i), _root(parent, j)
                    if a != b and within(lines[i], lines[j], edits):
                        parent[a] = b
                        out.append((i, j))
            at = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(held["node"][at[:, 0]]), pa.array(held["node"][at[:, 1]])], names=["a", "b"])
    return run


def open_links(groups: DataFrame, lines: DataFrame, edits: int, tile: int) -> DataFrame:
    """Links (a, b) between classes, from ``groups`` (pivot, node, of) dealt to pairs of tiles."""
    sizes = groups.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")).withColumnRenamed("pivot", "_pivot")
    facts = lines.select(F.col("node").alias("_n"), F.length("line").alias("size"), "bag_a", "bag_b")
    dealt = groups.join(sizes, F.col("pivot") == F.col("_pivot")).join(facts, F.col("node") == F.col("_n"))
    at = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    every = dealt.select("*", at.alias("at"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    side = F.when(F.col("at") == F.col("other"), F.col("node")).otherwise(F.col("at").cast("long"))
    every = every.select("pivot", F.least("at", "other").alias("t1"), F.greatest("at", "other").alias("t2"), "node", "of", side.alias("side"), "size", "bag_a", "bag_b")
    by_tiles = lambda d: d.repartition(*_RUN).sortWithinPartitions(*_RUN)
    alive = stage(by_tiles(every).mapInArrow(_alive(edits), _ALIVE), "alive")
    whole = alive.join(lines.select(F.col("node").alias("_n"), "line"), F.col("node") == F.col("_n")).drop("_n")
    return stage(by_tiles(whole).mapInArrow(_linked(edits), "a long, b long"), "links")


def _classed(frame: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return frame.join(own, F.col("node") == F.col("_n"), "left").withColumn("of", F.coalesce("_c", "node")).drop("_n", "_c")


def line_classes(docs: DataFrame, clash: frozenset[int], edits: int = EDITS, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """(node, component) of all lines with another line within the edits; ``clash`` has the
    hashes that different lines share."""
    kind = "bucket long, node long"
    found = docs.select("text").mapInArrow(_probing(edits, least, False, clash), kind)
    index = docs.select("text").mapInArrow(_probing(edits, least, True, clash), kind).select(F.col("bucket").alias("of_bucket"), "node")
    sums = index.groupBy("of_bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    hits = found.join(sums, F.col("bucket") == F.col("of_bucket")).where((F.col("lo") != F.col("hi")) | (F.col("lo") != F.col("node")))
    # the pivot is one end or the other by bucket, so that a group has more than one
    pivot = F.when(F.col("bucket") % 2 == 0, F.col("lo")).otherwise(F.col("hi"))
    hits = stage(hits.select("bucket", "node", pivot.alias("pivot")).distinct(), "hits")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") >= least).select(line_hash(F.col("line"), clash).alias("node"), "line")
    lines = lines.join(hits.select(F.explode(F.array("node", "pivot")).alias("_n")).distinct(), F.col("node") == F.col("_n"), "left_semi").dropDuplicates(["node"])
    lines = stage(lines.mapInPandas(_bagged, "node long, line string, bag_a long, bag_b long"), "lines")

    star = hits.where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = stage(verified(star, lines, edits), "links")
    labels = stage(components(links), "labels")
    own = _classed(hits, labels)
    several = own.groupBy("bucket").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo <> hi").select(F.col("bucket").alias("_bucket"))
    groups = own.join(several, F.col("bucket") == F.col("_bucket"), "left_semi").select("pivot", "node", "of").distinct()
    more = open_links(stage(groups, "open"), lines, edits, small)
    return labels if more.isEmpty() else stage(components(links.unionByName(more)), "labels")


def line_decisions(docs: DataFrame, edits: int = EDITS, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """(doc_id, text_hash, at, size, dropped) of every line of every document."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    full = split.where(F.col("line").rlike(r"\S"))
    hashed = full.select(F.xxhash64("line").alias("h"), _second(F.col("line")).alias("second"))
    twins = hashed.groupBy("h").agg(F.min("second").alias("lo"), F.max("second").alias("hi")).where("lo <> hi")
    clash = frozenset(r["h"] for r in twins.select("h").collect())  # one in 2^64 pairs of different lines
    rows = full.select("doc_id", "text_hash", "at", F.length("line").alias("size"), line_hash(F.col("line"), clash).alias("node"))
    classed = _classed(stage(rows, "lines"), line_classes(docs, clash, edits, least, small))
    repeated = classed.where("of IS NOT NULL").groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")
    twice = classed.join(repeated.select(F.col("of").alias("_of"), "first_id"), F.col("of") == F.col("_of"))
    twice = stage(twice.select("doc_id", "text_hash", "at", "size", "of", F.col("doc_id").eqNullSafe(F.col("first_id")).alias("first_doc")), "repeated")
    first = twice.where("first_doc").groupBy(F.col("of").alias("_of")).agg(F.min("at").alias("first_at"))
    stays = F.col("first_doc") & (F.col("at") == F.col("first_at"))
    return twice.join(first, F.col("of") == F.col("_of")).select("doc_id", "text_hash", "at", "size", (~stays).alias("dropped"))


def line_report(docs: DataFrame, edits: int = EDITS, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """doc_id, n_lines, n_repeated, n_dropped, kept_chars of every row: its lines, those in a
    class with another line, those that go, and the characters of the lines that stay."""
    lost = line_decisions(docs, edits, least, small).distinct()
    sums = lost.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.count(F.lit(1)).alias("n_repeated"), F.sum(F.col("dropped").cast("long")).alias("n_dropped"), F.sum(F.when(F.col("dropped"), F.col("size")).otherwise(0)).alias("gone"))
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"), F.length("text").alias("chars"))
    joined = own.join(sums, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    line_chars = F.greatest(zero("chars") - F.greatest(F.col("n_lines") - 1, F.lit(0)), F.lit(0))
    return joined.select("doc_id", "n_lines", zero("n_repeated").alias("n_repeated"), zero("n_dropped").alias("n_dropped"), (line_chars - zero("gone")).cast("long").alias("kept_chars"))


def drop_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST, small: int = SMALL) -> DataFrame:
    """``docs`` with all its columns, its texts without the lines that go (null texts stay)."""
    gone = line_decisions(docs, edits, least, small).where("dropped").distinct()
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_list("at").alias("_gone"))
    own = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own_id"), F.xxhash64("text").alias("_own_hash"))
    joined = own.join(gone, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")), "left")
    lines = F.split(F.col("_row.text"), "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("_gone", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(kept)
    return joined.select(F.col("_row").withField("text", text).alias("_row")).select("_row.*")
