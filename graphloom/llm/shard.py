"""Sharding by minimax contiguous partition.

Equal texts form one atomic group; groups stand in the order of their digest. The smallest
capacity for which a greedy pass fits all groups into the shards is found by binary search
over prefix sums. The driver never holds the groups: it holds a histogram of group ends of
fixed size, decides every capacity that the histogram can decide, and has only the ranges
in which undecided cuts fall divided again. Within that capacity the cuts are then set so
that the shards come out even. A document's shard follows from its own digest and the cut
digests, so texts are never shuffled.

Defined cases: a null text counts one byte and forms its own group before all others; equal
rows go to one shard and get distinct slots; with fewer groups than shards, some shards
stay empty; an empty table gives an empty result; further columns stay as they are, but
an earlier shard column is replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import hex_long, stage

BINS = 1 << 14  # parts into which the driver has its open ranges divided at once
RANGES = 64  # open ranges that are divided at once
SUBS = 256  # parts in which the rows of one group are numbered


def digest(text: Column) -> Column:
    return F.coalesce(F.md5(text), F.lit(""))


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def group_ends(rows: DataFrame) -> DataFrame:
    """Groups in digest order: digest, end (bytes up to and with the group), rows_before.

    ``rows`` has (digest, size). Totals of the 4,096 digest prefixes give every prefix its
    offset; running sums are taken within a prefix.
    """
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = stage(groups.withColumn("prefix", F.coalesce(hex_long(F.col("digest"), 1, 3), F.lit(-1))), "groups")
    before = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)  # 4,097 rows at most
    totals = groups.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    offsets = totals.select("prefix", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_0"))
    run = Window.partitionBy("prefix").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    sums = groups.select("digest", "prefix", "n", F.sum("bytes").over(run).alias("bytes_1"), F.sum("n").over(run).alias("n_1"))
    return stage(sums.join(offsets, "prefix").select("digest", (F.col("bytes_0") + F.col("bytes_1")).alias("end"),
                                                     (F.col("n_0") + F.col("n_1") - F.col("n")).alias("rows_before")), "ends")


class Ends:
    """What the driver knows of the group ends: some ends, and which gaps hide others."""

    def __init__(self, ends: DataFrame, total: int, bins: int = BINS):
        self.ends, self.total, self.bins, self.divisions = ends, total, bins, 0
        self.known, self.hidden = [0, total], [False, True]  # hidden[i]: ends between known[i - 1] and known[i]
        self.divide([(0, total)])

    def parts(self, ranges: list[tuple[int, int]], each: int) -> list[tuple[int, int, int]]:
        """(first end, last end, number of ends) of every part of the ranges that has any."""
        part = F.lit(None).cast("long")
        for k, (a, b) in enumerate(ranges):
            width = -(-(b - a) // each)
            part = F.when((F.col("end") > a) & (F.col("end") <= b), F.lit(k * each) + F.floor((F.col("end") - a - 1) / F.lit(width))).otherwise(part)
        found = self.ends.withColumn("part", part).where("part IS NOT NULL").groupBy("part")
        return [tuple(r)[1:] for r in found.agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count(F.lit(1)).alias("n")).collect()]

    def open_ranges(self, spans: list[tuple[int, int]], joined: bool) -> list[tuple[int, int]]:
        """Runs of neighbouring gaps in the spans that hide ends, ``RANGES`` at most: with
        ``joined`` the nearest runs become one, else the widest are taken."""
        out: list[tuple[int, int]] = []
        for a, b, hidden in zip(self.known, self.known[1:], self.hidden[1:], strict=False):
            if hidden and any(a < y and b > x for x, y in spans):
                if out and out[-1][1] == a:
                    out[-1] = (out[-1][0], b)
                else:
                    out.append((a, b))
        if len(out) <= RANGES or not joined:
            return sorted(sorted(out, key=lambda r: r[0] - r[1])[:RANGES])
        apart = sorted(range(1, len(out)), key=lambda i: out[i - 1][1] - out[i][0])[:RANGES - 1]
        starts = [0, *sorted(apart), len(out)]
        return [(out[i][0], out[j - 1][1]) for i, j in zip(starts, starts[1:], strict=False)]

    def divide(self, spans: list[tuple[int, int]]) -> None:
        """Learn the first and last end of every part of the open ranges. What is known is kept. If
        joined ranges were too wide to show anything new, the widest runs are divided alone: these
        shrink with each division, until they show all."""
        for joined in (True, False):
            before = len(self.known), sum(self.hidden)
            ranges = self.open_ranges(spans, joined)
            if not ranges:
                raise AssertionError("no gap is left to divide")
            self.divisions += 1
            known = dict(zip(self.known, self.hidden, strict=True))
            for first, last, n in self.parts(ranges, max(2, self.bins // len(ranges))):
                inside = sorted({first, last, *self.known[bisect_left(self.known, first):bisect_right(self.known, last)]})
                known.update({e: n > len(inside) and known.get(e, True) for e in inside})
                known[first] = False  # nothing lies between two parts' ends
            self.known, self.hidden = map(list, zip(*sorted(known.items()), strict=True))
            if (len(self.known), sum(self.hidden)) != before:
                return

    def reach(self, start: int, capacity: int, hopeful: bool) -> int:
        """The furthest end a shard from ``start`` can take: for sure, or at the very best."""
        to = start + capacity
        i = bisect_right(self.known, to)
        if hopeful and i < len(self.known) and self.hidden[i]:
            return max(start, to)
        return max(start, self.known[i - 1])

    def path(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        at, out = 0, []
        for _ in range(shards):
            out.append(at := min(self.reach(at, capacity, hopeful), self.total))
        return out

    def least(self, shards: int, hopeful: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.path(mid, shards, hopeful)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low


def capacity_of(known: Ends, shards: int) -> int:
    """The smallest capacity, after dividing as many ranges as it takes to be sure."""
    while (low := known.least(shards, True)) < (high := known.least(shards, False)):
        known.divide(list(zip(known.path(low, shards, False), known.path(high, shards, True), strict=True)))
    return high


def even_cuts(known: Ends, shards: int, capacity: int) -> list[int]:
    """Cut positions within the capacity, each as near to an even share of what is left as
    the known ends allow; the greedy cuts where only those fit."""
    latest, at = [], known.total  # the earliest cut from which the rest still fits
    for _ in range(shards):
        at = max(0, known.known[bisect_left(known.known, at - capacity)]) if at > capacity else 0
        latest.append(at)
    if at > 0:
        return known.path(capacity, shards, False)[:-1]
    cuts, at = [], 0
    for k, least in enumerate(reversed(latest[:-1])):
        want = at + (known.total - at) / (shards - k)
        i = bisect_left(known.known, want)
        near = min((e for e in known.known[max(0, i - 1):i + 1]), key=lambda e: abs(e - want), default=known.total)
        at = max(least, min(max(near, at), known.reach(at, capacity, False)))
        cuts.append(at)
    return cuts


def shard_plan(rows: DataFrame, shards: int, bins: int = BINS) -> tuple[DataFrame, list[str], int]:
    """Group ends, the last digest of every shard but the last, and the capacity."""
    ends = group_ends(rows)
    total = ends.agg(F.max("end")).first()[0]
    if not total:
        return ends, [], 0
    known = Ends(ends, total, bins)
    capacity = capacity_of(known, shards)
    cuts = even_cuts(known, shards, capacity)
    at = {r["end"]: r["digest"] for r in ends.where(F.col("end").isin(sorted(set(cuts)))).select("end", "digest").collect()}
    return ends, [at.get(c) for c in cuts], capacity


def shard_of(digest_: Column, cuts: list[str | None]) -> Column:
    """Shard of a digest: the number of cuts before it (a cut without a digest, at position
    0, is before all)."""
    out = F.lit(0)
    for c in cuts:
        out = out + (F.lit(1) if c is None else F.when(digest_ > F.lit(c), 1).otherwise(0))
    return out.cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, column: str = "shard") -> DataFrame:
    """``docs`` with all its columns plus ``column``: shard 0 to ``shards`` - 1 by bytes. A
    column that ``docs`` has under that name gives way."""
    text = F.col("_text")
    own = docs.drop(column).select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    _, cuts, _ = shard_plan(own.select(digest(text).alias("digest"), size_of(text).alias("size")), shards)
    return own.select("_row.*", shard_of(digest(text), cuts).alias(column))


def shard_report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row. A slot counts
    the rows before it: in earlier groups, in earlier parts of its group, in its own part."""
    text = F.col("text")
    rows = stage(docs.select("doc_id", size_of(text).alias("size"), F.crc32(text).alias("text_crc32"), digest(text).alias("digest")), "rows")
    ends, cuts, _ = shard_plan(rows, shards)
    placed = ends.withColumn("shard", shard_of(F.col("digest"), cuts))
    firsts = placed.groupBy("shard").agg(F.min("rows_before").alias("rows_0"))  # a row for each shard
    groups = placed.join(F.broadcast(firsts), "shard").select("digest", "shard", (F.col("rows_before") - F.col("rows_0")).alias("slot_0"))
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SUBS)))
    earlier = Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy("digest", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("digest", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_1")).join(groups, "digest")
    place = F.row_number().over(Window.partitionBy("digest", "part").orderBy("doc_id"))
    numbered = parted.withColumn("place", place).join(parts, ["digest", "part"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           (F.col("slot_0") + F.col("slot_1") + F.col("place") - 1).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
