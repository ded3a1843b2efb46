"""Hard negatives: high-scoring rows of another label below a share of a positive's score.

Summaries: a vector is cut into 1, 4 and 16 segments; each segment keeps its mean and its
deviation. In a segment of n components the product of two vectors is
n * mean * mean', give or take n * deviation * deviation' at most, so the sums over all
segments bound the score from both sides, and more segments bound it more closely.

Search: all rows are dealt by hash into parts of about ``PART`` rows (positives: parts of a
label), the queries are sent to every part, and a task holds one part at a time while the queries
stream past it. Coarse summaries rule out rows for a pack of queries, finer ones more of them, and
only what is left is scored exactly, in integers. Positives: the k-th best lower bound of the part
is a floor. Negatives: one part is searched first; the last place it yields is a floor for
all the others, and a row is ruled out if it lies below every floor or above every ceiling.
So a task's memory is bounded by a part and a pack, whatever a label's share of the rows is.

Defined cases: rows whose vector or label is null, or whose vector holds null or non-finite
components, take no part; a shorter vector counts as padded with zeros; rows with one id are
rows of their own; a null id is no anchor, and comes last in ties; an anchor without
positives, or a positive without rows in its range, gives no rows; a positive whose score is
below zero has an empty range, and at zero the range is zero; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import stage
from graphloom.llm.topk import _products as products

PART = 4096  # rows that a task holds at once
PACK = 128  # queries that are scored together
SEGMENTS = (1, 4, 16)  # from coarse to fine; vectors are padded to a multiple of the last
SLACK = 1e-9  # relative, for rounding in the bounds
_LAST = np.iinfo(np.int64).max


def labelled_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """(row, vec_id, label, v): usable rows, v = floor(scale * component), padded, staged."""
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    kept = stage(rows.where(usable).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                           F.col("label").cast("string").alias("label"), ints.alias("v")), "vectors")
    widest = max(kept.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    width = -(-widest // SEGMENTS[-1]) * SEGMENTS[-1]
    return kept.select("row", "vec_id", "label", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))).alias("v"))


class Summaries:
    """Means and deviations of the segments of some vectors, weighted so that plain products
    of them bound the scores."""

    def __init__(self, x: np.ndarray):
        self.mean, self.deviation = [], []
        for count in SEGMENTS:
            parts = x.reshape(len(x), count, -1).astype(np.float64)
            n = parts.shape[2]
            mean = parts.mean(axis=2)
            self.mean.append(mean * np.sqrt(n))
            self.deviation.append(np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2)))
        self.norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))

    def bounds(self, level: int, other: Summaries, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores with the vectors ``at`` of ``other``."""
        middle = self.mean[level] @ other.mean[level][at].T
        room = self.deviation[level] @ other.deviation[level][at].T + SLACK * self.norm[:, None] * other.norm[at][None, :] + SLACK
        return middle - room, middle + room


class Part:
    """The rows that a task holds: by id, so that a stable sort by score settles ties."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, label: np.ndarray, v: np.ndarray):
        order = np.lexsort((row, ids))
        self.row, self.ids, self.label, self.v = row[order], ids[order], label[order], v[order]
        self.summaries = Summaries(self.v)
        self.scored = 0

    def left(self, queries: Summaries, open_: np.ndarray, floor: np.ndarray, ceiling: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places that no bound rules out for all queries, and for which queries each is open.
        With ``k``, the k-th best lower bound of a query is a floor too."""
        at = np.flatnonzero(open_.any(axis=0))
        open_ = open_[:, at]
        for level in range(len(SEGMENTS)):
            if not len(at):
                break
            low, high = queries.bounds(level, self.summaries, at)
            if k and len(at) > k:
                sure = np.where(open_, low, -np.inf)
                floor = np.maximum(floor, np.partition(sure, len(at) - k, axis=1)[:, len(at) - k])
            open_ = open_ & (high >= floor[:, None]) & (low <= ceiling[:, None])
            some = open_.any(axis=0)
            at, open_ = at[some], open_[:, some]
        return at, open_

    def scores(self, v: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.scored += len(v) * len(at)
        return products(v, self.v[at])


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _parts(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[Part, pa.RecordBatch]]:
    """(part, some of its queries), for rows sorted by ``by`` and kind: a part's rows (kind 0)
    come first and are held, its queries (kind 1) follow."""
    key, held, part = None, [], None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in (*by, "kind")), strict=True))
        cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece = batch.slice(a, b - a)
            if keys[a][:-1] != key:
                key, held, part = keys[a][:-1], [], None
            if keys[a][-1] == 0:
                ids = piece.column("vec_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
                held.append((piece.column("row").to_numpy(), ids, piece.column("label").to_numpy(zero_copy_only=False), _matrix(piece.column("v"), b - a)))
                continue
            if part is None and held:
                part, held = Part(*(np.concatenate(x) for x in zip(*held, strict=True))), []
            if part is not None:
                for i in range(0, b - a, PACK):
                    yield part, piece.slice(i, PACK)


_POSITIVE = "anchor_row long, positive_row long, positive_id long, positive_score long"


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, queries in _parts(batches, ["label", "part"]):
            row, v = queries.column("row").to_numpy(), _matrix(queries.column("v"), queries.num_rows)
            open_ = part.row[None, :] != row[:, None]
            free = np.full(len(row), np.inf)
            at, open_ = part.left(Summaries(v), open_, -free, free, k)
            score, out = part.scores(v, at), []
            for i in range(len(row)):
                mine = np.flatnonzero(open_[i])
                best = mine[np.argsort(-score[i][mine], kind="stable")[:k]]
                out += [(int(row[i]), int(part.row[at[j]]), int(part.ids[at[j]]), int(score[i][j])) for j in best]
            names = ["anchor_row", "positive_row", "positive_id", "positive_score"]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=names)
    return run


_NEGATIVE = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, negative_row long, negative_id long, negative_score long"


def _negatives(k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, queries in _parts(batches, ["part"]):
            row, anchor = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy(zero_copy_only=False)
            v, label = _matrix(queries.column("v"), len(row)), queries.column("label").to_numpy(zero_copy_only=False)
            wanted = queries.column("positives").to_pylist()
            ranges = [[(p, max(-(-low * p["score"] // 100), -_LAST if p["floor"] is None else p["floor"]), high * p["score"] // 100) for p in w] for w in wanted]
            floor = np.array([min(r[1] for r in x) for x in ranges], np.float64)
            ceiling = np.array([max(r[2] for r in x) for x in ranges], np.float64)
            at, open_ = part.left(Summaries(v), part.label[None, :] != label[:, None], floor, ceiling, None)
            score, out = part.scores(v, at), []
            for i in range(len(row)):
                mine = np.flatnonzero(open_[i] & (score[i] >= floor[i]) & (score[i] <= ceiling[i]))
                mine = mine[np.argsort(-score[i][mine], kind="stable")]
                falling = -score[i][mine]
                for p, least, most in ranges[i]:
                    a = int(np.searchsorted(falling, -most, "left"))
                    b = min(a + k, int(np.searchsorted(falling, -least, "right")))
                    out += [(int(row[i]), int(anchor[i]), p["row"], p["id"], p["score"], int(part.row[at[j]]), int(part.ids[at[j]]), int(score[i][j])) for j in mine[a:b]]
            names = [c.split()[0] for c in _NEGATIVE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(8)], names=names)
    return run


def _ranked(found: DataFrame, by: list[str], score: str, ties: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), *ties))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: float = 256.0, part: int = PART) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row
    whose id ``every`` divides and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of another label that score ``low`` to ``high`` percent of the positive."""
    vectors = labelled_vectors(rows, scale)
    parts = max(1, -(-vectors.count() // part))
    base = vectors.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    anchors = vectors.where(F.col("vec_id") % every == 0)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    columns = ["row", "vec_id", "label", "v", "part", "kind"]
    both = base.withColumn("kind", F.lit(0)).select(*columns).unionByName(anchors.withColumn("part", everywhere).withColumn("kind", F.lit(1)).select(*columns))
    dealt = both.repartition("label", "part").sortWithinPartitions("label", "part", "kind")
    found = _ranked(dealt.mapInArrow(_positives(positives), _POSITIVE), ["anchor_row"], "positive_score", ["positive_id", "positive_row"], positives)
    found = stage(found.drop("rank"), "positives")

    def meet(floors: DataFrame, at: DataFrame, first: int, last: int) -> DataFrame:
        """Negatives of the parts first..last, with the floors known so far."""
        each = F.struct(F.col("positive_row").alias("row"), F.col("positive_id").alias("id"), F.col("positive_score").alias("score"), "floor")
        lists = floors.groupBy("anchor_row").agg(F.collect_list(each).alias("positives"))  # a few of each anchor
        span = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")))
        asked = anchors.join(lists, F.col("row") == F.col("anchor_row")).withColumn("part", span)
        held = at.where(F.col("part").between(first, last)).withColumn("kind", F.lit(0)).withColumn("positives", F.lit(None).cast(lists.schema["positives"].dataType))
        names = [*columns, "positives"]
        rows_ = held.select(*names).unionByName(asked.withColumn("kind", F.lit(1)).select(*names))
        return rows_.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(_negatives(negatives, low, high), _NEGATIVE)

    pair = ["anchor_row", "positive_row"]
    ties = ["negative_id", "negative_row"]
    out = stage(_ranked(meet(found.withColumn("floor", F.lit(None).cast("long")), base, 0, 0), pair, "negative_score", ties, negatives).drop("rank"), "probe")
    if parts > 1:
        full = out.groupBy(*pair).agg(F.count(F.lit(1)).alias("n"), F.min("negative_score").alias("floor")).where(F.col("n") == negatives).drop("n")
        out = out.unionByName(meet(found.join(full, pair, "left"), base, 1, parts - 1))
    named = lambda c: F.when(F.col(c) != int(_LAST), F.col(c)).alias(c)
    return _ranked(out, pair, "negative_score", ties, negatives).select(
        "anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")


def negative_report(rows: DataFrame) -> DataFrame:
    """The result for labels of which every seventh (by vec_id) is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))
