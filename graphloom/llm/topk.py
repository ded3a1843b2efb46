"""Exact top-k by inner product with a pivot-distance index.

Vectors become integers, floor(scale * x). One more component, sqrt(M^2 - |x|^2) with M the
largest norm, puts all of them on one sphere; there a larger inner product with a query
(whose extra component is 0) is a smaller distance: d^2 = |q|^2 + M^2 - 2 q.x.

Index: pivots are fitted on a bounded sample; every vector is keyed by its nearest pivot and
its distance to it, sorted by that key, and packed into blocks of at most ``BLOCK`` rows (so
equal vectors spread over blocks). Search: a query takes its first bound from its own block;
then the annulus of each pivot that the bound leaves open is the range of distances within
which the triangle inequality allows a better vector, and only blocks that meet an open
annulus are scored. Queries with like keys travel in packs. Scores are exact integers.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; a
shorter vector counts as padded with zeros; rows with one id are rows of their own, each
left out of its own result only; null ids are candidates, after all others in ties, but no
queries; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import stage

PIVOTS = 64
SAMPLE = 4096  # vectors on which the pivots are fitted
BLOCK = 256  # vectors of a block
PACK = 64  # queries of a pack
SLACK = 1e-6  # relative, for rounding of distances

_LAST = np.iinfo(np.int64).max


def _wide(rows: list[np.ndarray], norm2: float) -> np.ndarray:
    """Vectors with the component that puts them on the sphere."""
    x = np.array(rows, np.float64)
    return np.hstack((x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))[:, None]))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


def fit_pivots(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of a few rounds of k-means from far-apart starts."""
    centres = [x[0]]
    near = _distances(x, x[:1])[:, 0]
    while len(centres) < min(count, len(x)) and near.max() > 0:
        centres.append(x[int(near.argmax())])
        near = np.minimum(near, _distances(x, centres[-1][None, :])[:, 0])
    out = np.array(centres)
    for _ in range(rounds):
        of = _distances(x, out).argmin(axis=1)
        for k in range(len(out)):
            if (of == k).any():
                out[k] = x[of == k].mean(axis=0)
    return out


def integer_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """(row, vec_id, v): usable vectors as floor(scale * component), padded with zeros."""
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    staged = stage(rows.where(usable).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v")), "vectors")
    width = staged.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    return staged.select("row", "vec_id", padded.alias("v"))


def _keyed(pivots: np.ndarray, norm2: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").to_pylist()
            d = _distances(_wide(v, norm2), pivots) if v else np.empty((0, len(pivots)))
            at = d.argmin(axis=1) if len(d) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(d)), at])],
                                             names=["row", "vec_id", "v", "pivot", "far"])
    return run


_BLOCK = "block long, pivot int, near double, far double, n int, row binary, vec_id binary, v binary"


def _packed(size: int):
    """Runs of rows with one pivot, in key order, as blocks of at most ``size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            rows, ids, vectors, far = ([h[i] for h in held] for i in (0, 1, 2, 4))
            ids = [_LAST if i is None else i for i in ids]
            made = [rows[0], held[0][3], far[0], far[-1], len(held), *(np.array(x, np.int64).tobytes() for x in (rows, ids, vectors))]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([m], k) for m, k in zip(made, kinds, strict=True)],
                                              names=["block", "pivot", "near", "far", "n", "row", "vec_id", "v"])
        for batch in batches:
            for one in zip(*(batch.column(c).to_pylist() for c in ("row", "vec_id", "v", "pivot", "far")), strict=True):
                if held and (held[0][3] != one[3] or len(held) == size):
                    yield block()
                held.append(one)
        if held:
            yield block()
    return run


def _opened(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, ids = (np.frombuffer(block[c], np.int64) for c in ("row", "vec_id"))
    return row, ids, np.frombuffer(block["v"], np.int64).reshape(len(row), -1)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point while every sum is below 2^53."""
    if not q.shape[1]:
        return np.zeros((len(q), len(x)), np.int64)
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 53:
        return np.rint(q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


def _best(score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((row, ids, -score))[:k]


_FIRST = "row long, vec_id long, v binary, pivot int, far double, bound long"


def _first_bounds(k: int, every: int):
    """The queries of each block with the k-th best score inside it (none if it is smaller)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                row, ids, v = _opened(b)
                at = np.flatnonzero((ids % every == 0) & (ids != _LAST))
                score = _products(v[at], v)
                for i, q in enumerate(at):
                    others = np.delete(score[i], q)
                    bound = int(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else None
                    out.append((int(row[q]), int(ids[q]), v[q].tobytes(), b["pivot"], b["near"], bound))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["row", "vec_id", "v", "pivot", "far", "bound"])
    return run


_PACK = "pack long, row binary, vec_id binary, v binary, bound binary, open array<struct<pivot:int,lo:double,hi:double>>"


def _query_packs(pivots: np.ndarray, norm2: float, size: int):
    """Packs of queries with the annuli that their bounds leave open, pivot by pivot."""
    def pack(held: list[dict]) -> pa.RecordBatch:
        q = np.array([np.frombuffer(h["v"], np.int64) for h in held]).reshape(len(held), -1)
        bound = [h["bound"] for h in held]
        x = np.hstack((q.astype(np.float64), np.zeros((len(q), 1))))
        d = _distances(x, pivots)
        room = np.array([np.inf if b is None else (xx @ xx) + norm2 - 2.0 * b for b, xx in zip(bound, x, strict=True)])
        reach = np.sqrt(np.maximum(room, 0)) * (1 + SLACK) + SLACK * (1 + d.max())
        halfway = (d - d.min(axis=1, keepdims=True)) / 2 <= reach[:, None]  # else every vector of the pivot is out of reach
        lo = np.where(halfway, d - reach[:, None], np.inf).min(axis=0)
        hi = np.where(halfway, d + reach[:, None], -np.inf).max(axis=0)
        open_ = [{"pivot": int(p), "lo": float(lo[p]), "hi": float(hi[p])} for p in np.flatnonzero(hi >= lo)]
        worst = np.array([np.iinfo(np.int64).min if b is None else b for b in bound], np.int64)
        made = [held[0]["row"], *(np.array([h[c] for h in held], np.int64).tobytes() for c in ("row", "vec_id")), q.tobytes(), worst.tobytes(), open_]
        ring = pa.list_(pa.struct([("pivot", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64())]))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), ring]
        return pa.RecordBatch.from_arrays([pa.array([m], k) for m, k in zip(made, kinds, strict=True)], names=["pack", "row", "vec_id", "v", "bound", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for one in batch.to_pylist():
                if held and (held[0]["pivot"] != one["pivot"] or len(held) == size):
                    yield pack(held)
                    held = []
                held.append(one)
        if held:
            yield pack(held)
    return run


_SCORED = "query_row long, query_id long, row long, vec_id long, score long"


def _scored(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                row, ids, v = _opened(b)
                q_row, q_id, bound = (np.frombuffer(b[c], np.int64) for c in ("q_row", "q_id", "bound"))
                score = _products(np.frombuffer(b["q"], np.int64).reshape(len(q_row), -1), v)
                for i in range(len(q_row)):
                    at = np.flatnonzero((score[i] >= bound[i]) & (row != q_row[i]))
                    at = at[_best(score[i][at], ids[at], row[at], k)]
                    out.extend((int(q_row[i]), int(q_id[i]), int(row[a]), int(ids[a]), int(score[i][a])) for a in at)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(5)], names=["query_row", "query_id", "row", "vec_id", "score"])
    return run


def top_k(rows: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every row whose id ``every`` divides."""
    vectors = integer_vectors(rows, scale)
    norm2 = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).first()[0]
    if norm2 is None:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    sample = vectors.orderBy(F.xxhash64("row")).limit(SAMPLE).select("v").collect()
    centres = fit_pivots(_wide([r["v"] for r in sample], norm2), pivots)

    keyed = vectors.mapInArrow(_keyed(centres, norm2), "row long, vec_id long, v array<long>, pivot int, far double")
    sorted_ = keyed.repartitionByRange("pivot", "far", "row").sortWithinPartitions("pivot", "far", "row")
    blocks = stage(sorted_.mapInArrow(_packed(block), _BLOCK), "blocks")
    queries = blocks.select("pivot", "near", "row", "vec_id", "v").mapInArrow(_first_bounds(k, every), _FIRST)
    packs = stage(queries.repartitionByRange("pivot", "far", "row").sortWithinPartitions("pivot", "far", "row")
                  .mapInArrow(_query_packs(centres, norm2, PACK), _PACK), "packs")

    rings = packs.select("pack", F.explode("open").alias("o")).select("pack", F.col("o.pivot").alias("of"), "o.lo", "o.hi")
    shells = blocks.select("block", "pivot", "near", "far")
    meet = rings.join(shells, (F.col("of") == F.col("pivot")) & (F.col("near") <= F.col("hi")) & (F.col("far") >= F.col("lo"))).select("pack", "block")
    asked = packs.select("pack", F.col("row").alias("q_row"), F.col("vec_id").alias("q_id"), F.col("v").alias("q"), "bound")
    pairs = meet.join(asked, "pack").join(blocks.select("block", "row", "vec_id", "v"), "block").drop("pack", "block")
    scored = pairs.mapInArrow(_scored(k), _SCORED)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    best = scored.withColumn("rank", place).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(F.col("vec_id") != int(_LAST), F.col("vec_id")).alias("vec_id"), "score")
