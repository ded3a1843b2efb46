"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades are ordered (0 = clean). One weight vector is shared by all thresholds:
P(grade > j) = sigmoid(x . w - threshold_j), thresholds rising. A document's expected
severity is the sum of these probabilities. Features are hashed words and word beginnings of
4 to 6 letters (so inflected forms meet), with log counts; an L1 penalty leaves the few that
tell grades apart.

The model is fitted on a bounded sample of labelled documents: at most ``SAMPLE`` of each
label value, whole texts, by the order of a hash of the id; both values weigh the same, so the
probabilities are for an even prior. Every document is then scored on its whole text.

Grades of the ``labels`` table: 0 where toxic is 0; toxic documents get 1, or 2 where they
hold at least as many marked words (words that the labels show to be toxic) as the median one.

Defined cases: a null or wordless text has only the base rate; labels without a document or
with a null value are not used; several labels of a document count as several examples; with
no labels of both values, or no feature that tells them apart, nothing is learned, and every
severity is 0 and no row toxic; an empty table gives no rows; further columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2048  # labelled documents of each label value
BITS = 24  # of a hashed feature
FEATURES = 8192  # kept for the fit at most, by their evidence in the sample
RATIO, EVIDENCE = 3.5, 12.0  # least log ratio, and least evidence (about six standard deviations without effect)
RATIO_SHARE, EVIDENCE_SHARE = 0.4, 0.7  # of the highest possible log ratio, and of the best evidence, where these are less
MOST = 7  # count from which more of a feature adds nothing
TOXIC = 0.5  # probability of a grade above 0 from which a document is rejected

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    names = [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]
    return tuple(xxhash.xxh3_64_intdigest(n) >> (64 - BITS) for n in names)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their counts."""
    counts: Counter[int] = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for f in word_features(word):
            counts[f] += n
    return np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.int32, len(counts))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column("text")]
        made = [pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), *made], names=["toxic", "at", "n"])


def level(n):
    """A feature's value: its log count, alike from ``MOST`` on."""
    return np.log1p(np.minimum(n, MOST))


@dataclass
class Ordinal:
    """Weights by hashed feature, and the rising thresholds."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.empty(0))

    def above(self, score: float) -> np.ndarray:
        """P(grade > j) for every threshold j."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))


class Sparse:
    """Rows of (column, value) pairs: products from both sides."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], columns: int):
        self.shape = (len(rows), columns)
        self.row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
        self.column = np.concatenate([c for c, _ in rows]) if rows else np.empty(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.empty(0)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * g[self.row], self.shape[1])


def fit_ordinal(x: Sparse, grade: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, rounds: int = 400, pace: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least weighted negative log likelihood plus L1 penalty, by
    adaptive gradient steps (Adam) that shrink to 0, each followed by soft thresholding. The
    thresholds are a first one and positive gaps, so they stay in order."""
    top, rows, columns = int(grade.max()), np.arange(len(grade)), x.shape[1]
    weight = weight / weight.sum()
    share = np.clip([weight[grade > j].sum() for j in range(top)], 1e-6, 1 - 1e-6)
    start = np.log((1 - share) / share)
    at = np.concatenate((np.zeros(columns), start[:1], np.log(np.maximum(np.diff(start), 0.1))))
    mean, square = np.zeros_like(at), np.zeros_like(at)

    def cuts() -> np.ndarray:
        return at[columns] + np.concatenate(([0.0], np.cumsum(np.exp(at[columns + 1:]))))
    zero = np.zeros((len(grade), 1))
    for t in range(1, rounds + 1):
        up = 1 / (1 + np.exp(-np.clip(x.times(at[:columns])[:, None] - cuts()[None, :], -30, 30)))  # P(grade > j)
        edge, slope = np.hstack((zero + 1, up, zero)), np.hstack((zero, up * (1 - up), zero))
        scale = weight / np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-9)
        low, high = slope[rows, grade] * scale, slope[rows, grade + 1] * scale
        by_cut = np.bincount(grade, low, top + 2) - np.bincount(grade + 1, high, top + 2)
        by_cut = by_cut[1:top + 1]
        gaps = np.array([by_cut[j:].sum() for j in range(1, top)]) * np.exp(at[columns + 1:])
        g = np.concatenate((x.back(high - low), [by_cut.sum()], gaps))
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        step = pace * (1 - t / (rounds + 1)) * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-10)
        at = at - step
        shrink = pace * (1 - t / (rounds + 1)) * penalty
        at[:columns] = np.sign(at[:columns]) * np.maximum(np.abs(at[:columns]) - shrink, 0)
    return at[:columns], cuts()


def evidence(rows: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray) -> dict[int, float]:
    """Features that mark positive rows, with how sure that is: the smoothed log ratio of
    their shares, at least ``RATIO``, times the root of their rows, at least ``EVIDENCE``.
    Few rows cannot give so much. There, the floors are shares of the log ratio that a feature
    of all positive and no other rows has, and of the best evidence found."""
    df, pos = Counter(), Counter()
    for (at, _), y in zip(rows, positive, strict=True):
        df.update(at.tolist())
        if y:
            pos.update(at.tolist())
    n_pos, n_neg = int(positive.sum()), int((~positive).sum())
    most = float(np.log((n_pos + 0.5) / (n_pos + 1)) - np.log(0.5 / (n_neg + 1)))
    least = min(RATIO, RATIO_SHARE * most)
    out = {}
    for f, n in df.items():
        ratio = float(np.log((pos[f] + 0.5) / (n_pos + 1)) - np.log((n - pos[f] + 0.5) / (n_neg + 1)))
        if ratio >= least:
            out[f] = ratio * float(np.sqrt(n))
    sure = min(EVIDENCE, EVIDENCE_SHARE * max(out.values(), default=0.0))
    return {f: e for f, e in out.items() if e >= sure}


def graded(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 of labelled rows."""
    marks = evidence(rows, toxic)
    found = np.array([sum(min(int(k), MOST) for f, k in zip(at.tolist(), n.tolist(), strict=True) if f in marks) for at, n in rows])
    return np.where(toxic, np.where(found >= max(1, np.median(found[toxic])), 2, 1), 0)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column, as views of its chunks."""
    out = []
    for chunk in column.chunks:
        out += np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1]) if len(chunk) else []
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """The model of (doc_id, text) and (doc_id, toxic)."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", "toxic").distinct()
    shares = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    chosen = None
    for value in sorted(shares):
        some = usable.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    if len(shares) < 2:
        return Ordinal()
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one for each label
    found = texts.select("toxic", "text").mapInArrow(_featured, "toxic int, at array<int>, n array<int>").toArrow()
    # as arrays all along: the sample's numbers as Python objects would take ten times the driver's memory
    rows = list(zip(_lists(found.column("at")), _lists(found.column("n")), strict=True))
    toxic = found.column("toxic").to_numpy() == 1
    if not toxic.any() or toxic.all():
        return Ordinal()
    grade = graded(rows, toxic)
    proof = evidence(rows, toxic)
    kept = sorted(proof, key=lambda f: (-proof[f], f))[:FEATURES]
    place = {f: i for i, f in enumerate(kept)}
    packed = []
    for at, n in rows:
        own = [(place[f], k) for f, k in zip(at.tolist(), n.tolist(), strict=True) if f in place]
        packed.append((np.array([c for c, _ in own], np.int64), level(np.array([k for _, k in own], float))))
    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    w, thresholds = fit_ordinal(Sparse(packed, len(kept)), grade, weight)
    weights = {f: float(w[i]) for f, i in place.items() if w[i] != 0}
    return Ordinal(weights, thresholds) if weights else Ordinal()


def severity(text: Column, model: Ordinal) -> Column:
    """Struct of a text's expected severity, p_toxic (P(grade > 0)) and likeliest grade."""
    weights, thresholds = model.weights, model.thresholds

    @F.pandas_udf("severity double, p_toxic double, grade int")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}  # the features with a weight, of words met before
        for batch in batches:
            out = []
            for one in batch:
                counts: dict[int, int] = {}
                for word, n in Counter(_WORD.findall((one or "").lower())).items():
                    own = known.get(word)
                    if own is None:
                        if len(known) > 200_000:
                            known.clear()
                        own = known[word] = tuple(f for f in word_features(word) if f in weights)
                    for f in own:
                        counts[f] = counts.get(f, 0) + n
                up = Ordinal(weights, thresholds).above(sum(weights[f] * float(level(n)) for f, n in counts.items()))
                out.append((float(up.sum()), float(up[0]) if len(up) else 0.0, int((up >= 0.5).sum())))
            yield pd.DataFrame(out, columns=["severity", "p_toxic", "grade"])

    return scored(text)


def toxicity_report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, severity, p_toxic, grade, toxic of every row."""
    scored = docs.select("doc_id", severity(F.col("text"), fit(docs, labels, sample)).alias("s"))
    return scored.select("doc_id", "s.severity", "s.p_toxic", "s.grade", (F.col("s.p_toxic") >= TOXIC).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    scored = docs.select(F.struct("*").alias("_row"), severity(F.col("text"), fit(docs, labels, sample)).alias("_s"))
    return scored.where(F.col("_s.p_toxic") < TOXIC).select("_row.*")
