"""Periodic runs of words: seed and extend along diagonals.

A run of period q repeats its words q places on; ``length - q`` places in a row then hold a
word that is the same q places later. A run of at least ``times`` periods (and ``least``
words) so guarantees an overlap of k words for all periods of a class lo..hi, and every
k-gram inside it occurs again q places on. Where k >= 2q - 1, its *next* occurrence in the
document is exactly q places on (two shorter distances inside one run would give it a
smaller period), so the neighbouring occurrences of each k-gram are all the pairs needed:

1.  Classes of periods, each about 1.5 times as wide as the one before, with their own k.
2.  k-grams (64-bit hashes, built by doubling, salted by document) are sorted with their
    positions; neighbours in that order at a lag of the class are seeds. Only stretches in which the
    shortest k-grams recur are looked at beyond the first class.
3.  Seeds are visited by lag and position with a table of the furthest place that each lag's
    extensions cover; a seed inside it is passed over, any other is extended to both sides by
    comparing words. Extensions long enough are the runs.

Hashes only propose: every run is compared word by word. A run can be missed only if a
foreign k-gram of the same document has the same 64-bit hash.

Each text is worked on by itself, many short ones in one array, so nothing is shuffled; a
text may be of any length that a row can hold.

Defined cases: null, empty and wordless texts have no runs and the empty text as collapsed
text; rows that repeat, and null or equal ids, are rows of their own; an empty table gives
no rows; columns that are not in ``keep`` are left out, so their names may be anything.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import WORD

TIMES, LEAST = 4, 6  # a run holds that many periods and words at least
CHUNK = 1 << 19  # words that are worked on at once (or one text, if it is longer)
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

RUNS = "array<struct<start:long,length:long,period:long>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def overlap(period: int, times: int, least: int) -> int:
    """Words in a row that recur one period on in any run of that period."""
    return max(least, times * period) - period


def period_classes(longest: int, times: int = TIMES, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """(lo, hi, k): classes of periods that together hold 1..longest; every run of a period in
    lo..hi overlaps itself in at least k words, and k >= 2 * hi - 1."""
    lo = 1
    while lo <= longest:
        k = min(overlap(q, times, least) for q in range(lo, lo + least + 1))  # grows with q from there on
        hi = max(lo, (k + 1) // 2)
        yield lo, hi, k
        lo = hi + 1


class Grams:
    """Hashes of the k-grams that start at given places."""

    def __init__(self, words: np.ndarray):
        self.powers = [_mixed(words)]

    def at(self, places: np.ndarray, k: int) -> np.ndarray:
        m = k.bit_length() - 1
        while len(self.powers) <= m:
            last, half = self.powers[-1], 1 << (len(self.powers) - 1)
            self.powers.append(_mixed(last[:-half] * _ODD + last[half:]))
        grams = self.powers[m]
        return _mixed(grams[places] * _ODD2 + grams[places + (k - (1 << m))])


def next_same(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag to the next place with the same hash), where there is one. ``places`` ascend."""
    n = len(places)
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = np.sort(((hashes >> bits) << bits) | np.arange(n, dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = hashes[order[1:]] == hashes[order[:-1]]
    if (same != (packed[1:] >> bits == packed[:-1] >> bits)).any():  # the upper bits alone are equal somewhere
        order = np.lexsort((places, hashes))
        same = hashes[order[1:]] == hashes[order[:-1]]
    at = places[order[:-1][same]]
    return at, places[order[1:][same]] - at


def _extended(ids: np.ndarray, seed: int, lag: int, first: int, stop: int) -> tuple[int, int]:
    """The stretch [from, to) around ``seed`` whose words are the same ``lag`` places on."""
    def reach(a: np.ndarray, b: np.ndarray) -> int:
        done, step = 0, 64
        while done < len(a):
            apart = a[done:done + step] != b[done:done + step]
            if apart.any():
                return done + int(apart.argmax())
            done, step = done + step, 2 * step
        return len(a)
    right = reach(ids[seed:stop - lag], ids[seed + lag:stop])
    left = reach(ids[first:seed][::-1], ids[first + lag:seed + lag][::-1])
    return seed - left, seed + right


def runs_of(texts: list[list], times: int = TIMES, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each word list, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    if not total:
        return out
    book: defaultdict = defaultdict(count().__next__)
    ids = np.fromiter(map(book.__getitem__, chain.from_iterable(texts)), np.int64, total)
    last = np.cumsum(sizes)
    of = np.repeat(np.arange(len(texts)), sizes)
    stop = last[of]
    grams = Grams(ids.astype(np.uint64) * _ODD + of.astype(np.uint64) * _ODD2)
    ahead, back = np.zeros(total, np.int64), np.zeros(total, np.int64)  # lags to the shortest k-gram's neighbours
    shortest = 0
    for lo, hi, k in period_classes(int(sizes.max()) // times, times, least):
        if not shortest:
            shortest = k
            places = np.flatnonzero(np.arange(total) + k <= stop)
        else:
            if not ahead.any():
                break
            places = np.flatnonzero((ahead > 0) | (back > 0))
            places = places[places + k <= stop[places]]
            full = np.zeros(len(places), bool)
            for lags in (ahead, back):
                unfit = np.concatenate(([0], np.cumsum((lags == 0) | (lags > hi))))
                full |= unfit[places + (k - shortest + 1)] == unfit[places]
            places = places[full]
        if not len(places):
            continue
        at, lag = next_same(grams.at(places, k), places)
        if k == shortest:
            ahead[at] = lag
            back[at + lag] = lag
        fit = (lag >= lo) & (lag <= hi)
        order = np.lexsort((at[fit], lag[fit]))
        covered: dict[int, int] = {}  # lag -> the furthest place that its extensions cover
        at, lag = at[fit][order], lag[fit][order]
        # neighbouring seeds of one lag are one extension: only the first of them is looked up
        heads = np.flatnonzero(np.concatenate(([True], (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)))) if len(at) else []
        for seed, q in zip(at[heads].tolist(), lag[heads].tolist(), strict=True):
            if seed < covered.get(q, 0):
                continue
            text = int(of[seed])
            first, end = int(last[text] - sizes[text]), int(last[text])
            a, b = _extended(ids, seed, q, first, end)
            covered[q] = b
            if b - a + q >= max(least, times * q):
                out[text].append((a - first, b - a + q, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def _scanned(times: int, least: int, keep: list[str]):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_text = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
        for batch in batches:
            found: list[list] = []
            short: list[bytes] = []
            held: list[list[bytes]] = []

            def work() -> None:
                for words, runs in zip(held, runs_of(held, times, least), strict=True):
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    short.append(collapsed(words, runs))
                held.clear()
            size = 0
            for text in batch.column("_text").cast(pa.binary()):
                words = (text.as_py() or b"").split()
                if held and size + len(words) > CHUNK:
                    work()
                    size = 0
                held.append(words)
                size += len(words)
            work()
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind), pc.cast(pa.array(short, pa.binary()), options=as_text)],
                                             names=[*keep, "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), times: int = TIMES, least: int = LEAST) -> DataFrame:
    """The columns ``keep`` of ``docs`` plus ``runs`` (all maximal runs of the text's words with
    their smallest period, by start, then period) and ``collapsed`` (the text with one period of
    each run). ``times`` is 3 at least."""
    if times < 3:
        raise ValueError("runs of fewer than three periods have no sure seeds")
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col("text").alias("_text"))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = rows.mapInArrow(_scanned(times, least, names), f"{kinds}{', ' * bool(kinds)}runs {RUNS}, collapsed string")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equals; null without runs."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, x: F.when(better(best, x), x).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the text of every tenth document (by the CRC-32 of its id) repeats its own
    words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    rows = rows.select("doc_id", "text", "g", F.when(F.col("g").isNotNull(), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)) + 1)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run and the digests of all runs and of the collapsed text,
    of every row of ``planted``."""
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = periodic_runs(planted(docs)).withColumn("best", strongest(F.col("runs")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
