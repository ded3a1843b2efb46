"""Language identification by interpolated Kneser-Ney character models.

Texts become letters in lower case with one boundary mark for everything between them. The
counts of the longest n-grams come from Spark; from them the driver builds, order by order,
sorted arrays of n-gram hashes with a column of log probabilities for each language, and of
context hashes with a column of back-off weights. A text is looked up by binary search; an
n-gram that no language has seen backs off to its suffix. The language with the lowest
cross-entropy per character wins.

The models are fitted on a hash sample of the learning rows: about ``DOCS`` per language,
four fifths of them for the counts, one fifth to calibrate. Calibration fits the
temperature that turns cross-entropies into a score, and for each language the
cross-entropy beyond which a text is rejected as unlike all it has learned.

Defined cases: a null text or one without a letter is ``und`` with score 0 and never
rejected; rows without a language, or held out, are not learned from; with nothing to learn
every row is ``und``; repeated rows get the same answer each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 4
DOCS = 1000  # learning rows sampled for each language
REJECT = 0.999  # share of a language's own texts that its rejection limit lets pass
UNKNOWN = "und"
_P = np.uint64(0x9E3779B97F4A7C15)


_TABLE: list[np.ndarray] = []  # filled once in each worker


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, 0 where it is no letter."""
    if not _TABLE:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x34000):  # no letters are assigned beyond
            if chr(c).isalpha():
                low = chr(c).lower()
                out[c] = ord(low) if len(low) == 1 else c
        _TABLE.append(out)
    return _TABLE[0]


def letters(text: str | None) -> np.ndarray:
    """Letters of a text in lower case, one 0 for all between them and at the end; empty if
    there is no letter."""
    if not text:
        return np.empty(0, np.uint64)
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    codes = codes[keep].astype(np.uint64)
    if len(codes) and codes[0] == 0:
        codes = codes[1:]
    if len(codes) and codes[-1] != 0:
        codes = np.append(codes, np.uint64(0))
    return codes


def hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order up to ``order`` the hash of the n-gram that ends at each position; the
    text is preceded by boundary marks."""
    base = codes + np.uint64(1)
    out = [base]
    for _ in range(1, order):
        earlier = np.concatenate(([_start(len(out))], out[-1][:-1]))
        out.append(earlier * _P + base)
    return out


def _start(n: int) -> np.uint64:
    """Hash of n boundary marks."""
    h = 0
    for _ in range(n):
        h = (h * int(_P) + 1) % (1 << 64)
    return np.uint64(h)


def _counted(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                by.setdefault(lang, []).append(letters(text.as_py()))
            for lang, texts in by.items():
                padded = [np.concatenate((np.zeros(order - 1, np.uint64), t)) for t in texts if len(t)]
                if not padded:
                    continue
                grams = np.concatenate([np.lib.stride_tricks.sliding_window_view(t, order) for t in padded])
                found, n = np.unique(grams, axis=0, return_counts=True)
                names = ["".join(map(chr, g)) for g in found.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(names), pa.array(n, pa.int64())], names=["lang", "gram", "n"])
    return run


@dataclass
class Model:
    """``grams[i]``: sorted hashes and log probabilities (a column a language) of order
    i + 1; ``contexts[i]``: sorted hashes and log back-off weights of contexts of i letters
    (none for i = 0); ``unseen``: log probability of a letter that nobody has seen."""

    langs: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray] | None]
    unseen: np.ndarray
    temperature: float = 1.0
    limits: np.ndarray | None = None

    def cross_entropy(self, codes: np.ndarray) -> np.ndarray:
        """Per language, mean negative log probability of the letters."""
        total = np.zeros(len(self.langs))
        by_order = hashes(codes, len(self.grams))
        left = np.arange(len(codes))
        for n in range(len(self.grams), 0, -1):
            keys, logs = self.grams[n - 1]
            own = by_order[n - 1][left]
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            seen = keys[at] == own
            total += logs[at[seen]].sum(axis=0, dtype=np.float64)
            left = left[~seen]
            if n > 1 and len(left):
                keys, logs = self.contexts[n - 1]
                before = np.concatenate(([_start(n - 1)], by_order[n - 2]))[left]
                at = np.minimum(np.searchsorted(keys, before), len(keys) - 1)
                total += logs[at[keys[at] == before]].sum(axis=0, dtype=np.float64)
        total += len(left) * self.unseen
        return -total / len(codes)


def kneser_ney(langs: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated models from the longest n-grams: ``grams`` has a row of letters for each,
    ``counts`` a column for each language. A shorter n-gram counts its left extensions."""
    order, orders = grams.shape[1], []
    while True:
        orders.append((grams, counts))
        if grams.shape[1] == 1:
            break
        shorter, of = np.unique(grams[:, 1:], axis=0, return_inverse=True)
        left = np.zeros((len(shorter), counts.shape[1]))
        np.add.at(left, of.reshape(-1), counts > 0)
        grams, counts = shorter, left
    below, below_grams, out, contexts, unseen = None, None, [], [], None
    for grams, counts in reversed(orders):
        n = grams.shape[1]
        ones, twos = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
        discount = np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5).clip(0.1, 0.9)
        heads, of = np.unique(grams[:, :-1], axis=0, return_inverse=True)
        of = of.reshape(-1)
        sums, kinds = np.zeros((2, len(heads), counts.shape[1]))
        np.add.at(sums, of, counts)
        np.add.at(kinds, of, counts > 0)
        weight = np.where(sums > 0, discount * kinds / np.maximum(sums, 1), 1.0)
        if below is None:
            lower = np.full(counts.shape, 1.0 / (len(grams) + 1))
            unseen = np.log(weight[0] / (len(grams) + 1))
        else:
            lower = below[_rows(below_grams, grams[:, 1:])]
        prob = np.maximum(counts - discount, 0) / np.maximum(sums[of], 1) + weight[of] * lower
        below, below_grams = prob, grams
        keys = _hash_rows(grams)
        by = np.argsort(keys)
        out.append((keys[by], np.log(prob[by]).astype(np.float32)))
        if n == 1:
            contexts.append(None)
        else:
            keys = _hash_rows(heads)
            by = np.argsort(keys)
            contexts.append((keys[by], np.log(weight[by]).astype(np.float32)))
    assert len(out) == order
    return Model(langs, out, contexts, unseen)


def _hash_rows(grams: np.ndarray) -> np.ndarray:
    h = np.zeros(len(grams), np.uint64)
    for column in grams.T:
        h = h * _P + column.astype(np.uint64) + np.uint64(1)
    return h


def _rows(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    keys = _hash_rows(table)
    by = np.argsort(keys)
    return by[np.searchsorted(keys[by], _hash_rows(wanted))]


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**model.value)
        for batch in batches:
            out = []
            for text in batch.column("text"):
                codes = letters(text.as_py())
                out.append(m.cross_entropy(codes).tolist() if len(codes) else None)
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.list_(pa.float64()))], names=[*names, "entropy"])
    return run


def _share(key: Column) -> Column:
    """A number from 0 to 1 that belongs to a row's key."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def fit(rows: DataFrame, docs: int = DOCS, order: int = ORDER) -> Model | None:
    """Models and calibration from (key, text, lang); None if there is nothing to learn."""
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    limit = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, docs / sizes[lang]))])
    share = _share(F.col("key")) / F.element_at(limit, F.col("lang"))
    sample = known.withColumn("share", share).where("share < 1").select("lang", "text", "share")
    counted = sample.where("share < 0.8").select("lang", "text").mapInArrow(_counted(order), "lang string, gram string, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()  # bounded by the sample
    if not found:
        return None
    names = sorted({r["gram"] for r in found})
    place, column = {g: i for i, g in enumerate(names)}, {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((len(names), len(langs)))
    for r in found:
        counts[place[r["gram"]], column[r["lang"]]] = r["n"]
    model = kneser_ney(langs, np.array([[ord(c) for c in g] for g in names], np.uint64), counts)
    own = sample.where("share >= 0.8").select("lang", "text").mapInArrow(_scored(rows.sparkSession.sparkContext.broadcast(vars(model))), "lang string, entropy array<double>")
    held = [(column[r["lang"]], r["entropy"]) for r in own.where("entropy IS NOT NULL").collect()]
    return calibrated(model, held)


def calibrated(model: Model, held: list[tuple[int, list[float]]]) -> Model:
    """Temperature of least log loss, and each language's rejection limit."""
    limits = np.full(len(model.langs), np.inf)
    if held:
        truth, entropy = np.array([h[0] for h in held]), np.array([h[1] for h in held])

        def loss(t: float) -> float:
            p = _softmax(entropy, t)[np.arange(len(truth)), truth]
            return -float(np.log(np.maximum(p, 1e-12)).mean())
        model.temperature = min((2.0 ** k for k in range(0, 9)), key=loss)
        for k in range(len(model.langs)):
            if (truth == k).any():
                limits[k] = np.quantile(entropy[truth == k, k], REJECT)
    model.limits = limits
    return model


def _softmax(entropy: np.ndarray, temperature: float) -> np.ndarray:
    x = np.exp(-temperature * (entropy - entropy.min(axis=-1, keepdims=True)))
    return x / x.sum(axis=-1, keepdims=True)


def _judged(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**model.value)
        for batch in batches:
            out = []
            for text in batch.column("text"):
                codes = letters(text.as_py())
                if not len(codes):
                    out.append((UNKNOWN, 0.0, None, False))
                    continue
                entropy = m.cross_entropy(codes)
                best = int(entropy.argmin())
                out.append((m.langs[best], float(_softmax(entropy, m.temperature)[best]), float(entropy[best]), bool(entropy[best] > m.limits[best])))
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            made = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*names, "lang_pred", "score", "cross_entropy", "rejected"])
    return run


_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"


def language_report(docs: DataFrame, per_language: int = DOCS, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of every row. Rows whose
    crc32 of the id as text leaves 2 modulo 4 are held out; a null id counts as ''."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = (F.crc32(key) % 4) == 2
    model = fit(docs.where(~held).select(key.alias("key"), "text", "lang"), per_language, order)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected"))
    return rows.mapInArrow(_judged(docs.sparkSession.sparkContext.broadcast(vars(model))), _PREDICTED)
