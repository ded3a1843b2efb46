"""MinHash near-duplicates: many universal hash minima, banding, signature verification,
exact confirmation on full shingle sets, components by large-star and small-star.

1.  One pass over the texts gives each row its set class (hash of the sorted shingle
    hashes), set size, 32 band keys of 4 minima each, and 2 bits of all 128 minima.
2.  Rows that share a band key share a bucket, and every bucket links its members to a pivot.
    Pairs whose sizes allow the threshold and whose signatures agree in nearly the expected
    number of minima are confirmed on their full sets; the links make first components.
3.  Most buckets then stand in one component and are done. The others are joined pivot by
    pivot: the members of all its open buckets are cut by hash into tiles, and every pair of
    tiles compares sizes and signatures between components. Members without a candidate go;
    the others' full sets travel once for each pair of tiles they are needed in, and a task
    returns only links that connect something new: fewer than it has members, never pairs.

A link at the threshold is missed with a probability of about 5e-8 by the bands and 5e-6 by
the signatures (32 bands of 4 rows: (1 - 0.8^4)^32), whatever the size of a bucket.

Defined cases: null and wordless texts have an empty set and are linked with nothing; fewer
words than a shingle count as one shingle; equal sets are one class whatever the ids; a null
id never names a component while another id is in reach; an empty table gives no rows.
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

MINIMA, ROWS = 128, 4
BANDS = MINIMA // ROWS
TILE, ROOM = 512, 1 << 20  # members of a tile, and their shingles, on average
AGREE = 90  # of 128 two-bit minima; at similarity 0.8, 108.8 +- 4.0 agree, at 0.5 80 +- 5.5
_BLOCK = 128  # rows of a tile whose signatures are compared at once
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * _ODD)
_A, _B = (_SEEDS[:MINIMA] | np.uint64(1))[:, None], _SEEDS[MINIMA:][:, None]


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles (A-Z in lower case, words split at
    ASCII white space); a shorter text is one shingle, a wordless one has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    n = len(words) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = (s ^ (s >> np.uint64(29))) * _ODD + h[j:j + n]
    return np.unique(_mixed(s))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of the universal hashes (a * x + b, upper half) over a set."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(out, (shingles[None, i:i + 1024] * _A + _B).min(axis=1), out=out)
    return out >> np.uint64(32)


def _class_of(shingles: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


_BAND = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD
_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _sketch(low: np.ndarray) -> list[int]:
    bits = [((low >> np.uint64(b)) & np.uint64(1)).reshape(2, 64) @ _WEIGHTS for b in (0, 1)]
    return [int(x) for pair in bits for x in pair.astype(np.int64)]


_SIGNED = "doc_id long, text_hash long, n long, node long, check long, bands array<long>, sketch array<long>"


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k)
                if not len(s):
                    out.append((0, None, None, None, None))
                    continue
                m = minima(s)
                keys = _BAND
                for column in m.reshape(BANDS, ROWS).T:
                    keys = _mixed((keys ^ column) * _ODD)
                out.append((len(s), *_class_of(s), keys.astype(np.int64), _sketch(m)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *made],
                                             names=["doc_id", "text_hash", "n", "node", "check", "bands", "sketch"])
    return run


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n, node, check, bands, sketch of every row. ``node`` names the class
    of equal sets; ``check`` is the other half of its 128-bit hash."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return apart(stage(rows.mapInArrow(_signed(k), _SIGNED), "signatures"))


def apart(rows: DataFrame) -> DataFrame:
    """``rows``, and ``lo``: the node as it was. Different sets that share a node, which two of
    some billions will, get new ones made of both halves of their hashes."""
    rows = rows.withColumn("lo", F.col("node"))
    clashes = rows.where("n > 0").groupBy("node").agg((F.min("check") != F.max("check")).alias("clash")).where("clash")
    clashes = stage(clashes.select(F.col("node").alias("_clash")), "clashes")
    if clashes.isEmpty():
        return rows
    again = F.when(F.col("_clash").isNull(), F.col("node")).otherwise(F.xxhash64("node", "check"))
    return stage(rows.join(clashes, F.col("node") == F.col("_clash"), "left").withColumn("node", again).drop("_clash"), "signatures")


def classes(rows: DataFrame) -> DataFrame:
    """(node, doc_id): the smallest id of every set class."""
    return stage(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")


def _salt(bucket: Column) -> Column:
    """One of four masks, so that a group met in many buckets gets a few pivots, not many."""
    masks = [0x0, 0x5A5A5A5A5A5A5A5A, 0x33CC33CC33CC33CC, 0x0F1E2D3C4B5A6978]
    return F.get(F.array(*[F.lit(m).cast("long") for m in masks]), F.pmod(bucket, F.lit(4)).cast("int"))


def candidates(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of bucket members with their pivot, and the members of all buckets that
    hold several classes: (bucket, pivot, node, n).

    Sizes further apart than the threshold allows cannot be linked and are left out.
    """
    members = rows.where("n > 0").select(F.explode("bands").alias("bucket"), "node", "n")
    salted = F.col("node").bitwiseXOR(_salt(F.col("bucket")))
    sums = members.groupBy("bucket").agg(F.min(salted).alias("lo"), F.max(salted).alias("hi")).where("lo <> hi")
    buckets = stage(sums.select(F.col("bucket").alias("of"), F.col("lo").bitwiseXOR(_salt(F.col("bucket"))).alias("pivot")), "buckets")
    shared = stage(members.join(buckets, F.col("bucket") == F.col("of")).select("bucket", "pivot", "node", "n").distinct(), "shared")
    pivots = shared.where("node = pivot").select(F.col("bucket").alias("of"), F.col("n").alias("n_p"))
    near = (F.least("n", "n_p") * 100 >= F.greatest("n", "n_p") * percent) & (F.col("node") != F.col("pivot"))
    star = shared.join(pivots, F.col("bucket") == F.col("of")).where(near).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    return star.distinct(), shared


def _agreeing(agree: int) -> Column:
    """Whether the two-bit minima a0..a3 and b0..b3 agree in at least ``agree`` places."""
    differ = [F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")) for i in range(4)]
    apart = F.bit_count(differ[0].bitwiseOR(differ[2])) + F.bit_count(differ[1].bitwiseOR(differ[3]))
    return apart <= MINIMA - agree


def signed_pairs(pairs: DataFrame, rows: DataFrame, agree: int) -> DataFrame:
    """The pairs whose two-bit minima agree in at least ``agree`` places."""
    words = rows.where("n > 0").select("node", *[F.col("sketch")[i].alias(f"w{i}") for i in range(4)]).distinct()
    one = words.select(F.col("node").alias("a"), *[F.col(f"w{i}").alias(f"a{i}") for i in range(4)])
    two = words.select(F.col("node").alias("b"), *[F.col(f"w{i}").alias(f"b{i}") for i in range(4)])
    return pairs.join(one, "a").join(two, "b").where(_agreeing(agree)).select(*pairs.columns)


def _sets(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # rows equal in id and text share a partition
        for batch in batches:
            out = []
            for node, lo, check, text in batch[["node", "lo", "check", "text"]].itertuples(index=False):
                if node not in seen:
                    s = shingle_set(text, k)
                    if _class_of(s) == (lo, check):
                        seen.add(node)
                        out.append((node, s.tobytes()))
            yield pd.DataFrame(out, columns=["node", "shingles"])
    return run


def full_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the given classes, from one text each: the smallest text hash of
    the class, and of its rows the smallest id."""
    own = rows.join(nodes, "node", "left_semi").groupBy("node", "lo", "check", "text_hash").agg(F.min("doc_id").alias("_of"))
    first = own.groupBy("node", "lo", "check").agg(F.min(F.struct("text_hash", "_of")).alias("k")).select("node", "lo", "check", F.col("k.text_hash").alias("_hash"), F.col("k._of").alias("_of"))
    texts = docs.select(F.xxhash64("text").alias("text_hash"), F.col("doc_id").cast("long").alias("_id"), "text")
    one = texts.join(first, (F.col("text_hash") == F.col("_hash")) & F.col("_id").eqNullSafe(F.col("_of")))
    # a row that repeats gives its set once a task; the classes are then one row each
    found = one.select("node", "lo", "check", "text").mapInPandas(_sets(k), "node long, shingles binary")
    return stage(found.dropDuplicates(["node"]), "sets")


def _confirmed(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInPandas(_confirmed(percent), "a long, b long")


def _labelled(frame: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        own = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        frame = frame.join(own, F.col(c) == F.col("_n"), "left").withColumn(f"{c}_of", F.coalesce("_c", c)).drop("_n", "_c")
    return frame


_WORDS = [f"w{i}" for i in range(4)]
_RUN = ["pivot", "t1", "t2"]


def open_tiles(shared: DataFrame, rows: DataFrame, labels: DataFrame, tile: int, room: int) -> DataFrame:
    """The members of all open buckets of a pivot, dealt to pairs of tiles: pivot, t1 <= t2,
    node, n, part (its component), side (its tile; on the diagonal the member itself), w0..w3."""
    own = _labelled(shared, labels, "node")
    ends = own.groupBy("bucket").agg(F.min("node_of").alias("lo"), F.max("node_of").alias("hi")).where("lo <> hi").select(F.col("bucket").alias("of"))
    groups = stage(own.join(ends, F.col("bucket") == F.col("of"), "left_semi").select("pivot", "node", "n", F.col("node_of").alias("part")).distinct(), "open")
    sizes = groups.groupBy("pivot").agg(F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / room)).cast("int").alias("tiles"))
    words = rows.where("n > 0").select(F.col("node").alias("_n"), *[F.col("sketch")[i].alias(w) for i, w in enumerate(_WORDS)])
    words = words.join(groups.select("node").distinct(), F.col("_n") == F.col("node"), "left_semi").dropDuplicates(["_n"])
    at = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("at")
    dealt = groups.join(sizes.withColumnRenamed("pivot", "of"), F.col("pivot") == F.col("of")).select("pivot", "node", "n", "part", "tiles", at)
    dealt = dealt.join(words, F.col("node") == F.col("_n"))
    every = dealt.select("pivot", "node", "n", "part", "at", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"), *_WORDS)
    side = F.when(F.col("at") == F.col("other"), F.col("node")).otherwise(F.col("at"))
    return every.select("pivot", F.least("at", "other").alias("t1"), F.greatest("at", "other").alias("t2"), "node", "n", "part", side.alias("side"), *_WORDS)


def _alike(held: dict[str, np.ndarray], percent: int, agree: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i < j) of two sides and two parts whose sizes and signatures allow a link."""
    n, part, side = held["n"], held["part"], held["side"]
    w = [held[c].astype(np.uint64) for c in _WORDS]  # signed numbers would be counted by their magnitude
    for i in range(0, len(n), _BLOCK):
        x, y = slice(i, i + _BLOCK), slice(i, None)
        differ = [u[x, None] ^ u[None, y] for u in w]
        far = np.bitwise_count(differ[0] | differ[2]) + np.bitwise_count(differ[1] | differ[3])
        fit = (far <= MINIMA - agree) & (part[x, None] != part[None, y]) & (side[x, None] != side[None, y])
        fit &= np.minimum(n[x, None], n[None, y]) * 100 >= np.maximum(n[x, None], n[None, y]) * percent
        a, b = np.nonzero(np.triu(fit, 1))
        if len(a):
            yield a + i, b + i


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of one pair of tiles (rows come sorted by it)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in _RUN]) if batch.num_rows else np.empty((0, 3), np.int64)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *starts], [*starts, len(keys)], strict=True):
            if low == high:
                continue
            if held and not np.array_equal(last, keys[low]):
                yield pa.Table.from_batches(held)
                held = []
            last = keys[low]
            held.append(batch.select(columns).slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


_ALIVE = "pivot long, t1 int, t2 int, node long, n long, part long, side long, w0 long, w1 long, w2 long, w3 long"
_FACTS = ["n", "part", "side", *_WORDS]


def _alive(percent: int, agree: int):
    """The members of each pair of tiles that have a candidate in another component."""
    names = [c.split()[0] for c in _ALIVE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, names):
            held = {c: table.column(c).to_numpy() for c in _FACTS}
            keep = np.zeros(table.num_rows, bool)
            for a, b in _alike(held, percent, agree):
                keep[a] = keep[b] = True
            yield from table.filter(pa.array(keep)).to_batches()
    return run


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _linked(percent: int, agree: int):
    """Links of each pair of tiles, confirmed on full sets, as many as connect its parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["node", *_FACTS, "shingles"]):
            held = {c: table.column(c).to_numpy() for c in _FACTS}
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
            first: dict[int, int] = {}
            parent = [first.setdefault(p, i) for i, p in enumerate(held["part"].tolist())]
            words, ids = np.unique(np.concatenate(sets), return_inverse=True)
            own = np.split(ids, np.cumsum([len(s) for s in sets])[:-1])
            marks, marked, out = np.zeros(len(words), bool), -1, []
            for left, right in _alike(held, percent, agree):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
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
            nodes = table.column("node").to_numpy()
            at = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at[:, 0]]), pa.array(nodes[at[:, 1]])], names=["a", "b"])
    return run


def open_links(docs: DataFrame, rows: DataFrame, tiles: DataFrame, known: DataFrame, k: int, percent: int, agree: int) -> DataFrame:
    """Links (a, b) between components, from the tiles of the open buckets; ``known`` has the
    full sets made before."""
    by_tiles = lambda d: d.repartition(*_RUN).sortWithinPartitions(*_RUN)
    alive = stage(by_tiles(tiles).mapInArrow(_alive(percent, agree), _ALIVE), "alive")
    nodes = alive.select("node").distinct()
    sets = full_sets(docs, rows, nodes.join(known.select("node"), "node", "left_anti"), k).unionByName(known)
    whole = alive.join(sets.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n")).drop("_n")
    return stage(by_tiles(whole).mapInArrow(_linked(percent, agree), "a long, b long"), "links")


def near_components(docs: DataFrame, rows: DataFrame, k: int, percent: int, tile: int = TILE, agree: int = AGREE) -> DataFrame:
    """(node, component) of all classes that are linked with another class."""
    star, shared = candidates(rows, percent)
    star = stage(signed_pairs(star, rows, agree), "pairs")
    sets = full_sets(docs, rows, star.select(F.explode(F.array("a", "b")).alias("node")).distinct(), k)
    links = stage(confirmed(star, sets, percent), "links")
    labels = stage(components(links), "labels")
    more = open_links(docs, rows, open_tiles(shared, rows, labels, tile, ROOM), sets, k, percent, agree)
    return labels if more.isEmpty() else stage(components(links.unionByName(more)), "labels")


def named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component, component_id): the smallest id reachable from each class."""
    own = _labelled(classes(rows), labels, "node").select("node", F.col("node_of").alias("component"), "doc_id")
    least = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return own.select("node", "component").join(least, "component")


def near_report(docs: DataFrame, k: int = 4, percent: int = 80, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = signatures(docs, k)
    names = named(rows, near_components(docs, rows, k, percent, tile)).select(F.col("node").alias("_n"), "component_id")
    out = rows.select("doc_id", "n", "node").join(names, F.col("node") == F.col("_n"), "left")
    id_ = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), id_.alias("component_id"), F.col("doc_id").eqNullSafe(id_).alias("kept"))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the row with the smallest id
    (then the smallest text hash); rows without words all stay. Rows equal in id and text are
    one row."""
    rows = signatures(docs, k)
    names = named(rows, near_components(docs, rows, k, percent, tile)).select("node", "component")
    keyed = rows.where("n > 0").groupBy("node", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_rows"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("n_rows").alias("n_rows"))
    first = keyed.join(names, "node").groupBy("component").agg(F.min(order).alias("k"))
    winners = first.select(F.col("k.id").alias("_id"), F.col("k.hash").alias("_hash"), F.col("k.n_rows").alias("_n"))
    wordless = rows.where("n = 0").select("doc_id", "text_hash").distinct().select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(1).cast("long").alias("_n"))
    winners = stage(winners.unionByName(wordless), "winners")
    own = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own_id"), F.xxhash64("text").alias("_own_hash"))
    match = (F.col("_own_hash") == F.col("_hash")) & F.col("_own_id").eqNullSafe(F.col("_id"))
    out = own.join(winners.where("_n = 1"), match, "left_semi").select("_row.*")
    again = winners.where("_n > 1")
    if again.isEmpty():
        return out
    # which of them: the one whose row as a JSON text is least, so that reruns agree
    repeated = own.join(again, match).groupBy("_id", "_hash").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
    return out.unionByName(repeated)
