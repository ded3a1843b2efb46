"""Near-duplicates and components against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.llm.components import components
from graphloom.llm.near import apart, near_dedup, near_report


def _brute(rows, k=4, percent=80):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def _corpus(seed, groups=6, copies=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(40, 120))] + passage
        for c in range(copies if g < 3 else 3):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    rows += [(None, rows[0][1]), (None, "lonely words only here"), (5, rows[5][1]), (900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one\tTWO"), (905, "é É")]
    return rows


@pytest.mark.parametrize("tile", [512, 3])
def test_near_matches_brute_force(docs_of, tile):
    rows = _corpus(7)
    out = near_report(docs_of(rows), tile=tile).collect()
    assert sorted(map(tuple, out), key=str) == _brute(rows)


def test_near_dedup_keeps_one_of_each(docs_of):
    rows = _corpus(11)
    brute = _brute(rows, k=5)
    wide = docs_of(rows).withColumns({"node": F.lit("x"), "component": F.lit(1), "_id": F.lit(2)})
    kept = near_dedup(wide)
    assert kept.columns == wide.columns
    out = kept.collect()
    worded = [r for r in out if (r["text"] or "").split()]
    groups = {b[2] for b in brute if b[1] and b[2] is not None}
    assert {r["doc_id"] for r in worded if r["doc_id"] is not None} == groups
    assert len(worded) == len(groups) + 1  # and the row without an id that nothing else is near
    assert sum(not (r["text"] or "").split() for r in out) == 3


def test_near_shared_passage(docs_of):
    """Texts that share half their words, at many similarities around the threshold: no link
    is lost in a bucket that holds them all."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(260):
        own = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5, 6])):
            own[at] = rng.choice(words)
        rows.append((i, " ".join(own)))
    for tile in (512, 40):
        assert sorted(map(tuple, near_report(docs_of(rows), tile=tile).collect()), key=str) == _brute(rows)


def test_sets_that_share_half_a_hash(spark):
    rows = spark.createDataFrame([(1, 4, 7, 70), (2, 4, 7, 71), (3, 4, 7, 71), (4, 4, 8, 80), (5, 0, None, None)], "doc_id long, n long, node long, check long")
    out = {r["doc_id"]: (r["node"], r["lo"]) for r in apart(rows).collect()}
    assert out[2] == out[3] and out[1][0] != out[2][0] and out[4] == (8, 8) and out[5] == (None, None)
    assert [out[i][1] for i in (1, 2)] == [7, 7]


def test_near_dedup_repeated_ids(docs_of):
    """Rows equal in id and text: the one that stays does not depend on the order."""
    rows = [(1, "one two three four five six")] * 3
    wide = [docs_of(rows).withColumn("source", F.lit(x)) for x in "cab"]
    for order in ((0, 1, 2), (2, 0, 1)):
        docs = wide[order[0]].unionByName(wide[order[1]]).unionByName(wide[order[2]])
        assert [r["source"] for r in near_dedup(docs).collect()] == ["a"]


def test_near_empty(docs_of):
    assert near_report(docs_of([])).collect() == []
    assert near_dedup(docs_of([])).collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(90)] + [(7, 7), (0, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    out = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
