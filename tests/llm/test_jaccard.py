"""The Jaccard join against brute force, with one tile and many; bounds of the trees."""

import random

import numpy as np
import pytest

from graphloom.llm.jaccard import CountTree, bits_of, candidate_pairs, folded, forest, jaccard_components, keys_of, packed, point, unpacked


def _brute(rows, k=4, percent=85):
    def grams(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    sets = [grams(t) for _, t in rows]
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
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=str)


def _corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(5):
        base = [rng.choice(words) for _ in range(rng.randint(30, 120))] + passage
        for _ in range(60 if g < 2 else 4):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows) + 1, " ".join(own[:rng.choice([len(own), len(own) - 3])])))
    rows += [(None, rows[0][1]), (None, "lonely words only here"), (5, rows[5][1]), (900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one\tTWO"), (905, "é É")]
    return rows


@pytest.mark.parametrize("tile, most", [(512, 4096), (20, 4096), (5, 10)])
def test_components_match_brute_force(docs_of, tile, most):
    rows = _corpus(3)
    got = jaccard_components(docs_of(rows), tile=tile, most=most).collect()
    assert sorted(map(tuple, got), key=str) == _brute(rows)


def test_defined_cases(spark):
    rows = [(1, None, 1, 2), (1, None, 1, 2), (2, "a b c d e", 1, 2), (2, "a b c d e", 1, 2), (None, "a b c d e", 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node long, lo long")
    assert sorted(map(str, map(tuple, jaccard_components(frame).collect()))) == ["(1, 0, 1)", "(1, 0, 1)", "(2, 2, 2)", "(2, 2, 2)", "(None, 2, 2)"]
    empty = jaccard_components(frame.where("false"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id"]


def _sets(rng, n):
    """Sets of 20 to 200 numbers: some random ones, some near copies of each other."""
    out = []
    while len(out) < n:
        base = rng.integers(0, 2**63, rng.integers(20, 200)).astype(np.uint64) * np.uint64(2)
        for _ in range(rng.integers(1, 12)):
            own = base.copy()
            at = rng.integers(0, len(own), rng.integers(0, max(1, len(own) // 8)))
            own[at] = rng.integers(0, 2**63, len(at)).astype(np.uint64)
            out.append(np.unique(own))
    return out[:n]


def _linked(x, y, percent):
    both = len(np.intersect1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


def test_tree_keeps_every_link_and_drops_unrelated_pairs():
    sets = _sets(np.random.default_rng(1), 600)
    tree = CountTree(np.array([point(s) for s in sets]), np.array([len(s) for s in sets]))
    assert len(tree.levels) == 3
    kept = {(min(i, j), max(i, j)) for a, b in tree.pairs(85) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    links = {(i, j) for j in range(600) for i in range(j) if _linked(sets[i], sets[j], 85)}
    assert links and links <= kept
    assert len(kept) < 0.05 * 600 * 599 / 2


def test_points_of_all_resolutions_keep_links_and_tell_long_texts_apart():
    rng = np.random.default_rng(4)
    assert [bits_of(n) for n in (0, 1, 1024, 1025, 2048, 2049, 65536, 10**6)] == [6, 6, 6, 7, 7, 8, 12, 12]
    sets = []
    for n in (900, 1000, 1024, 1025, 1100, 2040, 2060, 9000):
        base = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        for share in (0, 0.04, 0.07):
            sets.append(np.unique(np.concatenate((base[:int(n * (1 - share))], rng.integers(0, 2**63, int(n * share)).astype(np.uint64)))))
    points = [point(s) for s in sets]
    assert all((unpacked(packed(p)) == p).all() for p in points)
    assert (folded(points[-1], 6) == np.bincount((sets[-1] >> np.uint64(58)).astype(int), minlength=64)).all()
    kept = {(min(i, j), max(i, j)) for a, b in candidate_pairs(points, np.array([len(s) for s in sets]), 85) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    links = {(i, j) for j in range(len(sets)) for i in range(j) if _linked(sets[i], sets[j], 85)}
    assert links == kept


def test_forest_connects_what_links_connect():
    sets = _sets(np.random.default_rng(2), 150)
    root = list(range(150))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for j in range(150):
        for i in range(j):
            if _linked(sets[i], sets[j], 85):
                root[find(i)] = find(j)
    want = [find(i) for i in range(150)]
    links = forest(sets, 85)
    assert len(links) == 150 - len(set(want)) and all(want[i] == want[j] for i, j in links)
    half = [i % 2 for i in range(150)]
    across = forest(sets, 85, parts=list(range(150)), sides=half)
    assert all(half[i] != half[j] and want[i] == want[j] for i, j in across)
    assert forest(sets, 85, parts=want) == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    sums = rng.integers(0, 1000, 1 << 16)
    sets = _sets(rng, 200)
    keys = [set(keys_of(s, sums, 85).tolist()) for s in sets]
    assert all(keys[i] & keys[j] for j in range(200) for i in range(j) if _linked(sets[i], sets[j], 85))
