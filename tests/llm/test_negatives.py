"""Hard negatives against brute force; the bounds; rows that the bounds leave to be scored."""

import numpy as np
import pytest

from graphloom.llm.negatives import Part, Summaries, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def _brute(rows, every, positives=5, negatives=10, low=30, high=90):
    usable = [(i, v, x) for i, (v, e, x, _) in enumerate(rows) if x is not None and e is not None and all(c is not None and np.isfinite(c) for c in e) for e in [e]]
    width = max((len(rows[i][1]) for i, _, _ in usable), default=0)
    vec = {i: np.array([int(np.floor(256 * float(np.float32(c)))) for c in rows[i][1]] + [0] * (width - len(rows[i][1]))) for i, _, _ in usable}
    key = lambda score, v, i: (-score, v is None, v or 0, i)
    out = []
    for a, a_id, a_label in usable:
        if a_id is None or a_id % every:
            continue
        score = {i: int(vec[a] @ vec[i]) for i, _, _ in usable}
        same = sorted((key(score[i], v, i) for i, v, x in usable if x == a_label and i != a))[:positives]
        for s, *_, p in same:
            ps = -s
            other = sorted(key(score[i], v, i) for i, v, x in usable if x != a_label and low * ps <= 100 * score[i] <= high * ps)
            out += [(a_id, rows[p][0], n + 1, rows[i][0], ps, -t) for n, (t, *_, i) in enumerate(other[:negatives])]
    return out


def _rows(seed, n=600, d=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        x = centres[rng.integers(6)] + 0.6 * rng.normal(size=d)
        x = [float(np.float32(c)) for c in x / np.linalg.norm(x)]
        rows.append((i, x, int(rng.integers(4)) if i % 3 else 0, "k"))
    return rows


@pytest.mark.parametrize("part", [4096, 100, 7])
def test_negatives_match_brute_force(spark, part):
    rows = _rows(2)
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), every=50, part=part).collect()
    assert sorted(map(tuple, got)) == sorted(_brute(rows, 50))


def test_defined_cases(spark):
    e = [1.0, 0.5]
    rows = [(0, e, 1, "k"), (0, e, 1, "k"), (50, e, 2, "k"), (None, e, 2, "k"), (7, None, 1, "k"), (8, [1.0, None], 1, "k"), (9, [float("nan"), 1.0], 2, "k"),
            (10, [0.5], 2, "k"), (11, [0.5, 0.25, 0.0], 1, "k"), (12, [0.4, 0.4], None, "k"), (13, [], 2, "k"), (100, [-1.0, 0.0], 3, "k"), (101, [1.0, 0.0], 3, "k")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(str, map(tuple, hard_negatives(frame, every=50).collect())))
    assert got == sorted(map(str, _brute(rows, 50)))
    assert not [r for r in got if r.startswith("(100,")]  # its only positive scores below zero
    empty = hard_negatives(frame.where("false"))
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_hold_and_rule_rows_out():
    rng = np.random.default_rng(5)
    centres = 100 * rng.normal(size=(8, 16)).repeat(4, axis=1)  # segments with small deviations
    of = np.arange(800) % 8
    v = np.floor(centres[of] + 3 * rng.normal(size=(800, 64))).astype(np.int64)
    part = Part(np.arange(800), np.arange(800), of, v)
    queries = Summaries(v[:8])
    exact = v[:8] @ part.v.T
    for level in range(3):
        low, high = queries.bounds(level, part.summaries, np.arange(800))
        assert (low <= exact).all() and (exact <= high).all()
    at, open_ = part.left(queries, np.ones((8, 800), bool), np.full(8, -np.inf), np.full(8, np.inf), 5)
    assert open_.sum() < 8 * 200  # of 8 * 800
    full = np.zeros((8, 800), bool)
    full[:, at] = open_
    for i in range(8):
        assert full[i][np.argsort(-exact[i])[:5]].all()
