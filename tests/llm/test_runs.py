"""Periodic runs against a scan of every lag, and the texts they collapse to."""

import random

import pytest

from graphloom.llm import runs as R
from graphloom.llm.runs import collapsed, overlap, period_classes, periodic_runs, run_report, runs_of


def _brute(w, times=4, least=6):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(least, times * q) and not any(all(w[j] == w[j + p] for j in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(rng):
    alphabet = rng.choice([1, 2, 3, 30])
    out = [rng.randrange(alphabet) for _ in range(rng.randint(0, 50))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.randrange(alphabet) for _ in range(rng.randint(1, 25))]
        out += (unit * 9)[:rng.randint(1, 9 * len(unit))] + [rng.randrange(alphabet) for _ in range(rng.randint(0, 9))]
    return out


@pytest.mark.parametrize("times, least", [(4, 6), (3, 3), (5, 20)])
def test_runs_match_a_scan_of_every_lag(times, least):
    rng = random.Random(times)
    for _ in range(150):
        texts = [_words(rng) for _ in range(5)]
        assert runs_of(texts, times, least) == [_brute(w, times, least) for w in texts]


def test_classes_hold_every_period_with_a_sure_seed():
    classes = list(period_classes(5000))
    assert [q for lo, hi, _ in classes for q in range(lo, hi + 1)][:5000] == list(range(1, 5001))
    assert all(k >= 2 * hi - 1 and all(overlap(q, 4, 6) >= k for q in range(lo, hi + 1)) for lo, hi, k in classes)


def test_equal_upper_bits_fall_back_to_full_hashes():
    import numpy as np

    hashes = np.array([5, 4, 5, 4, 5], np.uint64)  # all upper bits are equal
    at, lag = R.next_same(hashes, np.arange(5))
    assert sorted(zip(at.tolist(), lag.tolist(), strict=True)) == [(0, 2), (1, 2), (2, 2)]


def test_a_very_long_text_and_chunks(monkeypatch):
    unit = [f"w{i}" for i in range(9000)]
    assert runs_of([["x"], unit * 5 + ["end"], ["a"] * 7]) == [[], [(0, 45000, 9000)], [(0, 7, 1)]]
    assert runs_of([["a"] * 200_000]) == [[(0, 200_000, 1)]]


def test_collapsed_keeps_one_period_of_each_run():
    words = b"x a b a b a b a b y z z z z z z".split()
    runs = runs_of([words])[0]
    assert runs == [(1, 8, 2), (10, 6, 1)]
    assert collapsed(words, runs) == b"x a b y z"


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 8)
    rows = [(1, None, 5, "k"), (1, "", 6, "k"), (None, "a a a a a a", 7, "k"), (None, "a a a a a a", 8, "k"), (2, " \n\t", 9, "k"), (3, "é É é É é É é É é\x1cé", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect())
    assert got == [(0, [(0, 6, 1)], "a"), (0, [(0, 6, 1)], "a"), (1, [], ""), (1, [], ""), (2, [], ""), (3, [(0, 8, 2)], "é É é\x1cé")]
    assert periodic_runs(docs, keep=()).columns == ["runs", "collapsed"]
    assert periodic_runs(docs.where("false")).count() == 0
    assert run_report(docs).count() == 6 and run_report(docs.where("false")).count() == 0


def test_planted_runs_are_found(spark):
    import zlib

    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(1, 120)))) for i in range(400)]
    got = {r["doc_id"]: r for r in run_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        words = text.split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[j if j < a else a + (j - a) % p] for j in range(n)]
        runs = _brute(words)
        assert got[i]["n_runs"] == len(runs)
        if runs:
            best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            assert (got[i]["start"], got[i]["length"], got[i]["period"], got[i]["exponent_milli"]) == (*best, 1000 * best[1] // best[2])
