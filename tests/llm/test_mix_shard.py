"""Mixing and sharding against brute force."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from graphloom.llm.mix import mix, mix_report
from graphloom.llm.shard import shard_documents, shard_report


def _report(df):
    return [r.asDict() for r in mix_report(df).collect()]


def _water(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by handing the excess on, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        if not free:
            return {s: most * sizes[s] for s in sizes}
        level = (budget - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in sizes}
        capped |= over


def test_mix_targets_and_nearness(docs_of):
    rows = [(i, "w " * (1 + i * 7 % 23), "en", ["b", "a", "c", None, "d"][i % 5 if i % 3 else 0]) for i in range(400)]
    out = _report(docs_of(rows))
    assert len(out) == 400
    size = defaultdict(int)
    for r in out:
        size[r["source"]] += r["size"]
    want = _water(size)
    taken = defaultdict(int)
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 23 / 2 + 1e-6
    assert sorted(map(str, _report(docs_of(rows[::-1])))) == sorted(map(str, out))


def test_mix_edges(docs_of, spark):
    assert _report(docs_of([])) == []
    rows = [(1, None, None, "a"), (2, "", None, "a"), (None, "x y z", None, None), (3, "x y z", None, None), (3, "x y z", None, None)]
    out = _report(docs_of(rows))
    assert len(out) == 5 and all(r["taken"] <= 2 * r["size"] for r in out)
    assert sum(r["size"] for r in out) == 9
    wide = docs_of(rows).withColumns({"whole": F.lit(1), "cut": F.lit(2), "hash": F.lit(3), "row": F.lit(4)})
    mixed = mix(wide)
    assert mixed.columns == wide.columns
    assert mixed.where("text IS NULL OR text = ''").count() == 0
    assert sum(len(r["text"].split()) for r in mixed.collect()) == sum(r["taken"] for r in out)


def _least_capacity(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        mid, n, used = (low + high) // 2, 1, 0
        for s in sizes:
            if used + s > mid:
                n, used = n + 1, 0
            used += s
        low, high = (low, mid) if n <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("bins", [8, 64, 1 << 14])
def test_shard_capacity_is_minimal(spark, docs_of, bins):
    from graphloom.llm.shard import digest, shard_of, shard_plan, size_of

    texts = [f"text {i * 37 % 211} " * (1 + i * i % 41) for i in range(600)]
    df = docs_of(list(enumerate(texts)))
    rows = df.select(digest(F.col("text")).alias("digest"), size_of(F.col("text")).alias("size"))
    _, cuts, capacity = shard_plan(rows, 16, bins)
    per_group = {r["digest"]: r["s"] for r in rows.groupBy("digest").agg(F.sum("size").alias("s")).collect()}
    assert capacity == _least_capacity([per_group[g] for g in sorted(per_group)], 16)
    load = [r["s"] for r in rows.groupBy(shard_of(F.col("digest"), cuts).alias("k")).agg(F.sum("size").alias("s")).collect()]
    assert max(load) == capacity and sum(load) == sum(per_group.values())


def test_shard_report(small_docs):
    out = shard_report(small_docs).toPandas()
    assert len(out) == small_docs.count() and set(out["law"]) == {"bytes"} and set(out["shard"]) <= set(range(16))
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    of = defaultdict(set)
    for i, s in zip(out["doc_id"], out["shard"]):
        of[texts[i]].add(s)
    assert all(len(s) == 1 for s in of.values())


def test_shard_edges(docs_of):
    assert shard_report(docs_of([])).count() == 0
    rows = [(1, None), (2, ""), (3, ""), (3, ""), (None, "ä" * 5000), (4, "b")]
    out = [r.asDict() for r in shard_report(docs_of(rows)).collect()]
    assert sorted(r["size"] for r in out) == [1, 1, 1, 1, 2, 10001]
    assert len({(r["shard"], r["slot"]) for r in out}) == 6
    assert [r["text_crc32"] for r in out if r["doc_id"] == 1] == [None]
    wide = docs_of(rows).withColumns({"shard": F.lit("mine"), "digest": F.lit("d")}).drop("shard")
    assert shard_documents(wide).columns == [*wide.columns, "shard"]
    assert shard_documents(docs_of([(i, "same text") for i in range(50)])).select("shard").distinct().count() == 1


@pytest.mark.parametrize("bins", [8, 1 << 14])
@pytest.mark.parametrize("kind", ["one hot", "two hot", "pareto"])
def test_hot_and_heavy_tailed_sizes_end_in_few_divisions(spark, monkeypatch, kind, bins):
    import random

    from graphloom.llm import shard as S

    rng = random.Random(kind)
    sizes = [int(rng.paretovariate(1.1) * 500) if kind == "pareto" else rng.randint(200, 6000) for _ in range(2000)]
    for at in {"one hot": [1000], "two hot": [7, 1500], "pareto": []}[kind]:
        sizes[at] = sum(sizes) // 3
    made = []

    class Counted(S.Ends):
        def __init__(self, *args):
            made.append(self)
            super().__init__(*args)

    monkeypatch.setattr(S, "Ends", Counted)
    rows = spark.createDataFrame([(f"{i:08x}", s) for i, s in enumerate(sizes)], "digest string, size long")
    _, cuts, capacity = S.shard_plan(rows, 16, bins)
    assert capacity == _least_capacity(sizes, 16) and len(cuts) == 15
    assert made[0].divisions <= 10
    shard, loads = 0, [0] * 16
    for i, s in enumerate(sizes):
        shard = sum(c is None or f"{i:08x}" > c for c in cuts)
        loads[shard] += s
    assert max(loads) <= capacity


def test_an_empty_text_is_not_taken_beyond_its_whole_copies(docs_of):
    from graphloom.llm.mix import mix

    rows = [(i, None, None, "b") for i in range(40)] + [(100 + i, "w " * (1 + i % 7), None, "ab"[i % 2]) for i in range(60)]
    taken = mix(docs_of(rows)).groupBy("doc_id").count().collect()
    assert max(r["count"] for r in taken) <= 2
