"""The pipeline over hard input: empty tables, null ids and texts, repeated rows, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"
CLASHING = ("node", "component", "size", "target", "taken", "shard", "_id", "_row", "bucket", "n")


def _text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def _run(spark, path, docs, benchmark=()):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(benchmark), BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(path))


def test_empty_tables(spark, tmp_path):
    assert _run(spark, tmp_path, spark.createDataFrame([], DOCS)).collect() == []


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    leak = _text(99, 20)
    near = _text(1).split()
    near[30] = "changed"
    rows = [(1, _text(1)), (2, _text(1)), (3, " ".join(near) + " " + _text(8, 40)), (4, _text(4)), (4, _text(4)), (4, _text(5)), (None, _text(6)),
            (None, _text(4)), (7, None), (8, ""), (9, " \n\t"), (10, _text(10) + " " + leak + " " + _text(11)), (12, "word " * 30_000), (13, "é")]
    docs = spark.createDataFrame([(i, t, None if i == 13 else "en", None if i in (4, 8) else "a", len(t) if t else None) for i, t in rows], DOCS)
    wide = docs.withColumns({c: F.lit("x") for c in CLASHING})
    out = _run(spark, tmp_path, wide, [(1, leak), (2, None), (3, "")])
    got = out.select("doc_id").collect()
    ids = {r["doc_id"] for r in got}
    # 2 equals 1; 10 holds a whole item; one of the rows (4, 4) stays, the other text of id 4 too
    assert not ids & {2, 10}
    assert {1, 3, 4, None} <= ids


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, tmp_path, name):
    docs = spark.createDataFrame([(1, _text(1), "en", "a", 300), (None, None, None, None, None), (2, "", "de", None, 0)], DOCS).withColumns({c: F.lit(1) for c in CLASHING})
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, _text(99, 20))], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    assert out.schema.names == docs.schema.names
    assert 1 in {r["doc_id"] for r in out.collect()}
