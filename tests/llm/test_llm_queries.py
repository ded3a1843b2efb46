"""Every training-data query against its DuckDB SQL; the pipeline's rows and columns."""

import pytest

from tests.conftest import SF001

from graphloom.llm.oracle import ORACLE
from graphloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF001), duck.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == sorted(repr(tuple(r)) for r in want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == [*docs.columns, "shard"]
    ids = {r["doc_id"] for r in docs.collect()}
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} <= ids and {r["shard"] for r in rows} <= set(range(16))
