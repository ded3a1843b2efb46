"""Graph header (T14), header refresh (T15) and the base IRI of a graph (O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom import model as M
from graphloom.operators.sets import as_set, count_triples, delete
from graphloom.session import materialize_counted
from graphloom.operators.triples import emit, iri_triple, lang_triple, typed_triple


def stamp(ts: int) -> str:
    """L15 for the job clock: epoch seconds -> ISO text in UTC. The timestamp is one job
    parameter, so it is formatted once here and is the same whatever the session zone."""
    from datetime import datetime, timezone

    return datetime.fromtimestamp(ts, tz=timezone.utc).replace(tzinfo=None).isoformat()


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("_one"))


def _count_triple(base, counted: DataFrame) -> DataFrame:
    n = count_triples(counted)
    return emit(n, [typed_triple(base, M.VOID_TRIPLES, F.col("n").cast("string"), M.XSD_NONNEGATIVEINTEGER)])


def _written_with_count(body: DataFrame, base: str, more: int = 0) -> tuple[DataFrame, DataFrame]:
    """The set written once, and its count triple (``more`` triples that join it later, and the
    count triple itself, included). The count is taken while the set is written (A1)."""
    body, n = materialize_counted(body, "graph")
    return body, emit(_one_row(body.sparkSession), [typed_triple(base, M.VOID_TRIPLES, F.lit(str(n + more + 1)), M.XSD_NONNEGATIVEINTEGER)])


def header_triples(spark: SparkSession, base: str, ts: int, name: str, is_ontology: bool = False,
                   text: M.HeaderText = M.HeaderText()) -> DataFrame:
    """T14 without the count: type, modified, creator, publisher, rights holder, language,
    two titles, subject, two descriptions."""
    kind = "ontology" if is_ontology else "dataset"
    title = text.title.format(db=name.upper())
    structs = [
        iri_triple(base, M.RDF_TYPE, M.OWL_ONTOLOGY if is_ontology else M.VOID_DATASET),
        typed_triple(base, M.DCTERMS + "modified", F.lit(stamp(ts)), M.XSD_DATETIME),
        iri_triple(base, M.DCTERMS + "creator", text.creator),
        iri_triple(base, M.DCTERMS + "publisher", text.creator),
        iri_triple(base, M.DCTERMS + "rightsHolder", text.rights_holder),
        iri_triple(base, M.DCTERMS + "language", text.language),
        lang_triple(base, M.DCTERMS + "title", title, "nl"),
        lang_triple(base, M.DCTERMS + "title", title, "en"),
        iri_triple(base, M.DCTERMS + "subject", text.subject),
        lang_triple(base, M.DCTERMS + "description", text.description_nl.format(kind=kind), "nl"),
        lang_triple(base, M.DCTERMS + "description", text.description_en.format(kind=kind), "en"),
    ]
    return emit(_one_row(spark), structs)


HEADER_SIZE = 11  # distinct triples made by ``header_triples`` (the count triple not included)


def with_metadata(df: DataFrame, base: str, ts: int, name: str, is_ontology: bool = False,
                  text: M.HeaderText = M.HeaderText(), materialized: bool = True,
                  assume_set: bool = False) -> DataFrame:
    """The graph as a set plus its header; ``void:triples`` = distinct triples + 1.

    The count needs the whole set before the last triple exists. With ``materialized``
    the set is written once to the checkpoint folder and counted in that very job,
    instead of evaluating the deduplication twice. With ``assume_set`` the caller guarantees
    ``df`` is already a set without header triples of ``base``, so no deduplication runs.
    """
    header = header_triples(df.sparkSession, base, ts, name, is_ontology, text)
    if assume_set:
        body = df.select(*M.TRIPLE_COLUMNS).unionByName(header)
    else:
        body = as_set(df.unionByName(header))
    if not materialized:
        return body.unionByName(_count_triple(base, body))
    body, count = _written_with_count(body, base)
    return body.unionByName(count)


def base_of(df: DataFrame) -> DataFrame:
    """O2: one row (base, kind): the smallest subject typed ``owl:Ontology``, else the smallest
    typed ``void:Dataset``; no row when neither exists."""
    typed = df.where((F.col("p") == M.RDF_TYPE) & F.col("o").isin(M.OWL_ONTOLOGY, M.VOID_DATASET))
    rank = F.when(F.col("o") == M.OWL_ONTOLOGY, 0).otherwise(1)
    return typed.agg(F.min_by(F.struct("s", "o"), F.struct(rank, F.col("s"))).alias("b")).where(
        F.col("b").isNotNull()
    ).select(F.col("b.s").alias("base"), F.col("b.o").alias("kind"))


def refresh_metadata(df: DataFrame, ts: int, base: str | None = None) -> DataFrame:
    """Delete every ``modified`` and ``triples`` triple (all subjects), then add one of
    each for the base (O2 unless given; one value read back to the driver).

    The rest of the graph is deduplicated and written once, sorted by predicate, and counted in that
    job; the base is looked up in what was written. The two new triples cannot be in it.
    """
    kept = as_set(delete(df, p=[M.DCTERMS + "modified", M.VOID_TRIPLES])).sortWithinPartitions("p")
    body, n = materialize_counted(kept, "graph")
    if base is None:
        row = base_of(body).first()
        if row is None:
            raise ValueError("graph has no subject typed owl:Ontology or void:Dataset")  # Q9
        base = row.base
    return body.unionByName(_refreshed(df.sparkSession, base, ts, n))


def _refreshed(spark: SparkSession, base: str, ts: int, n: int) -> DataFrame:
    """The two triples of a refresh, for a graph of ``n`` others."""
    return emit(_one_row(spark), [typed_triple(base, M.DCTERMS + "modified", F.lit(stamp(ts)), M.XSD_DATETIME),
                                  typed_triple(base, M.VOID_TRIPLES, F.lit(str(n + 2)), M.XSD_NONNEGATIVEINTEGER)])


# ---- stored graphs ---------------------------------------------------------------------------

#: Folders of a stored graph: the triples that a refresh replaces, and all others.
REFRESHED, REST = "group=refreshed", "group=rest"


def store_graph(df: DataFrame, path: str, ts: int, base: str | None = None) -> str:
    """T15 for a graph that stays on disk: a Parquet folder with two partitions, the two
    refreshed triples and the rest. A later ``refresh_store`` rewrites only the first."""
    refresh = [M.DCTERMS + "modified", M.VOID_TRIPLES]
    as_set(delete(df, p=refresh)).sortWithinPartitions("p").write.mode("error").parquet(f"{path}/{REST}")
    return refresh_store(df.sparkSession, path, ts, base)


def refresh_store(spark: SparkSession, path: str, ts: int, base: str | None = None) -> str:
    """Replace the refreshed triples of a stored graph; the rest is counted from its footers."""
    rest = spark.read.schema(M.TRIPLE_SCHEMA).parquet(f"{path}/{REST}")
    if base is None:
        row = base_of(rest).first()
        if row is None:
            raise ValueError("graph has no subject typed owl:Ontology or void:Dataset")
        base = row.base
    _refreshed(spark, base, ts, rest.count()).coalesce(1).write.mode("overwrite").parquet(f"{path}/{REFRESHED}")
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(M.TRIPLE_SCHEMA).parquet(f"{path}/{REST}", f"{path}/{REFRESHED}").select(*M.TRIPLE_COLUMNS)
