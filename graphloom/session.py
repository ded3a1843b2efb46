"""Session helpers: a tuned local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "graphloom") -> SparkSession:
    """Session for tests and the local benchmark (a cluster job brings its own session)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def values(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """Rule and catalogue rows (configuration-sized) as an inline relation.

    Unlike rows handed over one by one, an inline relation has a size that the optimizer knows, so
    joins with it are broadcast by Spark's own size check, and plans over such rows alone run
    without shuffles.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*(tuple(r) for r in rows), strict=True)) or [()] * len(schema)
    fields = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), schema)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    Uses the directory already set on the context, else ``spark.checkpoint.dir`` from the
    session configuration. Only a local-mode session (tests, the local benchmark) may fall
    back to a fresh temporary folder: on a cluster a machine-local folder is not shared, so
    an unset directory is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (a session without a local context: use the setting)
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    path = tempfile.mkdtemp(prefix="graphloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize_counted(df: DataFrame, name: str = "part") -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows, counted while they are written."""
    seen = Observation()
    return materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name), seen.get["n"]


def materialize(df, name: str = "part"):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One pass over the data (a reliable ``checkpoint`` computes its input twice unless it is
    cached), executor loss re-reads files instead of replaying the lineage, and the read-back
    carries exact size statistics, so AQE sees the true size when it picks join strategies.
    """
    import uuid

    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/graphloom-{uuid.uuid4().hex}/{name}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
