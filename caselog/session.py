"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "caselog", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benches; on a cluster use spark-submit settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="caselog-")
        spark.conf.set(CHECKPOINT_DIR, root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the checkpoint folder, so every later read sees the same rows."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once to the shared folder, by column, so later reads take the columns they need."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/caselog/{name}-{uuid.uuid4().hex}"
