"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here expects. None of the operators depend on ANSI mode.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, bytes_per_task: int = 32 * 1024 * 1024) -> DataFrame:
    """Spread a small table over all tasks before costly per-row work.

    A small Parquet file is one row group and so one task. A table with enough bytes for every task is returned as
    it is: large inputs are never shuffled for this.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = parallelism(df.sparkSession)
    return df.repartition(tasks) if size < tasks * bytes_per_task else df


def part_count(df: DataFrame, least: int, bytes_per_piece: int = 32 * 1024 * 1024) -> int:
    """How many parts of bounded bytes a table makes, by the size Spark knows of it; `least` for small ones."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, -(-size // bytes_per_piece))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by `spark.checkpoint.dir`.

    Only a local master without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakeops-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lakeops/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several plans read to the shared folder, and read it again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
