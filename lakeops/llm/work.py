"""Written intermediate tables in the shared folder, and small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import table, work_path

ROWS_PER_BATCH = "1000"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, name)


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a task holds one batch of texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later jobs start from the files, also when executors are lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again.stored_path = path
    return again


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` that no later job reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: str) -> Column:
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
