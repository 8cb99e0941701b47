"""Sinks and routing: index names, message envelopes, warehouse writes, sample display."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.tables import balanced

log = logging.getLogger("lakeops")


def index_name(template: str) -> Column:
    """Index name from a template such as `app-{subsystem}-{logs_type}`; empty fields stay empty."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [
        F.coalesce(F.col(piece).cast("string"), F.lit("")) if i % 2 else F.lit(piece) for i, piece in enumerate(pieces)
    ]
    return F.concat(*parts)


def route_index(df: DataFrame, template: str, out: str = "index_name") -> DataFrame:
    return df.withColumn(out, index_name(template))


def write_by_index(df: DataFrame, path: str, index: str = "index_name", fmt: str = "parquet") -> None:
    """One folder per index; a very large index is split over several tasks."""
    balanced(df, [index]).write.mode("append").partitionBy(index).format(fmt).save(path)


def changelog_messages(df: DataFrame, key: Sequence[str], action: str = "action") -> DataFrame:
    """Changes as message key and change-event JSON: inserts and upserts in `after`, deletes in `before`."""
    data = F.struct(*(F.col(f"`{c}`") for c in df.columns if c != action))
    gone = F.col(action) == "delete"
    code = F.when(gone, "d").when(F.col(action) == "insert", "c").otherwise("u")
    event = F.struct(F.when(gone, data).alias("before"), F.when(~gone, data).alias("after"), code.alias("op"))
    return df.select(F.to_json(F.struct(*key)).alias("key"), F.to_json(event).alias("value"))


def write_messages(df: DataFrame, options: Mapping[str, str], fmt: str = "kafka") -> None:
    df.write.format(fmt).options(**options).save()


def warehouse_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    staging: str | None = None,
    truncate_columns: bool = True,
) -> dict[str, str]:
    """Options of a warehouse append with CSV staging."""
    options = {"url": url, "dbtable": table, "tempformat": "CSV", "extracopyoptions": "TRUNCATECOLUMNS" if truncate_columns else ""}
    for name, value in (("user", user), ("password", password), ("tempdir", staging)):
        if value is not None:
            options[name] = value
    return {k: v for k, v in options.items() if v}


def append_table(df: DataFrame, options: Mapping[str, str], fmt: str = "jdbc") -> None:
    df.write.format(fmt).options(**options).mode("append").save()


def mark_semistructured(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tag text columns as semi-structured for the warehouse writer."""
    marks = {"super": True, "redshift_type": "super"}  # fixed values
    for column in columns:
        if column in df.columns:
            df = df.withMetadata(column, marks)
    return df


def copy_table(spark: SparkSession, read: Mapping[str, str], stage: str, write: Mapping[str, str], fmt: str = "jdbc") -> None:
    """Relational table to files to relational table; the files decouple the two databases."""
    spark.read.format(fmt).options(**read).load().write.mode("overwrite").parquet(stage)
    append_table(spark.read.parquet(stage), write, fmt)


def log_sample(df: DataFrame, rows: int = 20, label: str = "batch") -> None:
    """Log the first rows of a micro-batch."""
    shown = [row.asDict() for row in df.limit(rows).collect()]
    log.info("%s: %s", label, shown)
