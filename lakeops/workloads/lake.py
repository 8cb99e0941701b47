"""Lake-table queries: each writes a table under the shared work folder and returns what a reader sees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import tables
from lakeops.session import table, work_path
from lakeops.workloads import change_data as cd


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def cow_upsert(spark: SparkSession, sf: str) -> DataFrame:
    lake = tables.BucketTable(spark, work_path(spark, "cow"), ["o_orderkey"])
    lake.append(_orders(spark, sf))
    lake.merge(cd._order_changes(spark, sf))
    lake.merge(cd._order_changes(spark, sf))  # a replay changes nothing
    return lake.snapshot()


def cow_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Upserts and deletes that touch some partitions only."""
    lake = tables.BucketTable(spark, work_path(spark, "cow-parts"), ["o_orderkey"], ["o_orderpriority"])
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    lake.append(orders)
    lake.merge(orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2))
    lake.delete(orders.filter("o_orderpriority = '5-LOW' and o_totalprice < 100000"))
    return lake.snapshot()


def _commits(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The routed change stream as four batches of about a week, each its own folder."""
    changes = cd._decoded(spark, sf)
    week = F.least(F.floor((F.dayofmonth(F.timestamp_millis("ts_ms")) - 1) / 8), F.lit(3)).cast("int")
    path = work_path(spark, "batches")
    tables.bulk_insert(changes.withColumn("week", week), path, ["week"])
    return [spark.read.schema(changes.schema).parquet(f"{path}/week={i}") for i in range(4)]


def _mor(spark: SparkSession, sf: str, compact: bool) -> DataFrame:
    lake = tables.MergeOnReadTable(spark, work_path(spark, "mor"), ["user_id"], ["ts_ms", "event_id"])
    for batch, changes in enumerate(_commits(spark, sf)):
        lake.append(changes, batch, F.col("action") == "delete")
        if compact:
            lake.compact(min_batches=3)
    return lake.snapshot().select("user_id", "event_id", "event_type", "value")


def applied_batches(spark: SparkSession, sf: str) -> DataFrame:
    lake = tables.BucketTable(spark, work_path(spark, "applied"), ["user_id"])
    for changes in _commits(spark, sf):
        lake.apply(changes, ["user_id"], ["ts_ms", "event_id"])
    return lake.snapshot().select("user_id", "event_id", "event_type", "value")


def delete_write(spark: SparkSession, sf: str) -> DataFrame:
    lake = tables.BucketTable(spark, work_path(spark, "delete"), ["o_orderkey"])
    lake.overwrite(_orders(spark, sf))
    gone = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    lake.delete(gone)
    return lake.snapshot()


def bucket_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user, from batches that come newest first and one that comes again: stored rows that are later stay."""
    lake = tables.BucketTable(spark, work_path(spark, "buckets"), ["user_id"], buckets=16)
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", cd.ts_ms().alias("ts_ms"))
    for share in (2, 0, 1, 0):
        lake.upsert(events.filter(F.col("event_id") % 3 == share), ["ts_ms", "event_id"])
    return lake.snapshot()


def bucket_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without an order go; each bucket and market segment is a folder, and folders that lose all rows go too."""
    lake = tables.BucketTable(spark, work_path(spark, "buckets"), ["c_custkey"], ["c_mktsegment"], buckets=16)
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    lake.append(customers)
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    lake.delete(customers.join(orders, "c_custkey", "left_anti"))
    lake.delete(customers.filter("c_mktsegment = 'BUILDING'"))
    left = lake._in_folders(lake.schema, None).withColumn("folder", F.regexp_extract("_folder", "c_mktsegment=(.*)", 1))
    return left.groupBy("folder").agg(F.count("*").alias("customers"), F.sum("c_custkey").alias("keys"))


def bulk_inserted(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "bulk")
    lines = table(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    tables.bulk_insert(lines, path, ["ship_year"], max_records_per_file=1_000_000)
    back = spark.read.schema(lines.schema).parquet(path)
    return back.groupBy("ship_year").agg(
        F.count("*").alias("rows"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    ).select(F.col("ship_year").cast("bigint").alias("ship_year"), "rows", "quantity")


def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "parts")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.bulk_insert(orders, path, ["o_orderpriority"])
    urgent = orders.filter("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    tables.overwrite_partitions(urgent, path, ["o_orderpriority"])
    return spark.read.schema(orders.schema).parquet(path)


def table_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    lake = tables.BucketTable(spark, work_path(spark, "parts"), ["o_orderkey"], ["o_orderpriority"])
    lake.overwrite(orders)
    lake.overwrite_partitions(orders.filter("o_orderpriority = '1-URGENT' and o_totalprice > 200000"))
    return lake.snapshot()


def evolved_append(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch brings a column and widens another."""
    lake = tables.BucketTable(spark, work_path(spark, "evolve"), ["id"])
    lake.append(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand")))
    lake.append(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("size"), F.col("s_name").alias("name")))
    return lake.snapshot()


def day_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "days")
    events = tables.with_day_partition(table(spark, sf, "events"), "ts")
    tables.bulk_insert(events, path, ["day"])
    back = spark.read.schema(events.schema).parquet(path)
    return back.groupBy("day").agg(
        F.count("*").alias("events")
    ).select(F.col("day").cast("string").alias("day"), "events")


def hash_written(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "hashed")
    tables.hash_distributed(_orders(spark, sf), 4, "o_orderkey").write.parquet(path)
    # Every key lands in one file, as the distribution promises.
    files = spark.read.parquet(path).select("o_orderkey", F.col("_metadata.file_name").alias("file"))
    spread = files.groupBy("o_orderkey").agg(F.count_distinct("file").alias("files"))
    return spread.groupBy("files").agg(F.count("*").alias("keys"))


def small_files(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "sizes")
    tables.bulk_insert(table(spark, sf, "events").withColumn("day", F.to_date("ts")), path, ["day"])
    day = F.regexp_extract("path", r"day=([^/]+)", 1)
    return tables.file_sizes(spark, path).groupBy(day.alias("day")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )


QUERIES = {
    "lake_cow_upsert": cow_upsert,
    "lake_cow_partitioned": cow_partitioned,
    "lake_mor_snapshot": lambda spark, sf: _mor(spark, sf, compact=False),
    "lake_mor_compacted": lambda spark, sf: _mor(spark, sf, compact=True),
    "lake_applied_batches": applied_batches,
    "lake_delete_write": delete_write,
    "lake_bucket_upsert": bucket_upsert,
    "lake_bucket_delete": bucket_delete,
    "lake_bulk_insert": bulk_inserted,
    "lake_partition_overwrite": partition_overwrite,
    "lake_table_partition_overwrite": table_partition_overwrite,
    "lake_evolved_append": evolved_append,
    "lake_day_partitions": day_partitions,
    "lake_hash_distribution": hash_written,
    "lake_file_sizes": small_files,
}

_OVERWRITTEN = """select o_orderkey, o_totalprice, o_orderpriority from orders
  where o_orderpriority <> '1-URGENT' or o_totalprice > 200000"""

ORACLE = {
    "lake_cow_upsert": cd.MERGED_ORDERS_SQL,
    "lake_cow_partitioned": """select o_orderkey, case when o_orderpriority = '1-URGENT' then o_totalprice * 2 else o_totalprice end as o_totalprice,
        o_orderpriority from orders where not (o_orderpriority = '5-LOW' and o_totalprice < 100000)""",
    "lake_mor_snapshot": cd.LIVE_SQL,
    "lake_mor_compacted": cd.LIVE_SQL,
    "lake_applied_batches": cd.LIVE_SQL,
    "lake_delete_write": cd.ORACLE["cdc_delete_by_key"],
    "lake_bucket_upsert": """select user_id, event_id, event_type, value, ts_ms from (select *, epoch_us(ts) // 1000 as ts_ms,
        row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) as rn from events) where rn = 1""",
    "lake_bucket_delete": """select c_mktsegment as folder, count(*) as customers, cast(sum(c_custkey) as bigint) as keys from customer
      where c_mktsegment <> 'BUILDING' and c_custkey in (select o_custkey from orders) group by 1""",
    "lake_bulk_insert": """select year(l_shipdate) as ship_year, count(*) as "rows", round(sum(l_quantity), 2) as quantity
      from lineitem group by 1""",
    "lake_partition_overwrite": _OVERWRITTEN,
    "lake_table_partition_overwrite": _OVERWRITTEN,
    "lake_evolved_append": cd.ORACLE["cdc_schema_merge"],
    "lake_day_partitions": "select cast(cast(ts as date) as varchar) as day, count(*) as events from events group by 1",
    "lake_hash_distribution": "select cast(1 as bigint) as files, count(distinct o_orderkey) as keys from orders",
}
