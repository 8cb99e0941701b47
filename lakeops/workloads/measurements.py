"""Pipeline metrics with `events.value` as a latency and the event type as the platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import metrics
from lakeops.session import table


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("date", F.col("ts").cast("date").cast("string"))


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_histogram(_events(spark, sf), "value")


def histogram_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_histogram(_events(spark, sf), "value", by=["event_type"])


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_stats(_events(spark, sf), "value", "ts", recent_seconds=3600)


def stats_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_stats(_events(spark, sf), "value", "ts", ["event_type"], recent_seconds=3600)


def slow(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.outliers(_events(spark, sf), "value", 100.0).select("event_id", "value")


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_summary(_events(spark, sf), "value", duration_s=60.0)


def summary_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_summary(_events(spark, sf), "value", ["event_type"], 60.0)


def summary_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.latency_summary(_events(spark, sf), "value", ["date"])


def top_dates(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.top_groups(_events(spark, sf), ["date"], 10)


def moving(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    rows = metrics.moving_latency(events, "value", ["t", "event_id"], ["event_id"])
    # The sum has two decimals, so unlike the mean it has no rounding ties to disagree about.
    return rows.withColumn("total", F.round(F.col("mean") * F.col("count"), 2)).drop("mean")


def consumer_rate(spark: SparkSession, sf: str) -> DataFrame:
    samples = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).alias("partition"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("sample_s"),
        "event_id",
        F.when(F.col("value") < 5, "-").otherwise(((F.col("event_id") * 3) % 1000).cast("string")).alias("current_offset"),
        ((F.col("event_id") * 3) % 1000 + F.col("user_id")).alias("log_end"),
    )
    rates = metrics.consumer_rate(samples, order=["sample_s", "event_id"])
    return rates.select("event_id", "topic", "partition", "status", "delta", "rate_per_s", "lag")


QUERIES = {
    "metrics_latency_hist": histogram,
    "metrics_latency_hist_by_type": histogram_by_type,
    "metrics_latency_stats": stats,
    "metrics_latency_stats_by_type": stats_by_type,
    "metrics_outliers": slow,
    "metrics_percentiles": summary,
    "metrics_percentiles_by_type": summary_by_type,
    "metrics_percentiles_by_date": summary_by_date,
    "metrics_top_groups": top_dates,
    "metrics_moving": moving,
    "metrics_consumer_rate": consumer_rate,
}

_BOUNDS = """(values ('<0', -1e300, 0), ('0-10', 0, 10), ('10-50', 10, 50), ('50-100', 50, 100), ('100-500', 100, 500), ('500-1000', 500, 1000),
  ('1000+', 1000, 1e300)) b(bucket, lo, hi)"""
_P = "list_sort(list(value))"
_PERCENTILES = ", ".join(
    f"{_P}[cast(floor(count(*) * {p / 100}::double) as bigint) + 1] as p{p}" for p in metrics.PERCENTILES
)
_SUMMARY = f"count(*) as queries, min(value) as min, max(value) as max, round(avg(value), 6) as mean, {_PERCENTILES}"
_STATS = """count(*) as messages, round(avg(value), 6) as mean, round(median(value), 6) as median, min(value) as min, max(value) as max,
  round(count(*) / (max(epoch_us(ts)) / 1e6 - min(epoch_us(ts)) / 1e6), 6) as rate_per_s,
  round(count(*) filter (where ts > (select max(ts) from events) - interval 3600 second) / 3600, 6) as recent_rate_per_s"""
_MOVING = ", ".join(
    f"l[cast(floor(len(l) * {p} / 100) as bigint) + 1] as p{p}" for p in metrics.PERCENTILES
)

ORACLE = {
    "metrics_latency_hist": f"""select bucket, count(value) as messages, round(count(value) * 100.0 / (select count(*) from events), 4)::double as percent
      from {_BOUNDS} left join events on value >= lo and value < hi group by 1""",
    "metrics_latency_hist_by_type": f"""with t as (select event_type, count(*) as n from events group by 1)
      select t.event_type, bucket, count(value) as messages, round(count(value) * 100.0 / any_value(n), 4)::double as percent
      from t cross join {_BOUNDS} left join events e on e.event_type = t.event_type and value >= lo and value < hi group by 1, 2""",
    "metrics_latency_stats": f"select {_STATS} from events",
    "metrics_latency_stats_by_type": f"select event_type, {_STATS} from events group by 1",
    "metrics_outliers": "select event_id, value from events where value > 100",
    "metrics_percentiles": f"select {_SUMMARY}, round(count(*) / 60.0::double, 6) as qps from events",
    "metrics_percentiles_by_type": f"select event_type, {_SUMMARY}, round(count(*) / 60.0::double, 6) as qps from events group by 1",
    "metrics_percentiles_by_date": f"select cast(cast(ts as date) as varchar) as date, {_SUMMARY} from events group by 1",
    "metrics_top_groups": """select cast(cast(ts as date) as varchar) as date, count(*) as "rows" from events group by 1
      order by 2 desc, 1 limit 10""",
    "metrics_moving": f"""select event_id, len(l) as count, l[1] as min, l[-1] as max, round(list_sum(l), 2) as total, {_MOVING} from (
        select event_id, list_sort(list(value) over (order by ts, event_id rows between 999 preceding and current row)) as l from events)""",
    "metrics_consumer_rate": """with s as (select event_id, event_type as topic, user_id % 4 as partition, epoch_us(ts) / 1e6 as sample_s,
          case when value < 5 then '-' else cast((event_id * 3) % 1000 as varchar) end as off, (event_id * 3) % 1000 + user_id as log_end from events),
      p as (select *, lag(off) over w as prev, lag(sample_s) over w as prev_s from s window w as (partition by topic, partition order by sample_s, event_id)),
      q as (select *, case when off = '-' then 'unassigned' when prev is null then 'pending' when prev = '-' then 'unassigned' else 'ok' end as status,
              greatest(try_cast(off as bigint) - try_cast(prev as bigint), 0) as d from p)
      select event_id, topic, partition, status, case when status = 'ok' then d end as delta,
        case when status = 'ok' then round(cast(d as double) / (sample_s - prev_s), 6) end as rate_per_s,
        log_end - try_cast(off as bigint) as lag from q""",
}
