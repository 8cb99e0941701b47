from __future__ import annotations

import math
import random

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import metrics, ordered


def hot(spark, n=600):
    """Two thirds of the rows share one key; values and times repeat."""
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 else rng.choice(["a", None]), rng.randrange(50), rng.choice([None, *range(9)])) for i in range(n)]
    return spark.createDataFrame(data, "id int, k string, t int, v int").repartition(7)


def test_prefix_sum_and_position_equal_plain_windows(spark):
    df = ordered.with_chunk(hot(spark), "t", 8)
    assert df.select("_chunk").distinct().count() == 8
    w = Window.partitionBy("k").orderBy("t", "id")
    df = df.withColumn("rn", F.row_number().over(w) - 1)
    df = df.withColumn("want", F.coalesce(F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    got = ordered.prefix_sum(ordered.with_position(df, ["k"], ["t", "id"]), ["k"], ["t", "id"], F.col("id"), "sum")
    assert got.count() == 600 and got.filter("pos <> rn or sum <> want").count() == 0


def test_running_max_equals_plain_window(spark):
    df = ordered.with_chunk(hot(spark), "t", 8)
    w = Window.partitionBy("k").orderBy("t", "id")
    df = df.withColumn("want", F.last("v", True).over(w)).withColumn("before", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    value = F.when(F.col("v").isNotNull(), F.struct("t", "id", "v"))
    df = ordered.running_max(df, ["k"], ["t", "id"], value, "last")
    df = ordered.running_max(df, ["k"], ["t", "id"], value, "prev", strict=True)
    assert df.count() == 600
    assert df.filter("not (last.v <=> want) or not (prev.v <=> before)").count() == 0


def test_null_order_values_come_first(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i) for i in range(100)], "id int, t int")
    got = ordered.with_position(ordered.with_chunk(df, "t", 6), [], ["t", "id"])
    want = Window.orderBy("t", "id")
    assert got.withColumn("rn", F.row_number().over(want) - 1).filter("pos <> rn").count() == 0


def test_rank_points_and_summary(spark):
    df = hot(spark).withColumn("x", (F.col("id") * 7 % 101).cast("double"))
    got = {r["k"]: r for r in metrics.latency_summary(df, "x", ["k"], 10.0).collect()}
    for key in ("hot", "a", None):
        values = sorted(float(r["x"]) for r in df.filter(F.col("k").eqNullSafe(key)).select("x").collect())
        assert got[key]["queries"] == len(values) and got[key]["qps"] == round(len(values) / 10, 6)
        for p in (50, 90, 95, 99):
            assert got[key][f"p{p}"] == values[int(len(values) * p / 100)]


def test_moving_latency(spark):
    data = [(i, float((i * 37) % 101)) for i in range(250)]
    df = spark.createDataFrame(data, "i int, x double").repartition(5)
    got = {r["i"]: r for r in metrics.moving_latency(df, "x", ["i"], ["i"], size=20, block=30).collect()}
    assert len(got) == 250
    for i in (0, 5, 19, 20, 29, 30, 31, 59, 60, 249):
        window = sorted(x for _, x in data[max(0, i - 19) : i + 1])
        row = got[i]
        assert (row["count"], row["min"], row["max"]) == (len(window), window[0], window[-1])
        assert math.isclose(row["mean"], sum(window) / len(window)) and row["p90"] == window[int(len(window) * 0.9)]


def test_consumer_rate(spark):
    data = [("t", 0, 0, "10", 15), ("t", 0, 5, "30", 40), ("t", 0, 10, "5", 40), ("t", 0, 15, "-", 40), ("t", 0, 20, "7", 40), ("t", 1, 5, "9", 9)]
    df = spark.createDataFrame(data, "topic string, partition int, sample_s int, current_offset string, log_end int")
    got = rows(metrics.consumer_rate(df).select("partition", "sample_s", "status", "delta", "rate_per_s", "lag"), "partition", "sample_s")
    assert got == [
        (0, 0, "pending", None, None, 5),
        (0, 5, "ok", 20, 4.0, 10),
        (0, 10, "ok", 0, 0.0, 35),
        (0, 15, "unassigned", None, None, None),
        (0, 20, "unassigned", None, None, 33),
        (1, 5, "pending", None, None, 0),
    ]


def test_histogram_and_write_figures(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (2000.0,)], "x double")
    got = {r["bucket"]: r["messages"] for r in metrics.latency_histogram(df, "x").collect()}
    assert got == {"<0": 0, "0-10": 1, "10-50": 1, "50-100": 0, "100-500": 0, "500-1000": 0, "1000+": 1}
    stats = spark.createDataFrame([(0, 0, 10, 9, 1, 2.0), (1, 0, 10, 10, 0, 4.0)], "partition int, batch int, docs int, ok int, failed int, seconds double")
    assert rows(metrics.write_throughput(stats)) == [(20, 19, 1, 3.0, 4.75)]
    assert rows(metrics.batch_throughput(stats).select("docs_per_s"), "docs_per_s") == [(2.5,), (4.5,)]
    assert metrics.timed_write(spark, "t", lambda: None).columns == ["tablename", "executiontime"]
