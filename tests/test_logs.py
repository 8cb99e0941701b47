from __future__ import annotations

import random
from itertools import pairwise

from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import logs
from lakeops.sources import readers


def read(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)


def test_multiline_over_file_blocks(spark, tmp_path):
    records = []
    for i in range(40):
        records.append("\n".join([f"2024-01-01 00:00:{i:02d} start {i}"] + [f"  at line {j} of {i}" for j in range(i % 7)]))
    text = "early line\nsecond early\n" + "\n".join(records) + "\n"
    read(spark, tmp_path, "a.log", text)
    read(spark, tmp_path, "b.log", "2024-01-01 only\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = readers.log_lines(spark, str(tmp_path))
        assert lines.select("path", "block").distinct().count() > 5
        got = logs.join_multiline(lines)
        a = [r["message"] for r in got.filter(F.col("path").endswith("a.log")).orderBy("first_line").collect()]
        assert a == ["early line\nsecond early", *records]
        assert rows(got.filter(F.col("path").endswith("b.log")).select("lines", "message")) == [(1, "2024-01-01 only")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_max_lines_drops_the_excess(spark):
    lines = spark.range(30).select(
        F.lit("p").alias("path"), F.floor(F.col("id") / 4).alias("block"), F.col("id").alias("line_no"),
        F.when(F.col("id") == 0, "2024-01-01").otherwise(F.col("id").cast("string")).alias("line"),
    )
    (row,) = logs.join_multiline(lines, max_lines=10).collect()
    assert row["lines"] == 10 and row["message"].endswith("\n9") and row["truncated"]
    (row,) = logs.join_multiline(lines).collect()
    assert row["lines"] == 30 and not row["truncated"]


def test_records_over_any_blocks(spark):
    """Records that begin, go on and end in any block, files of their own for a null path, and no second move of whole records."""
    rng, items, files = random.Random(3), [], {}
    for path in ("a", "b", None):
        block = 0
        for no in range(120):
            block += rng.random() < 0.3
            line = rng.choice(["2024-01-01 x", "more", "", "z", None, "more"])
            items.append((path, block, no, line))
            files.setdefault(path, []).append(line)
    rng.shuffle(items)
    frame = spark.createDataFrame(items, "path string, block long, line_no long, line string").repartition(3)
    for most in (None, 1, 3):
        want = []
        for path, texts in files.items():
            starts = sorted({0, *(i for i, t in enumerate(texts) if t is not None and t.startswith("2024"))})
            for i, j in pairwise([*starts, len(texts)]):
                kept = texts[i:j][:most]
                want.append((path, i, len(kept), "\n".join(t for t in kept if t is not None), most is not None and j - i > most))
        got = logs.join_multiline(frame, max_lines=most)
        moves = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
        assert len(moves) == 1  # of the pieces at the ends of blocks
        assert sorted(rows(got), key=str) == sorted(want, key=str)


def lines(spark, items):
    return spark.createDataFrame(items, "logs_topic string, logs_type string, message string")


def test_rules_by_type_and_merged_agree(spark):
    df = lines(
        spark,
        [
            ("core", "cimb-lazada", "2024-01-02 03:04:05,678 [app,t1,s1,x] INFO  com.A - hello - world\nsecond line"),
            ("core", "fts-proxy", "2024-01-02 03:04:05.678 [main] WARN com.A - m"),
            ("core", "fts-batch", "2024-01-02 03:04:05.678 [main] [t1] WARN com.A - m"),
            ("core", "csn-schedule", "2024/01/02 03:04:05:678 INFO [th|t1] com.A - m"),
            ("core", "gcredit", "2024-01-02 03:04:05:678| INFO| first|x| last| com.A - m"),
            ("core", "appointment", "2024-01-02 03:04:05.678 [t1] [th] INFO com.A - m"),
            ("slp", "any", "2024-01-02 03:04:05.678 INFO [t1,a,b] [th] [com.A]- m"),
            ("chms", "chms-arch", "2024-01-02 03:04:05.678 INFO [th] com.A: m"),
            ("chms", "other", "2024-01-02 03:04:05.678 INFO [t1,u1]|th|com.A: m"),
            ("core", "ibp", "not a log line"),
            ("other", "x", "2024-01-02 03:04:05.678 INFO"),
        ],
    )
    one = logs.extract_fields(df, logs.RULES_BY_TYPE)
    other = logs.extract_fields(df, logs.RULES_MERGED)
    assert one.exceptAll(other).count() == 0
    got = {r["logs_type"]: r for r in one.collect()}
    assert (got["cimb-lazada"]["traceId"], got["cimb-lazada"]["seqNo"], got["cimb-lazada"]["msg"]) == ("t1", "s1", "hello - world")
    assert got["fts-proxy"]["traceId"] is None and got["fts-batch"]["traceId"] == "t1"
    assert got["gcredit"]["traceId"] == "last" and got["other"]["userId"] == "u1"
    assert not got["ibp"]["matched"] and got["ibp"]["msg"] == "not a log line" and not got["x"]["matched"]
    done = logs.finish(lines(spark, [("core", "IBP", "x")]))
    assert rows(done) == [("core", "ibp")]


def test_one_level_line_fits_only_the_rule_by_type(spark):
    df = lines(spark, [("core", "bankcloud-check", "2024-01-02 03:04:05.678 INFO [t1] [th] com.A - m")])
    assert logs.extract_fields(df, logs.RULES_BY_TYPE).head()["matched"]
    assert not logs.extract_fields(df, logs.RULES_MERGED).head()["matched"]


def test_control_characters_stay_in_their_fields(spark):
    heads = "2024-01-02 03:04:05.678 INFO [t1] [th] com.A - "
    texts = ["a\x01b", "\x01\x02\x03", "\x02\x04\x01", "plain \x02\x03", "\x01"]
    df = lines(spark, [("core", "bankcloud-check", heads + t) for t in texts] + [("core", "bankcloud-check", "no \x01 line"), ("core", "bankcloud-check", None)])
    got = {r["msg"]: (r["matched"], r["traceId"], r["class"]) for r in logs.extract_fields(df).collect()}
    assert got == {**{t: (True, "t1", "com.A") for t in texts}, "no \x01 line": (False, None, None), None: (False, None, None)}


def test_time_formats_are_local_time(spark):
    df = spark.createDataFrame(
        [
            ("core", "icms", "2024/01/02 08:00:00:001"),
            ("core", "ibp", "2024-01-02 08:00:00:001"),
            ("rcms", "x", "2024-01-02 08:00:00.001"),
            ("core", "apsi", "2024-01-02 08:00:00,001"),
            ("core", "apsi", "2024-01-02 08:00:00.001"),
        ],
        "logs_topic string, logs_type string, timestamp string",
    )
    got = [r[0] for r in logs.parse_times(df).select(F.unix_millis("event_time")).collect()]
    assert got == [1704153600001] * 4 + [None]


def test_cap_and_events(spark):
    df = spark.createDataFrame([("é" * 10,), ("short",)], "message string")
    got = logs.cap_bytes(df, limit=11).collect()
    assert got[0]["truncated"] and got[0]["message"].startswith("é" * 5) and not got[1]["truncated"]
    lines_df = spark.createDataFrame([(" a ",), ("  ",)], "line string")
    assert rows(logs.log_events(lines_df, "src", F.lit(1.5))) == [(1.5, "a", "src")]


def test_unmatched_lines_are_given_up_quickly(spark):
    """10 KB lines that begin like a record of their type and then do not fit."""
    import time

    start = "2024-01-02 03:04:05.678 "
    bodies = ("[a b c d ", "[x] ", "a| ", "| [a b c d e", "x,", " - ", "] [")
    items = []
    for rule in logs.RULES_BY_TYPE:
        for kind in rule.types or ("other",):
            items += [(rule.topic, kind, start + body * (10_000 // len(body))) for body in bodies]
    df = lines(spark, items).coalesce(1).cache()
    df.count()
    logs.extract_fields(df).select("matched").collect()
    begun = time.time()
    logs.extract_fields(df).select("matched").collect()
    assert time.time() - begun < 0.05 * len(items)


def test_bounded_fields_read_the_same(spark):
    """Fields with blanks, dashes and brackets of other kinds in them."""
    df = lines(
        spark,
        [
            ("core", "apsi", "2024-01-02 03:04:05,678 [t (1)] [a b c d e f] [pool 1|x] WARN   com.A$1 - a - b [c] d"),
            ("core", "ocpay", "2024-01-02 03:04:05.678| INFO | t 1| [a b c d s1| th [2]| com.A - m | n"),
            ("core", "icms", "2024/01/02 03:04:05:678 INFO [a,b|t-1] com.A - m"),
            ("core", "cimb-lazada", "x 2024-01-02 03:04:05,678 [app,,s 1,x,y] INFO com.A - m"),
        ],
    )
    got = [tuple(r) for r in logs.extract_fields(df).select("matched", "traceId", "seqNo", "thread", "class", "msg").collect()]
    assert got == [
        (True, "t (1)", "e f", "pool 1|x", "com.A$1", "a - b [c] d"),
        (True, "t 1", "s1", "th [2]", "com.A", "m | n"),
        (True, "t-1", None, "a,b", "com.A", "m"),
        (True, None, "s 1", None, "com.A", "m"),
    ]
