from __future__ import annotations

import json

from conftest import rows

from lakeops.functions.text import parent_path, unescape, unescape_text
from lakeops.operators import lineage


def events(spark, items):
    return spark.createDataFrame(items, "stream string, event_id string, timestamp long, message string")


def test_events_from_logs(spark):
    m = lineage.SPARK_MARKER
    df = events(
        spark,
        [
            ("s", "a1", 0, f"x\n10:00 {m}: {{\"r\":1}}\ny"),
            ("s", "b1", 1000, f"{m} {{\"r\":2,"),  # two parts
            ("s", "b2", 1100, "\"z\":1}"),
            ("s", "c1", 2000, f"{m} {{\"r\":3,"),  # three parts
            ("s", "c2", 2010, "\"y\":2,"),
            ("s", "c3", 2020, "\"z\":1}\nlater }"),
            ("s", "d1", 3000, f"{m} {{\"r\":4,"),  # unrelated line between
            ("s", "d2", 3010, "heartbeat"),
            ("s", "d3", 3020, "\"z\":1}"),
            ("s", "e1", 4000, f"{m} {{\"r\":5,"),  # the end comes too late
            ("s", "e2", 4101, "\"z\":1}"),
            ("other", "f1", 4001, "\"z\":9}"),  # not of this stream
            ("s", "g1", 5000, f"{m} without a body"),
        ],
    )
    complete, missing = lineage.extract_log_events(df)
    got = sorted((json.loads(r["event"]) for r in complete.collect()), key=lambda e: e["r"])
    assert got == [{"r": 1}, {"r": 2, "z": 1}, {"r": 3, "y": 2, "z": 1}, {"r": 4, "z": 1}]
    assert [r["event"] for r in missing.collect()] == ['{"r":5,']
    assert lineage.next_position(df) == 5001 and lineage.next_position(df.limit(0), 7) == 7
    assert lineage.since(df, 4001).count() == 3


def test_task_marker_holds_a_brace_itself(spark):
    df = events(spark, [("s", "a", 0, f"at {lineage.TASK_MARKER}{{\"r\":1}}"), ("s", "b", 1, lineage.TASK_MARKER + "nothing")])
    complete, missing = lineage.extract_log_events(df, lineage.TASK_MARKER)
    assert [r["event"] for r in complete.collect()] == ['{"r":1}'] and missing.count() == 0


def test_query_text_order_and_types(spark):
    parts = spark.createDataFrame([(1, 1, "b  "), (1, 0, "a "), (1, 320, "z")], "query_id int, sequence int, text string")
    assert rows(lineage.query_texts(parts)) == [(1, "abz")]
    assert rows(lineage.query_texts(parts, max_parts=320)) == [(1, "ab")]
    history = spark.createDataFrame([(1, 1, 1, 1, 5, 6, "INSERT"), (2, 1, 1, 1, 5, 6, "SELECT"), (3, 1, 1, 1, 1, 2, "DDL")],
        "query_id int, user_id int, transaction_id int, session_id int, start_time int, end_time int, query_type string")
    details = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 7)], "query_id int, table_id int")
    tables = spark.createDataFrame([(7, "d", "s", "t", "TABLE")], "table_id int, database string, schema string, table string, table_type string")
    got = lineage.query_history(history, parts, details, tables, start_time=3, unescape_text=True)
    assert rows(got.select("query_id", "table", "query_txt")) == [(1, "t", "abz")]


def test_crawls(spark):
    crawls = spark.createDataFrame(
        [("long", "c", "COMPLETED", 0, 100), ("short", "c", "COMPLETED", 40, 50), ("bad", "c", "FAILED", 0, 500), ("x", "d", "COMPLETED", 0, 9)],
        "crawl_id string, crawler string, state string, start_ms long, end_ms long",
    )
    tables = spark.createDataFrame(
        [("db", "t1", 60, "s3://b/a/t1/", [("id", "int")], "c"), ("db", "t2", 101, "s3://b/a/t2", [("id", "int")], "c"),
         ("db", "t3", 100, "s3://b/a/t3", [("id", "int")], "c"), ("db", "t4", 5, "s3://b/a/t4", [("id", "int")], None)],
        "database string, table string, created_ms long, location string, columns array<struct<name:string,type:string>>, crawler string",
    )
    assert rows(lineage.match_crawls(tables, crawls).select("table", "crawl_id"), "table") == [("t1", "long"), ("t3", "long")]
    got = {(r["table"], r["event_type"]): json.loads(r["event"]) for r in lineage.crawl_lineage(tables, crawls, {"LANG": "x"}).collect()}
    assert got[("t1", "START")]["run"]["facets"]["environment-properties"]["environment-properties"] == {"LANG": "x"}
    assert got[("t1", "COMPLETE")]["run"] == {"runId": "long"}
    done = got[("t1", "COMPLETE")]["outputs"][0]
    assert done["namespace"] == "s3://b/a" and done["facets"]["symlinks"]["identifiers"][0]["name"] == "db.t1"
    assert done["facets"]["columnLineage"]["fields"]["id"]["inputFields"] == [{"namespace": "s3://b/a", "name": "t1", "field": "id"}]
    assert "columnLineage" not in got[("t1", "START")]["inputs"][0]["facets"]


def test_paths_and_edges(spark):
    df = spark.createDataFrame([([("a", "x"), ("b", "y"), ("c", "z")],), ([("c", "z")],)], "path array<struct<table:string,column:string>>")
    fine = lineage.fine_grained(df, "p")
    assert rows(fine.select("downstream", "upstreams"), "upstreams") == [("p:c/z", []), ("p:c/z", ["p:a/x", "p:b/y"])]
    assert rows(lineage.upstream_tables(fine), "upstream_table") == [("c", "a"), ("c", "b")]
    edges = spark.createDataFrame([("t", "b"), ("t", "a"), ("t", "a")], "target_table string, source_table string")
    assert rows(lineage.table_lineage(edges)) == [("t", ["a", "b"])]


def test_text_helpers(spark):
    assert unescape_text(r"a\nb\x41é\\n\q") == "a\nbAé\\n\\q"
    df = spark.createDataFrame([("a\\tb", "/x/y/z/"), (None, "z")], "t string, l string")
    assert rows(df.select(unescape("t"), parent_path("l"))) == [("a\tb", "x/y"), (None, "")]


def test_unescape_column_equals_the_function(spark):
    texts = [r"a\nb", r"\\n", r"\\\n", r"\x41\\x41", r"tab\there", "mark \x01 \\n", r"\q \' \"", "", r"\101\u00e9", r"end\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    got = dict(rows(df.select("i", unescape("t"))))
    assert got == {**{i: unescape_text(t) for i, t in enumerate(texts)}, 99: None}
