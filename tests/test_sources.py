from __future__ import annotations

import json
import random

import oracle
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.sources import readers
from lakeops.sources.json_array import json_array, json_array_elements
from lakeops.workloads import operations


def test_kafka_start_is_an_offset_or_a_time():
    latest = readers.kafka_options("h:9092", ["a", "b"], max_offsets=None)
    assert latest["subscribe"] == "a,b" and latest["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in latest
    timed = readers.kafka_options("h", "a", start=1700000000000, group="g", user="u", password="p")
    assert timed["startingTimestamp"] == "1700000000000" and "startingOffsets" not in timed
    assert timed["kafka.sasl.mechanism"] == "SCRAM-SHA-512" and 'username="u"' in timed["kafka.sasl.jaas.config"]


def test_message_values(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "value binary").withColumn("timestamp", F.timestamp_seconds(F.lit(7)))
    assert rows(readers.message_values(df, with_time=True)) == [("x", 7)]


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", "t", user="u", partition_column="id", bounds=(0, 100), partitions=4)
    assert options["numPartitions"] == "4" and options["upperBound"] == "100" and "password" not in options
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")


def test_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "x.txt").write_text('{"a":"p|q"}\n\n{"a":2}\n')
    assert rows(readers.change_files(spark, str(tmp_path / "in")), "value") == [('{"a":"p|q"}',), ('{"a":2}',)]
    (tmp_path / "array.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    (tmp_path / "object.json").write_text(json.dumps({"a": 1, "b": {"c": 2}}, indent=1))
    assert readers.json_documents(spark, str(tmp_path / "array.json")).count() == 2
    assert readers.json_documents(spark, str(tmp_path / "object.json")).count() == 1
    (tmp_path / "lines.jsonl").write_text('{"a":1}\n  \n{bad\n{"a":3}\n')
    good, bad = readers.json_lines(spark, str(tmp_path / "lines.jsonl"), "a int")
    assert rows(good, "a") == [(1,), (3,)] and rows(bad) == [("{bad",)]
    (tmp_path / "x.csv").write_text("h1,h2,h3\n1,ann,x\n2,,y\n3,bob,z\n")
    got = readers.positional_csv(spark, str(tmp_path / "x.csv"), ["id", "name", "c"], ["name", "c"], ["name"])
    assert rows(got, "name") == [("ann", "x"), ("bob", "z")]


def test_generated_rows(spark):
    trips = readers.synthetic_trips(spark, 5, 20)
    assert rows(trips.filter("trip_id = 13").select("route_id", "destination")) == [("D", "Los Angeles")]
    assert trips.count() == 20 and trips.agg(F.min("trip_id")).head()[0] == 5
    assert rows(readers.inline_rows(spark, [(1, "a", 2)], "id int, s string, n int")) == [(1, "a", 2)]


ODD = ['{"a":1}', '{"a":"},{[\\"x\\\\"}', '"text, with } and \\" in it"', "17", "null", '[[1,2],{"b":[]}]', '{ "a" : {"b": "\\\\\\\\"} }', '{"é中": "}😀"}', "{}", '""']


@pytest.mark.parametrize("block", [16, 64, 1024])
def test_json_array_in_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    files = {}
    for n in range(6):
        items = [rng.choice(ODD) for _ in range(rng.randrange(1, 60))] if n else []
        gap = lambda: rng.choice(["", " ", "\n  ", "\t"])
        text = gap() + "[" + ",".join(gap() + x + gap() for x in items) + "]" + rng.choice(["", "\n"])
        (tmp_path / f"{n}.json").write_bytes((b"\xef\xbb\xbf" if n == 2 else b"") + text.encode())
        files[f"{n}.json"] = items
    (tmp_path / "6.json").write_text('{"one": [1, {"x": "}"}],\n "two": "' + "y" * 100 + '"}\n')
    files["6.json"] = [(tmp_path / "6.json").read_text().strip()]
    (tmp_path / "7.json").write_text('{"a":[{}]}')
    files["7.json"] = ['{"a":[{}]}']
    (tmp_path / "8.json").write_text("")
    got = {name: {} for name in files}
    for path, idx, text in json_array_elements(spark, str(tmp_path), block).collect():
        got[path.rsplit("/", 1)[1]][idx] = text
    assert {name: [found[i] for i in sorted(found)] for name, found in got.items()} == files
    assert all(sorted(found) == list(range(len(found))) for found in got.values())
    with pytest.raises(KeyError):
        got["8.json"]


def test_json_array_rows(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([{"a": i, "b": [{"c": "]" * i}]} for i in range(40)], indent=2))
    got = json_array(spark, str(tmp_path), block_bytes=100)
    assert rows(got.select("a", F.col("b")[0]["c"]), "a") == [(i, "]" * i) for i in range(40)]
    assert json_array(spark, str(tmp_path), "a int").count() == 40


def test_json_array_query_in_small_blocks(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(operations.json_array_blocks(spark, sf, 1024), oracle.connect(sf), operations.ORACLE["source_json_array_blocks"]) is None
