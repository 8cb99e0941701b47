from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import docs, vectors
from lakeops.session import part_count, work_path
from lakeops.sources import json_array
from lakeops.streaming import state
from lakeops.workloads import logs, operations


class _Unsliced(list):
    def __getitem__(self, at):
        assert not isinstance(at, slice), "a copy of the lines for each head"
        return super().__getitem__(at)


def test_settle_copies_no_lines():
    lines = _Unsliced((10 * i, f"e{i}", 0, '{"x":', '{"x":') for i in range(50))
    found, rest = state.settle(lines, 10_000, 100)
    assert len(found) == 50 and rest == []


def test_bulk_write_gives_letters_out_early(spark, monkeypatch):
    """Batches are reported as they come, not a page at a time, and documents come a thousand at a time."""
    sizes = []

    class Refuse:
        def __call__(self):
            def write(batch):
                raise ValueError("no")

            return write

    rows = spark.range(5000).select(F.lit("i").alias("_index"), F.col("id").cast("string").alias("_id"), F.lit('{"a":1}').alias("_source")).coalesce(1)
    frame = type(rows)
    whole = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *rest: sizes.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) or whole(self, *rest))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    stats = docs.bulk_write(rows, Refuse(), 700, work_path(spark, "report"), letters := work_path(spark, "letters"))
    assert sizes == ["1000"] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert sorted(r["docs"] for r in stats.collect()) == [100] + [700] * 7
    assert spark.read.json(letters).select(F.explode("data")).count() == 5000


def test_inputs_are_cut_by_size(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([(i, f"line {i}\nmore", "en", "web", 9) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    for module, query in ((logs, logs.multiline_files), (operations, operations.write_batches)):
        seen = []
        monkeypatch.setattr(module, "part_count", lambda df, least: seen.append(least) or part_count(df, least, 300))
        row = query(spark, str(tmp_path)).head()
        assert seen and row[0] == 400
    assert part_count(spark.read.parquet(str(tmp_path / "documents.parquet")), 4, 300) > 4


def test_json_blocks_share_tasks(spark, tmp_path, monkeypatch):
    """Blocks far smaller than a task's share do not make a task each."""
    text = "[" + ",".join('{"a":"},{%d"}' % i for i in range(3000)) + "]"
    (tmp_path / "a.json").write_text(text)
    parts, stored = {}, json_array.stored
    monkeypatch.setattr(json_array, "stored", lambda df, name: parts.update({name: df._jdf.queryExecution().toRdd().getNumPartitions()}) or stored(df, name))
    found = json_array.json_array_elements(spark, str(tmp_path), 200)
    assert parts["json-blocks"] <= 16 < len(text) / 200
    assert [r["text"] for r in found.orderBy("idx").collect()] == ['{"a":"},{%d"}' % i for i in range(3000)]


def test_sparse_search_reads_documents_once(spark):
    """Rows that come twice stay two, and the corpus is evaluated once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i % 40, {"common": 1.0, **({f"w{i % 7}": 2.0} if i % 3 else {}), "rare": 0.5 + i % 5}) for i in range(80)]
    shape = "doc_id bigint, terms map<string, double>"
    corpus = spark.createDataFrame(rows, shape).mapInArrow(count, shape)
    asked = spark.createDataFrame([(1, {"common": 0.1, "rare": 3.0, "w3": 0.2})], "query_id bigint, terms map<string, double>")
    assert len(vectors.sparse_topk(asked, corpus, 6).collect()) == 6
    assert seen.value == 80
