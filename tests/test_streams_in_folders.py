from __future__ import annotations

import pytest

from lakeops.workloads import streams


@pytest.mark.parametrize("files", [1, 3])
def test_documents_in_a_folder_of_files(spark, tmp_path, files):
    docs = [(i, f"text {i}", ["en", "fr", "de"][i % 3], "web", 6) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    for query in (streams.document_load, streams.document_sink):
        assert tuple(query(spark, str(tmp_path)).head()) == (30, 20, 10)
