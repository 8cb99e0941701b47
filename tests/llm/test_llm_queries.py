"""The registered queries on the smallest data set: against their SQL where there is one, else for whole results."""

from __future__ import annotations

import os

import oracle
import pytest

from lakeops.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS = {"op4_projection_forest": "select count(*) filter (where vec_id % 20 = 0) * 20 from embeddings", "op6_variable_best_fit": None}


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    con, df = oracle.connect(SF), QUERIES[name](spark, SF)
    if name in ORACLE:
        assert oracle.compare(df, con, ORACLE[name]) is None
        return
    rows = df.collect()
    wanted = con.execute(ROWS.get(name, "select count(*) from documents") or "select 1").fetchone()[0]
    assert len(rows) == wanted or name == "op6_variable_best_fit" and len(rows) >= con.execute("select count(*) from documents where n_chars > 0").fetchone()[0] - 5
