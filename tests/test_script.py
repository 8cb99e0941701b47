from __future__ import annotations

import pytest
from conftest import rows

from lakeops.plans import script


def test_split_is_aware_of_quotes_and_comments():
    text = "select ';' as a; -- note; more\n/* x; y */ select \"b;\";\n;----last\nselect 'it''s;'"
    assert script.split_statements(text) == ["select ';' as a", 'select "b;"', "select 'it''s;'"]


def test_params_and_substitution():
    params = script.parse_params("HOUR=11;DT='2024-01-01'")
    assert script.substitute("h = {HOUR} and d = '${DT}' and m = '{\"k\": 1}'", params) == "h = 11 and d = '2024-01-01' and m = '{\"k\": 1}'"
    with pytest.raises(KeyError):
        script.substitute("{MISSING}", params)
    for bad in ("import os", "a b=1"):
        with pytest.raises(ValueError):
            script.parse_params(bad)


def test_failing_statement_is_named(spark):
    with pytest.raises(script.ScriptError) as error:
        script.run_script(spark, "select 1; s; select 2")
    assert error.value.index == 2
    assert rows(script.run_script(spark, "select 1 as a; select {N} as a", {"N": "5"})) == [(5,)]
    seen = []
    script.run_script(spark, "select 1; select 2", on_result=lambda i, df: seen.append((i, df.head()[0])))
    assert seen == [(1, 1), (2, 2)]


def test_suite_and_catalog(spark, tmp_path):
    (tmp_path / "b.sql").write_text("select * from range(5)")
    (tmp_path / "a.sql").write_text("select nothing; select {X}")
    got = rows(script.run_suite(spark, str(tmp_path)).select("file", "statement", "rows", "ok"), "file", "statement")
    assert got == [("a.sql", 1, 0, False), ("a.sql", 2, 0, False), ("b.sql", 1, 5, True)]
    assert script.run_suite(spark, str(tmp_path)).filter("not ok and seconds <> -999").count() == 0
    spark.range(1).createOrReplaceTempView("listed_view")
    assert "listed_view" in [r["name"] for r in script.list_tables(spark).collect()]
    assert script.list_databases(spark).filter("database = 'default'").count() == 1


def test_bytes_follow_the_columns(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "hash(id) as a", "md5(cast(id as string)) as b").write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("wide_rows")
    few, all_, none = (script.time_statement(spark, q)["gigabytes"] for q in ("select a from wide_rows", "select * from wide_rows", "select 1 as one"))
    assert 0 == none < few < all_ / 2
    assert script.time_statement(spark, "select a from wide_rows where id < 0")["gigabytes"] < few
