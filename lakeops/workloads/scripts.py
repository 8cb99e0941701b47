"""SQL-script queries: layered tables written by a parameterised script, and a timed suite."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.operators.tables import write_text
from lakeops.plans import script
from lakeops.session import tune, work_path

_STEPS = """
create or replace temp view sales_{RUN} using parquet options (path '{SF}/lineitem.parquet');
/* revenue per supplier and month; the busy and the quiet months go to tables of their own */
create table monthly_{RUN} using parquet location '{DIR}/monthly' as
  select l_suppkey as supplier, date_format(l_shipdate, 'yyyy-MM') as month, count(*) as lines, round(sum(l_quantity), 2) as quantity
  from sales_{RUN} group by 1, 2;
drop table if exists busy_{RUN};
create table busy_{RUN} using parquet location '{DIR}/busy' as select * from monthly_{RUN} where quantity >= {MANY};
drop table if exists quiet_{RUN};
create table quiet_{RUN} using parquet location '{DIR}/quiet' as select * from monthly_{RUN} where quantity < {MANY};
create table report_{RUN} using parquet location '${DIR}/report' as select * from busy_{RUN} where month < '${CUT}';
"""

_APPEND = "insert into report_{RUN} select * from quiet_{RUN} where month < '{CUT}'; select * from report_{RUN}"
_OVERWRITE = """insert overwrite table report_{RUN}
  select * from quiet_{RUN} where month >= '{CUT}' union select * from busy_{RUN} where month >= '{CUT}' and lines > 1;
select * from report_{RUN}"""


def _params(spark: SparkSession, sf: str) -> dict[str, str]:
    tune(spark)
    return {"RUN": uuid.uuid4().hex[:10], "SF": sf, "DIR": work_path(spark, "steps"), "MANY": "60", "CUT": "1998-06"}


def layers_append(spark: SparkSession, sf: str) -> DataFrame:
    return script.run_script(spark, _STEPS + _APPEND, _params(spark, sf))


def layers_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    return script.run_script(spark, _STEPS + _OVERWRITE, _params(spark, sf))


def create_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """The second CREATE finds the table and leaves it alone."""
    text = """
      create or replace temp view orders_{RUN} using parquet options (path '{SF}/orders.parquet');
      create table if not exists by_status_{RUN} using parquet location '{DIR}/status' as
        select o_orderstatus, count(*) as orders from orders_{RUN} group by o_orderstatus;
      create table if not exists by_status_{RUN} using parquet location '{DIR}/status2' as
        select o_orderstatus, count(*) + 1 as orders from orders_{RUN} group by o_orderstatus;
      select * from by_status_{RUN};
    """
    return script.run_script(spark, text, _params(spark, sf))


def suite_timing(spark: SparkSession, sf: str) -> DataFrame:
    params = _params(spark, sf)
    folder = work_path(spark, "suite")
    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"{sf}/{name}.parquet").createOrReplaceTempView(f"{name}_{params['RUN']}")
    write_text(spark, f"{folder}/q1.sql", "select l_returnflag, sum(l_quantity) q from lineitem_{RUN} group by 1;")
    write_text(
        spark,
        f"{folder}/q2.sql",
        "select o_orderpriority, count(*) n from orders_{RUN} group by 1; "
        "select p_brand, sum(l_extendedprice) s from lineitem_{RUN}, part_{RUN} where l_partkey = p_partkey group by 1;",
    )
    write_text(spark, f"{folder}/q3.sql", "select no_such_column from orders_{RUN}")
    return script.run_suite(spark, folder, params)


def suite_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return suite_timing(spark, sf).select("file", "statement", "rows", "ok")


def bytes_scanned(spark: SparkSession, sf: str) -> DataFrame:
    """A statement over one column, one over all of them and one over no file: rows, and whether each reads more than the one before."""
    params = _params(spark, sf)
    folder = work_path(spark, "suite")
    for name, text in (("q1", "select 1 as one"), ("q2", "select l_linenumber from lineitem_{RUN}"), ("q3", "select * from lineitem_{RUN}")):
        write_text(spark, f"{folder}/{name}.sql", text)
    spark.read.parquet(f"{sf}/lineitem.parquet").createOrReplaceTempView(f"lineitem_{params['RUN']}")
    report = script.run_suite(spark, folder, params)
    before = F.lag("gigabytes").over(Window.orderBy("file"))  # three rows
    return report.select("file", "rows", F.when(before.isNull(), F.col("gigabytes") == 0).otherwise(F.col("gigabytes") > before).alias("reads_more"))


QUERIES = {
    "script_layers_append": layers_append,
    "script_layers_overwrite": layers_overwrite,
    "script_create_if_absent": create_if_absent,
    "script_suite_timing": suite_timing,
    "script_suite_outcome": suite_outcome,
    "script_bytes_scanned": bytes_scanned,
}

_MONTHS = """select * from (select l_suppkey as supplier, strftime(l_shipdate, '%Y-%m') as month, count(*) as lines, round(sum(l_quantity), 2) as quantity
  from lineitem group by 1, 2) where {where}"""

ORACLE = {
    "script_layers_append": _MONTHS.format(where="month < '1998-06'"),
    "script_layers_overwrite": _MONTHS.format(where="month >= '1998-06' and (quantity < 60 or lines > 1)"),
    "script_create_if_absent": "select o_orderstatus, count(*) as orders from orders group by 1",
    "script_suite_outcome": """select 'q1.sql' as file, cast(1 as integer) as statement, count(distinct l_returnflag) as "rows", true as ok from lineitem
      union all select 'q2.sql', 1, count(distinct o_orderpriority), true from orders
      union all select 'q2.sql', 2, count(distinct p_brand), true from lineitem, part where l_partkey = p_partkey
      union all select 'q3.sql', 1, 0, false""",
    "script_bytes_scanned": """select 'q1.sql' as file, 1 as "rows", true as reads_more union all select 'q2.sql', count(*), true from lineitem
      union all select 'q3.sql', count(*), true from lineitem""",
}
