"""Star-schema reports on the driver tables.

Returns are `lineitem` rows with return flag R, stores are suppliers, channels are return flags or order
priorities, the calendar is the order or ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.plans import star
from lakeops.session import table


def over_average(spark: SparkSession, sf: str) -> DataFrame:
    returns = table(spark, sf, "lineitem").filter(
        (F.col("l_returnflag") == "R") & star.between_dates("l_shipdate", "2000-01-01", "2001-01-01")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    totals = (
        returns.join(orders, returns["l_orderkey"] == orders["o_orderkey"])
        .groupBy("o_custkey", "l_suppkey")
        .agg(F.sum("l_extendedprice").alias("total"))
    )
    above = star.above_group_average(totals, "l_suppkey", "total")
    stores = table(spark, sf, "supplier").join(
        table(spark, sf, "nation").filter("n_name = 'NATION_6'"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    found = above.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return found.select("c_name").orderBy("c_name").limit(100)


def weekday_yoy(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d"), F.col("l_extendedprice").alias("amount"))
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("amount"))
    return star.weekday_yoy(lines.unionByName(orders), "d", "amount", 1998)


def brand_month(spark: SparkSession, sf: str) -> DataFrame:
    return star.brand_month(
        table(spark, sf, "lineitem"),
        table(spark, sf, "part"),
        table(spark, sf, "orders"),
        F.col("p_size") == 28,
        11,
    )


def growth_compare(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").filter(star.between_dates("l_shipdate", "1998-01-01", "2000-01-01"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    cost = F.col("l_extendedprice") * F.col("l_tax")
    rebate = F.col("l_extendedprice") * F.col("l_discount")
    yearly = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", F.col("l_returnflag").alias("channel"), F.year("l_shipdate").alias("y"))
        .agg(F.sum(((F.col("l_extendedprice") - cost - rebate) + F.col("l_extendedprice")) / 2).alias("amount"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    found = star.growth_compare(yearly, ["c_name", "c_mktsegment"], {"s": "N", "c": "A", "w": "R"}, 1998)
    return found.orderBy("c_name", "c_mktsegment").limit(100)


def channel_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Sales and returns of three channels: the order's priority makes the channel, supplier, brand or customer segment its ids.

    All channels are one join of the facts; the site of a web sale may be missing, the brand of a catalog sale may not.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    facts = (
        table(spark, sf, "lineitem").filter(F.col("l_returnflag").isNotNull())
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    zero = F.lit(0.0)
    price, profit = F.col("l_extendedprice"), F.col("l_extendedprice") * F.col("l_discount")
    priority = F.col("o_orderpriority")
    channel = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "store")
        .when((priority == "3-MEDIUM") & F.col("p_partkey").isNotNull(), "catalog")
        .when(priority.isin("4-NOT SPECIFIED", "5-LOW"), "web")
    )
    ident = F.when(channel == "store", F.col("l_suppkey").cast("string")).when(channel == "catalog", F.col("p_brand")).otherwise(F.col("c_mktsegment"))
    # Sales and returns live in one table here, so their union is one pass with conditional amounts.
    returned = F.col("l_returnflag") == "R"
    flows = facts.filter(channel.isNotNull()).select(
        F.concat(channel, F.lit(" channel")).alias("channel"),
        F.concat(channel, ident).alias("id"),
        F.col("l_shipdate").alias("d"),
        F.when(returned, zero).otherwise(price).alias("sales"),
        F.when(returned, zero).otherwise(profit).alias("profit"),
        F.when(returned, price).otherwise(zero).alias("returns"),
        F.when(returned, price * F.col("l_tax")).otherwise(zero).alias("loss"),
    )
    return star.channel_rollup(flows, "d", "2000-08-23", 14)


def average_slice(spark: SparkSession, sf: str) -> DataFrame:
    facts = (
        table(spark, sf, "lineitem").filter((F.col("l_discount") == 0.05) | (F.col("l_tax") == 0.02))
        .join(table(spark, sf, "orders").filter(star.between_dates("o_orderdate", "2000-01-01", "2001-01-01")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation").filter("n_regionkey = 2"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    measures = {"agg1": "l_quantity", "agg2": "l_extendedprice", "agg3": "l_discount", "agg4": "p_retailprice"}
    return star.average_slice(facts, "p_partkey", measures)


def loss_slice(spark: SparkSession, sf: str) -> DataFrame:
    facts = (
        table(spark, sf, "lineitem").filter(
            (F.col("l_returnflag") == "R") & star.between_dates("l_shipdate", "1999-11-01", "1999-12-01")
        )
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            table(spark, sf, "customer").filter(
                ((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0))
                | ((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 1000))
            ),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(table(spark, sf, "part").filter(F.col("p_type").like("S%")), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return star.loss_slice(
        facts, ["s_suppkey", "s_name"], ["c_mktsegment"], F.col("l_extendedprice") * F.col("l_tax")
    )


def hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return star.hourly_counts(star.with_calendar(table(spark, sf, "events"), "ts"))


def hourly_union_day(spark: SparkSession, sf: str) -> DataFrame:
    return star.day_slices(table(spark, sf, "events"), "ts", "2024-01-02", [11, 12, 13], [13, 14])


QUERIES = {
    "star_over_average": over_average,
    "star_weekday_yoy": weekday_yoy,
    "star_brand_month": brand_month,
    "star_growth_compare": growth_compare,
    "star_channel_rollup": channel_rollup,
    "star_average_slice": average_slice,
    "star_loss_slice": loss_slice,
    "hourly_counts": hourly_counts,
    "hourly_union_day": hourly_union_day,
}

_DAYS = ", ".join(
    f"sum(case when dayofweek(d) = {i} then amount end) as {name}_sales" for i, name in enumerate(star.WEEKDAYS)
)
_RATIOS = ", ".join(f"round(y.{d}_sales / z.{d}_sales, 2) as {d}" for d in star.WEEKDAYS)


def _flows(channel: str, name: str, rows: str) -> str:
    base = f"select '{channel}' as channel, {name} as id, l_shipdate as d, "
    return f"""{base} l_extendedprice as sales, l_extendedprice * l_discount as profit, 0.0::double as returns, 0.0::double as loss from {rows} and l_returnflag <> 'R'
      union all {base} 0.0, 0.0, l_extendedprice, l_extendedprice * l_tax from {rows} and l_returnflag = 'R'"""


_STORE = "lineitem join orders on l_orderkey = o_orderkey where o_orderpriority in ('1-URGENT', '2-HIGH')"
_CATALOG = "lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey where o_orderpriority = '3-MEDIUM'"
_WEB = """lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
  where o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')"""
HOURLY_SQL = """select strftime(ts, '%Y-%m-%d') as pardate, cast(hour(ts) as integer) as hour, count(*) as cnt
  from events {where} group by 1, 2"""

ORACLE = {
    "star_over_average": """with totals as (select o_custkey, l_suppkey, sum(l_extendedprice) as total
        from lineitem, orders where l_orderkey = o_orderkey and l_returnflag = 'R' and year(l_shipdate) = 2000 group by 1, 2)
      select c_name from totals t1, supplier, nation, customer
      where t1.total > (select avg(total) * 1.2 from totals t2 where t1.l_suppkey = t2.l_suppkey)
        and s_suppkey = t1.l_suppkey and n_nationkey = s_nationkey and n_name = 'NATION_6' and t1.o_custkey = c_custkey
      order by c_name limit 100""",
    "star_weekday_yoy": f"""with sales as (select cast(l_shipdate as date) as d, l_extendedprice as amount from lineitem
        union all select cast(o_orderdate as date), o_totalprice from orders),
      weekly as (select cast(floor((d - date '1970-01-04') / 7) as bigint) as week_seq, {_DAYS} from sales group by 1),
      calendar as (select distinct d, cast(floor((d - date '1970-01-04') / 7) as bigint) as week_seq, year(d) as y from sales),
      y as (select weekly.* from weekly, calendar where weekly.week_seq = calendar.week_seq and y = 1998),
      z as (select weekly.* from weekly, calendar where weekly.week_seq = calendar.week_seq and y = 1999)
      select y.week_seq, {_RATIOS} from y, z where y.week_seq = z.week_seq - 53""",
    "star_brand_month": """select year(o_orderdate) as year, cast(regexp_extract(p_brand, '(\\d+)$', 1) as bigint) as brand_id,
        p_brand as brand, round(sum(l_extendedprice), 2) as sum_agg
      from lineitem, orders, part where l_orderkey = o_orderkey and l_partkey = p_partkey and p_size = 28 and month(o_orderdate) = 11
      group by 1, 2, 3 order by year, sum_agg desc, brand_id limit 100""",
    "star_growth_compare": """with yt as (select c_name, c_mktsegment, l_returnflag as ch, year(l_shipdate) as y,
          sum(((l_extendedprice - l_extendedprice * l_tax - l_extendedprice * l_discount) + l_extendedprice) / 2) as amount
        from customer, orders, lineitem where c_custkey = o_custkey and o_orderkey = l_orderkey group by 1, 2, 3, 4)
      select s2.c_name, s2.c_mktsegment from yt s1, yt s2, yt c1, yt c2, yt w1, yt w2
      where s2.c_name = s1.c_name and s1.c_name = c2.c_name and s1.c_name = c1.c_name and s1.c_name = w1.c_name and s1.c_name = w2.c_name
        and s1.ch = 'N' and s2.ch = 'N' and c1.ch = 'A' and c2.ch = 'A' and w1.ch = 'R' and w2.ch = 'R'
        and s1.y = 1998 and s2.y = 1999 and c1.y = 1998 and c2.y = 1999 and w1.y = 1998 and w2.y = 1999
        and s1.amount > 0 and c1.amount > 0 and w1.amount > 0
        and case when c1.amount > 0 then c2.amount / c1.amount end > case when s1.amount > 0 then s2.amount / s1.amount end
        and case when c1.amount > 0 then c2.amount / c1.amount end > case when w1.amount > 0 then w2.amount / w1.amount end
      order by 1, 2 limit 100""",
    "star_channel_rollup": f"""with flows as (
        {_flows('store channel', "'store' || cast(l_suppkey as varchar)", _STORE)}
        union all {_flows('catalog channel', "'catalog' || p_brand", _CATALOG)}
        union all {_flows('web channel', "'web' || c_mktsegment", _WEB)}),
      x as (select channel, id, sum(sales) as sales, sum(returns) as returns, sum(profit) - sum(loss) as profit from flows
        where cast(d as date) between date '2000-08-23' and date '2000-08-23' + interval 14 day group by 1, 2)
      select channel, id, round(sum(sales), 4) as sales, round(sum(returns), 4) as returns, round(sum(profit), 4) as profit
      from x group by rollup (channel, id) order by channel nulls first, id nulls first limit 100""",
    "star_average_slice": """select p_partkey, round(avg(l_quantity), 6) as agg1, round(avg(l_extendedprice), 6) as agg2,
        round(avg(l_discount), 6) as agg3, round(avg(p_retailprice), 6) as agg4
      from lineitem, orders, customer, nation, part
      where l_orderkey = o_orderkey and o_custkey = c_custkey and c_nationkey = n_nationkey and l_partkey = p_partkey
        and c_mktsegment = 'BUILDING' and n_regionkey = 2 and (l_discount = 0.05 or l_tax = 0.02) and year(o_orderdate) = 2000
      group by 1 order by 1 limit 100""",
    "star_loss_slice": """select s_suppkey, s_name, round(sum(l_extendedprice * l_tax), 4) as returns_loss
      from lineitem, orders, customer, nation, region, part, supplier
      where l_orderkey = o_orderkey and o_custkey = c_custkey and c_nationkey = n_nationkey and n_regionkey = r_regionkey
        and l_partkey = p_partkey and l_suppkey = s_suppkey and l_returnflag = 'R' and year(l_shipdate) = 1999 and month(l_shipdate) = 11
        and r_name = 'ASIA' and p_type like 'S%'
        and ((c_mktsegment = 'BUILDING' and c_acctbal > 0) or (c_mktsegment = 'MACHINERY' and c_acctbal > 1000))
      group by s_suppkey, s_name, c_mktsegment""",
    "hourly_counts": HOURLY_SQL.format(where=""),
    "hourly_union_day": HOURLY_SQL.format(where="where cast(ts as date) = date '2024-01-02' and hour(ts) between 11 and 14"),
}
