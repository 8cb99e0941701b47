"""Star-schema report queries as parameterised DataFrame plans.

Joins carry no broadcast hints: Spark broadcasts a dimension only while its measured size is under
`spark.sql.autoBroadcastJoinThreshold`, and adaptive execution splits skewed join partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")


def between_dates(column: str, start: str, end: str) -> Column:
    """Half-open date range. Unlike a condition on year() or month() it reaches the Parquet scan."""
    return (F.col(column) >= F.lit(start).cast("date")) & (F.col(column) < F.lit(end).cast("date"))


def above_group_average(
    totals: DataFrame, group: str, value: str, factor: float = 1.2
) -> DataFrame:
    """Rows whose value exceeds `factor` times the average of their group (the correlated-subquery report).

    The average is an aggregate joined back, not a window, so a hot group is never sorted in one task.
    """
    limit = totals.groupBy(group).agg((F.avg(value) * factor).alias("_limit"))
    return totals.join(limit, group).filter(F.col(value) > F.col("_limit")).drop("_limit")


def weekday_totals(sales: DataFrame, date: str, amount: str, days: Sequence[int] = ()) -> DataFrame:
    """Sales per week number, one column per weekday. Weeks count from a Sunday. `days` adds a count of rows of each of these years."""
    day = F.col(date).cast("date")
    week = F.floor((F.datediff(day, F.lit("1970-01-04").cast("date"))) / 7)
    sums = [
        F.sum(F.when(F.dayofweek(day) == i + 1, F.col(amount))).alias(f"{name}_sales")
        for i, name in enumerate(WEEKDAYS)
    ]
    sums += [F.count_if(F.year(day) == y).alias(f"_days_{y}") for y in days]
    return sales.groupBy(week.alias("week_seq")).agg(*sums)


def weekday_yoy(sales: DataFrame, date: str, amount: str, year: int, lag_weeks: int = 53) -> DataFrame:
    """Ratio of each weekday's sales to the same weekday `lag_weeks` later.

    As in the star-schema query, a week repeats once per pair of its calendar days in the two years. The sales are read once, and only
    those of the weeks of the two years; a week meets the one after `lag_weeks` by grouping on the shifted number, not by a join.
    """
    near = between_dates(date, f"{year - 1}-12-25", f"{year + 2}-01-08")
    day = F.col(date).cast("date")
    daily = sales.filter(near).groupBy(day.alias("_day")).agg(F.sum(amount).alias("_amount"))
    weekly = weekday_totals(daily, "_day", "_amount", days=[year, year + 1])
    columns = [f"{d}_sales" for d in WEEKDAYS]
    first = F.struct(F.col("week_seq").alias("week"), F.col(f"_days_{year}").alias("times"), *columns)
    second = F.struct((F.col("week_seq") - lag_weeks).alias("week"), F.col(f"_days_{year + 1}").alias("times"), *columns)
    sides = weekly.select(F.posexplode(F.array(first, second)).alias("side", "w")).filter("w.times > 0")
    met = sides.groupBy(F.col("w.week").alias("week_seq")).agg(
        F.max(F.when(F.col("side") == 0, F.col("w"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("w"))).alias("b")
    )
    pairs = met.filter("a is not null and b is not null")
    repeated = pairs.withColumn("_n", F.explode(F.sequence(F.lit(1), (F.col("a.times") * F.col("b.times")).cast("int"))))
    return repeated.select(
        F.col("week_seq").cast("bigint").alias("week_seq"),
        *(F.round(F.try_divide(f"a.{d}_sales", f"b.{d}_sales"), 2).alias(d) for d in WEEKDAYS),
    )


def brand_month(
    lines: DataFrame, items: DataFrame, orders: DataFrame, item_filter: Column, month: int, limit: int = 100
) -> DataFrame:
    """Revenue by year and brand for one manufacturer and one calendar month."""
    joined = (
        lines.join(items.filter(item_filter), lines["l_partkey"] == items["p_partkey"])
        .join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .filter(F.month("o_orderdate") == month)
    )
    grouped = joined.groupBy(
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("brand_id"),
        F.col("p_brand").alias("brand"),
    ).agg(F.round(F.sum("l_extendedprice"), 2).alias("sum_agg"))
    return grouped.orderBy("year", F.desc("sum_agg"), "brand_id").limit(limit)


def growth_compare(
    yearly: DataFrame, customer: Sequence[str], channels: Mapping[str, str], year: int
) -> DataFrame:
    """Customers whose `c` channel grew faster than their `s` and `w` channels.

    The six-way self join of (channel, year) totals is one conditional aggregate over a single scan.
    `yearly` has the customer columns, `channel`, `y` and `amount`.
    """
    sums = {
        f"{name}{offset}": F.sum(F.when((F.col("channel") == code) & (F.col("y") == year + offset), F.col("amount")))
        for name, code in channels.items()
        for offset in (0, 1)
    }
    wide = (
        yearly.filter(F.col("y").isin(year, year + 1))
        .groupBy(*customer)
        .agg(*(expression.alias(name) for name, expression in sums.items()))
    )
    growth = {n: F.when(F.col(f"{n}0") > 0, F.try_divide(f"{n}1", f"{n}0")) for n in channels}
    present = F.lit(True)
    for n in channels:
        present = present & (F.col(f"{n}0") > 0) & F.col(f"{n}1").isNotNull()
    return wide.filter(present & (growth["c"] > growth["s"]) & (growth["c"] > growth["w"])).select(*customer)


def channel_rollup(flows: DataFrame, date: str, start: str, days: int, limit: int = 100) -> DataFrame:
    """Sales, returns and profit per channel and id with subtotals over a date window.

    `flows` is the union of sales and returns: channel, id, the date, sales, profit, returns, loss.
    """
    begin = F.lit(start).cast("date")
    window = (F.col(date) >= begin) & (F.col(date) < F.date_add(begin, days + 1))
    by_id = flows.filter(window).groupBy("channel", "id").agg(
        F.sum("sales").alias("sales"),
        F.sum("returns").alias("returns"),
        (F.sum("profit") - F.sum("loss")).alias("profit"),
    )
    rolled = by_id.rollup("channel", "id").agg(
        *(F.round(F.sum(c), 4).alias(c) for c in ("sales", "returns", "profit"))
    )
    return rolled.orderBy(F.asc_nulls_first("channel"), F.asc_nulls_first("id")).limit(limit)


def average_slice(facts: DataFrame, by: str, measures: Mapping[str, str], limit: int = 100) -> DataFrame:
    """Averages per item over an already filtered star join."""
    grouped = facts.groupBy(by).agg(*(F.round(F.avg(c), 6).alias(name) for name, c in measures.items()))
    return grouped.orderBy(by).limit(limit)


def loss_slice(facts: DataFrame, shown: Sequence[str], hidden: Sequence[str], loss: Column) -> DataFrame:
    """Loss by call center: grouped also by hidden demographics, largest first."""
    grouped = facts.groupBy(*shown, *hidden).agg(F.round(F.sum(loss), 4).alias("returns_loss"))
    return grouped.orderBy(F.desc("returns_loss")).select(*shown, "returns_loss")


def with_calendar(df: DataFrame, time: str) -> DataFrame:
    """All columns plus year, month, day, hour."""
    return df.withColumns({"year": F.year(time), "month": F.month(time), "day": F.day(time), "hour": F.hour(time)})


def hourly_counts(rides: DataFrame, hours: Sequence[int] | None = None) -> DataFrame:
    """Rides per padded date key and hour; `rides` has the calendar columns.

    Several hour slices are one scan with an IN list instead of a union of scans.
    """
    if hours is not None:
        rides = rides.filter(F.col("hour").isin(*hours))
    counts = rides.groupBy("year", "month", "day", "hour").agg(F.count("*").alias("cnt"))
    padded = [F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day")]
    return counts.select(
        F.concat(F.col("year").cast("string"), F.lit("-"), padded[0], F.lit("-"), padded[1]).alias("pardate"), "hour", "cnt"
    )


def day_slices(rides: DataFrame, time: str, day: str, *hours: Sequence[int]) -> DataFrame:
    """Distinct union of hourly slices of one day: one scan of the day with one list of hours."""
    wanted = sorted({h for some in hours for h in some})
    tomorrow = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
    return hourly_counts(with_calendar(rides.filter(between_dates(time, day, tomorrow)), time), wanted)
