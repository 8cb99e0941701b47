"""Change-data queries: `events` becomes a change stream per user, `orders` and `lineitem` a keyed merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import cdc
from lakeops.session import spread, stored, table, work_path

_OPS = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}
_ORDER = ["ts_ms", "event_id"]
_PAYLOAD = "user_id bigint, event_id bigint, event_type string, value double"
_TABLES = [cdc.TableConfig(db, name, ("user_id",), schema=_PAYLOAD) for db in ("crm", "shop") for name in ("visits", "users")]


def op_code() -> Column:
    mapping = F.create_map(*(F.lit(x) for pair in _OPS.items() for x in pair))
    return F.element_at(mapping, F.col("event_type"))


def ts_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def change_events(events: DataFrame, extra: bool = False) -> DataFrame:
    """`events` as change-event JSON text in `value`; purchases carry one more payload field with `extra`."""
    if not events.isStreaming:
        events = spread(events)
    fields = [F.col(c) for c in ("user_id", "event_id", "event_type", "value")]
    if extra:
        fields.append(F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"))
    row = F.struct(*fields)
    deleted = F.col("event_type") == "error"
    source = F.struct(
        F.when(F.col("user_id") % 2 == 0, "shop").otherwise("crm").alias("db"),
        F.when(F.col("event_type").isin("view", "click"), "visits").otherwise("users").alias("table"),
    )
    event = F.struct(
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        source.alias("source"),
        op_code().alias("op"),
        ts_ms().alias("ts_ms"),
    )
    return events.select(F.to_json(event).alias("value"))


def _routed(spark: SparkSession, sf: str, policy: str = "C") -> DataFrame:
    parsed = cdc.parse_envelope(change_events(table(spark, sf, "events")))
    return cdc.route(parsed, policy)


def _decoded(spark: SparkSession, sf: str, policy: str = "C") -> DataFrame:
    routed = _routed(spark, sf, policy).select("ts_ms", "action", cdc.payload().alias("data"))
    return cdc.decode(routed, "data", _PAYLOAD)


def live_state(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.apply_changelog(None, _decoded(spark, sf), ["user_id"], _ORDER).drop("ts_ms")


def live_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return live_state(spark, sf).groupBy("event_type").agg(F.count("*").alias("users"), F.round(F.sum("value"), 2).alias("value"))


def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cdc.parse_envelope(change_events(table(spark, sf, "events")))
    # Routing looks only at the code and at which payloads exist: count those first, then route the counts.
    shapes = parsed.groupBy(
        "op",
        F.when(F.col("before").isNotNull(), "{}").alias("before"),
        F.when(F.col("after").isNotNull(), "{}").alias("after"),
    ).agg(F.count("*").alias("n"))
    parts = [
        cdc.route(shapes, p).groupBy("action").agg(F.sum("n").alias("events")).withColumn("policy", F.lit(p))
        for p in cdc.POLICIES
    ]
    return reduce(DataFrame.unionByName, parts)


def table_action_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.batch_counts(cdc.with_source(_routed(spark, sf, "A")))


def demuxed(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cdc.with_source(cdc.route(cdc.parse_envelope(change_events(table(spark, sf, "events"))), "C"))
    parts = []
    for (db, name), rows in cdc.demux(parsed, _TABLES, stage=work_path(spark, "demux")).items():
        state = cdc.apply_changelog(
            None,
            cdc.decode(rows.select("ts_ms", "action", cdc.payload().alias("data")), "data", _PAYLOAD),
            ["user_id"],
            _ORDER,
        )
        parts.append(state.select(F.lit(db).alias("db"), F.lit(name).alias("table"), "user_id", "event_id", "event_type"))
    return reduce(DataFrame.unionByName, parts)


def decode_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Columns each schema mode finds, with the rows that fill them."""
    events = table(spark, sf, "events")
    routed = cdc.route(cdc.parse_envelope(change_events(events, extra=True)), "C")
    rows = stored(routed.select("ts_ms", cdc.payload().alias("data")), "routed")
    parts = []
    for mode in ("batch", "first", "last", "target"):
        schema = f"{_PAYLOAD}, amount double" if mode == "target" else None
        decoded = cdc.decode(rows, "data", schema, infer=mode, order=["ts_ms"]).drop("ts_ms")
        counts = decoded.agg(*(F.count(c).alias(c) for c in decoded.columns))
        parts.append(
            counts.unpivot([], counts.columns, "field", "filled").select(F.lit(mode).alias("mode"), "field", "filled")
        )
    return reduce(DataFrame.unionByName, parts)


def applied(spark: SparkSession, sf: str, mode: str = "latest") -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    changes = _decoded(spark, sf, "A" if mode == "sequential" else "C")
    return cdc.apply_changelog(customers, changes, ["user_id"], _ORDER, mode).select(
        "user_id", "event_id", "event_type", "value"
    )


def _order_changes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        "l_shipdate",
        "l_linenumber",
    )
    latest = cdc.dedupe_latest(lines, ["o_orderkey"], ["l_shipdate", "l_linenumber", "o_totalprice", "o_orderstatus"])
    return latest.drop("l_shipdate", "l_linenumber")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.merge_rows(_orders(spark, sf), _order_changes(spark, sf), ["o_orderkey"])


def merge_partial(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.merge_rows(
        _orders(spark, sf), _order_changes(spark, sf), ["o_orderkey"], ["o_totalprice"], ["o_orderkey", "o_orderstatus"]
    )


def delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    gone = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return cdc.delete_rows(_orders(spark, sf), gone, ["o_orderkey"])


def nearest_time(spark: SparkSession, sf: str) -> DataFrame:
    raw = spread(table(spark, sf, "events")).select(
        F.to_json(F.struct(F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("timeStamp"),
                           F.struct(F.struct(F.col("user_id").cast("string").alias("vin")).alias("unit")).alias("Data"))).alias("kafka_data"),
        F.col("ts").cast("timestamp").alias("kafka_time"),
        "event_id",
    )
    rows = raw.select(
        F.get_json_object("kafka_data", "$.Data.unit.vin").alias("vin"),
        F.get_json_object("kafka_data", "$.timeStamp").cast("bigint").alias("active_timestamp"),
        "kafka_time",
        "event_id",
    )
    nearest = cdc.dedupe_nearest(rows, ["vin", "active_timestamp"], "kafka_time", "active_timestamp", ["event_id"])
    return nearest.select("vin", "active_timestamp", "event_id", F.unix_millis("kafka_time").alias("kafka_ms"))


def schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("size"), F.col("s_name").alias("name")
    )
    return cdc.union_evolved(old, new)


def ddl_log(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "ALTER").when(F.col("event_type") == "click", "CREATE")
    name = F.concat(F.lit("t"), F.col("user_id").cast("string"))
    change = F.struct(F.concat(F.lit("x."), name).alias("id"), kind.alias("type"), F.lit("{}").alias("table"))
    db = F.when(F.col("user_id") % 2 == 0, "shop").otherwise("crm")
    event = F.struct(
        db.alias("databaseName"),
        F.when(kind.isNotNull(), F.to_json(F.array(change))).otherwise("[]").alias("tableChanges"),
        F.to_json(F.struct(db.alias("db"), name.alias("table"), ts_ms().alias("ts_ms"), F.col("event_id").cast("int").alias("pos"))).alias("source"),
        F.concat(F.lit("ALTER TABLE "), name, F.lit(" ADD COLUMN c"), F.col("event_id").cast("string"), F.lit(" int")).alias("ddl"),
    )
    log = spread(table(spark, sf, "events")).select(F.to_json(event).alias("value"))
    return cdc.schema_changes(log, "shop")


def field_map(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.map_fields(
        table(spark, sf, "orders"),
        [
            ("o_orderkey", "bigint", "id", "string"),
            ("o_totalprice", "double", "price", "decimal(12,1)"),
            ("o_orderpriority", "string", "priority", "string"),
        ],
    ).withColumn("price", F.col("price").cast("double"))


def coerced_times(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a time").otherwise(F.col("ts").cast("string")).alias("created_at"),
    )
    done = cdc.coerce_timestamps(text, ["created_at", "updated_at"])
    return done.select("event_id", F.unix_millis("created_at").alias("created_ms"))


def flink_state(spark: SparkSession, sf: str) -> DataFrame:
    code = (
        F.when(F.col("event_type") == "signup", "+I").when(F.col("event_type") == "error", "-D")
        .when(F.col("event_type") == "view", "-U").otherwise("+U")
    )
    data = F.struct("user_id", "event_id", "event_type", "value", ts_ms().alias("ts_ms"))
    log = spread(table(spark, sf, "events")).select(F.to_json(F.struct(data.alias("data"), code.alias("op"))).alias("value"))
    routed = cdc.route(cdc.parse_envelope(log, "flink"), "C", before="data", after="data")
    changes = cdc.decode(routed.select("action", "data"), "data", f"{_PAYLOAD}, ts_ms bigint")
    return cdc.apply_changelog(None, changes, ["user_id"], _ORDER).drop("ts_ms")


def replication_rows(spark: SparkSession, sf: str) -> DataFrame:
    data = F.struct("event_id", "user_id", F.col("value").alias("price"))
    log = spread(table(spark, sf, "events")).select(
        F.to_json(
            F.struct(
                F.when(F.col("event_type") != "error", data).alias("data"),
                F.struct(F.col("event_type").alias("operation")).alias("metadata"),
            )
        ).alias("value")
    )
    rows = cdc.parse_envelope(log, "replication").select("data", F.get_json_object("metadata", "$.operation").alias("operation"))
    decoded = cdc.decode(rows, "data", "event_id bigint, user_id bigint, price decimal(10,2)")
    return decoded.withColumn("price", F.col("price").cast("double"))


def count_live(spark: SparkSession, sf: str) -> DataFrame:
    return live_state(spark, sf).agg(F.count("*").alias("live"))


QUERIES = {
    "cdc_latest_state": live_state,
    "cdc_live_by_type": live_by_type,
    "cdc_route_counts": route_counts,
    "cdc_table_action_counts": table_action_counts,
    "cdc_demux": demuxed,
    "cdc_decode_modes": decode_modes,
    "cdc_apply": applied,
    "cdc_apply_sequential": lambda spark, sf: applied(spark, sf, "sequential"),
    "cdc_merge_upsert": merge_upsert,
    "cdc_merge_partial": merge_partial,
    "cdc_delete_by_key": delete_by_key,
    "cdc_nearest_time": nearest_time,
    "cdc_schema_merge": schema_merge,
    "cdc_ddl_log": ddl_log,
    "cdc_field_map": field_map,
    "cdc_coerce_times": coerced_times,
    "cdc_flink_state": flink_state,
    "cdc_replication_rows": replication_rows,
    "cdc_count_live": count_live,
}

_LAST = """select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) rn from events)
where rn = 1"""
LIVE_SQL = f"select * from ({_LAST}) where event_type <> 'error'"
ORDER_CHANGES_SQL = """select o_orderkey, o_orderstatus, o_totalprice from (
  select l_orderkey * 2 as o_orderkey, l_linestatus as o_orderstatus, l_extendedprice as o_totalprice,
         row_number() over (partition by l_orderkey
           order by l_shipdate desc, l_linenumber desc, l_extendedprice desc, l_linestatus desc) rn
  from lineitem) where rn = 1"""
MERGED_ORDERS_SQL = f"""with s as ({ORDER_CHANGES_SQL})
select coalesce(s.o_orderkey, o.o_orderkey) as o_orderkey,
       case when s.o_orderkey is null then o.o_orderstatus else s.o_orderstatus end as o_orderstatus,
       case when s.o_orderkey is null then o.o_totalprice else s.o_totalprice end as o_totalprice
from orders o full join s on o.o_orderkey = s.o_orderkey"""

ORACLE = {
    "cdc_latest_state": LIVE_SQL,
    "cdc_live_by_type": f"select event_type, count(*) as users, round(sum(value), 2) as value from ({LIVE_SQL}) group by 1",
    "cdc_route_counts": """select policy, action, count(*) as events from (
      select 'A' as policy, case event_type when 'signup' then 'insert' when 'view' then 'insert' when 'error' then 'delete' else 'upsert' end as action from events
      union all select 'B', case event_type when 'signup' then 'insert' when 'error' then 'delete' else 'upsert' end from events
      union all select 'C', case event_type when 'error' then 'delete' else 'upsert' end from events) group by 1, 2""",
    "cdc_table_action_counts": """select case when user_id % 2 = 0 then 'shop' else 'crm' end as db,
        case when event_type in ('view', 'click') then 'visits' else 'users' end as "table",
        case event_type when 'signup' then 'insert' when 'view' then 'insert' when 'error' then 'delete' else 'upsert' end as action,
        count(*) as events from events group by 1, 2, 3""",
    "cdc_demux": """select db, "table", user_id, event_id, event_type from (
        select *, row_number() over (partition by db, "table", user_id order by epoch_us(ts) // 1000 desc, event_id desc) rn from (
          select case when user_id % 2 = 0 then 'shop' else 'crm' end as db,
                 case when event_type in ('view', 'click') then 'visits' else 'users' end as "table", * from events))
      where rn = 1 and event_type <> 'error'""",
    "cdc_decode_modes": """with up as (select * from events),
      f as (select mode, field from (values ('batch'), ('first'), ('last'), ('target')) m(mode),
            (values ('user_id'), ('event_id'), ('event_type'), ('value'), ('amount')) c(field)),
      ends as (select 'first' as mode, arg_min(event_type, epoch_us(ts) // 1000) as t from up
               union all select 'last', arg_max(event_type, epoch_us(ts) // 1000) from up)
      select f.mode, f.field,
             case when f.field = 'amount' then (select count(*) from up where event_type = 'purchase') else (select count(*) from up) end as filled
      from f left join ends on f.mode = ends.mode
      where f.field <> 'amount' or ends.t is null or ends.t = 'purchase'""",
    "cdc_apply": f"""with last as ({_LAST})
      select user_id, event_id, event_type, value from last where event_type <> 'error'
      union all select c_custkey, -1, c_mktsegment, c_acctbal from customer where c_custkey not in (select user_id from last)""",
    "cdc_apply_sequential": """with ins as (select user_id, event_id, event_type, value from events where event_type in ('signup', 'view')
          union all select c_custkey, -1, c_mktsegment, c_acctbal from customer),
      ups as (select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) rn
          from events where event_type in ('click', 'purchase')) where rn = 1),
      merged as (select * from ups union all select * from ins where user_id not in (select user_id from ups))
      select * from merged where user_id not in (select user_id from events where event_type = 'error')""",
    "cdc_merge_upsert": MERGED_ORDERS_SQL,
    "cdc_merge_partial": f"""with s as ({ORDER_CHANGES_SQL})
      select coalesce(s.o_orderkey, o.o_orderkey) as o_orderkey,
             case when o.o_orderkey is null then s.o_orderstatus else o.o_orderstatus end as o_orderstatus,
             case when o.o_orderkey is null then null when s.o_orderkey is null then o.o_totalprice else s.o_totalprice end as o_totalprice
      from orders o full join s on o.o_orderkey = s.o_orderkey""",
    "cdc_delete_by_key": """select o_orderkey, o_orderstatus, o_totalprice from orders
      where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)""",
    "cdc_nearest_time": """select vin, active_timestamp, event_id, kafka_ms from (
        select *, row_number() over (partition by vin, active_timestamp order by abs(epoch_s - active_timestamp), event_id) rn from (
          select cast(user_id as varchar) as vin, cast(epoch(date_trunc('hour', ts)) as bigint) as active_timestamp, event_id,
                 epoch_us(ts) // 1000 as kafka_ms, epoch_us(ts) // 1000000 as epoch_s from events)) where rn = 1""",
    "cdc_schema_merge": """select p_partkey as id, cast(p_size as double) as size, p_brand as brand, cast(null as varchar) as name from part
      union all select s_suppkey, s_acctbal, null, s_name from supplier""",
    "cdc_ddl_log": """select 'ALTER' as type, 'shop' as db, 't' || user_id as "table", epoch_us(ts) // 1000 as ts_ms, cast(event_id as integer) as pos,
        'ALTER TABLE t' || user_id || ' ADD COLUMN c' || event_id || ' int' as ddl
      from events where event_type = 'purchase' and user_id % 2 = 0""",
    "cdc_field_map": """select cast(o_orderkey as varchar) as id, cast(cast(o_totalprice as decimal(12,1)) as double) as price,
        o_orderpriority as priority from orders""",
    "cdc_coerce_times": "select event_id, case when event_type = 'error' then null else epoch_us(ts) // 1000 end as created_ms from events",
    "cdc_flink_state": """select user_id, event_id, event_type, value from (
        select *, row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) rn from events where event_type <> 'view')
      where rn = 1 and event_type <> 'error'""",
    "cdc_replication_rows": "select event_type as operation, event_id, user_id, round(value, 2) as price from events where event_type <> 'error'",
    "cdc_count_live": f"select count(*) as live from ({LIVE_SQL})",
}
