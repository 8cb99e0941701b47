"""Change-data operators: parse change events, route, de-duplicate and apply them."""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.jsonx import infer_schema, schema_of_text

# Field names of the change-event formats.
ENVELOPES = {
    "debezium": "before string, after string, source string, op string, ts_ms bigint, transaction string",
    "flink": "data string, op string",
    "replication": "data string, metadata string",
}
FLINK_OPS = {"+I": "c", "+U": "u", "-D": "d"}
DDL_ENVELOPE = "databaseName string, tableChanges string, source string, schemaName string, ddl string"
DDL_CHANGE = "id string, type string, table string"
DDL_SOURCE = (
    "query string, thread string, server_id bigint, version string, sequence string, file string, "
    "connector string, pos int, name string, gtid string, row int, ts_ms bigint, snapshot string, "
    "db string, table string"
)

# Which event codes insert and which upsert; deletes are always "d".
POLICIES = {
    "A": {"insert": ("r", "c"), "upsert": ("u",)},
    "B": {"insert": ("c",), "upsert": ("u", "r")},
    "C": {"insert": (), "upsert": ("c", "r", "u")},
}

DELETED = "_deleted"  # flag of rows that are kept for their key and time alone


@dataclass(frozen=True)
class TableConfig:
    """Settings of one target table."""

    db: str
    table: str
    primary_key: tuple[str, ...] = ("id",)
    precombine_key: str | None = None
    timestamp_fields: tuple[str, ...] = ()
    target: str | None = None
    schema: str | None = None
    partition_by: tuple[str, ...] = ()
    buckets: int | None = None
    properties: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return self.target or self.table


def load_table_config(spark: SparkSession, path: str) -> list[TableConfig]:
    """Read the per-table JSON settings (a small list of objects) from any Spark path."""
    text = spark.read.text(path, wholetext=True).head()[0]
    return [table_config(entry) for entry in json.loads(text)]


def table_config(entry: dict) -> TableConfig:
    named = {"db", "table", "primary_key", "precombine_key", "timestamp.fields", "target", "schema", "partition_by", "buckets"}

    def listed(value: str | Sequence[str] | None) -> tuple[str, ...]:
        return tuple(k.strip() for k in (value.split(",") if isinstance(value, str) else value or ()) if k.strip())

    return TableConfig(
        db=entry["db"],
        table=entry["table"],
        primary_key=listed(entry.get("primary_key", "id")),
        precombine_key=entry.get("precombine_key") or None,
        timestamp_fields=tuple(entry.get("timestamp.fields") or ()),
        target=entry.get("target"),
        schema=entry.get("schema"),
        partition_by=listed(entry.get("partition_by")),
        buckets=int(entry["buckets"]) if entry.get("buckets") else None,
        properties={k: str(v) for k, v in entry.items() if k not in named},
    )


def expand_json(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Replace a JSON text column by the columns of `schema`; unreadable text gives nulls.

    The text is parsed in a generator (an object reads as a list of one). Catalyst moves filters on plain
    projections below them and would then parse the text once per filtered field; a generator it leaves alone.
    Text that is no object, a list among them, counts as unreadable.
    """
    object_text = F.when(F.col(column).rlike(r"^\s*\{"), F.col(column))
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.inline_outer(F.from_json(object_text, T.ArrayType(fields))))


def parse_envelope(df: DataFrame, fmt: str = "debezium", value_col: str = "value") -> DataFrame:
    """Parse change events of one format; payloads stay JSON text. Other columns are kept."""
    keep = [c for c in df.columns if c != value_col]
    parsed = expand_json(df.select(*keep, F.col(value_col).cast("string").alias("_json")), "_json", ENVELOPES[fmt])
    if fmt == "flink":
        code = F.create_map(*(F.lit(x) for pair in FLINK_OPS.items() for x in pair))
        # "-U" (the old image of an update) has no code and drops out.
        parsed = parsed.withColumn("op", F.try_element_at(code, F.col("op"))).filter("op is not null")
    if fmt == "replication":
        parsed = parsed.filter("data is not null")
    return parsed


def route(df: DataFrame, policy: str = "A", before: str = "before", after: str = "after") -> DataFrame:
    """Add `action` (insert, upsert, delete); events without the payload their action needs drop out."""
    rules = POLICIES[policy]
    action = F.when(F.col("op").isin("d") & F.col(before).isNotNull(), "delete")
    for name, codes in rules.items():
        if codes:
            action = action.when(F.col("op").isin(*codes) & F.col(after).isNotNull(), name)
    return df.withColumn("action", action).filter("action is not null")


def payload(before: str = "before", after: str = "after") -> Column:
    """The JSON payload an action works on."""
    return F.when(F.col("action") == "delete", F.col(before)).otherwise(F.col(after))


def with_source(df: DataFrame, source: str = "source") -> DataFrame:
    """Add the source database and table of each event."""
    return df.withColumns(
        {"db": F.get_json_object(source, "$.db"), "table": F.get_json_object(source, "$.table")}
    )


def demux(
    df: DataFrame, tables: Iterable[TableConfig], stage: str | None = None
) -> dict[tuple[str, str], DataFrame]:
    """One filtered DataFrame per configured (db, table): same-named tables of two databases stay apart.

    With `stage` the events are written there once, foldered by (db, table), so each table reads only its own
    folder; without it, pass a persisted batch.
    """
    if stage:
        writer = df.hint("rebalance", "db", "table").write.mode("overwrite").partitionBy("db", "table")
        writer.parquet(stage)
        df = df.sparkSession.read.schema(df.schema).parquet(stage)
    return {(t.db, t.table): df.filter((F.col("db") == t.db) & (F.col("table") == t.table)) for t in tables}


def unrouted(df: DataFrame, tables: Iterable[TableConfig]) -> DataFrame:
    """Events of tables that are not configured, and events without a table: what `demux` hands to nobody."""
    known = F.lit(False)
    for t in tables:
        known = known | ((F.col("db") == t.db) & (F.col("table") == t.table))
    return df.filter(~F.coalesce(known, F.lit(False)))


def decode(
    df: DataFrame,
    payload_col: str,
    schema: str | T.StructType | None = None,
    infer: str = "batch",
    order: Sequence[str] = (),
) -> DataFrame:
    """Expand a JSON payload into columns.

    Without `schema`: `infer="batch"` reads it from all payloads, `"first"` and `"last"` from one row by `order`.
    Pass the target table's schema for `"target"`.
    """
    keep = [c for c in df.columns if c != payload_col]
    if schema is None:
        rows = df.filter(F.col(payload_col).isNotNull())
        if infer == "batch":
            schema = infer_schema(rows, payload_col)
        elif infer in ("first", "last"):
            ranked = rows
            if order:
                ranked = rows.orderBy(*(F.desc(c) if infer == "last" else F.asc(c) for c in order))
            elif infer == "last":
                raise ValueError("infer='last' needs an order")
            sample = ranked.select(payload_col).head()
            schema = schema_of_text(df.sparkSession, sample[0] if sample else "{}")
        else:
            raise ValueError(f"infer={infer!r} needs a schema")
    if isinstance(schema, T.StructType) and not schema.fields:
        return df.select(*keep)
    return expand_json(df, payload_col, schema)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Latest row per key by `order` (descending).

    The rank filter becomes a per-partition group limit, so each task forwards one row per key.
    """
    ordering = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    return _first(df, keys, ordering)


def dedupe_nearest(
    df: DataFrame, keys: Sequence[str], time: str, reference: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key, the row whose `time` (epoch seconds of a timestamp) is closest to `reference` (epoch seconds)."""
    distance = F.abs(F.unix_seconds(F.col(time).cast("timestamp")) - F.col(reference))
    return _first(df, keys, [distance.asc(), *(F.asc(c) for c in ties)])


def _first(df: DataFrame, keys: Sequence[str], ordering: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def coerce_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn configured text columns into timestamps; unreadable values become null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in present}) if present else df


def map_fields(df: DataFrame, mapping: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Rename and cast by (source, source type, target, target type); unlisted columns are dropped."""
    return df.select(
        *(F.expr(f"try_cast(try_cast(`{src}` as {kind}) as {out_kind})").alias(out) for src, kind, out, out_kind in mapping)
    )


def with_ingest_time(df: DataFrame, name: str = "ts") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def batch_counts(df: DataFrame) -> DataFrame:
    """Events per source table and action."""
    return df.groupBy("db", "table", "action").agg(F.count("*").alias("events"))


# --- row-level change as logical results -------------------------------------------------------------


def widen(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest common type: int, long, decimal(38, 0), double; anything else meets in string."""
    if left == right:
        return left
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
    if T.DecimalType(38, 0) in (left, right) and isinstance(left, whole) and isinstance(right, whole):
        return T.DecimalType(38, 0) if not any(getattr(t, "scale", 0) for t in (left, right)) else T.DoubleType()
    if isinstance(left, T.DecimalType) and isinstance(right, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(right, T.DecimalType) and isinstance(left, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    ladder = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
    if left in ladder and right in ladder:
        wider = max(ladder.index(left), ladder.index(right))
        # A long does not fit a float.
        return T.DoubleType() if isinstance(ladder[wider], T.FloatType) else ladder[wider]
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    return T.StringType()


def merge_schemas(left: T.StructType, right: T.StructType) -> T.StructType:
    """Union by name: fields of `left` first, then the new ones; common fields widen."""
    ours = {f.name: f for f in left.fields}
    theirs = {f.name: f for f in right.fields}
    merged = [
        T.StructField(n, widen(f.dataType, theirs[n].dataType) if n in theirs else f.dataType, True, f.metadata)
        for n, f in ours.items()
    ]
    return T.StructType(merged + [f for n, f in theirs.items() if n not in ours])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` in order, cast; missing ones are null."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def pick(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[f.name] == f.dataType:
            return F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and isinstance(have[f.name], (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(f"`{f.name}`").alias(f.name)
        return F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)

    return df.select(*(pick(f) for f in schema.fields))


def union_evolved(left: DataFrame, right: DataFrame) -> DataFrame:
    """Append with schema merge: new columns are null in old rows, widened types are cast."""
    schema = merge_schemas(left.schema, right.schema)
    return align(left, schema).unionByName(align(right, schema))


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """MERGE: matched rows are updated, others inserted. `source` must hold one row per key.

    `update` and `insert` limit the columns each branch sets, as in a partial MERGE.
    """
    keys = list(keys)
    if update is None and insert is None:
        return union_evolved(target.join(source, keys, "left_anti"), source)
    update = [c for c in (update if update is not None else source.columns) if c not in keys]
    insert = insert if insert is not None else source.columns
    renamed = source.select(
        *(F.col(k) for k in keys),
        *(F.col(c).alias(f"_s_{c}") for c in source.columns if c not in keys),
        F.lit(True).alias("_in_source"),
    )
    joined = target.withColumn("_in_target", F.lit(True)).join(renamed, keys, "full_outer")
    matched = F.col("_in_target") & F.col("_in_source")
    new = F.col("_in_target").isNull()

    def value(c: str) -> Column:
        column = F.col(c)
        if c in update:
            column = F.when(matched, F.col(f"_s_{c}")).otherwise(column)
        if c in insert:
            column = F.when(new, F.col(f"_s_{c}")).otherwise(column)
        return column.alias(c)

    return joined.select(*(F.col(c) if c in keys else value(c) for c in target.columns))


def delete_rows(target: DataFrame, key_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `target` whose key is not listed."""
    return target.join(key_rows.select(*keys).distinct(), list(keys), "left_anti")


def apply_changelog(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    mode: str = "latest",
) -> DataFrame:
    """Apply routed changes (an `action` column plus data columns) to `current`.

    `latest` keeps event order: only the last change of each key counts, and a change older than the stored row, by the leading
    order columns that `current` has, does not. If `current` has a `_deleted` column, deletes stay as rows with that flag, so that
    they too outlast older changes that come later. `sequential` reproduces the three passes insert, upsert, delete, where inserts append and a
    delete beats a later re-insert.
    """
    keys = list(keys)
    data = [c for c in changes.columns if c != "action"]
    if mode == "latest":
        last = dedupe_latest(changes, keys, order)
        stored_columns = [] if current is None else current.columns
        if current is None:
            return last.filter("action <> 'delete'").select(*data)
        hidden = DELETED in current.columns
        current = align(current, merge_schemas(current.schema, last.select(*data).schema))
        last = align(last, merge_schemas(T.StructType([f for f in current.schema.fields if f.name in data]), last.schema))
        known = list(itertools.takewhile(lambda c: isinstance(c, str) and c in stored_columns, order))
        if known and set(keys) <= set(stored_columns):
            stored = current.groupBy(*keys).agg(F.max(F.struct(*known)).alias("_stored"))
            last = last.join(stored, keys, "left").filter(F.coalesce(F.struct(*known) >= F.col("_stored"), F.lit(True))).drop("_stored")
        if hidden:
            fresh = last.select(*data, (F.col("action") == "delete").alias(DELETED))
        else:
            fresh = last.filter("action <> 'delete'").select(*data)
        return union_evolved(current.join(last, keys, "left_anti"), fresh)
    inserts = changes.filter("action = 'insert'").select(*data)
    upserts = dedupe_latest(changes.filter("action = 'upsert'"), keys, order).select(*data)
    deletes = changes.filter("action = 'delete'")
    state = inserts if current is None else union_evolved(current, inserts)
    return delete_rows(merge_rows(state, upserts, keys), deletes, keys)


# --- schema-change log -----------------------------------------------------------------------------------


def schema_changes(df: DataFrame, database: str, value_col: str = "value", kind: str = "ALTER") -> DataFrame:
    """Work list of table changes of one database from DDL events (two nested JSON levels)."""
    events = df.select(F.from_json(F.col(value_col).cast("string"), DDL_ENVELOPE).alias("e")).select("e.*")
    changes = events.filter((F.col("tableChanges") != "[]") & (F.col("databaseName") == database)).select(
        # A single object parses as a list of one.
        F.explode(F.from_json("tableChanges", f"array<struct<{DDL_CHANGE.replace(' string', ':string')}>>")).alias("c"),
        F.from_json("source", DDL_SOURCE).alias("s"),
        "ddl",
    )
    return changes.filter(F.col("c.type") == kind).select(
        F.col("c.type").alias("type"),
        F.col("s.db").alias("db"),
        F.col("s.table").alias("table"),
        F.col("s.ts_ms").alias("ts_ms"),
        F.col("s.pos").alias("pos"),
        "ddl",
    )


_ALTER = re.compile(r"^\s*alter\s+table\s+[\w.`]+\s+(add|drop|rename|alter|change)\b[^;]*$", re.I | re.S)


def replay_ddl(spark: SparkSession, work: DataFrame, limit: int = 10_000) -> int:
    """Run a bounded list of ALTER TABLE statements; anything else is refused."""
    rows = work.select("ts_ms", "pos", "ddl").distinct().orderBy("ts_ms", "pos").limit(limit + 1)
    statements = [row["ddl"] for row in rows.collect()]
    if len(statements) > limit:
        raise ValueError(f"more than {limit} schema changes in one batch")
    for statement in statements:
        if not _ALTER.match(statement):
            raise ValueError(f"not an ALTER TABLE statement: {statement[:80]!r}")
    for statement in statements:
        spark.sql(statement)
    return len(statements)
