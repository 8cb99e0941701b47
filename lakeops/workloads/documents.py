"""Document queries: `documents` wrapped as extended JSON, loaded and written in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.jsonx import infer_schema
from lakeops.operators import docs, sinks
from lakeops.operators.cdc import parse_envelope, route
from lakeops.sources import readers
from lakeops.session import table, work_path
from lakeops.workloads import change_data as cd


def _wrapped(spark: SparkSession, sf: str) -> DataFrame:
    """`documents` as extended-JSON text."""
    number = lambda c: F.struct(F.col(c).cast("string").alias("$numberInt"))
    text = F.to_json(
        F.struct(
            F.struct(F.lpad(F.hex("doc_id"), 24, "0").alias("$oid")).alias("_id"),
            F.col("doc_id"),
            F.col("text"),
            number("n_chars").alias("chars"),
            F.struct((F.col("doc_id") * 5_000_000_000).cast("string").alias("$numberLong")).alias("big"),
            F.struct((F.col("n_chars") / 4).cast("string").alias("$numberDouble")).alias("ratio"),
            F.struct(
                F.when(F.col("doc_id") % 11 == 0, "some day").otherwise(
                    F.date_format(F.timestamp_seconds(F.col("doc_id") * 86400), "yyyy-MM-dd'T'HH:mm:ss'Z'")
                ).alias("$date")
            ).alias("created"),
            F.when(F.col("doc_id") % 7 == 0, "null").otherwise(F.col("lang")).alias("lang"),
            F.array(F.col("lang"), F.lit("null"), F.lit(None), F.col("source")).alias("tags"),
            F.struct(
                F.struct(number("n_chars").alias("size"), F.col("source")).alias("parts"),
                F.struct(number("doc_id").alias("grade")).alias("review"),
                F.struct(F.when(F.col("doc_id") % 2 == 0, F.lit("null")).otherwise(F.col("source")).alias("note")).alias("extra"),
            ).alias("meta"),
        )
    )
    return table(spark, sf, "documents").select(text.alias("value"))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    raw = _wrapped(spark, sf)
    return raw.select(F.from_json("value", infer_schema(raw, "value")).alias("d")).select("d.*")


def unwrapped(spark: SparkSession, sf: str, dates: str = "raw") -> DataFrame:
    plain = docs.unwrap_extended_json(
        _parsed(spark, sf), dates, as_text=["meta.parts"], as_string=["meta.review.grade"], drop_empty=dates == "millis"
    )
    return plain.select(
        F.col("_id").alias("id"),
        "doc_id",
        F.md5("text").alias("digest"),
        "chars",
        "big",
        "ratio",
        "created",
        "lang",
        F.array_join("tags", ",").alias("tags"),
        F.col("meta.parts").alias("files"),
        F.col("meta.review.grade").alias("grade"),
        F.col("meta.extra").isNotNull().cast("int").alias("has_extra"),
        F.col("meta.extra.note").alias("note"),
    )


def document_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Object id where there is one, plain id where not, content hash as the last resort."""
    base = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    ident = (
        F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(F.lpad(F.hex("doc_id"), 24, "0").alias("$oid"))))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("id-"), F.col("doc_id").cast("string")))
    )
    return docs.with_document_id(base.withColumn("_id", ident)).select("doc_id", "doc_key")


def actions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("doc_key"), "lang", "n_chars", "text")
    return docs.bulk_actions(rows, sinks.index_name("docs-{lang}-v1"))


def batches(spark: SparkSession, sf: str) -> DataFrame:
    numbered = docs.with_batches(table(spark, sf, "documents").select("doc_id"), 64, "doc_id")
    return numbered.groupBy("batch").agg(
        F.count("*").alias("docs"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )


class _Picky:
    """A writer that refuses any batch with a French document."""

    def __call__(self):
        def write(batch: list[dict]) -> tuple[int, int]:
            if any(a["_index"] == "docs-fr-v1" for a in batch):
                raise ValueError("fr not accepted")
            return len(batch), 0

        return write


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of one document each, so the outcome does not depend on how rows are grouped."""
    letters = work_path(spark, "letters")
    docs.bulk_write(actions(spark, sf), _Picky(), 1, work_path(spark, "report"), letters)
    back = spark.read.schema(
        "error string, timestamp string, index string, data array<struct<_id: string, lang: string, n_chars: bigint, text: string>>"
    ).json(letters)
    return back.select("error", "index", F.explode("data").alias("d")).select("error", "index", "d._id", "d.lang", "d.n_chars", F.md5("d.text").alias("digest"))


def write_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = docs.bulk_write(actions(spark, sf), _Picky(), 1, work_path(spark, "report"))
    return stats.agg(F.sum("docs").alias("docs"), F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))


def resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A load stopped after its first step and started again: every document is written once."""
    rows = actions(spark, sf).withColumn("doc_id", F.col("_id").cast("bigint"))
    state, report = work_path(spark, "state"), work_path(spark, "resume")
    first = rows.agg(F.percentile_approx("doc_id", 0.3)).head()[0]
    docs.bulk_write(rows.filter(F.col("doc_id") <= first), _Picky(), 1, f"{report}/from=-1")
    docs.save_state(spark, state, first, rows.filter(F.col("doc_id") <= first).count(), False)
    stats = docs.resumable_load(rows, "doc_id", _Picky(), 1, state, report, rows_per_step=rows.count() // 3 + 1)
    done = docs.load_state(spark, state)
    return stats.agg(F.sum("docs").alias("docs"), F.sum("ok").alias("ok")).withColumns(
        {"position": F.lit(done["position"]).cast("bigint"), "completed": F.lit(done["completed"])}
    )


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """JSON Lines with blank and broken lines among them: counts of each kind."""
    path = work_path(spark, "lines")
    line = (
        F.when(F.col("doc_id") % 10 == 3, F.lit("{broken"))
        .when(F.col("doc_id") % 10 == 4, F.lit("  "))
        .otherwise(F.to_json(F.struct("doc_id", "lang", "text")))
    )
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    good, bad = readers.json_lines(spark, path, "doc_id bigint, lang string, text string")
    counted = good.groupBy("lang").agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars"))
    broken = bad.agg(F.count("*").alias("rows"), F.sum(F.length("line")).alias("chars"))
    return counted.unionByName(broken.select(F.lit("broken").alias("lang"), "rows", "chars"))


def json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Array files, each with the first (second, ...) thousand turns of a hundred conversations."""
    path = work_path(spark, "arrays")
    turns = table(spark, sf, "conversations").groupBy(F.floor(F.col("conv_id") / 100), F.floor(F.col("turn") / 1000)).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("conv_id", "turn", "role"))), ","), F.lit("]")).alias("value")
    )
    turns.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.json_documents(spark, path).groupBy("role").agg(F.count("*").alias("turns"), F.max("turn").alias("last"))


def positional_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "csv")
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("a"),
        F.when(F.col("p_size") > 45, "").otherwise(F.col("p_name")).alias("b"),
        F.col("p_brand").alias("c"),
        F.col("p_size").alias("d"),
    )
    rows.write.option("header", True).csv(path)
    back = readers.positional_csv(spark, path, ["id", "name", "brand", "size"], ["id", "name", "brand"], ["name"])
    return back.select(F.col("id").cast("bigint").alias("id"), "name", "brand")


def change_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Changes written as change-event JSON and parsed back to actions."""
    changes = cd._decoded(spark, sf).select("action", "user_id", "event_id")
    messages = sinks.changelog_messages(changes, ["user_id"])
    back = route(parse_envelope(messages.select("value")), "B")
    return back.groupBy("action").agg(
        F.count("*").alias("events"),
        F.sum(F.get_json_object(F.coalesce("after", "before"), "$.event_id").cast("bigint")).alias("ids"),
    )


def index_folders(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "indices")
    rows = sinks.route_index(table(spark, sf, "documents"), "s1-{source}-{lang}-alias")
    sinks.write_by_index(rows, path)
    return spark.read.schema(rows.schema).parquet(path).groupBy("index_name").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))


QUERIES = {
    "docs_unwrap": unwrapped,
    "docs_unwrap_millis": lambda spark, sf: unwrapped(spark, sf, "millis"),
    "docs_ids": document_ids,
    "docs_actions": actions,
    "docs_batches": batches,
    "docs_dead_letters": dead_letters,
    "docs_write_stats": write_stats,
    "docs_resume": resumed,
    "source_json_lines": json_lines,
    "source_json_array": json_array,
    "source_positional_csv": positional_csv,
    "sink_change_messages": change_messages,
    "sink_index_folders": index_folders,
}

_UNWRAP = """select lpad(printf('%X', doc_id), 24, '0') as id, doc_id, md5(text) as digest, cast(n_chars as integer) as chars, doc_id * 5000000000 as big,
    n_chars / 4 as ratio, case when doc_id % 11 = 0 then 'some day' else {date} end as created,
    case when doc_id % 7 = 0 then null else lang end as lang, lang || ',' || source as tags,
    '{{"size":{{"$numberInt":"' || n_chars || '"}},"source":"' || source || '"}}' as files, cast(doc_id as varchar) as grade,
    cast({extra} as integer) as has_extra, case when doc_id % 2 = 0 then null else source end as note from documents"""

ORACLE = {
    "docs_unwrap": _UNWRAP.format(date="strftime(epoch_ms(doc_id * 86400000), '%Y-%m-%dT%H:%M:%SZ')", extra="1"),
    "docs_unwrap_millis": _UNWRAP.format(date="cast(doc_id * 86400000 as varchar)", extra="doc_id % 2"),
    "docs_ids": """select doc_id, case doc_id % 3 when 0 then lpad(printf('%X', doc_id), 24, '0') when 1 then 'id-' || doc_id
      else sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","text":' || to_json(text) || '}') end as doc_key from documents""",
    "docs_actions": """select 'docs-' || lang || '-v1' as _index, cast(doc_id as varchar) as _id,
      '{"lang":"' || lang || '","n_chars":' || n_chars || ',"text":' || to_json(text) || '}' as _source from documents""",
    "docs_batches": """select batch, count(*) as docs, min(doc_id) as first, max(doc_id) as last from (
      select doc_id, (row_number() over (order by doc_id) - 1) // 64 as batch from documents) group by 1""",
    "docs_dead_letters": """select 'fr not accepted' as error, 'docs-fr-v1' as index, cast(doc_id as varchar) as _id, lang, n_chars, md5(text) as digest
      from documents where lang = 'fr'""",
    "docs_write_stats": """select count(*) as docs, count(*) filter (where lang <> 'fr') as ok, count(*) filter (where lang = 'fr') as failed
      from documents""",
    "docs_resume": """select count(*) as docs, count(*) filter (where lang <> 'fr') as ok, max(doc_id) as position, true as completed from documents""",
    "source_json_lines": """select lang, count(*) as "rows", cast(sum(length(text)) as bigint) as chars from documents where doc_id % 10 not in (3, 4) group by 1
      union all select 'broken', count(*), count(*) * 7 from documents where doc_id % 10 = 3""",
    "source_json_array": "select role, count(*) as turns, max(turn) as last from conversations group by 1",
    "source_positional_csv": "select p_partkey as id, p_name as name, p_brand as brand from part where p_size <= 45",
    "sink_change_messages": """select case when event_type = 'error' then 'delete' else 'upsert' end as action, count(*) as events,
      cast(sum(event_id) as bigint) as ids from events group by 1""",
    "sink_index_folders": "select 's1-' || source || '-' || lang || '-alias' as index_name, count(*) as docs, cast(sum(length(text)) as bigint) as chars from documents group by 1",
}
