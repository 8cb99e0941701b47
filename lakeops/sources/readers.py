"""Readers and option builders. Streams come back with a `value` column; credentials come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"

# Destinations of the synthetic trips, by id modulo ten.
DESTINATIONS = [
    "Seattle", "New York", "New Jersey", "Los Angeles", "Las Vegas",
    "Tucson", "Washington DC", "Philadelphia", "Miami", "San Francisco",
]


# --- message streams --------------------------------------------------------------------------------------


def kafka_options(
    servers: str,
    topics: str | Sequence[str],
    start: str | int = "latest",
    max_offsets: int | None = None,
    group: str | None = None,
    fail_on_data_loss: bool = False,
    user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Options of a Kafka source. `start` is earliest, latest or an epoch-millisecond timestamp."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    # A timestamp start and an offset start exclude each other.
    if str(start) in ("earliest", "latest"):
        options["startingOffsets"] = str(start)
    else:
        options["startingTimestamp"] = str(int(start))
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group:
        options["kafka.group.id"] = group
    if user is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config": "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{user}" password="{password}";',
        }
    return options


def message_values(stream: DataFrame, with_time: bool = False) -> DataFrame:
    """Message text, optionally with the record time in epoch seconds."""
    columns = [F.col("value").cast("string").alias("value")]
    if with_time:
        columns.append(F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("timestamp"))
    return stream.select(*columns)


def message_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], with_time: bool = False) -> DataFrame:
    """Stream of any message connector on the class path (kafka, kinesis, ...)."""
    return message_values(spark.readStream.format(fmt).options(**options).load(), with_time)


def catalog_stream(spark: SparkSession, name: str) -> DataFrame:
    """Stream registered in the catalog."""
    return spark.readStream.table(name)


def file_stream(
    spark: SparkSession, path: str, fmt: str = "text", schema: str | T.StructType | None = None, max_files: int | None = None, **options
) -> DataFrame:
    """New files of a folder as a stream; `max_files` limits the files of a trigger."""
    reader = spark.readStream.format(fmt).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


# --- files ------------------------------------------------------------------------------------------------


def change_files(spark: SparkSession, path: str) -> DataFrame:
    """One raw change event per line, below any folder depth. Lines are not split at any delimiter."""
    return spark.read.option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, file block and an order number that rises within a file.

    Large files are read in blocks by many tasks. A block's lines stay in order inside one task, and blocks are
    ordered by their start, so (block, order) orders a file without any task reading it whole.
    """
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON files holding one array (an element per row) or one object (one row)."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """JSON Lines as (documents, malformed lines); blank lines are skipped."""
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select("value", F.from_json("value", wide, options).alias("d"))
    broken = F.col(f"d.{CORRUPT}").isNotNull()
    good = parsed.filter(~broken).select(*(F.col("d").getField(f.name).alias(f.name) for f in fields.fields))
    return good, parsed.filter(broken).select(F.col("value").alias("line"))


def positional_csv(
    spark: SparkSession, path: str, names: Sequence[str], keep: Sequence[str], required: Sequence[str] = (), header: bool = True
) -> DataFrame:
    """CSV read by position: `names` for all columns, rows with an empty required column dropped."""
    schema = ", ".join(f"`{n}` string" for n in names)
    # The header line is skipped, not matched: columns count by position.
    rows = spark.read.csv(path, schema=schema, header=header, enforceSchema=True, multiLine=False)
    for name in required:
        rows = rows.filter(F.col(name).isNotNull() & (F.trim(name) != ""))
    return rows.select(*keep)


# --- tables and rows --------------------------------------------------------------------------------------


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the table is read in ranges by many tasks."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if partition_column:
        if not bounds or not partitions:
            raise ValueError("a partition column needs bounds and a partition count")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def synthetic_trips(spark: SparkSession, start: int, count: int, time: str = "2024-01-01 00:00:00") -> DataFrame:
    """Trips generated on the executors: route letter and destination by id modulo ten."""
    place = F.col("trip_id") % 10
    routes = F.array(*(F.lit(chr(65 + i)) for i in range(10)))
    return spark.range(start, start + count).withColumnRenamed("id", "trip_id").select(
        "trip_id",
        F.lit(time).alias("tstamp"),
        F.element_at(routes, (place + 1).cast("int")).alias("route_id"),
        F.element_at(F.array(*map(F.lit, DESTINATIONS)), (place + 1).cast("int")).alias("destination"),
    )
