"""Lake tables with row-level change.

`CatalogTable` sends MERGE and DELETE to a table format that supports them. `BucketTable` does the same jobs on plain Parquet, foldered
by a hash of the key: a change rewrites the folders that it touches and leaves the others. `MergeOnReadTable`
adds a folder per batch, and readers keep the latest row per key over all of them. A table's folder can be read by any Parquet reader; only its schema,
key and number of buckets are kept beside the rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import cdc

BUCKET, BATCH = "row_bucket", "batch"
BUCKETS = 8


# --- small helpers on the Hadoop file API (works for any path Spark can write) ---------------------------


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write through a temporary name, so readers never see half a file."""
    fs, p = _fs(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p) or not fs.rename(temporary, p):
        raise RuntimeError(f"another writer already committed {path}")


def _leaf_dirs(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders `depth` levels below `path`, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{d}/{name}".lstrip("/")
            for d in found
            for name in list_dirs(spark, f"{path}/{d}".rstrip("/"))
            if "=" in name
        ]
    return found


# --- write helpers ---------------------------------------------------------------------------------------


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group rows by partition columns for writing; AQE splits a partition that is far larger than the rest."""
    return df.hint("rebalance", *columns) if columns else df


def hash_distributed(df: DataFrame, pieces: int, *keys: str) -> DataFrame:
    """Fixed hash distribution before a write."""
    return df.repartition(pieces, *keys)


def bulk_insert(
    df: DataFrame, path: str, partition_by: Sequence[str], max_records_per_file: int = 0, mode: str = "append"
) -> None:
    """Partitioned append without a key lookup, hive-style folders."""
    writer = balanced(df, partition_by).write.mode(mode).partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in `df`."""
    balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file of a table: the small-file report, listed by Spark rather than by the driver."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )


def compact_files(spark: SparkSession, source: str, target: str, partition_by: Sequence[str], file_bytes: int = 256 << 20) -> None:
    """Rewrite a partitioned Parquet folder with files of at most about `file_bytes`, few as small ones as there are folders.

    A file's rows are bounded by the measured bytes a row of the whole folder; large partitions are split, small ones gathered, by the rebalancing of the write.
    """
    rows = spark.read.parquet(source)
    size = file_sizes(spark, source).agg(F.sum("bytes")).head()[0] or 0
    per_row = size / max(rows.count(), 1)
    writer = balanced(rows, partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.option("maxRecordsPerFile", max(1, int(file_bytes / per_row)) if per_row else 0).parquet(target)


def with_day_partition(df: DataFrame, time: str, name: str = "day") -> DataFrame:
    """Day transform of a timestamp as a derived partition column."""
    return df.withColumn(name, F.to_date(time))


# --- keyed tables on plain Parquet ------------------------------------------------------------------------


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key. Keys are hashed as text, so a wider whole-number type keeps them in place."""
    return F.pmod(F.xxhash64(*(F.col(f"`{k}`").cast("string") for k in keys)), F.lit(buckets)).cast("int")


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# Columns that Parquet readers widen by themselves; any other change of type makes a table be written anew.
_READABLE = {("int", "bigint"), ("int", "double"), ("float", "double"), ("smallint", "int"), ("smallint", "bigint")}


def _retyped(old: T.StructType, new: T.StructType, keys: Sequence[str] = ()) -> bool:
    kinds = {f.name: f.dataType.simpleString() for f in old.fields}
    for f in new.fields:
        was, now = kinds.get(f.name), f.dataType.simpleString()
        if was not in (None, now) and ((was, now) not in _READABLE or (f.name in keys and now == "double")):
            return True
    return False


class _KeyedFolders:
    """A Parquet folder with its schema, key and number of buckets in `_table.json`, which Spark's readers pass over."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS, properties: Mapping | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.properties = dict(properties or {})
        known = self._info()
        self.buckets = known["buckets"] if known else buckets
        if known and known["keys"] != self.keys:
            raise ValueError(f"{path} has the key {known['keys']}, not {self.keys}")

    def _info(self) -> dict | None:
        path = f"{self.path}/_table.json"
        return json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else None

    def _stored_schema(self) -> T.StructType | None:
        known = self._info()
        return T.StructType.fromJson(known["schema"]) if known else None

    def _keep_schema(self, schema: T.StructType) -> None:
        if schema == self._stored_schema():
            return
        info = {"schema": schema.jsonValue(), "keys": self.keys, "buckets": self.buckets, "properties": self.properties}
        fs, p = _fs(self.spark, f"{self.path}/_table.json")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(info).encode()))
        finally:
            stream.close()

    @property
    def schema(self) -> T.StructType | None:
        schema = self._stored_schema()
        return schema and T.StructType([f for f in schema.fields if f.name != cdc.DELETED])

    def _read(self, schema: T.StructType, more: Sequence[T.StructField], folders: Sequence[str] | None = None) -> DataFrame:
        """Rows of the given folders, or of all, with the folder columns `more`."""
        if folders is not None and not folders:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *more]))
        paths = [self.path] if folders is None else [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(T.StructType([*schema.fields, *more])).option("basePath", self.path).parquet(*paths)


def _alive(rows: DataFrame) -> DataFrame:
    """Rows without the hidden ones of deleted keys."""
    return rows.filter(~F.coalesce(cdc.DELETED, F.lit(False))).drop(cdc.DELETED) if cdc.DELETED in rows.columns else rows


class BucketTable(_KeyedFolders):
    """A keyed table in folders by key bucket and, below, by `partition_by`.

    A change finds the folders that hold one of its keys (only buckets of its keys are looked at) or get one of its rows, and rewrites these;
    all other files stay. So its cost follows the buckets it touches: choose the number so that a bucket is rewritten in the time a batch may take. The new rows are
    first written to a side folder, whose folders then replace the old ones; a writer that is lost in between is finished by the next change.

    Repeating a change changes nothing: by event order a row never beats itself, and a merge or delete leaves what it left before. (`append`
    and the inserts of the `sequential` mode add rows each time.) One writer at a time. Deletes applied in event order stay as rows with a hidden
    `_deleted` flag, so that a late older change cannot bring a key back; `purge` drops them. Empty text in a partition column is stored as null.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), buckets: int = BUCKETS, properties: Mapping | None = None
    ):
        super().__init__(spark, path, keys, buckets, properties)
        self.partition_by = list(partition_by)
        self.folder_by = [BUCKET, *self.partition_by]

    # read ----------------------------------------------------------------------------------------------

    def snapshot(self) -> DataFrame | None:
        """The current rows, or None for a table never written."""
        schema = self._stored_schema()
        return None if schema is None else _alive(self._rows(schema))

    def recover(self) -> None:
        """Finish or drop what a lost writer left. Every change does so first; a reader need not."""
        self._put_in_place()

    def _rows(self, schema: T.StructType, folders: Sequence[str] | None = None) -> DataFrame:
        return self._read(schema, [T.StructField(BUCKET, T.IntegerType())], folders).select(*(f"`{c}`" for c in schema.fieldNames()))

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _folders(self) -> list[str]:
        return _leaf_dirs(self.spark, self.path, len(self.folder_by))

    # change --------------------------------------------------------------------------------------------

    def append(self, df: DataFrame) -> None:
        """Add rows without a key lookup; new columns widen the table and are null in old rows."""
        old = self._begin()
        schema = self._complete(cdc.merge_schemas(old, df.schema) if old else df.schema)
        rows = self._normal(cdc.align(df, schema))
        if old and _retyped(old, schema, self.keys):
            self._replace(cdc.align(self._rows(old), schema).unionByName(rows), schema, self._folders())
            return
        self._keep_schema(schema)
        balanced(self._placed(rows), self.folder_by).write.mode("append").partitionBy(*self.folder_by).parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        """Replace the table."""
        self._begin()
        schema = self._complete(df.schema)
        self._replace(self._normal(cdc.align(df, schema)), schema, self._folders())

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Replace only the values of the partition columns that are present in `df`."""
        old = self._begin()
        schema = self._complete(cdc.merge_schemas(old, df.schema) if old else df.schema)
        rows = self._normal(cdc.align(df, schema))
        if old and _retyped(old, schema, self.keys):
            raise ValueError("a partition cannot change a column's type")
        gone = self._matching(self._in_folders(old, None), rows.select(*self.partition_by).distinct(), self.partition_by) if old else []
        self._replace(rows, schema, gone)

    def merge(self, df: DataFrame, update: Sequence[str] | None = None, insert: Sequence[str] | None = None) -> None:
        """Upsert by key. `df` must hold one row per key (see `cdc.dedupe_latest`)."""
        self._change(df, lambda current, source: cdc.merge_rows(current, source, self.keys, update, insert), df)

    def upsert(self, df: DataFrame, order: Sequence[str | Column]) -> None:
        """Upsert the latest row per key of `df`, unless the stored row is later; `order` is the precombine column and its tie-breaks."""
        self.apply(df.withColumn("action", F.lit("upsert")), self.keys, order)

    def delete(self, key_rows: DataFrame) -> None:
        """Remove the rows whose key is listed."""
        self._change(key_rows.select(*self.keys), lambda current, source: cdc.delete_rows(current, source, self.keys), None)

    def apply(self, changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column], mode: str = "latest") -> None:
        """Apply routed changes (see `cdc.apply_changelog`)."""
        if list(keys) != self.keys:
            raise ValueError(f"the table's key is {self.keys}, not {list(keys)}")
        self._change(
            changes, lambda current, source: cdc.apply_changelog(current, source, self.keys, order, mode), changes.drop("action"), tombstones=mode == "latest"
        )

    def purge(self, before: Column) -> None:
        """Drop the hidden rows of deleted keys for which `before` holds: older changes of theirs must not come any more."""
        schema = self._begin()
        if schema is None or cdc.DELETED not in schema.fieldNames():
            return
        gone = self._in_folders(schema, None).filter(F.coalesce(cdc.DELETED, F.lit(False)) & before)
        folders = self._names(gone.select("_folder").distinct())
        rows = self._rows(schema, folders).filter(~F.coalesce(F.coalesce(cdc.DELETED, F.lit(False)) & before, F.lit(False)))
        self._replace(rows, schema, folders)

    def _change(self, source: DataFrame, rewrite: Callable[[DataFrame, DataFrame], DataFrame], new_rows: DataFrame | None, tombstones: bool = False) -> None:
        """`rewrite` sees hidden rows only with `tombstones`; else they stay, but for keys that get new rows."""
        old = self._begin()
        if old is None and new_rows is None:
            return
        if tombstones:
            new_rows = new_rows.withColumn(cdc.DELETED, F.lit(False))
        schema = self._complete(cdc.merge_schemas(old or new_rows.schema, new_rows.schema) if new_rows is not None else old)
        old = old or schema
        source = self._normal(source).persist()  # read for the touched folders, the anti join and the new rows
        try:
            rewritten = _retyped(old, schema, self.keys)
            folders = self._folders() if rewritten else self._touched(old, source, new_rows is not None)
            current = cdc.align(self._rows(old, folders), schema)
            if tombstones or cdc.DELETED not in current.columns:
                rows = rewrite(current, source)
            else:
                rows = cdc.align(rewrite(_alive(current), source), schema)
                hidden = current.filter(cdc.DELETED)
                rows = rows.unionByName(hidden if new_rows is None else hidden.join(source.select(*self.keys), self.keys, "left_anti").select(rows.columns))
            self._replace(cdc.align(rows, schema), schema, folders)
        finally:
            source.unpersist()

    def _complete(self, schema: T.StructType) -> T.StructType:
        """A schema with the partition columns, null for now if the rows lack them."""
        missing = [T.StructField(c, T.StringType()) for c in self.partition_by if c not in schema.fieldNames()]
        return T.StructType([*schema.fields, *missing])

    def _normal(self, rows: DataFrame) -> DataFrame:
        texts = [c for c in self.partition_by if c in rows.columns and isinstance(rows.schema[c].dataType, T.StringType)]
        return rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else rows

    # folders -------------------------------------------------------------------------------------------

    def _touched(self, schema: T.StructType, source: DataFrame, lands: bool) -> list[str]:
        """Folders with a key of `source`, and with `lands` those that its rows would go to: at most one row a folder comes back."""
        mine = self._placed(source)
        buckets = {f"{BUCKET}={r[0]}" for r in mine.select(BUCKET).distinct().collect()}
        here = [b for b in list_dirs(self.spark, self.path) if b in buckets]
        if not self.partition_by or not here:
            return here
        current = self._in_folders(schema, here)
        found = self._names(current.join(source.select(*self.keys).distinct(), self.keys, "left_semi").select("_folder").distinct())
        known = [c for c in self.folder_by if c in mine.columns]
        if lands:
            if len(known) < len(self.folder_by):
                mine = mine.withColumns({c: F.lit(None).cast(schema[c].dataType) for c in self.folder_by if c not in known})
            found = sorted({*found, *self._matching(current, mine.select(*self.folder_by).distinct(), self.folder_by)})
        return found

    def _in_folders(self, schema: T.StructType, folders: Sequence[str] | None) -> DataFrame:
        """Rows with their bucket and `_folder`, the path below the table as the writer escaped it."""
        rows = self._read(schema, [T.StructField(BUCKET, T.IntegerType())], folders)
        return rows.withColumn("_folder", F.regexp_extract(F.col("_metadata.file_path"), rf"/({BUCKET}=[^/]*.*)/[^/]+$", 1))

    def _matching(self, current: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> list[str]:
        """Folders whose values of `columns` are among `wanted`; nulls match."""
        there = current.select("_folder", *columns).distinct()
        wanted = wanted.select(*(F.col(c).alias(f"_w_{c}") for c in columns))
        same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in columns]
        return self._names(there.join(wanted, same, "left_semi").select("_folder").distinct())

    def _names(self, found: DataFrame) -> list[str]:
        jvm = self.spark._jvm
        names = {r[0] for r in found.collect()}
        return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(n).getPath()).toString() if "%" in n else n for n in names)

    # write ---------------------------------------------------------------------------------------------

    @property
    def _side(self) -> str:
        return f"{self.path}/_pending"

    def _begin(self) -> T.StructType | None:
        self.recover()
        return self._stored_schema()

    def _replace(self, rows: DataFrame, schema: T.StructType, folders: Sequence[str]) -> None:
        """Put `rows` in place of the rows of `folders`; rows go to these or to folders that are new."""
        balanced(self._placed(rows), self.folder_by).write.mode("overwrite").partitionBy(*self.folder_by).parquet(self._side)
        self._keep_schema(schema)
        filled = set(_leaf_dirs(self.spark, self._side, len(self.folder_by)))
        self._put_in_place()
        for folder in set(folders) - filled:
            _remove(self.spark, f"{self.path}/{folder}")

    def _put_in_place(self) -> None:
        """Move the folders of a whole side folder over the table's; a second call moves those that are left."""
        if not path_exists(self.spark, self._side):
            return
        if path_exists(self.spark, f"{self._side}/_SUCCESS"):
            for folder in _leaf_dirs(self.spark, self._side, len(self.folder_by)):
                _remove(self.spark, f"{self.path}/{folder}")
                fs, target = _fs(self.spark, f"{self.path}/{folder}")
                fs.mkdirs(target.getParent())
                if not fs.rename(_fs(self.spark, f"{self._side}/{folder}")[1], target):
                    raise RuntimeError(f"could not move {folder} of {self.path} into place")
        _remove(self.spark, self._side)


# --- merge-on-read ---------------------------------------------------------------------------------------


class MergeOnReadTable(_KeyedFolders):
    """Changes added as a folder per key bucket and batch; readers keep the latest row per key over all folders.

    Rows carry `_deleted` and the order columns. A batch's folders are named by its stream and number, so a replay replaces them. Compaction
    writes, bucket by bucket, what readers see, hidden rows of deleted keys included, and drops the folders it came from. In between both are there, which
    changes nothing for a reader: a row never beats itself. A reader that is running while old folders go has to read again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS):
        super().__init__(spark, path, keys, buckets)
        self.order = list(order)

    _MORE = [T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.StringType())]

    def append(self, df: DataFrame, batch_id: int, deleted: Column | None = None, stream: str = "w") -> None:
        """Write one batch of upserts and deletes."""
        flag = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        rows = df.withColumn(cdc.DELETED, flag)
        old = self._stored_schema()
        schema = cdc.merge_schemas(old, rows.schema) if old else rows.schema
        if old and _retyped(old, schema, self.keys):
            self._fold(old, schema, list_dirs(self.spark, self.path))
        self._keep_schema(schema)
        name = f"{hashlib.sha256(stream.encode()).hexdigest()[:16]}-{batch_id}"
        self._write(cdc.align(rows, schema), name)

    def _write(self, rows: DataFrame, name: str) -> None:
        placed = rows.withColumns({BUCKET: bucket_of(self.keys, self.buckets), BATCH: F.lit(name)})
        overwrite_partitions(placed, self.path, [BUCKET, BATCH])

    def batches(self) -> dict[str, list[str]]:
        """The folders of each bucket, compacted ones included."""
        return {b: list_dirs(self.spark, f"{self.path}/{b}") for b in list_dirs(self.spark, self.path) if b.startswith(f"{BUCKET}=")}

    def _latest(self, schema: T.StructType, folders: Sequence[str] | None = None) -> DataFrame:
        rows = self._read(schema, self._MORE, folders).select(*(f"`{c}`" for c in schema.fieldNames()))
        return cdc.dedupe_latest(rows, self.keys, self.order)

    def snapshot(self) -> DataFrame:
        """Latest row per key over all batches, without deleted keys."""
        schema = self._stored_schema()
        if schema is None:
            raise ValueError(f"no batches under {self.path}")
        return _alive(self._latest(schema))

    def compact(self, min_batches: int = 3) -> list[str]:
        """Fold the folders of each bucket that has `min_batches` of them or more, and at least two, into one. Returns these buckets."""
        full = [b for b, names in self.batches().items() if len(names) >= max(min_batches, 2)]
        if full:
            schema = self._stored_schema()
            self._fold(schema, schema, full)
        return full

    def _fold(self, old: T.StructType, schema: T.StructType, buckets: Sequence[str]) -> None:
        have = self.batches()
        folders = [f"{b}/{name}" for b in buckets for name in have.get(b, [])]
        last = max((int(f.rsplit("-", 1)[1]) for f in folders if f"/{BATCH}=base-" in f), default=0)
        self._write(cdc.align(self._latest(old, folders), schema), f"base-{last + 1}")
        for folder in folders:
            _remove(self.spark, f"{self.path}/{folder}")


# --- native table formats --------------------------------------------------------------------------------


class CatalogTable:
    """Row-level change by MERGE and DELETE on a catalog table of a format that supports them."""

    def __init__(self, spark: SparkSession, name: str, using: str = "iceberg"):
        self.spark = spark
        self.name = name
        self.using = using

    def create_sql(self, schema: T.StructType | None = None, properties: Mapping[str, str] | None = None, partition: str = "") -> str:
        columns = f" ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)})" if schema else ""
        parted = f" PARTITIONED BY ({partition})" if partition else ""
        pairs = ", ".join(f"'{k}'='{v}'" for k, v in (properties or {}).items())
        props = f" TBLPROPERTIES ({pairs})" if pairs else ""
        return f"CREATE TABLE IF NOT EXISTS {self.name}{columns} USING {self.using}{parted}{props}"

    def create(self, schema=None, properties=None, partition: str = "") -> None:
        self.spark.sql(self.create_sql(schema, properties, partition))

    def append(self, df: DataFrame, merge_schema: bool = True) -> None:
        writer = df.writeTo(self.name).option("check-ordering", "false")
        (writer.option("merge-schema", "true") if merge_schema else writer).append()

    def merge_sql(
        self, source: str, keys: Sequence[str], update: Sequence[str] | None = None, insert: Sequence[str] | None = None
    ) -> str:
        on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        sets = "*" if update is None else ", ".join(f"t.`{c}` = s.`{c}`" for c in update)
        if insert is None:
            rows = "*"
        else:
            rows = f"({', '.join(f'`{c}`' for c in insert)}) VALUES ({', '.join(f's.`{c}`' for c in insert)})"
        return (
            f"MERGE INTO {self.name} t USING {source} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT {rows}"
        )

    def delete_sql(self, source: str, keys: Sequence[str]) -> str:
        on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        return f"DELETE FROM {self.name} t WHERE EXISTS (SELECT 1 FROM {source} s WHERE {on})"

    @property
    def schema(self) -> T.StructType | None:
        return self.spark.table(self.name).schema if self.spark.catalog.tableExists(self.name) else None

    def apply_sql(self, source: str, keys: Sequence[str], columns: Sequence[str]) -> str:
        """One MERGE for upserts and deletes: `source` holds the last change per key with its `action`."""
        on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
        names, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"s.`{c}`" for c in columns)
        return (
            f"MERGE INTO {self.name} t USING {source} s ON {on} WHEN MATCHED AND s.action = 'delete' THEN DELETE "
            f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED AND s.action <> 'delete' THEN INSERT ({names}) VALUES ({values})"
        )

    def apply(self, changes: DataFrame, keys: Sequence[str], order: Sequence[str | Column], mode: str = "latest") -> None:
        """Apply routed changes; the table format's own commit makes a repeated batch harmless, as keys decide."""
        if mode != "latest":
            raise ValueError("a single MERGE keeps event order; use mode='latest'")
        last = cdc.dedupe_latest(changes, keys, order)
        columns = [c for c in changes.columns if c != "action"]
        if self.schema is None:
            self.create(changes.select(*columns).schema)
        self._with_view(last, lambda view: self.apply_sql(view, keys, columns))

    def merge(self, df: DataFrame, keys, update=None, insert=None) -> None:
        """Errors propagate, so a stream never commits past a failed merge."""
        self._with_view(df, lambda view: self.merge_sql(view, keys, update, insert))

    def delete(self, key_rows: DataFrame, keys) -> None:
        self._with_view(key_rows, lambda view: self.delete_sql(view, keys))

    def snapshot(self) -> DataFrame:
        return self.spark.table(self.name)

    def _with_view(self, df: DataFrame, statement) -> None:
        view = f"_changes_{abs(hash(self.name)) % 10**8}"
        df.createOrReplaceGlobalTempView(view)
        try:
            self.spark.sql(statement(f"global_temp.{view}"))
        finally:
            self.spark.catalog.dropGlobalTempView(view)
