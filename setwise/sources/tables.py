"""Tables: creation, scans, partition overwrite, keyed upsert, reports.

A target is a catalog name (``db.table``) or, if it contains a slash, a path. Below a path,
the folders of a partition column lie in folders of a hash of it, so that the folders to
look at for any number of values are at most ``BUCKETS``.

A packed table below a path has no folder for a value: the files of ``PACKS`` folders hold the
rows of many values each, so that a table of many small sessions has few files. To replace some
values, the folders that hold them are written anew.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import batched

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.contract import GOLD_ROWS_PER_FILE
from setwise.sources.change_log import ChangeLog
from setwise.sources.files import exists, names_in, partition_folder, remove, rename

PRUNED_KEYS = 10_000
"""Up to this many partition values are listed in the plan to prune the scan."""

BUCKET = "session_bucket"
BUCKETS = 4096
"""Folders of a path between the table and those of its partition column."""

PACK = "session_pack"
PACKS = 256
"""Folders of a packed table."""

STAGED = "_staged"
"""Folder of a packed table with folders that are complete and not yet in their place."""

LISTED_ROWS = 200
"""Up to this many values are listed to filter the rows of a path; more are joined."""

REPORT, LEFT = "report_number", "left_table"
STATEMENT = 500
"""Partitions that one statement drops."""

_DYNAMIC = "partitionOverwriteMode=dynamic"


def is_path(target: str) -> bool:
    return "/" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    return exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a target. With a ``schema``, one that does not exist yet reads as empty."""
    if not is_path(target):
        if schema is not None and not table_exists(spark, target):
            return empty(spark, schema)
        return spark.table(target)
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(target).drop(BUCKET, PACK)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def column_ddl(schema: T.StructType) -> str:
    """Column list for a CREATE TABLE. All columns are nullable."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_on: Sequence[str] = (),
    location: str | None = None,
    properties: dict[str, str] | None = None,
    max_rows_per_file: int = 0,
) -> None:
    """Create a parquet table if it is absent, with the columns in the given order.

    The table itself says that an overwrite replaces only the partitions it has rows for,
    and how many rows a file may have, so no writer changes settings of the session.
    """
    options = {"partitionOverwriteMode": "dynamic", "maxRecordsPerFile": str(max_rows_per_file)}
    pairs = lambda items: ", ".join(f"{k!r} = {v!r}" for k, v in items.items())
    statement = [f"CREATE TABLE IF NOT EXISTS {name} ({column_ddl(schema)}) USING parquet OPTIONS ({pairs(options)})"]
    if partition_on:
        statement.append(f"PARTITIONED BY ({', '.join(partition_on)})")
    if location:
        statement.append(f"LOCATION '{location}'")
    if properties:
        statement.append(f"TBLPROPERTIES ({pairs(properties)})")
    spark.sql(" ".join(statement))


def _require_dynamic(spark: SparkSession, name: str, max_rows_per_file: int) -> None:
    """The table must replace single partitions, and a cap that is asked for becomes its own."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Storage Properties'").first()
    if told is None or _DYNAMIC not in told["data_type"]:
        raise ValueError(f"{name} would lose its other partitions; make it with create_table")
    if max_rows_per_file and f"maxRecordsPerFile={max_rows_per_file}]" not in told["data_type"].replace(",", "]"):
        spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('maxRecordsPerFile' = '{max_rows_per_file}')")


def bucket_of(partition: str) -> Column:
    """The bucket of a partition value. Null and the empty text share a folder, so a bucket too."""
    return F.pmod(F.xxhash64(F.nullif(F.col(partition).cast("string"), F.lit(""))), F.lit(BUCKETS)).cast("int")


def pack_of(partition: str) -> Column:
    """The folder of a value in a packed table."""
    return F.pmod(F.xxhash64(F.nullif(F.col(partition).cast("string"), F.lit(""))), F.lit(PACKS)).cast("int")


def overwrite_partitions(df: DataFrame, target: str, partition: str, max_rows_per_file: int = 0) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Rows are gathered by partition value before the write; adaptive execution cuts a
    value with too many rows into several tasks and packs small ones together. A table
    that is not there is created; one that has another cap on the rows of a file gets this.
    """
    spark = df.sparkSession
    spread = df.hint("rebalance", partition)
    if not is_path(target):
        if not table_exists(spark, target):
            create_table(spark, target, df.schema, [partition], max_rows_per_file=max_rows_per_file)
        _require_dynamic(spark, target, max_rows_per_file)
        spread.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        return
    (
        spread.withColumn(BUCKET, bucket_of(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(BUCKET, partition)
        .parquet(target)
    )


def drop_partitions(gone: DataFrame, target: str, partition: str) -> None:
    """Remove the rows of the partition values in ``gone``. A catalog table takes ``STATEMENT``
    values at a time; below a path, several folders are removed at once."""
    spark = gone.sparkSession
    values = gone.select(F.col(partition).cast("string"), bucket_of(partition)).distinct().toLocalIterator()
    if not is_path(target):
        for some in batched((value for value, _ in values), STATEMENT):
            _drop_listed(spark, target, partition, some)
        return
    with ThreadPoolExecutor(16) as pool:
        folders = (partition_folder(spark, f"{target.rstrip('/')}/{BUCKET}={bucket}", partition, value) for value, bucket in values)
        list(pool.map(lambda folder: remove(spark, folder), folders))


def _drop_listed(spark: SparkSession, name: str, partition: str, values: Iterable[str | None]) -> None:
    named = {f"v{i}": value for i, value in enumerate(values)}
    listed = [f"PARTITION ({partition} = {'null' if value is None else ':' + mark})" for mark, value in named.items()]
    told = {mark: value for mark, value in named.items() if value is not None}
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(listed)}", args=told)


def replace_partitions(
    df: DataFrame, target: str, partition: str, touched: DataFrame, max_rows_per_file: int = 0
) -> None:
    """Make ``df`` all there is of the partition values in ``touched`` (one column)."""
    spark = df.sparkSession
    overwrite_partitions(df, target, partition, max_rows_per_file)
    if not table_exists(spark, target):  # nothing was written, and there was nothing
        return
    filled = df.select(F.col(partition).alias("__filled")).distinct()
    gone = touched.select(partition).distinct().join(filled, F.col(partition).eqNullSafe(F.col("__filled")), "left_anti")
    drop_partitions(gone, target, partition)


def finish_staged(spark: SparkSession, target: str) -> None:
    """Put the staged folders of a packed table in their place, also those of a run that
    failed meanwhile. They hold all there is of their values, so it can be done again."""
    staged = f"{target.rstrip('/')}/{STAGED}"
    if not exists(spark, f"{staged}/_SUCCESS"):
        return

    def move(name: str) -> None:
        place = f"{target.rstrip('/')}/{name}"
        remove(spark, place)
        rename(spark, f"{staged}/{name}", place)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [name for name in names_in(spark, staged) if name.startswith(f"{PACK}=")]))
    remove(spark, staged)


def replace_packed(df: DataFrame, target: str, partition: str, touched: DataFrame, max_rows_per_file: int = 0) -> None:
    """Make ``df`` all there is of its values and those in ``touched`` (one column) in a packed
    table. The other rows of their folders are written with them, first beside the table, so
    that a run that fails loses none. Both frames are read more than once."""
    spark = df.sparkSession
    finish_staged(spark, target)
    values = touched.select(F.col(partition).alias("__touched")).union(df.select(partition)).distinct()
    numbers = values.select(pack_of("__touched")).distinct().collect()
    held = {f"{PACK}={number}" for number, in numbers}.intersection(names_in(spark, target))
    if dict(df.dtypes)[partition] == "string":  # as in names of folders
        df = df.withColumn(partition, F.nullif(F.col(partition), F.lit("")))
    rows, left = df.withColumn(PACK, pack_of(partition)), set()
    if held:
        old = _folders(spark, target, held, df.schema)
        same = F.nullif(F.col(partition).cast("string"), F.lit("")).eqNullSafe(F.nullif(F.col("__touched").cast("string"), F.lit("")))
        rows = rows.unionByName(old.join(values, same, "left_anti"))
        left = held - {f"{PACK}={number}" for number, in rows.select(PACK).distinct().collect()}
    (
        rows.hint("rebalance", PACK)
        .sortWithinPartitions(PACK, partition)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(PACK)
        .parquet(f"{target.rstrip('/')}/{STAGED}")
    )
    finish_staged(spark, target)
    for name in left:
        remove(spark, f"{target.rstrip('/')}/{name}")


def append_table(
    df: DataFrame, target: str, partition_on: Sequence[str] = (), max_rows_per_file: int = GOLD_ROWS_PER_FILE
) -> None:
    """Append with a cap on the rows of one file."""
    writer = df.write.mode("append").option("maxRecordsPerFile", max_rows_per_file)
    if not is_path(target):
        writer.format("parquet").saveAsTable(target, partitionBy=list(partition_on) or None)
        return
    writer.partitionBy(*partition_on).parquet(target)


def listed_values(values: DataFrame, partition: str, most: int | None = None) -> dict[str | None, int] | None:
    """The partition values as text with their buckets, or None if there are more than ``most``."""
    most = PRUNED_KEYS if most is None else most
    found = values.select(F.col(partition).cast("string"), bucket_of(partition)).distinct().limit(most + 1).collect()
    return None if len(found) > most else dict(map(tuple, found))


def touched_rows(table: DataFrame, updates: DataFrame, partition: str, most: int | None = None) -> DataFrame:
    """The rows of ``table`` in partitions that occur in ``updates``, null among them.

    A short list of values prunes the scan; a long one becomes a semi-join.
    """
    return _rows_of(table, updates, partition, listed_values(updates, partition, most))


def _rows_of(table: DataFrame, updates: DataFrame, partition: str, listed: dict[str | None, int] | None) -> DataFrame:
    if listed is None:
        values = updates.select(F.col(partition).alias("__touched")).distinct()
        return table.join(values, F.col(partition).eqNullSafe(F.col("__touched")), "left_semi")
    kind = table.schema[partition].dataType
    found = F.col(partition).isin([F.lit(v).cast(kind) for v in listed if v is not None])
    return table.where(found | F.col(partition).isNull() if None in listed else found)


def _folders(spark: SparkSession, target: str, names: Iterable[str], schema: T.StructType) -> DataFrame:
    """The rows in some folders of a path, with the column that names the folders."""
    places = [f"{target.rstrip('/')}/{name}" for name in sorted(names)]
    return spark.read.schema(schema).option("basePath", target).parquet(*places)


def read_touched(
    spark: SparkSession, target: str, updates: DataFrame, partition: str, schema: T.StructType, most: int | None = None
) -> DataFrame:
    """The same from a target. Of a path, only the folders of the values are listed, by Spark
    where they are many; the table itself is looked at once."""
    if not is_path(target):
        return _rows_of(read_table(spark, target, schema), updates, partition, listed_values(updates, partition, most))
    there = names_in(spark, target)
    packed = any(name.startswith(f"{PACK}=") for name in there)
    column, number = (PACK, pack_of(partition)) if packed else (BUCKET, bucket_of(partition))
    folders = {f"{column}={row[0]}" for row in updates.select(number).distinct().collect()}.intersection(there)
    if not folders:
        return empty(spark, schema)
    listed = listed_values(updates, partition, LISTED_ROWS if packed and most is None else most)
    return _rows_of(_folders(spark, target, folders, schema).drop(column), updates, partition, listed)


_MARKS = ("__new", "__was_there", "__updated", "__changed")


def match_keys(old: DataFrame, updates: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """Old rows and updates together, each told whether its key is old, whether it is
    updated, and whether that changes the row. One shuffle by the full key, so no session
    is too heavy; null keys match.

    Updates that are equal count once. Different updates of one key are an error, unless
    ``latest_by`` names a column whose largest value decides.
    """
    columns = old.columns
    same_key = Window.partitionBy(*keys)
    updates = updates.dropDuplicates()
    if latest_by is not None:
        newest = F.row_number().over(same_key.orderBy(F.col(latest_by).desc_nulls_last(), *columns))
        updates = updates.withColumn("__nth", newest).where("__nth = 1").drop("__nth")
    both = old.withColumn("__new", F.lit(False)).unionByName(updates.select(*columns).withColumn("__new", F.lit(True)))
    row = F.struct(*columns)
    before, after = F.max(F.when(~F.col("__new"), row)).over(same_key), F.max(F.when(F.col("__new"), row)).over(same_key)
    marked = both.withColumns(
        {
            "__was_there": F.bool_or(~F.col("__new")).over(same_key),
            "__updated": F.bool_or("__new").over(same_key),
            "__changed": ~before.eqNullSafe(after),
            "__times": F.count_if("__new").over(same_key),
        }
    )
    error = F.raise_error(F.lit(f"an update has different rows for one key of {', '.join(keys)}"))
    return marked.where(F.when(F.col("__times") > 1, error.cast("boolean")).otherwise(F.lit(True))).drop("__times")


def merged_rows(matched: DataFrame, replace: bool = False) -> DataFrame:
    """All updates and, unless they replace everything, the old rows without one."""
    return matched.where("__new" if replace else "__new OR NOT __updated").drop(*_MARKS)


def upsert_changes(matched: DataFrame, replace: bool = False) -> DataFrame:
    """What the upsert does: inserts, the rows before and after updates that change
    something, and the old rows that a replacement leaves out."""
    kind = (
        F.when(~F.col("__updated"), "delete")
        .when(~F.col("__new"), "update_preimage")
        .when(F.col("__was_there"), "update_postimage")
        .otherwise("insert")
    )
    rows = matched.where("__changed" if replace else "__updated AND __changed")
    return rows.withColumn("_change_type", kind).drop(*_MARKS)


def upsert(
    spark: SparkSession,
    target: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition: str,
    schema: T.StructType | None = None,
    log: ChangeLog | None = None,
    delivery: int | None = None,
    replace: DataFrame | None = None,
    latest_by: str | None = None,
    max_listed: int | None = None,
    packed: bool = False,
) -> int | None:
    """Update rows with a known key, insert the others; touches only their partitions.

    With ``replace``, a frame of partition values, the updates are all there is of these:
    old rows without an update go. ``packed`` tells that the path is a packed table.

    With a ``log`` the outcome is written down first, then the table, and the changes are
    published last, as the version ``delivery`` (the next number, if none is given). A
    delivery that comes again is finished from its outcome, and one that is published does
    nothing; so a source that has grown meanwhile makes no difference. Returns the version.
    """
    version = None
    if packed:
        finish_staged(spark, target)
    if log is not None:
        latest = log.latest()
        version = delivery if delivery is not None else 0 if latest is None else latest + 1
        if log.has(version):
            return version
    whole = replace is not None

    def match() -> DataFrame:
        kept = updates.schema if schema is None else schema
        touched = updates.select(partition)
        touched = touched if replace is None else touched.union(replace.select(partition))
        old = read_touched(spark, target, touched.distinct(), partition, kept, max_listed)
        return match_keys(old, updates, keys, latest_by)

    matched = match().persist(StorageLevel.DISK_ONLY) if log is None else log.outcome(version, match)
    try:
        rows = merged_rows(matched, whole)
        if packed:
            replace_packed(rows, target, partition, matched.select(partition))
        elif whole:
            replace_partitions(rows, target, partition, matched.select(partition))
        else:
            overwrite_partitions(rows, target, partition)
    finally:
        matched.unpersist()
    if log is not None:
        log.publish(version, upsert_changes(matched, whole))
    return version


def write_report(summary: DataFrame, path: str, session: str = "filename", gone: DataFrame | None = None) -> None:
    """The summary as JSON lines, many sessions a file, in a folder with the next number. A
    session that is summed up again is read from its last folder, and one of the sessions in
    ``gone`` (one column) is read no more; so a run that failed and is repeated changes
    nothing. Columns without a value are written too."""
    spark = summary.sparkSession
    rows = summary.withColumn(LEFT, F.lit(False))
    if gone is not None:
        rows = rows.unionByName(gone.select(session).withColumn(LEFT, F.lit(True)), allowMissingColumns=True)
    prefix = f"{REPORT}="
    numbers = [int(n.removeprefix(prefix)) for n in names_in(spark, path) if n.startswith(prefix)]
    place = f"{path.rstrip('/')}/{prefix}{max(numbers, default=-1) + 1}"
    rows.hint("rebalance").write.option("ignoreNullFields", False).json(place)


def read_report(spark: SparkSession, path: str, schema: T.StructType, session: str = "filename") -> DataFrame:
    """The last summary of each session, with all its columns, whether any row has a value
    for them or not."""
    told = T.StructType([*schema.fields, T.StructField(LEFT, T.BooleanType()), T.StructField(REPORT, T.IntegerType())])
    try:
        rows = spark.read.schema(told).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)
    last = rows.groupBy(F.col(session).alias("__session")).agg(F.max_by(F.struct(*schema.names, LEFT), REPORT).alias("__last"))
    return last.where(~F.col(f"__last.{LEFT}")).select(*[F.col(f"__last.{name}") for name in schema.names])
