"""The eight warehouse tables: schemas, defaults, reading and writing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.session import shared_folder
from rowloom.sources.commits import Change, beside, settle

# Column names and types of the warehouse, in table order.
# Money is DECIMAL(18,2) throughout.  address_type, customer_master.is_deleted and
# customer_staging.created_at are read by the change statements, so they belong here.
SCHEMAS = {
    "raw_customer": """
        customer_id STRING, customer_name STRING, email STRING, phone STRING,
        registration_date TIMESTAMP, country STRING, created_at TIMESTAMP""",
    "raw_address": """
        address_id STRING, customer_id STRING, street_address STRING, city STRING, state STRING,
        postal_code STRING, country STRING, is_primary BOOLEAN, address_type STRING, created_at TIMESTAMP""",
    "raw_order": """
        order_id STRING, customer_id STRING, order_date TIMESTAMP, order_status STRING,
        total_amount DECIMAL(18,2), payment_method STRING, created_at TIMESTAMP""",
    "raw_order_item": """
        order_item_id STRING, order_id STRING, product_id STRING, quantity INT,
        unit_price DECIMAL(18,2), item_total DECIMAL(18,2), created_at TIMESTAMP""",
    "customer_master": """
        customer_id STRING, customer_name STRING, email STRING, phone STRING,
        registration_date TIMESTAMP, country STRING, last_order_date TIMESTAMP, total_orders INT,
        total_amount DECIMAL(18,2), created_at TIMESTAMP, updated_at TIMESTAMP, is_deleted BOOLEAN""",
    "customer_staging": """
        customer_id STRING, customer_name STRING, email STRING, phone STRING,
        registration_date TIMESTAMP, country STRING, is_deleted BOOLEAN, created_at TIMESTAMP""",
    "order_staging": """
        order_id STRING, customer_id STRING, order_date TIMESTAMP, order_status STRING,
        total_amount DECIMAL(18,2), payment_method STRING, is_deleted BOOLEAN""",
    "data_quality_log": """
        log_id STRING, table_name STRING, check_type STRING, check_description STRING, result STRING,
        record_count INT, error_count INT, checked_at TIMESTAMP""",
}

# Partition columns.  Orders carry a timestamp, which would make one
# directory per instant; they are laid out by the day of it instead.
PARTITIONS = {
    "raw_customer": ["country"],
    "raw_address": ["country"],
    "raw_order": ["order_day"],
    "customer_master": ["country"],
    "data_quality_log": ["table_name"],
}

# Columns filled with the time of the write, or with FALSE, when absent.
STAMPED = {"created_at", "updated_at", "checked_at"}
UNSET_FLAGS = {"is_deleted"}

# Declared buckets, number and key.
BUCKETS = {"raw_customer": (10, "customer_id")}
CUSTOMER_BUCKETS = BUCKETS["raw_customer"]


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one table with its fixed schema; nothing is inferred.

    ``order_day`` stays visible on orders, so a filter on it prunes directories.  A change of the table that was cut off is
    ended first.
    """
    settle(spark, f"{folder.rstrip('/')}/{name}")
    schema = table_schema(name)
    if "order_day" in PARTITIONS.get(name, []):
        schema = schema.add("order_day", T.DateType())
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}")


def fill_defaults(df: DataFrame, name: str, now: Column | None = None) -> DataFrame:
    """Add absent columns with the table's defaults and order all of them by name.

    ``now`` stands in for the clock (default: the time of the query).
    """
    now = F.current_timestamp() if now is None else now
    columns = []
    for field in table_schema(name):
        if field.name in df.columns:
            value = F.col(field.name)
        elif field.name in STAMPED:
            value = now
        elif field.name in UNSET_FLAGS:
            value = F.lit(False)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def with_order_day(df: DataFrame) -> DataFrame:
    return df.withColumn("order_day", F.to_date("order_date"))


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], spread: int = 1) -> None:
    """Overwrite ``path`` with one directory per value of ``columns``.

    Rows are gathered by partition value first, so a value does not leave one small
    file per task.  ``spread`` cuts a value into that many files for hot values.
    """
    keys = [F.col(c) for c in columns]
    if spread > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    # REBALANCE lets Spark cut a hot value into several tasks at run time.
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_table(df: DataFrame, folder: str, name: str, now: Column | None = None, catalog: str | None = None) -> None:
    """Write a whole warehouse table by column name, laid out as declared.

    Buckets exist for catalog tables only: with ``catalog``, the name of a table there, a table with declared buckets
    is saved under it, its files below ``folder``.
    """
    out = fill_defaults(df, name, now)
    if catalog and name in BUCKETS:
        path = f"{folder.rstrip('/')}/{name}"
        write_bucketed(out, catalog, *BUCKETS[name], partition_by=PARTITIONS.get(name, ()), path=path)
        return
    if "order_day" in PARTITIONS.get(name, []):
        out = with_order_day(out)
    path = f"{folder.rstrip('/')}/{name}"
    if name in PARTITIONS:
        write_partitioned(out, path, PARTITIONS[name])
    else:
        out.write.mode("overwrite").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, key: str, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Save a catalog table hashed by ``key``, so joins on it need no shuffle.

    ``partition_by`` adds directories above the buckets.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def kept(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back; left there for the cluster to clean up.

    What follows reads the written rows, so a lost executor costs a re-read of its part only.  ``partition_by`` makes a
    folder for each value of these columns, of which there should be few.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """A maker of paths and the file system of ``path``: names only, on the driver."""
    jvm = spark._jvm.org.apache.hadoop.fs
    return jvm.Path, jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the rows at ``path`` by ``df``, matched by column name; ``df`` may be computed from ``path`` itself.

    Every row-change operator returns the new table; this puts it in place.  The new rows are written once, to a
    folder beside the old one, and the folders are swapped when they are complete, so a write that fails leaves the
    old table as it was.  If the driver is lost between the two renames of the swap, the next ``read_table`` or change, or
    ``commits.settle``, makes the second one.  On stores without a rename the swap is a copy.
    """
    spark = df.sparkSession
    settle(spark, path)
    new, old = beside(path, "new"), beside(path, "old")
    make, files = _hadoop(spark, path)
    try:
        if partition_by:
            write_partitioned(df, new, partition_by)
        else:
            df.write.parquet(new)
    except BaseException:
        files.delete(make(new), True)
        raise
    there = files.exists(make(path))
    if there and not files.rename(make(path), make(old)):
        raise OSError(f"{path} cannot be moved aside; the new table is at {new}")
    # Someone who settles the table may have been faster.
    if not files.rename(make(new), make(path)) and files.exists(make(new)):
        if there and not files.exists(make(path)):
            files.rename(make(old), make(path))
        raise OSError(f"{new} cannot be moved to {path}")
    if there:
        files.delete(make(old), True)
    # What Spark knows of the files of this path is out of date.
    spark.catalog.refreshByPath(path)


def change_partitions(
    table: DataFrame,
    path: str,
    partition_by: Sequence[str],
    touched: Column,
    change: Callable[[DataFrame], DataFrame],
) -> list[str]:
    """Apply ``change`` to the partitions of ``path`` that satisfy ``touched``; the others' files stay untouched.

    ``table`` reads ``path``; ``touched`` is a condition on its partition columns, so only these directories are read.
    Partitions that lose their last row disappear.  A change that moves rows into a partition it has not read is refused.
    All partitions change or none does (``rowloom.sources.commits``).  Returns the directories that were replaced or dropped.
    """
    step = Change(table.sparkSession, path)
    part = table.filter(touched)
    # File names, never rows; they are escaped as addresses are.
    names = part.select(F.col("_metadata.file_path")).distinct().collect()
    old = [step.files.relative(unquote(r[0])) for r in names]
    read = {n.rpartition("/")[0] for n in old}
    try:
        write_partitioned(change(part), step.staging, partition_by)
        new = step.staged()
        written = {n.rpartition("/")[0] for n in new}
        clash = [d for d in written - read if step.files.exists(d)]
        if clash:
            raise ValueError(f"the change moves rows into partitions it has not read: {sorted(clash)[:3]}")
    except BaseException:
        step.abandon()
        raise
    step.commit(old, new)
    return sorted(read | written)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; all others stay as they are.

    For changes known to touch a few partitions.  A partition that loses its last row
    does not occur in ``df`` and therefore has to be dropped instead.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def truncate(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``, which ``df`` reads, by one without rows and with the same columns."""
    overwrite(df.sparkSession.createDataFrame([], df.schema), path)


def drop_partitions_before(df: DataFrame, day: date, column: str = "order_day") -> DataFrame:
    """Keep partitions from ``day`` on and the one without a day; the scan is pruned."""
    return df.filter((F.col(column) >= F.lit(day)) | F.col(column).isNull())


def drop_catalog_partitions_before(spark: SparkSession, table: str, day: date, column: str = "order_day") -> list[str]:
    """Drop the partitions of a catalog table before ``day`` without reading a row.

    Spark drops partitions by equality only, so the days are listed first; that list
    is partition names, never data.
    """
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = [r[0].split("=", 1)[1] for r in rows]
    old = sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__" and v < day.isoformat())
    for at in range(0, len(old), 500):
        specs = ", ".join(f"PARTITION ({column}='{value}')" for value in old[at : at + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return old
