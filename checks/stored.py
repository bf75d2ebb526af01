"""Queries on stored tables: a table is written to the shared folder, changed or read there, and read back.

The tables are whole warehouse tables; each query takes a new folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, RUN_TS, Warehouse
from rowloom.plans import filechange, updates
from rowloom.session import shared_folder
from rowloom.sources import sinks, tables

#: Files of a table whose files are changed.
FILES = 24


def new_folder(w: Warehouse) -> str:
    return f"{shared_folder(w.spark)}/stored-{uuid.uuid4().hex}"


def _written(w: Warehouse, name: str) -> tuple[DataFrame, str]:
    """A table in its declared layout, and its place."""
    folder = new_folder(w)
    tables.write_table(getattr(w, name)(), folder, name)
    return tables.read_table(w.spark, folder, name), f"{folder}/{name}"


def _in_files(w: Warehouse, name: str, key: str) -> tuple[DataFrame, str]:
    """A table in ``FILES`` files by hash of a key, and its place."""
    df, path = getattr(w, name)(), f"{new_folder(w)}/{name}"
    df.repartition(FILES, key).write.parquet(path)
    return w.spark.read.schema(df.schema).parquet(path), path


def round_trip(w: Warehouse, name: str) -> DataFrame:
    """Written in its declared layout, read by its fixed schema."""
    return _written(w, name)[0]


def with_buckets(w: Warehouse) -> DataFrame:
    """The bucketed table, joined with itself on its key from the catalog."""
    name, folder = f"raw_customer_{uuid.uuid4().hex}", new_folder(w)
    tables.write_table(w.raw_customer(), folder, "raw_customer", catalog=name)
    return w.spark.table(name)


def defaults(w: Warehouse) -> DataFrame:
    """Absent columns come with their defaults."""
    few = w.customer_staging().drop("is_deleted", "created_at", "phone")
    return tables.fill_defaults(few, "customer_staging", F.lit(RUN_TS))


def overwritten(w: Warehouse) -> DataFrame:
    """A table replaced by one computed from itself."""
    table, path = _written(w, "customer_master")
    contact = {"customer_name": "Updated Name", "email": "newemail@example.com", "phone": "010-1234-5678"}
    tables.overwrite(updates.update_by_key(table, "77", contact, RUN_TS), path, ["country"])
    return w.spark.read.schema(table.schema).parquet(path)


def partitions_changed(w: Warehouse) -> DataFrame:
    """Only the logs of one table are read and replaced."""
    table, path = _written(w, "data_quality_log")
    tables.change_partitions(
        table, path, ["table_name"], F.col("table_name") == "raw_order", lambda part: part.withColumn("result", F.upper("check_type"))
    )
    return w.spark.read.schema(table.schema).parquet(path)


def truncated(w: Warehouse) -> DataFrame:
    """Rows of each country before a table is truncated and after."""
    table, path = _written(w, "customer_staging")
    tables.truncate(table, path)
    after = w.spark.read.parquet(path).groupBy("country").agg(F.count(F.lit(1)).alias("after_rows"))
    before = w.customer_staging().groupBy("country").agg(F.count(F.lit(1)).alias("before_rows"))
    both = before.join(after, "country", "left")
    return both.select("country", "before_rows", F.coalesce("after_rows", F.lit(0)).alias("after_rows"))


def csv_read_back(w: Warehouse) -> DataFrame:
    """A CSV output, every value as text."""
    path = new_folder(w)
    sinks.write_csv(w.raw_order_item(), path)
    back = w.spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in back.columns])


def unloaded(w: Warehouse) -> DataFrame:
    """The rows of a query as CSV, with the number the unload has counted."""
    path = new_folder(w)
    w.customer_master().createOrReplaceTempView("unload_master")
    n = sinks.unload(
        w.spark, "SELECT country, customer_id, email FROM unload_master WHERE total_orders IS NULL OR total_orders > 3;", path
    )
    return w.spark.read.option("header", True).csv(path).withColumn("counted", F.lit(n).cast("long"))


CONTACT = {"customer_name": "Updated Name", "email": "newemail@example.com", "phone": "010-1234-5678"}


def _changed(table_of: str, key: str, step: Callable) -> Callable[[Warehouse], DataFrame]:
    def run(w: Warehouse) -> DataFrame:
        table, path = _in_files(w, table_of, key)
        step(w, table, path)
        return w.spark.read.schema(table.schema).parquet(path)

    return run


#: Query name to function; the SQL of the second part is that of the whole-table form.
STORED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "s01_write_read": lambda w: round_trip(w, "customer_staging"),
    "s02_partitioned": lambda w: round_trip(w, "customer_master"),
    "s03_order_days": lambda w: round_trip(w, "data_quality_log"),
    "s04_buckets": with_buckets,
    "s05_defaults": defaults,
    "s06_overwrite": overwritten,
    "s06_change_partitions": partitions_changed,
    "s09_csv": csv_read_back,
    "s13_unload": unloaded,
    "s16_truncate": truncated,
}
BY_FILE: dict[str, Callable[[Warehouse], DataFrame]] = {
    "u01_update_by_key": _changed(
        "customer_master", "customer_id", lambda w, t, p: filechange.update_by_key(t, p, "77", CONTACT, RUN_TS)
    ),
    "u03_merge_customers": _changed(
        "customer_master", "customer_id", lambda w, t, p: filechange.merge_customers(t, p, w.customer_staging(), RUN_TS)
    ),
    "u04_merge_orders": _changed(
        "raw_order", "order_id", lambda w, t, p: filechange.merge_orders(t, p, w.order_staging(), RUN_TS)
    ),
    "u11_merge_aggregated": _changed(
        "customer_master", "customer_id",
        lambda w, t, p: filechange.merge_aggregated(t, p, w.customer_staging(), w.raw_order(), RUN_TS),
    ),
    "d01_by_key": _changed("customer_master", "customer_id", lambda w, t, p: filechange.by_key(t, p, "77")),
    "d03_orphan_orders": _changed(
        "raw_order", "order_id", lambda w, t, p: filechange.orphan_orders(t, p, w.customer_master())
    ),
    "d07_cancelled_items": _changed(
        "raw_order_item", "order_id", lambda w, t, p: filechange.cancelled_items(t, p, w.raw_order(), AS_OF)
    ),
    "d20_mask_deleted": _changed(
        "customer_master", "customer_id", lambda w, t, p: filechange.mask_deleted(t, p, w.customer_staging(), RUN_TS)
    ),
}


def by_file_name(name: str) -> str:
    """``u01_update_by_key`` → ``u01_files_update_by_key``."""
    number, _, rest = name.partition("_")
    return f"{number}_files_{rest}"


def all_queries() -> dict[str, Callable[[Warehouse], DataFrame]]:
    return {**STORED, **{by_file_name(name): step for name, step in BY_FILE.items()}}


