"""The changes by key on stored tables: only files that hold a touched key are written again.

The same statements as in ``updates`` and ``deletes``, with the place of the table in front of their arguments.  ``partition_by``
names the columns of its directories.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import not_in
from rowloom.plans import deletes, updates
from rowloom.sources.rewrite import Changed, change_files, rows_with


def update_by_key(
    master: DataFrame, path: str, customer_id: str, sets: Mapping[str, str], now: datetime, partition_by: Sequence[str] = ()
) -> Changed:
    return change_files(
        master,
        path,
        F.col("customer_id") == customer_id,
        lambda part: updates.update_by_key(part, customer_id, sets, now),
        partition_by,
    )


def merge_customers(
    master: DataFrame, path: str, staging: DataFrame, now: datetime, partition_by: Sequence[str] = ()
) -> Changed:
    return change_files(
        master,
        path,
        # Also keys marked deleted, which change nothing: two rows of one key are to fail as they do on the whole table.
        rows_with(staging.select("customer_id")),
        lambda part: updates.merge_customers(part, staging, now),
        partition_by,
    )


def merge_orders(orders: DataFrame, path: str, staging: DataFrame, now: datetime, partition_by: Sequence[str] = ()) -> Changed:
    return change_files(
        orders, path, rows_with(staging.select("order_id")), lambda part: updates.merge_orders(part, staging, now), partition_by
    )


def merge_aggregated(
    master: DataFrame, path: str, staging: DataFrame, orders: DataFrame, now: datetime, partition_by: Sequence[str] = ()
) -> Changed:
    return change_files(
        master,
        path,
        rows_with(staging.select("customer_id")),
        lambda part: updates.merge_aggregated(part, staging, orders, now),
        partition_by,
    )


def by_key(master: DataFrame, path: str, customer_id: str, partition_by: Sequence[str] = ()) -> Changed:
    return change_files(
        master, path, F.col("customer_id") == customer_id, lambda part: deletes.by_key(part, customer_id), partition_by
    )


def orphan_orders(orders: DataFrame, path: str, master: DataFrame, partition_by: Sequence[str] = ()) -> Changed:
    known = master.select("customer_id")
    return change_files(
        orders,
        path,
        lambda table: not_in(table, "customer_id", known, "__orphan").filter("__orphan"),
        lambda part: deletes.orphan_orders(part, master),
        partition_by,
    )


def cancelled_items(
    items: DataFrame, path: str, orders: DataFrame, as_of: date, partition_by: Sequence[str] = ()
) -> Changed:
    gone = deletes.long_cancelled(orders, as_of).select("order_id")
    return change_files(
        items, path, rows_with(gone), lambda part: deletes.cancelled_items(part, orders, as_of), partition_by
    )


def mask_deleted(
    master: DataFrame, path: str, staging: DataFrame, now: datetime, partition_by: Sequence[str] = ()
) -> Changed:
    gone = staging.filter(F.col("is_deleted")).select("customer_id")
    return change_files(
        master, path, rows_with(gone), lambda part: deletes.mask_deleted(part, staging, now), partition_by
    )
