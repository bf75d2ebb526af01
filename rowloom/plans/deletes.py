"""The deletes and soft deletes: old tables in, the whole new table out."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import drop_members, mark_members, not_in
from rowloom.operators.rowchange import Update, apply_delete, apply_merge, apply_update


def _before(column: str, as_of: date, days: int) -> Column:
    return F.col(column) < F.lit(as_of - timedelta(days=days)).cast("timestamp")


def by_key(master: DataFrame, customer_id: str) -> DataFrame:
    return apply_delete(master, F.col("customer_id") == customer_id)


def old_failed(orders: DataFrame, as_of: date) -> DataFrame:
    """Cancelled and failed orders older than a year go."""
    return apply_delete(orders, _before("order_date", as_of, 365) & F.col("order_status").isin("CANCELLED", "FAILED"))


def failed_days(as_of: date) -> Column:
    """The order partitions that ``old_failed`` may change."""
    return F.col("order_day") < F.lit(as_of - timedelta(days=365))


def orphan_orders(orders: DataFrame, master: DataFrame) -> DataFrame:
    """Orders of unknown customers go; those without a customer stay (NULL is not NOT IN)."""
    marked = not_in(orders, "customer_id", master.select("customer_id"), "__orphan")
    return apply_delete(marked, F.col("__orphan")).select(*orders.columns)


def duplicate_addresses(addresses: DataFrame) -> DataFrame:
    """Secondary addresses go unless they have the largest id of their customer and type."""
    largest = addresses.groupBy("customer_id", "address_type").agg(F.max("address_id").alias("address_id"))
    marked = not_in(addresses, "address_id", largest.select("address_id"), "__surplus")
    return apply_delete(marked, F.col("__surplus") & ~F.col("is_primary")).select(*addresses.columns)


def test_rows(customers: DataFrame) -> DataFrame:
    return apply_delete(customers, F.col("customer_name").like("%TEST%") | F.col("email").like("%test@%"))


def idle_customers(master: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Customers without orders, registered more than two years ago, go."""
    marked = mark_members(master, "customer_id", orders.select("customer_id"), "__ordered")
    idle = ~F.col("__ordered") & (F.datediff(F.lit(as_of), F.col("registration_date")) > 730)
    return apply_delete(marked, idle).select(*master.columns)


def long_cancelled(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders cancelled more than 90 days ago."""
    return orders.filter((F.col("order_status") == "CANCELLED") & _before("order_date", as_of, 90))


def cancelled_items(items: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Items of orders cancelled more than 90 days ago go."""
    return drop_members(items, "order_id", long_cancelled(orders, as_of).select("order_id"))


def done_staging(staging: DataFrame, master: DataFrame, as_of: date) -> DataFrame:
    """Live staging rows already merged into the customer table go."""
    merged = master.filter(F.col("updated_at") >= F.lit(as_of).cast("timestamp"))
    return drop_members(
        staging, "customer_id", merged.select("customer_id"), when=F.col("is_deleted") == F.lit(False)
    )


def failed_log(log: DataFrame, as_of: datetime) -> DataFrame:
    return apply_delete(log, (F.col("result") == "FAILED") & _before("checked_at", as_of, 30))


def cascade_addresses(addresses: DataFrame, master: DataFrame) -> DataFrame:
    """Addresses of deleted customers, or of customers without a country, go."""
    gone = master.filter(F.col("is_deleted") | (F.col("country") == "UNKNOWN"))
    return drop_members(addresses, "customer_id", gone.select("customer_id"))


def soft_delete_orders(orders: DataFrame, as_of: date) -> DataFrame:
    """Orders older than five years are marked deleted unless completed or shipped."""
    old = _before("order_date", as_of, 1825) & ~F.col("order_status").isin("COMPLETED", "SHIPPED")
    return apply_update(orders, old, {"order_status": F.lit("DELETED")})


def invalid_orders(orders: DataFrame) -> DataFrame:
    return apply_delete(
        orders, (F.col("total_amount") <= 0) | F.col("customer_id").isNull() | F.col("order_date").isNull()
    )


def bad_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with missing or impossible numbers, or of an unknown order, go."""
    marked = not_in(items, "order_id", orders.select("order_id"), "__orphan")
    bad = (
        F.col("quantity").isNull() | (F.col("quantity") <= 0)
        | F.col("unit_price").isNull() | (F.col("unit_price") < 0)
        | F.col("item_total").isNull() | (F.col("item_total") < 0)
    )
    return apply_delete(marked, bad | F.col("__orphan")).select(*items.columns)


def inactive_customers(master: DataFrame, as_of: date) -> DataFrame:
    """Customers idle for three years and untouched for half a year go."""
    return apply_delete(
        master,
        (F.datediff(F.lit(as_of), F.col("last_order_date")) > 1095)
        & (F.datediff(F.lit(as_of), F.col("updated_at")) > 180),
    )


def log_cleanup(log: DataFrame, as_of: datetime) -> DataFrame:
    return apply_delete(log, _before("checked_at", as_of, 90) & F.col("result").isin("SKIPPED", "DEPRECATED"))


def mask_deleted(master: DataFrame, staging: DataFrame, now: datetime) -> DataFrame:
    """Customers marked deleted in staging keep their row but lose name, e-mail and phone."""
    gone = staging.filter(F.col("is_deleted")).select("customer_id")
    return apply_merge(
        master,
        gone,
        "customer_id",
        matched=[
            Update(
                {
                    "customer_name": F.lit("[DELETED]"),
                    "email": F.lit(None),
                    "phone": F.lit(None),
                    "updated_at": F.lit(now),
                }
            )
        ],
    )
