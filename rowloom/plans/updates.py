"""The eleven updates and merges: old tables in, the whole new table out.

``as_of`` and ``now`` stand in for the clock.  Order facts are always reduced to one row per
customer, map-side first, before they meet the table to be changed.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.money import MONEY_TYPE
from rowloom.operators.joins import group_apart
from rowloom.operators.rowchange import Delete, Insert, Update, apply_merge, apply_update
from rowloom.plans.views import SOLD


def _orders_by_customer(orders: DataFrame, **facts: Column) -> DataFrame:
    grouped = group_apart(orders.filter(F.col("customer_id").isNotNull()), "customer_id")
    return grouped.agg(*[value.alias(name) for name, value in facts.items()]).select("__key.*", *facts)


def _with_facts(target: DataFrame, facts: DataFrame) -> DataFrame:
    """Target rows, each with its customer's facts or NULLs."""
    return target.join(facts, "customer_id", "left")


def update_by_key(master: DataFrame, customer_id: str, sets: Mapping[str, str], now: datetime) -> DataFrame:
    """Change one customer."""
    values = {name: F.lit(value) for name, value in sets.items()}
    return apply_update(master, F.col("customer_id") == customer_id, {**values, "updated_at": F.lit(now)})


def refresh_stats(master: DataFrame, orders: DataFrame, now: datetime) -> DataFrame:
    """Recount customers that have orders: sold orders, completed money, last order of any state."""
    status = F.col("order_status")
    facts = _orders_by_customer(
        orders,
        __orders=F.count_distinct(F.when(status.isin(*SOLD), F.col("order_id"))),
        __amount=F.coalesce(F.sum(F.when(status == "COMPLETED", F.col("total_amount"))), F.lit(0)),
        __last=F.max("order_date"),
    )
    changed = apply_update(
        _with_facts(master, facts),
        F.col("__orders").isNotNull(),
        {
            "total_orders": F.col("__orders"),
            "total_amount": F.col("__amount"),
            "last_order_date": F.col("__last"),
            "updated_at": F.lit(now),
        },
    )
    return changed.select(*master.columns)


def merge_customers(master: DataFrame, staging: DataFrame, now: datetime) -> DataFrame:
    """Upsert customers from staging, leaving out those marked deleted."""
    fields = ["customer_name", "email", "phone", "registration_date", "country"]
    live = F.col("s.is_deleted") == F.lit(False)
    sets = {c: F.col(f"s.{c}") for c in fields}
    return apply_merge(
        master,
        staging,
        "customer_id",
        matched=[Update({**sets, "updated_at": F.lit(now)}, live)],
        not_matched=[
            Insert(
                {"customer_id": F.col("s.customer_id"), **sets, "created_at": F.lit(now), "updated_at": F.lit(now)}, live
            )
        ],
    )


def merge_orders(orders: DataFrame, staging: DataFrame, now: datetime) -> DataFrame:
    """Update, delete or insert orders from staging."""
    live, gone = F.col("s.is_deleted") == F.lit(False), F.col("s.is_deleted") == F.lit(True)
    changed = ["order_status", "total_amount", "payment_method"]
    fields = ["order_id", "customer_id", "order_date", *changed]
    return apply_merge(
        orders,
        staging,
        "order_id",
        matched=[
            Update({**{c: F.col(f"s.{c}") for c in changed}, "created_at": F.lit(now)}, live),
            Delete(gone),
        ],
        not_matched=[Insert({**{c: F.col(f"s.{c}") for c in fields}, "created_at": F.lit(now)}, live)],
    )


def expire_orders(orders: DataFrame, as_of: date, now: datetime) -> DataFrame:
    """Expire pending orders older than a week, raise big ones in work; last 30 days only."""
    status = F.col("order_status")
    old = (F.datediff(F.lit(as_of), F.col("order_date")) > 7) & (status == "PENDING")
    big = (status == "PROCESSING") & (F.col("total_amount") >= 100000)
    recent = F.col("order_date") >= F.lit(as_of - timedelta(days=30)).cast("timestamp")
    return apply_update(
        orders,
        recent & status.isin("PENDING", "PROCESSING"),
        {
            "order_status": F.when(old, "EXPIRED").when(big, "PRIORITY").otherwise(status),
            "created_at": F.lit(now),
        },
    )


def expired_days(as_of: date) -> Column:
    """The order partitions that ``expire_orders`` may change."""
    return F.col("order_day") >= F.lit(as_of - timedelta(days=30))


def recount_recent(master: DataFrame, orders: DataFrame, as_of: date, now: datetime) -> DataFrame:
    """Recount all orders of customers with one in the last 90 days."""
    facts = _orders_by_customer(orders, __orders=F.count(F.lit(1)), __last=F.max("order_date"))
    recent = F.col("__last") >= F.lit(as_of - timedelta(days=90)).cast("timestamp")
    changed = apply_update(
        _with_facts(master, facts), recent, {"total_orders": F.col("__orders"), "updated_at": F.lit(now)}
    )
    return changed.select(*master.columns)


def last_order(master: DataFrame, orders: DataFrame, as_of: date, now: datetime) -> DataFrame:
    """Set the last order date of customers with an order in the last 30 days."""
    # An order in the last 30 days is newer than all others, so only these are read.
    since = as_of - timedelta(days=30)
    recent = F.col("order_date") >= F.lit(since).cast("timestamp")
    if "order_day" in orders.columns:
        recent = recent & (F.col("order_day") >= F.lit(since))
    facts = _orders_by_customer(orders.filter(recent), __last=F.max("order_date"))
    changed = apply_update(
        _with_facts(master, facts), F.col("__last").isNotNull(), {"last_order_date": F.col("__last"), "updated_at": F.lit(now)}
    )
    return changed.select(*master.columns)


def one_primary(addresses: DataFrame) -> DataFrame:
    """Where a customer has several primary addresses, keep the one with the smallest id."""
    several = (
        group_apart(addresses.filter(F.col("is_primary") & F.col("customer_id").isNotNull()), "customer_id")
        .agg(F.count(F.lit(1)).alias("__primaries"), F.min("address_id").alias("__keep"))
        .filter(F.col("__primaries") > 1)
        .select("__key.*", "__keep")
    )
    changed = apply_update(
        _with_facts(addresses, several), F.col("address_id") != F.col("__keep"), {"is_primary": F.lit(False)}
    )
    return changed.select(*addresses.columns)


def log_status(log: DataFrame, now: datetime, table: str = "customer_master") -> DataFrame:
    """Mark pending checks of a table as updated."""
    return apply_update(
        log,
        (F.col("table_name") == table) & (F.col("result") == "PENDING"),
        {"result": F.lit("UPDATED"), "checked_at": F.lit(now)},
    )


def rebuild_master(staging: DataFrame, orders: DataFrame, now: datetime) -> DataFrame:
    """The customer table rebuilt from staging and completed orders, in table order by name."""
    done = orders.filter(F.col("order_status") == "COMPLETED")
    facts = _orders_by_customer(
        done,
        __last=F.max("order_date"),
        __orders=F.count_distinct("order_id"),
        __amount=F.sum("total_amount"),
    )
    fields = ["customer_id", "customer_name", "email", "phone", "registration_date", "country", "created_at"]
    live = staging.filter(F.col("is_deleted") == F.lit(False)).select(*fields)
    # Equal staging rows fall into one group: distinct orders stay, money adds up.
    return (
        _with_facts(live, facts)
        .groupBy(*fields)
        .agg(
            F.max("__last").alias("last_order_date"),
            F.coalesce(F.max("__orders"), F.lit(0)).cast("int").alias("total_orders"),
            F.coalesce(F.sum("__amount"), F.lit(0)).cast(MONEY_TYPE).alias("total_amount"),
        )
        .select(
            "customer_id", "customer_name", "email", "phone", "registration_date", "country",
            "last_order_date", "total_orders", "total_amount", "created_at", F.lit(now).alias("updated_at"),
        )
    )


def merge_aggregated(master: DataFrame, staging: DataFrame, orders: DataFrame, now: datetime) -> DataFrame:
    """Upsert customers together with their order totals; money of no orders is NULL."""
    facts = _orders_by_customer(
        orders,
        __last=F.max("order_date"),
        __orders=F.count("order_id"),
        __amount=F.sum("total_amount"),
    )
    fields = ["customer_id", "customer_name", "email", "phone", "registration_date", "country"]
    source = (
        _with_facts(staging.filter(F.col("is_deleted") == F.lit(False)).select(*fields), facts)
        .groupBy(*fields)
        .agg(
            F.max("__last").alias("last_order_date"),
            F.sum(F.coalesce("__orders", F.lit(0))).alias("total_orders"),
            F.sum("__amount").alias("total_amount"),
        )
    )
    totals = {c: F.col(f"s.{c}") for c in ("last_order_date", "total_orders", "total_amount")}
    names = {c: F.col(f"s.{c}") for c in ("customer_name", "email", "phone")}
    return apply_merge(
        master,
        source,
        "customer_id",
        matched=[Update({**names, **totals, "updated_at": F.lit(now)})],
        not_matched=[
            Insert({**{c: F.col(f"s.{c}") for c in fields}, **totals, "created_at": F.lit(now), "updated_at": F.lit(now)})
        ],
    )


def logged_tables(table: str = "customer_master") -> Column:
    """The log partitions that ``log_status`` may change."""
    return F.col("table_name") == table
