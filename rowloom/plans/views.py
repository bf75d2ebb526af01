"""The three views the reports build on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.money import mean, total
from rowloom.operators.ranking import HOT, number_rows, weight_before
from rowloom.sources.tables import kept

# Order states that count as a sale.
SOLD = ("COMPLETED", "PENDING")

# Order of a customer's purchases: newest first, then by the remaining columns so that the
# items of one order do not swap places between runs.
ITEM_ORDER = ("order_item_id", "product_id", "quantity", "unit_price")


def newest_first() -> dict[str, Column]:
    """The order of a customer's orders."""
    return {"order_date": F.col("order_date").desc_nulls_last(), "order_id": F.col("order_id").asc_nulls_last()}


def item_order() -> list[Column]:
    """The order of the items of an order."""
    return [F.col(c).asc_nulls_last() for c in ITEM_ORDER]


def newest_first_values() -> list[Column]:
    """The same order of orders as ascending values, NULL first, which splitters can be taken from."""
    late = -F.unix_micros("order_date")
    return [F.col("order_date").isNull(), late, F.col("order_id").isNull(), F.col("order_id")]


def item_order_values() -> list[Column]:
    return [value for c in ITEM_ORDER for value in (F.col(c).isNull(), F.col(c))]


def sold_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*SOLD)).select(
        "customer_id", "order_id", "order_date", "total_amount"
    )


def items_per_order(items: DataFrame) -> DataFrame:
    """(order_id, __items); counted map-side, so a hot order is one row per task in the shuffle."""
    return items.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias("__items"))


def hot_orders(sizes: DataFrame, hot: int) -> DataFrame | None:
    """The ids of orders with more than ``hot`` items, a kept table; None if there are none."""
    found = kept(sizes.filter(F.col("__items") > hot).select("order_id"), "large-orders")
    return None if found.isEmpty() else found


def sales_analysis(master: DataFrame, orders: DataFrame, items: DataFrame, hot: int = HOT) -> DataFrame:
    """Every sold item with its place among the customer's purchases, newest first.

    Customers without a sale do not appear: the status condition turns the first left
    join into an inner one.  Orders without items do, with empty item columns.  The place
    counts items, not orders.

    The places are prepared on orders, which know how many item rows they stand for.  Orders with their numbers of items and the
    names of their customers are kept, so customers and orders are read once, items twice.  A customer of more than
    ``hot`` orders, and an order of more than ``hot`` items, are cut into pieces at splitters of their order, so also undated
    orders and the items of one order are spread over many tasks.
    """
    sizes = kept(items_per_order(items), "order-sizes")
    counted = sold_orders(orders).join(sizes, "order_id", "left").withColumn("__rows", F.coalesce("__items", F.lit(1)))
    named = kept(master.select("customer_id", "customer_name", "email").join(counted, "customer_id"), "named-orders")
    placed = weight_before(named, ["customer_id"], newest_first_values(), "__rows", "__before", hot)
    bought = items.select("order_id", *ITEM_ORDER)
    large = hot_orders(sizes, hot)
    usual = placed if large is None else placed.join(large, "order_id", "left_anti")
    # Orders of one id and instant share their places, as they are told apart by items only.
    same = Window.partitionBy("order_id", "customer_id", "order_date")
    within = same.orderBy(*item_order())
    few = bought if large is None else bought.join(large, "order_id", "left_anti")
    ranked = usual.join(few, "order_id", "left").withColumn("__in", F.row_number().over(within))
    if large is not None:
        inside = kept(bought.join(large, "order_id"), "items-of-large-orders")
        numbered = number_rows(inside, ["order_id"], item_order_values(), "__place", hot)
        # Rows of an order that comes several times follow each other item by item.
        copies = placed.join(large, "order_id").withColumns(
            {"__copies": F.count(F.lit(1)).over(same), "__nth": F.row_number().over(same.orderBy("email"))}
        )
        place = (F.col("__place") - 1) * F.col("__copies") + F.col("__nth")
        spread = copies.join(numbered, "order_id").withColumn("__in", place)
        ranked = ranked.unionByName(spread.drop("__copies", "__nth", "__place"))
    return ranked.select(
        "customer_id", "customer_name", "email", "order_id", "order_date", "total_amount",
        "product_id", "quantity", "unit_price", (F.col("__before") + F.col("__in")).alias("purchase_rank"),
    )


def daily_sales_report(orders: DataFrame, since: date | None = None) -> DataFrame:
    """Completed orders per day.

    ``since`` restricts the orders themselves, so the condition reaches the scan (and prunes
    directories where orders are laid out by ``order_day``) instead of the formatted text.
    """
    done = orders.filter(F.col("order_status") == "COMPLETED")
    if since is not None:
        done = done.filter(F.col("order_date") >= F.lit(since).cast("timestamp"))
        if "order_day" in orders.columns:
            done = done.filter(F.col("order_day") >= F.lit(since))
    amount = F.col("total_amount")
    grouped = done.groupBy(F.date_format("order_date", "yyyy-MM-dd").alias("sales_date")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        total(amount).alias("daily_revenue"),
        F.count(amount).alias("__amounts"),
        F.min(amount).alias("min_order_amount"),
        F.max(amount).alias("max_order_amount"),
    )
    return grouped.withColumn("avg_order_amount", mean(F.col("daily_revenue"), F.col("__amounts"))).select(
        "sales_date", "total_orders", "unique_customers", "daily_revenue",
        "avg_order_amount", "min_order_amount", "max_order_amount",
    )


def customer_revenue(master: DataFrame, orders: DataFrame, items: DataFrame, per_order: bool = False) -> DataFrame:
    """Sales per customer.

    The view sums ``total_amount`` over item rows, so an order counts once per item;
    ``per_order=True`` counts it once.  Items are only counted per order and orders summed
    per customer before they meet the customers, so no join sees more than one row per key
    on its aggregated side and hot orders or customers shrink map-side.
    """
    sold = sold_orders(orders).filter(F.col("customer_id").isNotNull())
    if per_order:
        weighted = sold.withColumn("__rows", F.lit(1).cast("bigint"))
    else:
        weighted = sold.join(items_per_order(items), "order_id", "left").withColumn(
            "__rows", F.coalesce("__items", F.lit(1))
        )
    amount, rows = F.col("total_amount"), F.col("__rows")
    per_customer = weighted.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("__orders"),
        F.sum(amount * rows).cast("decimal(28,2)").alias("__revenue"),
        F.sum(F.when(amount.isNotNull(), rows)).alias("__amounts"),
        F.max("order_date").alias("__last"),
        F.min("order_date").alias("__first"),
    )
    # A customer id may stand on several master rows; those with one name share a result row.
    grouped = (
        master.select("customer_id", "customer_name")
        .join(per_customer, "customer_id")
        .groupBy("customer_id", "customer_name")
        .agg(
            F.max("__orders").alias("order_count"),
            total(F.col("__revenue")).alias("total_revenue"),
            F.sum("__amounts").alias("__amounts"),
            F.max("__last").alias("last_purchase_date"),
            F.min("__first").alias("first_purchase_date"),
        )
    )
    return grouped.select(
        "customer_id",
        "customer_name",
        "order_count",
        "total_revenue",
        mean(F.col("total_revenue"), F.col("__amounts")).alias("avg_order_value"),
        "last_purchase_date",
        "first_purchase_date",
        F.datediff("last_purchase_date", "first_purchase_date").cast("bigint").alias("customer_lifetime_days"),
    )
