"""The eleven reports.  ``as_of`` stands in for the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.money import MONEY_TYPE, mean, rounded_ratio, total
from rowloom.operators.joins import keys_of
from rowloom.operators.ranking import HOT
from rowloom.plans.views import (
    ITEM_ORDER,
    SOLD,
    customer_revenue,
    daily_sales_report,
    hot_orders,
    item_order,
    items_per_order,
    newest_first,
    sold_orders,
)


def customers(master: DataFrame, rows: int = 100) -> DataFrame:
    """The first customers by id."""
    return (
        master.filter(F.col("customer_id").isNotNull())
        .select("customer_id", "customer_name", "email", "phone", "registration_date", "country")
        .orderBy("customer_id")
        .limit(rows)
    )


def customer_history(master: DataFrame, orders: DataFrame, country: str) -> DataFrame:
    """Orders and spending of every customer of a country, biggest spender first."""
    amount = F.col("total_amount")
    wanted = keys_of(master.filter(F.col("country") == country), "customer_id")
    spent = (
        orders.join(wanted, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("__orders"),
            total(amount).alias("__spent"),
            F.max("order_date").alias("__last"),
            F.min("order_date").alias("__first"),
        )
    )
    return (
        master.filter(F.col("country") == country)
        .select("customer_id", "customer_name", "email")
        .join(spent, "customer_id", "left")
        .groupBy("customer_id", "customer_name", "email")
        .agg(
            F.sum(F.coalesce("__orders", F.lit(0))).alias("total_orders"),
            total(F.col("__spent")).alias("total_spent"),
            F.max("__last").alias("last_order_date"),
            F.min("__first").alias("first_order_date"),
        )
        .orderBy(F.col("total_spent").desc_nulls_last(), "customer_id")
    )


def daily_recent(orders: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """The daily report of the last days with revenue per customer."""
    daily = daily_sales_report(orders, since=as_of - timedelta(days=days))
    return daily.withColumn(
        "revenue_per_customer", rounded_ratio(F.col("daily_revenue"), F.col("unique_customers"))
    ).orderBy(F.col("sales_date").desc())


def top_purchases(master: DataFrame, orders: DataFrame, items: DataFrame, places: int = 5, hot: int = HOT) -> DataFrame:
    """The newest purchases of every customer.

    An order fills at least one place, so only a customer's newest ``places`` orders can appear; the cut runs as a group limit
    before the shuffle by customer, so a hot customer never meets in one task.  Of an order with more than ``hot`` items only
    the first ``places`` can appear: these orders, if there are any, are cut likewise before the join.
    """

    def first_places(df: DataFrame, *order: Column) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("customer_id").orderBy(*order))
        return df.withColumn("purchase_rank", place.cast("bigint")).filter(F.col("purchase_rank") <= places)

    sold = sold_orders(orders).filter(F.col("customer_id").isNotNull())
    newest = first_places(sold, *newest_first().values()).drop("purchase_rank")
    in_order = (*newest_first().values(), *item_order())
    few = items.filter(F.col("order_id").isNotNull()).select("order_id", *ITEM_ORDER)
    large = hot_orders(items_per_order(items), hot)
    if large is not None:
        in_item_order = Window.partitionBy("order_id").orderBy(*item_order())
        first_items = (
            few.join(large, "order_id")
            .withColumn("__place", F.row_number().over(in_item_order))
            .filter(F.col("__place") <= places)
            .drop("__place")
        )
        few = few.join(large, "order_id", "left_anti").unionByName(first_items)
    # With at most ``hot`` items an order is no hot key any more, and a plain left join is safe.
    bought = first_places(newest.join(few, "order_id", "left"), *in_order)
    # A customer id may stand on several master rows, which share the places.
    named = master.select("customer_id", "customer_name", "email").join(bought.drop("purchase_rank"), "customer_id")
    return (
        first_places(named, *in_order)
        .select(
            "customer_id", "customer_name", "email", "order_id", "order_date", "total_amount", "product_id",
            "quantity", "unit_price",
            (F.col("quantity") * F.col("unit_price")).cast(MONEY_TYPE).alias("calculated_total"),
            "purchase_rank",
        )
        .orderBy("customer_id", "purchase_rank")
    )


def spending_band(revenue: Column) -> Column:
    # Band limits.
    return (
        F.when(revenue >= 100000, "VIP").when(revenue >= 50000, "PREMIUM").when(revenue >= 10000, "REGULAR").otherwise("NEW")
    )


def customer_segment(master: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per customer with a spending band."""
    return (
        customer_revenue(master, orders, items)
        .filter(F.col("order_count") > 0)
        .withColumn("customer_segment", spending_band(F.col("total_revenue")))
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id")
    )


def product_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Completed sales per product."""
    done = orders.filter(F.col("order_status") == "COMPLETED").select("order_id")
    price = F.col("unit_price")
    return (
        items.select("order_id", "product_id", "quantity", "unit_price", "item_total")
        .join(done, "order_id")
        .groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
            total(F.col("item_total")).alias("total_revenue"),
            mean(F.sum(price), F.count(price)).alias("avg_price"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "product_id")
    )


def country_revenue(master: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and revenue per country."""
    amount = F.col("total_amount")
    known = master.select("customer_id", "country")
    # Customers are counted from their own table, so customers without orders need no outer join of the orders.
    customers = known.groupBy("country").agg(F.count_distinct("customer_id").alias("total_customers"))
    sold = (
        known.join(orders.select("customer_id", "order_id", "total_amount"), "customer_id")
        .groupBy(F.col("country").alias("__country"))
        .agg(
            F.count_distinct("order_id").alias("__orders"),
            total(amount).alias("total_revenue"),
            F.count(amount).alias("__amounts"),
        )
    )
    return (
        customers.join(sold, F.col("country").eqNullSafe(F.col("__country")), "left")
        .select(
            "country",
            "total_customers",
            F.coalesce("__orders", F.lit(0)).alias("total_orders"),
            "total_revenue",
            mean(F.col("total_revenue"), F.coalesce("__amounts", F.lit(0))).alias("avg_order_value"),
            rounded_ratio(F.col("total_revenue"), F.col("total_customers")).alias("revenue_per_customer"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "country")
    )


def payment_methods(orders: DataFrame) -> DataFrame:
    """Sales per payment method."""
    amount = F.col("total_amount")
    return (
        orders.filter(F.col("payment_method").isNotNull() & F.col("order_status").isin(*SOLD))
        .groupBy("payment_method")
        .agg(
            F.count_distinct("order_id").alias("transaction_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            total(amount).alias("total_amount"),
            mean(F.sum(amount), F.count(amount)).alias("avg_amount"),
            F.min(amount).alias("min_amount"),
            F.max(amount).alias("max_amount"),
        )
        .orderBy(F.col("transaction_count").desc(), "payment_method")
    )


def age_band(registered: Column, as_of: date) -> Column:
    # Band limits in days.
    age = F.datediff(F.lit(as_of), registered)
    return F.when(age <= 30, "NEW").when(age <= 90, "ACTIVE").when(age <= 365, "LOYAL").otherwise("DORMANT")


def customer_age(master: DataFrame, as_of: date) -> DataFrame:
    """Customers, orders and spending by time since registration."""
    orders, amount = F.col("total_orders"), F.col("total_amount")
    return (
        master.groupBy(age_band(F.col("registration_date"), as_of).alias("customer_type"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum(orders).cast("decimal(28,2)").alias("__orders"),
            F.count(orders).alias("__order_rows"),
            total(amount).alias("__amount"),
            F.count(amount).alias("__amount_rows"),
        )
        .select(
            "customer_type",
            "customer_count",
            rounded_ratio(F.col("__orders"), F.col("__order_rows")).alias("avg_orders"),
            rounded_ratio(F.col("__amount"), F.col("__amount_rows")).alias("avg_amount"),
        )
    )


def order_status(orders: DataFrame) -> DataFrame:
    """Orders per status."""
    amount = F.col("total_amount")
    return (
        orders.groupBy("order_status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            total(amount).alias("__total"),
            F.count(amount).alias("__amounts"),
            F.min("order_date").alias("earliest_date"),
            F.max("order_date").alias("latest_date"),
        )
        .select(
            "order_status",
            "order_count",
            "unique_customers",
            F.col("__total").alias("total_amount"),
            rounded_ratio(F.col("__total"), F.col("__amounts")).alias("avg_amount"),
            "earliest_date",
            "latest_date",
        )
        .orderBy(F.col("order_count").desc(), "order_status")
    )


def quality(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Recent quality checks with the share of good records in percent; NULL for no records."""
    good = (F.col("record_count") - F.col("error_count")).cast("decimal(28,2)")
    return (
        log.filter(F.col("checked_at") >= F.lit(as_of - timedelta(days=days)))
        .select(
            "table_name", "check_type", "check_description", "result", "record_count", "error_count",
            rounded_ratio(good * 100, F.col("record_count")).alias("quality_percentage"),
            "checked_at",
        )
        .orderBy(F.col("checked_at").desc())
    )
