"""Results and plans when one key holds a third of all rows."""

from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowloom.operators import ranking
from rowloom.operators.ranking import number_rows, weight_before
from rowloom.plans import reports, views
from rowloom.session import shared_folder
from rowloom.sources.tables import kept

ORDERS = "order_id string, customer_id string, order_date timestamp, order_status string, total_amount decimal(18,2)"


@pytest.fixture(scope="module")
def hot(spark):
    """Customer 'h' holds a third of the orders, order 'o0' a third of the items."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    master = spark.range(20).selectExpr(
        "IF(id = 0, 'h', CAST(id AS STRING)) AS customer_id", "concat('n', id) AS customer_name",
        "concat('e', id) AS email", "concat('c', id % 3) AS country",
    )
    # A customer may stand on two rows, and an order may come twice.
    master = master.unionByName(master.filter("customer_id IN ('h', '3')").withColumn("email", F.lit("second")))
    orders = spark.range(900).selectExpr(
        "concat('o', id) AS order_id",
        "CASE WHEN id % 3 = 0 THEN 'h' WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 23 AS STRING) END AS customer_id",
        "IF(id % 11 = 0, NULL, timestamp_seconds(978307200 + (id % 17) * 86400 + (id % 5) * 3600)) AS order_date",
        "IF(id % 4 = 0, 'PENDING', IF(id % 7 = 0, 'FAILED', 'COMPLETED')) AS order_status",
        "CAST(id % 90 + 0.05 AS DECIMAL(18,2)) AS total_amount",
        "'CARD' AS payment_method",
    )
    orders = orders.unionByName(orders.filter("order_id IN ('o0', 'o6')"))
    items = spark.range(2000).selectExpr(
        "concat('i', id % 700) AS order_item_id",
        "CASE WHEN id % 3 = 0 THEN 'o0' WHEN id % 97 = 0 THEN NULL ELSE concat('o', id % 800) END AS order_id",
        "concat('p', id % 13) AS product_id", "IF(id % 19 = 0, NULL, CAST(id % 5 AS INT)) AS quantity",
        "CAST(id % 7 AS DECIMAL(18,2)) AS unit_price", "CAST(id % 9 AS DECIMAL(18,2)) AS item_total",
    )
    tables = {"customer_master": master, "raw_order": orders, "raw_order_item": items}
    folder = f"{shared_folder(spark)}/hot"
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


def sql(spark, hot, text):
    return spark.sql(text, **hot)


SALES = """
SELECT c.customer_id, c.customer_name, c.email, o.order_id, o.order_date, o.total_amount, i.product_id, i.quantity,
       i.unit_price, row_number() OVER (PARTITION BY c.customer_id ORDER BY o.order_date DESC NULLS LAST, o.order_id,
       i.order_item_id NULLS LAST, i.product_id NULLS LAST, i.quantity NULLS LAST, i.unit_price NULLS LAST) AS purchase_rank
FROM {customer_master} c LEFT JOIN {raw_order} o ON c.customer_id = o.customer_id
LEFT JOIN {raw_order_item} i ON o.order_id = i.order_id
WHERE o.order_status IN ('COMPLETED', 'PENDING')
"""


def without_copies(df):
    """Rows as counted tuples; rows of two master copies tie, so the copy's own columns are left out."""
    counted = defaultdict(int)
    for r in df.drop("customer_name", "email").collect():
        counted[tuple(r)] += 1
    return counted


def test_sales_view(spark, hot):
    got = views.sales_analysis(*hot.values())
    assert without_copies(got) == without_copies(sql(spark, hot, SALES))


def test_top_purchases(spark, hot):
    got = reports.top_purchases(*hot.values()).drop("calculated_total")
    assert without_copies(got) == without_copies(sql(spark, hot, SALES).filter("purchase_rank <= 5"))


def test_customer_revenue(spark, hot, rows):
    want = sql(
        spark, hot,
        f"""SELECT customer_id, customer_name, count(DISTINCT order_id), CAST(sum(total_amount) AS DECIMAL(28,2)),
            CAST(sum(total_amount) AS DOUBLE) / count(total_amount), max(order_date), min(order_date),
            CAST(datediff(max(order_date), min(order_date)) AS BIGINT) FROM ({SALES}) GROUP BY ALL""",
    )
    assert rows(views.customer_revenue(*hot.values())) == rows(want)


def test_country_revenue(spark, hot, rows):
    want = sql(
        spark, hot,
        """SELECT c.country, count(DISTINCT c.customer_id), count(DISTINCT o.order_id),
           CAST(sum(o.total_amount) AS DECIMAL(28,2)), CAST(sum(o.total_amount) AS DOUBLE) / count(o.total_amount),
           CAST(sum(o.total_amount) / count(DISTINCT c.customer_id) AS DECIMAL(18,2))
           FROM {customer_master} c LEFT JOIN {raw_order} o ON c.customer_id = o.customer_id GROUP BY c.country""",
    )
    assert rows(reports.country_revenue(hot["customer_master"], hot["raw_order"])) == rows(want)


def test_customer_history(spark, hot, rows):
    want = sql(
        spark, hot,
        """SELECT c.customer_id, c.customer_name, c.email, count(o.order_id), CAST(sum(o.total_amount) AS DECIMAL(28,2)),
           max(o.order_date), min(o.order_date)
           FROM {customer_master} c LEFT JOIN {raw_order} o ON c.customer_id = o.customer_id
           WHERE c.country = 'c0' GROUP BY c.customer_id, c.customer_name, c.email""",
    )
    assert rows(reports.customer_history(hot["customer_master"], hot["raw_order"], "c0")) == rows(want)


@pytest.mark.parametrize("bound", [1_000_000, 100, 10, 1])
def test_running_sums_and_numbers_equal_one_window(spark, rows, bound):
    """Ties, NULLs in the order, groups of one row, groups just above and below the bound."""
    df = kept(spark.range(500).selectExpr(
        "IF(id % 3 = 0, 0, id % 5) AS k", "IF(id % 9 = 0, NULL, id % 7 * 10 + id % 3) AS at", "id % 4 + 1 AS w", "id"
    ), "rows")
    order = [F.col("at").isNull(), -F.col("at")]
    got = weight_before(df, ["k"], order, "w", "before", bound)
    want = df.selectExpr(
        "*",
        """sum(w) OVER (PARTITION BY k ORDER BY at DESC NULLS LAST) - sum(w) OVER (PARTITION BY k, at) AS before""",
    )
    assert rows(got.select(*want.columns)) == rows(want)
    numbered = number_rows(df, ["k"], [*order, F.col("id")], "n", bound)
    want = df.selectExpr("*", "CAST(row_number() OVER (PARTITION BY k ORDER BY at DESC NULLS LAST, id) AS BIGINT) AS n")
    assert rows(numbered.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("bound", [40, 300])
def test_sales_view_and_top_purchases_with_pieces(spark, hot, bound):
    """Customer, order and undated orders are cut."""
    assert without_copies(views.sales_analysis(*hot.values(), hot=bound)) == without_copies(sql(spark, hot, SALES))
    got = reports.top_purchases(*hot.values(), hot=bound).drop("calculated_total")
    assert without_copies(got) == without_copies(sql(spark, hot, SALES).filter("purchase_rank <= 5"))


@pytest.mark.parametrize("column", ["order_id", "customer_id"])
def test_pieces_are_even(spark, column):
    """A third of all items in one order, and a third of all orders undated and of one customer: no piece is twice the median."""
    rows = spark.range(60_000).selectExpr(
        f"IF(id % 3 = 0, 'h', CAST(id % 9000 AS STRING)) AS {column}", "CAST(NULL AS TIMESTAMP) AS order_date",
        "md5(CAST(id AS STRING)) AS order_item_id", "id % 5 AS product_id",
    )
    df = kept(rows, "rows")
    groups = ranking.hot_groups(df, [column], 1000)
    order = [F.col("order_date").isNull(), -F.unix_micros("order_date"), F.col("order_item_id")]
    cut = ranking._cut(df, [column], order, groups, 1000)
    sizes = sorted(r["count"] for r in cut.groupBy(column, "__piece").count().collect())
    assert sum(sizes) == 20_000 and len(sizes) == 20 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def scans(df):
    """Paths of all files that the final plan reads."""
    plan = plan_of(df)
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_scans_of_views_and_statement_table(spark):
    """Customers and orders are read once, items twice, the corpus once; later reads are of kept tables."""
    import __spark_entry__ as registered
    from tests.conftest import SMALL

    read = []
    for name in ("v1_sales_analysis", "l22_query_text"):
        df = registered.own_queries()[name](spark, SMALL)
        read.append(scans(df))
    # What is left to the last plan: kept orders with their customers, and the items; kept statements and kept sizes.
    assert len(read[0]) <= 4 and len(read[1]) <= 4
    assert sum("lineitem" in s for s in read[0]) == 1 and not any("orders.parquet" in s or "customer.parquet" in s for s in read[0])
    assert not any(f"{SMALL}/" in s for s in read[1])


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_purchases_cut_groups_before_the_shuffle(spark, hot):
    plan = plan_of(reports.top_purchases(*hot.values()))
    assert plan.count("WindowGroupLimit") >= 4 and "Partial" in plan


def test_no_plan_broadcasts_by_hint_or_crosses(spark):
    """Broadcasts are Spark's own choice by size; with that choice off there are none."""
    # Plans that keep tables run a part here, on the smallest input.
    import __spark_entry__ as registered
    from tests.conftest import SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, query in registered.own_queries().items():
            plan = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan, name
            # The id buckets are the one table with a fixed number of rows.
            assert plan.count("BroadcastExchange") == (1 if name == "l22_query_text" else 0), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_recent_report_filters_at_the_scan(spark, tmp_path):
    from rowloom.sources.tables import read_table, write_table

    orders = spark.createDataFrame(
        [("1", "a", datetime(2001, 7, 30), "COMPLETED", None), ("2", "a", datetime(1999, 1, 1), "COMPLETED", None)], ORDERS
    )
    write_table(orders, str(tmp_path), "raw_order")
    stored = read_table(spark, str(tmp_path), "raw_order")
    out = reports.daily_recent(stored, datetime(2001, 8, 1).date())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "order_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r["sales_date"] for r in out.collect()] == ["2001-07-30"]


@pytest.fixture
def eager_skew_split(spark):
    """Sizes at which a third of this small fixture already counts as hot."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "4KB",
        "spark.sql.files.openCostInBytes": "0",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_join_keys_are_split(spark, hot, rows, eager_skew_split):
    from rowloom.operators.joins import drop_members, left_join_many, mark_members
    from rowloom.operators.rowchange import Update, apply_merge

    # Many input files, as a hot partition is cut along its map outputs.
    big = spark.range(40_000).selectExpr(
        "IF(id % 3 = 0, 'h', CAST(id % 5000 AS STRING)) AS k", "concat('text ', id) AS v"
    ).repartition(40)
    folder = f"{shared_folder(spark)}/many"
    big.write.mode("overwrite").parquet(folder)
    big = spark.read.parquet(folder)
    few = spark.createDataFrame([("h",), ("7",), ("nobody",)], "k string")
    source = few.withColumn("w", F.lit("new"))
    plans = {
        "left_join_many": left_join_many(source, big, ["k"]),
        "drop_members": drop_members(big, "k", few),
        "mark_members": mark_members(big, "k", few, "m"),
        "apply_merge": apply_merge(big, source, "k", matched=[Update({"v": F.col("s.w")})]),
    }
    for name, df in plans.items():
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, name
        assert len(got) == {"left_join_many": 13_334 + 5 + 1, "drop_members": 26_666 - 5}.get(name, 40_000), name
