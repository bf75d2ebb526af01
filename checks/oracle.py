"""Independent DuckDB SQL for the registered queries.

The warehouse tables are derived here a second time, in SQL, from the driver's tables; the
script answers come from the template parameters without reading any script text.
"""

from __future__ import annotations

VIEWS = {
    "raw_customer": """
SELECT CAST(c_custkey AS STRING) AS customer_id,
       CASE WHEN c_custkey % 97 = 0 THEN concat(c_name, ' TEST') ELSE c_name END AS customer_name,
       CASE WHEN c_custkey % 89 = 0 THEN concat('test@', CAST(c_custkey AS STRING), '.example.com')
            ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END AS email,
       concat('010-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS phone,
       CAST(DATE '2001-08-01' - CAST(c_custkey % 1500 AS INT) AS TIMESTAMP) AS registration_date,
       n_name AS country,
       TIMESTAMP '2001-01-01 00:00:00' AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
    "raw_address": """
SELECT CASE WHEN k < 3 OR c_custkey % 70 <> 0 THEN concat(CAST(c_custkey AS STRING), '-', CAST(k AS STRING)) END AS address_id,
       CAST(c_custkey AS STRING) AS customer_id,
       concat('street ', CAST(c_custkey % 50 AS STRING)) AS street_address,
       concat('city ', CAST(c_custkey % 20 AS STRING)) AS city,
       concat('state ', CAST(c_custkey % 5 AS STRING)) AS state,
       lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postal_code,
       n_name AS country,
       (k = 0 OR k = c_custkey % 3) AS is_primary,
       CASE WHEN k = 2 THEN 'SHIP' ELSE 'HOME' END AS address_type,
       TIMESTAMP '2001-01-01 00:00:00' AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey
CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) ks
WHERE k < 3 OR c_custkey % 10 = 0
""",
    "raw_order": """
SELECT CAST(o_orderkey AS STRING) AS order_id,
       CASE WHEN o_orderkey % 211 = 0 THEN NULL
            WHEN o_orderkey % 199 = 0 THEN concat('X', CAST(o_custkey AS STRING))
            ELSE CAST(o_custkey AS STRING) END AS customer_id,
       CASE WHEN o_orderkey % 223 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS order_date,
       CASE WHEN o_orderkey % 10 = 0 THEN 'CANCELLED' WHEN o_orderkey % 10 = 1 THEN 'FAILED'
            WHEN o_orderkey % 10 = 2 THEN 'SHIPPED'   WHEN o_orderstatus = 'F' THEN 'COMPLETED'
            WHEN o_orderstatus = 'O' THEN 'PENDING'   ELSE 'PROCESSING' END AS order_status,
       CAST(CASE WHEN o_orderkey % 227 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS total_amount,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'BANK'
            WHEN '3-MEDIUM' THEN 'CASH' WHEN '5-LOW' THEN 'POINT' ELSE NULL END AS payment_method,
       TIMESTAMP '2001-01-01 00:00:00' AS created_at
FROM orders
""",
    "raw_order_item": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id,
       CASE WHEN l_orderkey % 307 = 0 THEN concat('X', CAST(l_orderkey AS STRING))
            ELSE CAST(l_orderkey AS STRING) END AS order_id,
       CAST(l_partkey AS STRING) AS product_id,
       CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN 0
            ELSE CAST(l_quantity AS INT) END AS quantity,
       CAST(CASE WHEN l_partkey % 107 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT) AS DECIMAL(18,2)) AS item_total,
       TIMESTAMP '2001-01-01 00:00:00' AS created_at
FROM lineitem
""",
    "customer_master": """
SELECT b.customer_id, b.customer_name, b.email, b.phone, b.registration_date, b.country,
       a.last_order_date, a.total_orders, a.total_amount,
       b.created_at,
       CASE WHEN b.k % 13 = 0 THEN TIMESTAMP '2001-08-01 00:00:00' ELSE TIMESTAMP '2001-01-01 00:00:00' END AS updated_at,
       b.k % 61 = 0 AS is_deleted
FROM (SELECT c_custkey AS k, CAST(c_custkey AS STRING) AS customer_id, c_name AS customer_name,
             concat('c', CAST(c_custkey AS STRING), '@example.com') AS email, '010' AS phone,
             CAST(DATE '2001-08-01' - CAST(c_custkey % 1500 AS INT) AS TIMESTAMP) AS registration_date,
             n_name AS country, TIMESTAMP '2001-01-01 00:00:00' AS created_at
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL
      SELECT c_custkey + 10000000, CAST(c_custkey + 10000000 AS STRING), concat('Prospect ', c_name), NULL, NULL,
             CAST(DATE '2001-08-01' - CAST(c_custkey % 1500 AS INT) AS TIMESTAMP),
             n_name, TIMESTAMP '2001-01-01 00:00:00'
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 50 = 0) b
LEFT JOIN (SELECT CAST(o_custkey AS STRING) AS customer_id, max(CAST(o_orderdate AS TIMESTAMP)) AS last_order_date,
                  CAST(count(*) AS INT) AS total_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
           FROM orders GROUP BY o_custkey) a ON a.customer_id = b.customer_id
""",
    "customer_master_dup": """
SELECT * FROM customer_master
UNION ALL
SELECT * REPLACE (concat(customer_name, ' v2') AS customer_name, TIMESTAMP '2001-08-02 00:00:00' AS updated_at)
FROM customer_master WHERE CAST(customer_id AS BIGINT) % 41 = 0
""",
    "customer_staging": """
SELECT CAST(c_custkey AS STRING) AS customer_id, concat(c_name, ' upd') AS customer_name,
       concat('n', CAST(c_custkey AS STRING), '@example.com') AS email, '011' AS phone,
       CAST(DATE '2001-08-01' - CAST(c_custkey % 1500 AS INT) AS TIMESTAMP) AS registration_date,
       n_name AS country, c_custkey % 35 = 0 AS is_deleted, TIMESTAMP '2001-07-01 00:00:00' AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 5 = 0
UNION ALL
SELECT CAST(c_custkey + 20000000 AS STRING), concat('New ', c_name), NULL, '012',
       TIMESTAMP '2001-08-01 00:00:00', n_name, c_custkey % 200 = 0, TIMESTAMP '2001-07-01 00:00:00'
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 100 = 0
""",
    "order_staging": """
SELECT order_id, customer_id, order_date, 'SHIPPED' AS order_status,
       CAST(total_amount + 1 AS DECIMAL(18,2)) AS total_amount, 'CARD' AS payment_method,
       CAST(order_id AS BIGINT) % 21 = 0 AS is_deleted
FROM raw_order WHERE CAST(order_id AS BIGINT) % 7 = 0
UNION ALL
SELECT concat('N', order_id), customer_id, order_date, 'PENDING', total_amount, payment_method,
       CAST(order_id AS BIGINT) % 22 = 0
FROM raw_order WHERE CAST(order_id AS BIGINT) % 11 = 0
""",
    "data_quality_log": """
SELECT CAST(event_id AS STRING) AS log_id,
       CASE event_type WHEN 'view' THEN 'customer_master' WHEN 'click' THEN 'raw_order'
            WHEN 'purchase' THEN 'raw_order_item' WHEN 'signup' THEN 'raw_customer' ELSE 'raw_address' END AS table_name,
       concat('C', CAST(user_id % 4 AS STRING)) AS check_type,
       concat('check ', CAST(user_id % 4 AS STRING)) AS check_description,
       CASE CAST(event_id % 6 AS INT) WHEN 0 THEN 'PENDING' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SKIPPED'
            WHEN 3 THEN 'DEPRECATED' WHEN 4 THEN 'PASSED' ELSE 'UPDATED' END AS result,
       CAST(event_id % 64 AS INT) AS record_count,
       CAST(CASE WHEN event_id % 64 > 8 THEN event_id % 8 ELSE 0 END AS INT) AS error_count,
       CAST(ts AS TIMESTAMP) AS checked_at
FROM events
""",
}

# A view and the views it reads.
NEEDS = {"customer_master_dup": ["customer_master"], "order_staging": ["raw_order"]}

AS_OF = "DATE '2001-08-01'"
RUN_TS = "TIMESTAMP '2001-08-01 00:00:00'"
LOG_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _with_views(body: str, *names: str) -> str:
    order: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in order:
                order.append(needed)
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def ratio(numerator: str, denominator: str) -> str:
    """Money ratio rounded half up in whole hundredths."""
    cents = f"CAST(abs({numerator}) * 100 AS HUGEINT)"
    n = f"CAST({denominator} AS HUGEINT)"
    return (
        f"CASE WHEN {n} <> 0 THEN CAST(CAST(((2 * {cents} + {n}) // (2 * {n})) * "
        f"(CASE WHEN {numerator} < 0 THEN -1 ELSE 1 END) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) END"
    )


def mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / nullif(CAST(count({column}) AS DOUBLE), 0)"


SUM = "CAST(sum({}) AS DECIMAL(28,2))"

SALES_ROWS = """
SELECT c.customer_id, c.customer_name, c.email, o.order_id, o.order_date, o.total_amount,
       oi.product_id, oi.quantity, oi.unit_price,
       row_number() OVER (PARTITION BY c.customer_id ORDER BY o.order_date DESC NULLS LAST, o.order_id,
                          oi.order_item_id, oi.product_id, oi.quantity NULLS LAST, oi.unit_price) AS purchase_rank
FROM customer_master c
LEFT JOIN raw_order o ON c.customer_id = o.customer_id
LEFT JOIN raw_order_item oi ON o.order_id = oi.order_id
WHERE o.order_status IN ('COMPLETED', 'PENDING')
"""

SALES = ("customer_master", "raw_order", "raw_order_item")

DAILY = f"""
SELECT strftime(order_date, '%Y-%m-%d') AS sales_date, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers, {SUM.format('total_amount')} AS daily_revenue,
       {mean('total_amount')} AS avg_order_amount, min(total_amount) AS min_order_amount,
       max(total_amount) AS max_order_amount
FROM raw_order WHERE order_status = 'COMPLETED' GROUP BY 1
"""

REVENUE_COLUMNS = f"""
customer_id, customer_name, count(DISTINCT order_id) AS order_count, {SUM.format('total_amount')} AS total_revenue,
{mean('total_amount')} AS avg_order_value, max(order_date) AS last_purchase_date,
min(order_date) AS first_purchase_date,
CAST(datediff('day', min(order_date), max(order_date)) AS BIGINT) AS customer_lifetime_days
"""

REVENUE = f"SELECT {REVENUE_COLUMNS} FROM ({SALES_ROWS}) GROUP BY customer_id, customer_name"

AGE = f"datediff('day', CAST(registration_date AS DATE), {AS_OF})"

REPORTS = {
    "v1_sales_analysis": (SALES_ROWS, *SALES),
    "v2_daily_sales": (DAILY, "raw_order"),
    "v3_customer_revenue": (REVENUE, *SALES),
    "v3_customer_revenue_per_order": (
        f"""
        SELECT {REVENUE_COLUMNS} FROM (
            SELECT c.customer_id, c.customer_name, o.order_id, o.order_date, o.total_amount
            FROM customer_master c JOIN raw_order o ON c.customer_id = o.customer_id
            WHERE o.order_status IN ('COMPLETED', 'PENDING'))
        GROUP BY customer_id, customer_name""",
        "customer_master", "raw_order",
    ),
    "r01_customers": (
        """
        SELECT customer_id, customer_name, email, phone, registration_date, country
        FROM customer_master WHERE customer_id IS NOT NULL ORDER BY customer_id LIMIT 100""",
        "customer_master",
    ),
    "r02_customer_history": (
        f"""
        SELECT c.customer_id, c.customer_name, c.email, count(o.order_id) AS total_orders,
               {SUM.format('o.total_amount')} AS total_spent, max(o.order_date) AS last_order_date,
               min(o.order_date) AS first_order_date
        FROM customer_master c LEFT JOIN raw_order o ON c.customer_id = o.customer_id
        WHERE c.country = 'NATION_7' GROUP BY c.customer_id, c.customer_name, c.email""",
        "customer_master", "raw_order",
    ),
    "r03_daily_recent": (
        f"""
        SELECT *, {ratio('daily_revenue', 'unique_customers')} AS revenue_per_customer
        FROM ({DAILY}) WHERE sales_date >= strftime({AS_OF} - 30, '%Y-%m-%d')""",
        "raw_order",
    ),
    "r04_top_purchases": (
        f"""
        SELECT customer_id, customer_name, email, order_id, order_date, total_amount, product_id, quantity, unit_price,
               CAST(quantity * unit_price AS DECIMAL(18,2)) AS calculated_total, purchase_rank
        FROM ({SALES_ROWS}) WHERE purchase_rank <= 5""",
        *SALES,
    ),
    "r05_customer_segment": (
        f"""
        SELECT *, CASE WHEN total_revenue >= 100000 THEN 'VIP' WHEN total_revenue >= 50000 THEN 'PREMIUM'
                       WHEN total_revenue >= 10000 THEN 'REGULAR' ELSE 'NEW' END AS customer_segment
        FROM ({REVENUE}) WHERE order_count > 0""",
        *SALES,
    ),
    "r06_product_sales": (
        f"""
        SELECT oi.product_id, count(DISTINCT oi.order_id) AS total_sales, CAST(sum(oi.quantity) AS BIGINT) AS total_quantity,
               {SUM.format('oi.item_total')} AS total_revenue, {mean('oi.unit_price')} AS avg_price,
               min(oi.unit_price) AS min_price, max(oi.unit_price) AS max_price
        FROM raw_order_item oi JOIN raw_order o ON oi.order_id = o.order_id
        WHERE o.order_status = 'COMPLETED' GROUP BY oi.product_id""",
        "raw_order_item", "raw_order",
    ),
    "r07_country_revenue": (
        f"""
        SELECT country, total_customers, total_orders, total_revenue, avg_order_value,
               {ratio('total_revenue', 'total_customers')} AS revenue_per_customer
        FROM (SELECT c.country, count(DISTINCT c.customer_id) AS total_customers,
                     count(DISTINCT o.order_id) AS total_orders, {SUM.format('o.total_amount')} AS total_revenue,
                     {mean('o.total_amount')} AS avg_order_value
              FROM customer_master c LEFT JOIN raw_order o ON c.customer_id = o.customer_id GROUP BY c.country)""",
        "customer_master", "raw_order",
    ),
    "r08_payment_methods": (
        f"""
        SELECT payment_method, count(DISTINCT order_id) AS transaction_count,
               count(DISTINCT customer_id) AS unique_customers, {SUM.format('total_amount')} AS total_amount,
               {mean('total_amount')} AS avg_amount, min(raw_order.total_amount) AS min_amount,
               max(raw_order.total_amount) AS max_amount
        FROM raw_order WHERE payment_method IS NOT NULL AND order_status IN ('COMPLETED', 'PENDING')
        GROUP BY payment_method""",
        "raw_order",
    ),
    "r09_customer_age": (
        f"""
        SELECT customer_type, customer_count, {ratio('o', 'n_o')} AS avg_orders, {ratio('a', 'n_a')} AS avg_amount
        FROM (SELECT CASE WHEN {AGE} <= 30 THEN 'NEW' WHEN {AGE} <= 90 THEN 'ACTIVE' WHEN {AGE} <= 365 THEN 'LOYAL'
                          ELSE 'DORMANT' END AS customer_type,
                     count(*) AS customer_count, sum(total_orders) AS o, count(total_orders) AS n_o,
                     sum(total_amount) AS a, count(total_amount) AS n_a
              FROM customer_master GROUP BY 1)""",
        "customer_master",
    ),
    "r10_order_status": (
        f"""
        SELECT order_status, order_count, unique_customers, CAST(s AS DECIMAL(28,2)) AS total_amount,
               {ratio('s', 'n')} AS avg_amount, earliest_date, latest_date
        FROM (SELECT order_status, count(*) AS order_count, count(DISTINCT customer_id) AS unique_customers,
                     sum(total_amount) AS s, count(total_amount) AS n, min(order_date) AS earliest_date,
                     max(order_date) AS latest_date
              FROM raw_order GROUP BY order_status)""",
        "raw_order",
    ),
    "r11_quality": (
        f"""
        SELECT table_name, check_type, check_description, result, record_count, error_count,
               {ratio('((record_count - error_count) * 100)', 'record_count')} AS quality_percentage, checked_at
        FROM data_quality_log WHERE checked_at >= {LOG_AS_OF} - INTERVAL 7 DAY""",
        "data_quality_log",
    ),
}

ORDER_COLUMNS = "order_id, customer_id, order_date, order_status, total_amount, payment_method, created_at"


def _recent(days: int) -> str:
    return f"SELECT customer_id FROM raw_order WHERE order_date >= {AS_OF} - {days}"


UPDATES = {
    "u01_update_by_key": (
        f"""
        SELECT * REPLACE (
            CASE WHEN customer_id = '77' THEN 'Updated Name' ELSE customer_name END AS customer_name,
            CASE WHEN customer_id = '77' THEN 'newemail@example.com' ELSE email END AS email,
            CASE WHEN customer_id = '77' THEN '010-1234-5678' ELSE phone END AS phone,
            CASE WHEN customer_id = '77' THEN {RUN_TS} ELSE updated_at END AS updated_at)
        FROM customer_master""",
        "customer_master",
    ),
    "u02_refresh_stats": (
        f"""
        WITH touched AS (SELECT DISTINCT customer_id FROM raw_order)
        SELECT c.* REPLACE (
            CASE WHEN t.customer_id IS NULL THEN c.total_orders ELSE CAST((
                SELECT count(DISTINCT order_id) FROM raw_order o WHERE o.customer_id = c.customer_id
                AND order_status IN ('COMPLETED', 'PENDING')) AS INT) END AS total_orders,
            CASE WHEN t.customer_id IS NULL THEN c.total_amount ELSE CAST((
                SELECT coalesce(sum(o.total_amount), 0) FROM raw_order o WHERE o.customer_id = c.customer_id
                AND order_status = 'COMPLETED') AS DECIMAL(18,2)) END AS total_amount,
            CASE WHEN t.customer_id IS NULL THEN c.last_order_date ELSE (
                SELECT max(order_date) FROM raw_order o WHERE o.customer_id = c.customer_id) END AS last_order_date,
            CASE WHEN t.customer_id IS NULL THEN c.updated_at ELSE {RUN_TS} END AS updated_at)
        FROM customer_master c LEFT JOIN touched t ON t.customer_id = c.customer_id""",
        "customer_master", "raw_order",
    ),
    "u03_merge_customers": (
        f"""
        SELECT t.* REPLACE (
            CASE WHEN s.is_deleted = FALSE THEN s.customer_name ELSE t.customer_name END AS customer_name,
            CASE WHEN s.is_deleted = FALSE THEN s.email ELSE t.email END AS email,
            CASE WHEN s.is_deleted = FALSE THEN s.phone ELSE t.phone END AS phone,
            CASE WHEN s.is_deleted = FALSE THEN s.registration_date ELSE t.registration_date END AS registration_date,
            CASE WHEN s.is_deleted = FALSE THEN s.country ELSE t.country END AS country,
            CASE WHEN s.is_deleted = FALSE THEN {RUN_TS} ELSE t.updated_at END AS updated_at)
        FROM customer_master t LEFT JOIN customer_staging s ON t.customer_id = s.customer_id
        UNION ALL BY NAME
        SELECT customer_id, customer_name, email, phone, registration_date, country,
               {RUN_TS} AS created_at, {RUN_TS} AS updated_at
        FROM customer_staging s WHERE is_deleted = FALSE
        AND NOT EXISTS (SELECT 1 FROM customer_master t WHERE t.customer_id = s.customer_id)""",
        "customer_master", "customer_staging",
    ),
    "u04_merge_orders": (
        f"""
        SELECT t.order_id, t.customer_id, t.order_date,
               CASE WHEN s.order_id IS NULL THEN t.order_status ELSE s.order_status END AS order_status,
               CASE WHEN s.order_id IS NULL THEN t.total_amount ELSE s.total_amount END AS total_amount,
               CASE WHEN s.order_id IS NULL THEN t.payment_method ELSE s.payment_method END AS payment_method,
               CASE WHEN s.order_id IS NULL THEN t.created_at ELSE {RUN_TS} END AS created_at
        FROM raw_order t LEFT JOIN order_staging s ON t.order_id = s.order_id
        WHERE s.is_deleted IS DISTINCT FROM TRUE
        UNION ALL
        SELECT order_id, customer_id, order_date, order_status, total_amount, payment_method, {RUN_TS}
        FROM order_staging s WHERE is_deleted = FALSE
        AND NOT EXISTS (SELECT 1 FROM raw_order t WHERE t.order_id = s.order_id)""",
        "order_staging",
    ),
    "u05_expire_orders": (
        f"""
        SELECT * REPLACE (
            CASE WHEN order_date >= {AS_OF} - 30 AND order_status = 'PENDING'
                      AND datediff('day', CAST(order_date AS DATE), {AS_OF}) > 7 THEN 'EXPIRED'
                 WHEN order_date >= {AS_OF} - 30 AND order_status = 'PROCESSING' AND total_amount >= 100000 THEN 'PRIORITY'
                 ELSE order_status END AS order_status,
            CASE WHEN order_date >= {AS_OF} - 30 AND order_status IN ('PENDING', 'PROCESSING') THEN {RUN_TS}
                 ELSE created_at END AS created_at)
        FROM raw_order""",
        "raw_order",
    ),
    "u06_recount_recent": (
        f"""
        SELECT c.* REPLACE (
            CASE WHEN c.customer_id IN ({_recent(90)}) THEN CAST((
                SELECT count(*) FROM raw_order o WHERE o.customer_id = c.customer_id) AS INT)
                ELSE c.total_orders END AS total_orders,
            CASE WHEN c.customer_id IN ({_recent(90)}) THEN {RUN_TS} ELSE c.updated_at END AS updated_at)
        FROM customer_master c""",
        "customer_master", "raw_order",
    ),
    "u07_last_order": (
        f"""
        SELECT c.* REPLACE (
            CASE WHEN c.customer_id IN ({_recent(30)}) THEN (
                SELECT max(order_date) FROM raw_order o WHERE o.customer_id = c.customer_id)
                ELSE c.last_order_date END AS last_order_date,
            CASE WHEN c.customer_id IN ({_recent(30)}) THEN {RUN_TS} ELSE c.updated_at END AS updated_at)
        FROM customer_master c""",
        "customer_master", "raw_order",
    ),
    "u08_one_primary": (
        """
        SELECT a.* REPLACE (
            CASE WHEN a.customer_id IN (SELECT customer_id FROM raw_address WHERE is_primary GROUP BY customer_id
                                        HAVING count(*) > 1)
                  AND a.address_id <> (SELECT min(b.address_id) FROM raw_address b
                                       WHERE b.customer_id = a.customer_id AND b.is_primary)
                 THEN FALSE ELSE a.is_primary END AS is_primary)
        FROM raw_address a""",
        "raw_address",
    ),
    "u09_log_status": (
        f"""
        SELECT * REPLACE (
            CASE WHEN table_name = 'customer_master' AND result = 'PENDING' THEN 'UPDATED' ELSE result END AS result,
            CASE WHEN table_name = 'customer_master' AND result = 'PENDING' THEN {LOG_AS_OF} ELSE checked_at END
                AS checked_at)
        FROM data_quality_log""",
        "data_quality_log",
    ),
    "u10_rebuild_master": (
        f"""
        SELECT c.customer_id, c.customer_name, c.email, c.phone, c.registration_date, c.country,
               max(o.order_date) AS last_order_date, CAST(count(DISTINCT o.order_id) AS INT) AS total_orders,
               CAST(coalesce(sum(o.total_amount), 0) AS DECIMAL(18,2)) AS total_amount, c.created_at,
               {RUN_TS} AS updated_at
        FROM customer_staging c
        LEFT JOIN raw_order o ON c.customer_id = o.customer_id AND o.order_status = 'COMPLETED'
        WHERE c.is_deleted = FALSE
        GROUP BY c.customer_id, c.customer_name, c.email, c.phone, c.registration_date, c.country, c.created_at""",
        "customer_staging", "raw_order",
    ),
    "u11_merge_aggregated": (
        f"""
        WITH s AS (
            SELECT c.customer_id, c.customer_name, c.email, c.phone, c.registration_date, c.country,
                   max(o.order_date) AS last_order_date, CAST(count(o.order_id) AS INT) AS total_orders,
                   CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS total_amount
            FROM customer_staging c LEFT JOIN raw_order o ON c.customer_id = o.customer_id
            WHERE c.is_deleted = FALSE GROUP BY ALL)
        SELECT t.* REPLACE (
            CASE WHEN s.customer_id IS NULL THEN t.customer_name ELSE s.customer_name END AS customer_name,
            CASE WHEN s.customer_id IS NULL THEN t.email ELSE s.email END AS email,
            CASE WHEN s.customer_id IS NULL THEN t.phone ELSE s.phone END AS phone,
            CASE WHEN s.customer_id IS NULL THEN t.last_order_date ELSE s.last_order_date END AS last_order_date,
            CASE WHEN s.customer_id IS NULL THEN t.total_orders ELSE s.total_orders END AS total_orders,
            CASE WHEN s.customer_id IS NULL THEN t.total_amount ELSE s.total_amount END AS total_amount,
            CASE WHEN s.customer_id IS NULL THEN t.updated_at ELSE {RUN_TS} END AS updated_at)
        FROM customer_master t LEFT JOIN s ON t.customer_id = s.customer_id
        UNION ALL BY NAME
        SELECT s.*, {RUN_TS} AS created_at, {RUN_TS} AS updated_at
        FROM s WHERE NOT EXISTS (SELECT 1 FROM customer_master t WHERE t.customer_id = s.customer_id)""",
        "customer_master", "customer_staging", "raw_order",
    ),
}


def _kept(table: str, condition: str) -> str:
    return f"SELECT * FROM {table} WHERE coalesce({condition}, FALSE) = FALSE"


DELETES = {
    "d01_by_key": (_kept("customer_master", "customer_id = '77'"), "customer_master"),
    "d02_old_failed": (
        _kept("raw_order", f"order_date < {AS_OF} - 365 AND order_status IN ('CANCELLED', 'FAILED')"), "raw_order"),
    "d03_orphan_orders": (
        _kept("raw_order", "customer_id NOT IN (SELECT customer_id FROM customer_master)"), "raw_order", "customer_master"),
    "d04_dup_addresses": (
        _kept("raw_address", """address_id NOT IN (SELECT max(address_id) FROM raw_address
              GROUP BY customer_id, address_type) AND is_primary = FALSE"""), "raw_address"),
    "d05_test_rows": (_kept("raw_customer", "customer_name LIKE '%TEST%' OR email LIKE '%test@%'"), "raw_customer"),
    "d06_idle_customers": (
        _kept("customer_master", f"""NOT EXISTS (SELECT 1 FROM raw_order o WHERE o.customer_id = customer_master.customer_id)
              AND datediff('day', CAST(registration_date AS DATE), {AS_OF}) > 730"""), "customer_master", "raw_order"),
    "d07_cancelled_items": (
        _kept("raw_order_item", f"""order_id IN (SELECT order_id FROM raw_order WHERE order_status = 'CANCELLED'
              AND order_date < {AS_OF} - 90)"""), "raw_order_item", "raw_order"),
    "d08_done_staging": (
        _kept("customer_staging", f"""customer_id IN (SELECT customer_id FROM customer_master
              WHERE updated_at >= {AS_OF}) AND is_deleted = FALSE"""), "customer_staging", "customer_master"),
    "d09_failed_log": (
        _kept("data_quality_log", "result = 'FAILED' AND checked_at < TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 30 DAY"),
        "data_quality_log"),
    "d11_cascade_addresses": (
        _kept("raw_address", """customer_id IN (SELECT customer_id FROM customer_master
              WHERE is_deleted = TRUE OR country = 'UNKNOWN')"""), "raw_address", "customer_master"),
    "d12_soft_delete_orders": (
        f"""SELECT * REPLACE (CASE WHEN order_date < {AS_OF} - 1825 AND order_status NOT IN ('COMPLETED', 'SHIPPED')
            THEN 'DELETED' ELSE order_status END AS order_status) FROM raw_order""", "raw_order"),
    "d13_invalid_orders": (
        _kept("raw_order", "total_amount <= 0 OR customer_id IS NULL OR order_date IS NULL"), "raw_order"),
    "d15_drop_partitions": (
        """SELECT *, CAST(order_date AS DATE) AS order_day FROM raw_order
           WHERE NOT coalesce(CAST(order_date AS DATE) < DATE '2000-01-01', FALSE)""", "raw_order"),
    "d16_dups_as_written": (
        """SELECT * FROM customer_master_dup WHERE customer_id NOT IN (SELECT customer_id FROM (
               SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS rn
               FROM customer_master_dup) WHERE rn > 1)""", "customer_master_dup"),
    "d16_dups_keep_latest": (
        """SELECT * EXCLUDE (rn) FROM (
               SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) AS rn
               FROM customer_master_dup) WHERE rn = 1""", "customer_master_dup"),
    "d17_bad_items": (
        _kept("raw_order_item", """(quantity IS NULL OR quantity <= 0) OR (unit_price IS NULL OR unit_price < 0)
              OR (item_total IS NULL OR item_total < 0) OR order_id NOT IN (SELECT order_id FROM raw_order)"""),
        "raw_order_item", "raw_order"),
    "d18_inactive": (
        _kept("customer_master", f"""datediff('day', CAST(last_order_date AS DATE), {AS_OF}) > 1095
              AND datediff('day', CAST(updated_at AS DATE), {AS_OF}) > 180"""), "customer_master"),
    "d19_log_cleanup": (
        _kept("data_quality_log", """checked_at < TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY
              AND result IN ('SKIPPED', 'DEPRECATED')"""), "data_quality_log"),
    "d20_mask_deleted": (
        f"""
        WITH s AS (SELECT customer_id FROM customer_staging WHERE is_deleted)
        SELECT t.* REPLACE (
            CASE WHEN s.customer_id IS NULL THEN t.customer_name ELSE '[DELETED]' END AS customer_name,
            CASE WHEN s.customer_id IS NULL THEN t.email END AS email,
            CASE WHEN s.customer_id IS NULL THEN t.phone END AS phone,
            CASE WHEN s.customer_id IS NULL THEN t.updated_at ELSE {RUN_TS} END AS updated_at)
        FROM customer_master t LEFT JOIN s ON t.customer_id = s.customer_id""",
        "customer_master", "customer_staging"),
}


CSV_TEXT = "coalesce(CAST({0} AS VARCHAR), '') AS {0}"
STORED = {
    "s01_write_read": ("SELECT * FROM customer_staging", "customer_staging"),
    "s02_partitioned": ("SELECT * FROM customer_master", "customer_master"),
    "s03_order_days": ("SELECT * FROM data_quality_log", "data_quality_log"),
    "s04_buckets": ("SELECT * FROM raw_customer", "raw_customer"),
    "s05_defaults": (
        f"SELECT * REPLACE (FALSE AS is_deleted, {RUN_TS} AS created_at, CAST(NULL AS VARCHAR) AS phone) FROM customer_staging",
        "customer_staging"),
    "s06_overwrite": UPDATES["u01_update_by_key"],
    "s06_change_partitions": (
        """SELECT * REPLACE (CASE WHEN table_name = 'raw_order' THEN upper(check_type) ELSE result END AS result)
           FROM data_quality_log""", "data_quality_log"),
    "s09_csv": (
        f"""SELECT {", ".join(CSV_TEXT.format(c) for c in (
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", "item_total"))},
            strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM raw_order_item""", "raw_order_item"),
    "s13_unload": (
        """WITH q AS (SELECT country, customer_id, email FROM customer_master WHERE total_orders IS NULL OR total_orders > 3)
           SELECT *, (SELECT count(*) FROM q) AS counted FROM q""", "customer_master"),
    "s16_truncate": (
        "SELECT country, count(*) AS before_rows, CAST(0 AS BIGINT) AS after_rows FROM customer_staging GROUP BY country",
        "customer_staging"),
}
#: Changes by file are checked by the SQL of the whole-table form.
BY_FILE = (
    "u01_update_by_key", "u03_merge_customers", "u04_merge_orders", "u11_merge_aggregated", "d01_by_key", "d03_orphan_orders",
    "d07_cancelled_items", "d20_mask_deleted",
)


# What every script template holds: (sql type, class, text, target, sources) per statement.
# Names are SQL expressions over the template parameters a and b.
M_A, TV_A, DW_A = "'m.t' || a", "'tv' || a", "'${DW}.t' || a"
S_B, D_A, U_A, STG_B = "'ods.s' || b", "'ods.d' || a", "'ods.u' || a", "'stg.s' || b"

TEMPLATES = {
    0: [("INSERT", "C", f"'INSERT INTO ' || {DW_A} || ' SELECT x.c FROM ' || {S_B} || ' x JOIN ' || {D_A} || ' y ON x.k = y.k;'",
         DW_A, [S_B, D_A])],
    1: [("INSERT", "C", f"'INSERT OVERWRITE TABLE ' || {M_A} || ' WITH c1 AS (SELECT * FROM ' || {S_B} || "
         "'), c2 AS (SELECT * FROM c1) SELECT * FROM c2;'", M_A, [S_B])],
    2: [("MERGE", "C", f"'MERGE INTO ' || {M_A} || ' t USING ' || {STG_B} || ' s ON t.k = s.k WHEN MATCHED THEN UPDATE "
         "SET t.c = s.c WHEN NOT MATCHED THEN INSERT (k) VALUES (s.k);'", M_A, [STG_B])],
    3: [("UPDATE", "U", f"'UPDATE ' || {M_A} || ' SET c = (SELECT max(x) FROM ' || {S_B} || ' q WHERE q.k = 1) "
         f"WHERE k IN (SELECT k FROM ' || {U_A} || ');'", M_A, [S_B, U_A])],
    4: [("DELETE", "D", f"'DELETE FROM ' || {M_A} || ' WHERE k IN (SELECT k FROM ' || {S_B} || ');'", M_A, [M_A, S_B])],
    5: [("CREATE", "C", f"'CREATE TEMPORARY VIEW ' || {TV_A} || ' AS SELECT * FROM ' || {S_B} || ', ' || {D_A} || ';'",
         TV_A, [S_B, D_A]),
        ("INSERT", "C", f"'INSERT INTO ' || {M_A} || ' SELECT * FROM ' || {TV_A} || ';'", M_A, [TV_A])],
    6: [("TRUNCATE", "D", f"'TRUNCATE TABLE ' || {M_A} || ';'", M_A, []),
        ("DROP", "D", "'DROP TABLE IF EXISTS m.o' || b || ';'", "'m.o' || b", [])],
    7: [("SELECT", "R", f"'SELECT count(*) FROM (SELECT * FROM ' || {S_B} || ' WHERE n = ''FROM fake; x'') q LEFT JOIN ' "
         f"|| {D_A} || ' z ON q.k = z.k;'", None, [S_B, D_A])],
    8: [("INSERT", "C", f"'INSERT INTO ' || {M_A} || ' SELECT * FROM ' || {S_B}", M_A, [S_B])],
    9: [("INSERT", "C", f"'INSERT INTO ' || {M_A} || ' SELECT * FROM ' || {S_B} || ';'", M_A, [S_B])],
    12: [("INSERT", "C", f"'INSERT OVERWRITE TABLE ' || {M_A} || ' WITH c1 AS (SELECT * FROM c2), c2 AS (SELECT * FROM ' || "
          f"{S_B} || ') SELECT * FROM c1;'", M_A, [S_B])],
    13: [("INSERT", "C", f"'INSERT OVERWRITE TABLE ' || {M_A} || ' WITH c1 AS (SELECT * FROM ' || {S_B} || "
          "' x JOIN c1 r ON r.k = x.k) SELECT * FROM c1;'", M_A, [S_B])],
}
# What WITH names read and feed: (template, source, target, depth).
WITH_EDGES = (
    (1, S_B, "'C1'", 1), (1, "'c1'", "'C2'", 2), (1, "'c1'", M_A, 2), (1, "'c2'", M_A, 3),
    (12, S_B, "'C2'", 1), (12, "'c2'", "'C1'", 2), (12, "'c2'", M_A, 2), (12, "'c1'", M_A, 3),
    (13, S_B, "'C1'", 2), (13, "'c1'", "'C1'", 2), (13, "'c1'", M_A, 3),
)

SCRIPTS = """
s AS (SELECT *, base_directory || '/' || file_name AS dir_file FROM (
    SELECT CASE WHEN doc_id % 12 = 1 AND doc_id % 5 IN (1, 2) THEN 11 + doc_id % 5 ELSE doc_id % 12 END AS t,
           CAST(doc_id % 17 AS VARCHAR) AS a, CAST(doc_id % 23 AS VARCHAR) AS b, text,
           '/corpus/d' || CAST(doc_id % 10 AS VARCHAR) AS base_directory,
           'f' || CAST(doc_id AS VARCHAR) || '.' || ['sql', 'hql', 'SQL', 'uld', 'ld', 'sh'][CAST(doc_id % 6 AS INT) + 1]
               AS file_name
    FROM documents WHERE doc_id % 24 <> 11))"""


def _statements() -> str:
    parts = []
    for t, found in TEMPLATES.items():
        for number, (kind, crud, text, _, _) in enumerate(found, 1):
            parts.append(
                f"SELECT base_directory, file_name, dir_file, CAST({number} AS INT) AS stmt_no, '{kind}' AS sql_type, "
                f"'{crud}' AS crud_type, {text} AS query_text FROM s WHERE t = {t}"
            )
    return f"WITH {SCRIPTS}, q AS (" + "\nUNION ALL ".join(parts) + ")"


def _pairs(detail: bool) -> str:
    parts = []

    def add(t, number, kind, crud, source, target, depth):
        parts.append(
            f"SELECT base_directory, file_name, dir_file, a, CAST({number} AS INT) AS stmt_no, '{kind}' AS sql_type, "
            f"'{crud}' AS crud_type, {source} AS source, {target} AS target, CAST({depth} AS INT) AS depth "
            f"FROM s WHERE t = {t}"
        )

    for t, found in TEMPLATES.items():
        for number, (kind, crud, _, target, sources) in enumerate(found, 1):
            for source in sources or ["''"]:
                add(t, number, kind, crud, source, target or "''", 1)
    if detail:
        for t, source, target, depth in WITH_EDGES:
            add(t, 1, "INSERT", "C", source, target, depth)
    return f"WITH {SCRIPTS}, e AS (" + "\nUNION ALL ".join(parts) + ")"


def _kind(name: str) -> str:
    return (
        f"CASE WHEN {name} = '' THEN '' WHEN lower({name}) IN ('c1', 'c2') THEN 'CTE' "
        f"WHEN {name} LIKE 'tv%' THEN 'TEMP' ELSE 'TABLE' END"
    )


def _schema(name: str) -> str:
    return (
        f"CASE WHEN {name} LIKE '${{DW}}.%' THEN 'dwh' WHEN contains({name}, '.') THEN split_part({name}, '.', 1) "
        "ELSE '' END"
    )


def _table(name: str) -> str:
    return f"CASE WHEN contains({name}, '.') THEN split_part({name}, '.', 2) ELSE {name} END"


def _lineage(detail: bool) -> str:
    return f"""{_pairs(detail)}
    SELECT '20240131_000000' AS run_id, base_directory, file_name, dir_file, crud_type, sql_type,
           source AS source_table, {_kind('source')} AS source_type, target AS target_table,
           {_kind('target')} AS target_type, depth, {_schema('source')} AS src_schema, {_table('source')} AS src_table,
           {_schema('target')} AS tgt_schema, {_table('target')} AS tgt_table, {LOG_AS_OF} AS op_dtm
    FROM e"""


# The same white space as on the other side; RE2 writes code points in braces.
RE2_WHITE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{RE2_WHITE}]+|[{RE2_WHITE}]+$', '', 'g')"


SCRIPT_LINES = """
l AS (
    SELECT base_directory, file_name, dir_file, '-- ' || unnest(string_split(text, chr(10))) AS line FROM s
    UNION ALL
    SELECT base_directory, file_name, dir_file,
           unnest(['EMRPUT job' || a, '  EMRPUTF job' || b || '  ', 'col DEFAULT 0', '-- KEY_MST note', 'emrput lower'])
    FROM s WHERE t = 11)"""

LINEAGE = {
    "l02_keyword_lines": f"""
        WITH {SCRIPTS}, {SCRIPT_LINES}
        SELECT base_directory, file_name, dir_file, keyword, {_strip('line')} AS line
        FROM l JOIN (SELECT unnest(['default', 'key_mst']) AS keyword) k ON contains(lower(line), keyword)""",
    "l02_keyword_documents": f"""
        SELECT doc_id, 'thing' AS keyword, {_strip('line')} AS line
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE contains(lower(line), 'thing')""",
    "l02_keyword_table": f"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
        k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS keyword FROM benchmark)
        SELECT keyword, count(*) AS lines, count(DISTINCT doc_id) AS documents
        FROM l JOIN (SELECT keyword FROM k) q ON contains(lower(line), lower(keyword)) GROUP BY keyword""",
    "l03_emrput_lines": f"""
        WITH {SCRIPTS}, {SCRIPT_LINES}
        SELECT base_directory, file_name, dir_file,
               CASE WHEN contains(line, 'EMRPUTF') THEN 'EMRPUTF' ELSE 'EMRPUT' END AS emrput_type,
               {_strip('line')} AS emrput_line
        FROM l WHERE contains(line, 'EMRPUT')""",
    "l05_statements": f"{_statements()} SELECT dir_file, stmt_no, query_text FROM q",
    "l08_statement_types": f"{_statements()} SELECT dir_file, stmt_no, sql_type, crud_type FROM q",
    "l11_sources": f"""{_pairs(False)}
        SELECT dir_file, stmt_no, source FROM e WHERE source <> ''
        UNION ALL
        SELECT dir_file, CAST(1 AS INT), unnest(['c1', 'c2']) FROM s WHERE t IN (1, 12)
        UNION ALL SELECT dir_file, CAST(1 AS INT), 'c1' FROM s WHERE t = 13""",
    "l13_targets": f"{_pairs(False)} SELECT DISTINCT dir_file, stmt_no, target FROM e WHERE target <> ''",
    "l15_ctes": "\nUNION ALL ".join(
        f"(WITH {SCRIPTS} SELECT dir_file, CAST(1 AS INT) AS stmt_no, {target} AS cte, {source} AS source FROM s WHERE t = {t})"
        for t, source, target, _ in WITH_EDGES
        if target != M_A
    ),
    "l16_cte_depth": f"""WITH {SCRIPTS}
        SELECT dir_file, CAST(1 AS INT) AS stmt_no, cte, CAST(depth AS INT) AS depth
        FROM s JOIN (VALUES (1, 'C1', 1), (1, 'C2', 2), (12, 'C1', 2), (12, 'C2', 1), (13, 'C1', 2)) d(n, cte, depth)
        ON t = n""",
    "l17_temp_objects": f"WITH {SCRIPTS} SELECT DISTINCT 'TV' || a AS temp_name FROM s WHERE t = 5",
    "l19_resolved_names": f"""{_pairs(False)}
        SELECT DISTINCT dir_file, stmt_no, target, {_schema('target')} AS tgt_schema, {_table('target')} AS tgt_table
        FROM e WHERE target <> ''""",
    "l20_lineage_simple": _lineage(False),
    "l21_lineage_detail": _lineage(True),
    "l22_query_text": f"""{_statements()}
        SELECT row_number() OVER (ORDER BY substr(md5(dir_file), 1, 3), dir_file, stmt_no) AS id, base_directory, file_name,
               dir_file, crud_type, sql_type, query_text, {LOG_AS_OF} AS op_dtm FROM q""",
    "l23_run_summary": f"""{_pairs(False)}, {SCRIPT_LINES},
        w AS (SELECT base_directory, file_name, dir_file, stmt_no FROM e GROUP BY ALL)
        SELECT (SELECT count(*) FROM s) AS files,
               (SELECT count(*) FROM w) AS queries,
               (SELECT CAST(sum(length(text) - length(replace(text, chr(10), '')) + 3 +
                   CASE t WHEN 5 THEN 1 WHEN 6 THEN 1 WHEN 9 THEN 2 WHEN 10 THEN 2 WHEN 11 THEN 4 ELSE 0 END) AS BIGINT)
                FROM s) AS file_lines,
               (SELECT count(*) FROM e) AS lineage_rows,
               (SELECT count(*) FROM w) AS query_text_rows,
               (SELECT count(*) FROM l WHERE contains(line, 'EMRPUTF')) AS emrputf_lines,
               (SELECT count(*) FROM l WHERE contains(line, 'EMRPUT') AND NOT contains(line, 'EMRPUTF')) AS emrput_lines,
               (SELECT count(*) FROM l WHERE contains(lower(line), 'default')) AS default_lines,
               (SELECT count(*) FROM l WHERE contains(lower(line), 'key_mst')) AS key_mst_lines""",
}


def all_sql() -> dict[str, str]:
    changes = {**UPDATES, **DELETES}
    by_file = {f"{n.partition('_')[0]}_files_{n.partition('_')[2]}": changes[n] for n in BY_FILE}
    groups = {**REPORTS, **changes, **STORED, **by_file}
    return {**{name: _with_views(body, *views) for name, (body, *views) in groups.items()}, **LINEAGE}
