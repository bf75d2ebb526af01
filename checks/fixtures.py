"""The warehouse tables and the script corpus, derived from the driver's tables.

Bad rows (missing keys, orphan keys, negative amounts, zero denominators) are planted
by modulus because the driver's tables are clean.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.session import use_utc
from rowloom.sources.tables import table_schema

AS_OF = date(2001, 8, 1)
LOG_AS_OF = datetime(2024, 1, 31)
RUN_TS = datetime(2001, 8, 1)


class Warehouse:
    """The warehouse tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        use_utc(spark)
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def _shaped(self, df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in table_schema(name)])

    def _people(self) -> DataFrame:
        nation = self.base("nation").select("n_nationkey", F.col("n_name").alias("country"))
        return (
            self.base("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey AS k",
                "c_name",
                "country",
                "CAST(c_custkey AS STRING) AS customer_id",
                "CAST(date_sub(DATE '2001-08-01', CAST(c_custkey % 1500 AS INT)) AS TIMESTAMP) AS registration_date",
                "TIMESTAMP '2001-01-01 00:00:00' AS created_at",
            )
        )

    def raw_customer(self) -> DataFrame:
        df = self._people().selectExpr(
            "customer_id",
            "IF(k % 97 = 0, concat(c_name, ' TEST'), c_name) AS customer_name",
            "concat(IF(k % 89 = 0, 'test@', 'c'), customer_id, IF(k % 89 = 0, '.', '@'), 'example.com') AS email",
            "concat('010-', lpad(CAST(k % 10000 AS STRING), 4, '0')) AS phone",
            "registration_date",
            "country",
            "created_at",
        )
        return self._shaped(df, "raw_customer")

    def raw_address(self) -> DataFrame:
        # Every tenth customer has a surplus address, some of these without an id.
        places = F.expr("IF(k % 10 = 0, array(0, 1, 2, 3), array(0, 1, 2))")
        df = self._people().withColumn("n", F.explode(places)).selectExpr(
            "IF(n = 3 AND k % 70 = 0, NULL, concat(customer_id, '-', CAST(n AS STRING))) AS address_id",
            "customer_id",
            "concat('street ', CAST(k % 50 AS STRING)) AS street_address",
            "concat('city ', CAST(k % 20 AS STRING)) AS city",
            "concat('state ', CAST(k % 5 AS STRING)) AS state",
            "lpad(CAST(k % 100000 AS STRING), 5, '0') AS postal_code",
            "country",
            "n = 0 OR n = k % 3 AS is_primary",
            "IF(n = 2, 'SHIP', 'HOME') AS address_type",
            "created_at",
        )
        return self._shaped(df, "raw_address")

    def raw_order(self) -> DataFrame:
        df = self.base("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id",
            """CASE WHEN o_orderkey % 211 = 0 THEN NULL
                    WHEN o_orderkey % 199 = 0 THEN concat('X', CAST(o_custkey AS STRING))
                    ELSE CAST(o_custkey AS STRING) END AS customer_id""",
            "IF(o_orderkey % 223 = 0, NULL, CAST(o_orderdate AS TIMESTAMP)) AS order_date",
            """CASE o_orderkey % 10 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'SHIPPED'
                    ELSE CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'
                                            ELSE 'PROCESSING' END END AS order_status""",
            "IF(o_orderkey % 227 = 0, -o_totalprice, o_totalprice) AS total_amount",
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'BANK'
                    WHEN '3-MEDIUM' THEN 'CASH' WHEN '5-LOW' THEN 'POINT' END AS payment_method""",
            "TIMESTAMP '2001-01-01 00:00:00' AS created_at",
        )
        return self._shaped(df, "raw_order")

    def raw_order_item(self) -> DataFrame:
        df = self.base("lineitem").selectExpr(
            "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS order_item_id",
            "concat(IF(l_orderkey % 307 = 0, 'X', ''), CAST(l_orderkey AS STRING)) AS order_id",
            "CAST(l_partkey AS STRING) AS product_id",
            """CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN 0
                    ELSE CAST(l_quantity AS INT) END AS quantity""",
            "IF(l_partkey % 107 = 0, -l_extendedprice, l_extendedprice) AS unit_price",
            "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT) AS item_total",
            "TIMESTAMP '2001-01-01 00:00:00' AS created_at",
        )
        return self._shaped(df, "raw_order_item")

    def customer_master(self) -> DataFrame:
        people = self._people()
        known = people.selectExpr(
            "k", "customer_id", "c_name AS customer_name", "concat('c', customer_id, '@example.com') AS email",
            "'010' AS phone", "registration_date", "country", "created_at",
        )
        # Prospects have no order, so the empty side of left joins is exercised.
        prospects = people.filter("k % 50 = 0").selectExpr(
            "k + 10000000 AS k", "CAST(k + 10000000 AS STRING) AS customer_id",
            "concat('Prospect ', c_name) AS customer_name", "CAST(NULL AS STRING) AS email",
            "CAST(NULL AS STRING) AS phone", "registration_date", "country", "created_at",
        )
        totals = (
            self.base("orders")
            .groupBy(F.col("o_custkey").cast("string").alias("customer_id"))
            .agg(
                F.max(F.col("o_orderdate").cast("timestamp")).alias("last_order_date"),
                F.count(F.lit(1)).alias("total_orders"),
                F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_amount"),
            )
        )
        df = known.unionByName(prospects).join(totals, "customer_id", "left")
        df = df.withColumn(
            "updated_at", F.expr("IF(k % 13 = 0, TIMESTAMP '2001-08-01 00:00:00', TIMESTAMP '2001-01-01 00:00:00')")
        ).withColumn("is_deleted", F.expr("k % 61 = 0"))
        return self._shaped(df, "customer_master")

    def customer_master_dup(self) -> DataFrame:
        master = self.customer_master()
        second = (
            master.filter("CAST(customer_id AS BIGINT) % 41 = 0")
            .withColumn("customer_name", F.expr("concat(customer_name, ' v2')"))
            .withColumn("updated_at", F.expr("TIMESTAMP '2001-08-02 00:00:00'"))
        )
        return master.unionByName(second)

    def customer_staging(self) -> DataFrame:
        people = self._people().drop("created_at").withColumn("created_at", F.expr("TIMESTAMP '2001-07-01 00:00:00'"))
        changed = people.filter("k % 5 = 0").selectExpr(
            "customer_id", "concat(c_name, ' upd') AS customer_name",
            "concat('n', customer_id, '@example.com') AS email", "'011' AS phone", "registration_date", "country",
            "k % 35 = 0 AS is_deleted", "created_at",
        )
        fresh = people.filter("k % 100 = 0").selectExpr(
            "CAST(k + 20000000 AS STRING) AS customer_id", "concat('New ', c_name) AS customer_name",
            "CAST(NULL AS STRING) AS email", "'012' AS phone",
            "TIMESTAMP '2001-08-01 00:00:00' AS registration_date", "country", "k % 200 = 0 AS is_deleted", "created_at",
        )
        return self._shaped(changed.unionByName(fresh), "customer_staging")

    def order_staging(self) -> DataFrame:
        orders = self.raw_order().withColumn("k", F.col("order_id").cast("bigint"))
        changed = orders.filter("k % 7 = 0").selectExpr(
            "order_id", "customer_id", "order_date", "'SHIPPED' AS order_status", "total_amount + 1 AS total_amount",
            "'CARD' AS payment_method", "k % 21 = 0 AS is_deleted",
        )
        fresh = orders.filter("k % 11 = 0").selectExpr(
            "concat('N', order_id) AS order_id", "customer_id", "order_date", "'PENDING' AS order_status",
            "CAST(total_amount AS DECIMAL(19,2)) AS total_amount", "payment_method", "k % 22 = 0 AS is_deleted",
        )
        return self._shaped(changed.unionByName(fresh), "order_staging")

    def data_quality_log(self) -> DataFrame:
        df = self.base("events").selectExpr(
            "CAST(event_id AS STRING) AS log_id",
            """CASE event_type WHEN 'view' THEN 'customer_master' WHEN 'click' THEN 'raw_order'
                    WHEN 'purchase' THEN 'raw_order_item' WHEN 'signup' THEN 'raw_customer'
                    ELSE 'raw_address' END AS table_name""",
            "concat('C', CAST(user_id % 4 AS STRING)) AS check_type",
            "concat('check ', CAST(user_id % 4 AS STRING)) AS check_description",
            """element_at(array('PENDING', 'FAILED', 'SKIPPED', 'DEPRECATED', 'PASSED', 'UPDATED'),
                          CAST(event_id % 6 AS INT) + 1) AS result""",
            "event_id % 64 AS record_count",
            "IF(event_id % 64 > 8, event_id % 8, 0) AS error_count",
            "CAST(ts AS TIMESTAMP) AS checked_at",
        )
        return self._shaped(df, "data_quality_log")

    def documents(self) -> DataFrame:
        return self.base("documents").select("doc_id", "text")

    def benchmark(self) -> DataFrame:
        return self.base("benchmark").select("item_id", "text")

    def scripts(self) -> DataFrame:
        """One script per document: its text as a comment block, then a templated body."""
        body = F.expr(SCRIPT_BODY)
        comment = F.array_join(F.transform(F.split("text", "\n"), lambda line: F.concat(F.lit("-- "), line)), "\n")
        ending = F.expr(
            "IF(doc_id % 24 = 11, 'txt', element_at(array('sql', 'hql', 'SQL', 'uld', 'ld', 'sh'), "
            "CAST(doc_id % 6 AS INT) + 1))"
        )
        return (
            self.documents()
            .withColumn("a", F.expr("CAST(doc_id % 17 AS STRING)"))
            .withColumn("b", F.expr("CAST(doc_id % 23 AS STRING)"))
            .select(
                F.concat(
                    F.lit("/corpus/d"), F.expr("CAST(doc_id % 10 AS STRING)"), F.lit("/f"),
                    F.col("doc_id").cast("string"), F.lit("."), ending,
                ).alias("dir_file"),
                F.concat(comment, F.lit("\n"), body, F.lit("\n")).alias("content"),
            )
        )


# The name variables of the corpus.
SCRIPT_VARIABLES = {"DW": "dwh", "TMP": "tmp_zone"}

# The script templates; the template number is doc_id % 12, but some of number 1 are 12 and 13.
SCRIPT_BODY = r"""
CASE CAST(IF(doc_id % 12 = 1 AND doc_id % 5 IN (1, 2), 11 + doc_id % 5, doc_id % 12) AS INT)
WHEN 0 THEN concat('INSERT INTO $', '{DW}.t', a, ' SELECT x.c FROM ods.s', b, ' x JOIN ods.d', a, ' y ON x.k = y.k;')
WHEN 1 THEN concat('INSERT OVERWRITE TABLE m.t', a, ' WITH c1 AS (SELECT * FROM ods.s', b,
                   '), c2 AS (SELECT * FROM c1) SELECT * FROM c2;')
WHEN 12 THEN concat('INSERT OVERWRITE TABLE m.t', a, ' WITH c1 AS (SELECT * FROM c2), c2 AS (SELECT * FROM ods.s', b,
                   ') SELECT * FROM c1;')
WHEN 13 THEN concat('INSERT OVERWRITE TABLE m.t', a, ' WITH c1 AS (SELECT * FROM ods.s', b,
                   ' x JOIN c1 r ON r.k = x.k) SELECT * FROM c1;')
WHEN 2 THEN concat('MERGE INTO m.t', a, ' t USING stg.s', b, ' s ON t.k = s.k WHEN MATCHED THEN UPDATE SET t.c = s.c ',
                   'WHEN NOT MATCHED THEN INSERT (k) VALUES (s.k);')
WHEN 3 THEN concat('UPDATE m.t', a, ' SET c = (SELECT max(x) FROM ods.s', b,
                   ' q WHERE q.k = 1) WHERE k IN (SELECT k FROM ods.u', a, ');')
WHEN 4 THEN concat('DELETE FROM m.t', a, ' WHERE k IN (SELECT k FROM ods.s', b, ');')
WHEN 5 THEN concat('CREATE TEMPORARY VIEW tv', a, ' AS SELECT * FROM ods.s', b, ', ods.d', a, ';\n',
                   'INSERT INTO m.t', a, ' SELECT * FROM tv', a, ';')
WHEN 6 THEN concat('TRUNCATE TABLE m.t', a, ';\nDROP TABLE IF EXISTS m.o', b, ';')
WHEN 7 THEN concat('SELECT count(*) FROM (SELECT * FROM ods.s', b, ' WHERE n = ''FROM fake; x'') q LEFT JOIN ods.d', a,
                   ' z ON q.k = z.k;')
WHEN 8 THEN concat('EXECUTE IMMEDIATE ''INSERT INTO m.t', a, ' SELECT * FROM ods.s', b, ''';')
WHEN 9 THEN concat('#!/bin/sh\n# INSERT INTO no.no SELECT * FROM no.no;\nhive -e "INSERT INTO m.t', a,
                   ' SELECT * FROM ods.s', b, ';"')
WHEN 10 THEN 'SELECT 1 FROM DUAL;\n/* DELETE FROM no.no; */\nmerge this file later'
ELSE concat('EMRPUT job', a, '\n  EMRPUTF job', b, '  \ncol DEFAULT 0\n-- KEY_MST note\nemrput lower')
END
"""
