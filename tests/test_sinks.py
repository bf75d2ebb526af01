"""Tables, CSV and the whole job: write, read back, compare."""

import csv
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, RUN_TS, SCRIPT_VARIABLES, Warehouse
from rowloom.plans import deletes, updates
from rowloom.plans.job import run_lineage
from rowloom.sources import sinks, tables
from tests.conftest import SMALL


def csv_rows(folder):
    """Header and data rows of all parts, read by a plain CSV reader."""
    header, data = None, []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            lines = list(csv.reader(f))
        header, data = lines[0], data + lines[1:]
    return header, data


def test_table_round_trip_keeps_rows_types_and_layout(spark, tmp_path, rows):
    w = Warehouse(spark, SMALL)
    for name in tables.SCHEMAS:
        df = getattr(w, name)()
        tables.write_table(df, str(tmp_path), name)
        back = tables.read_table(spark, str(tmp_path), name).select(*df.columns)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert rows(back) == rows(df)
    assert (tmp_path / "customer_master" / "country=NATION_3").is_dir()
    assert (tmp_path / "raw_order" / "order_day=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert len(list((tmp_path / "customer_master" / "country=NATION_3").glob("*.parquet"))) == 1


def test_partition_filter_prunes(spark, tmp_path):
    w = Warehouse(spark, SMALL)
    tables.write_table(w.raw_order(), str(tmp_path), "raw_order")
    stored = tables.read_table(spark, str(tmp_path), "raw_order")
    kept = tables.drop_partitions_before(stored, date(2000, 1, 1))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((order_day" in plan
    expected = w.raw_order().filter("order_date >= '2000-01-01' OR order_date IS NULL").count()
    assert kept.count() == expected


def test_defaults(spark):
    df = spark.createDataFrame([("1",)], "customer_id string")
    now = datetime(2001, 8, 1)
    row = tables.fill_defaults(df, "customer_staging", F.lit(now)).first()
    assert (row["created_at"], row["is_deleted"], row["email"]) == (now, False, None)
    assert tables.fill_defaults(df, "raw_customer").first()["created_at"] is not None


def test_overwrite_reading_itself(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    old = spark.read.parquet(path)
    # Columns in another order: written by name.
    new = old.filter("id <> 3").select("p", (F.col("id") * 10).alias("id"))
    tables.overwrite(new, path, ["p"])
    assert rows(spark.read.parquet(path).select("id", "p")) == sorted(
        [(i * 10, i % 2) for i in range(10) if i != 3], key=repr
    )


def test_overwrite_some_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    tables.overwrite_partitions(spark.createDataFrame([(100, 1)], "id bigint, p bigint"), path, ["p"])
    back = {(r["id"], r["p"]) for r in spark.read.parquet(path).collect()}
    assert back == {(0, 0), (2, 0), (4, 0), (6, 0), (8, 0), (100, 1)}


def test_truncate(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    df = spark.read.parquet(path)
    tables.truncate(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.schema == df.schema


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    bad = spark.read.parquet(path).withColumn("id", F.raise_error("no").cast("long"))
    with pytest.raises(Exception, match="no"):
        tables.overwrite(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_change_of_some_partitions(spark, tmp_path):
    w = Warehouse(spark, SMALL)
    folder = str(tmp_path)
    # One day of each month and the last ones, so that there are not too many directories.
    some = w.raw_order().filter("order_date IS NULL OR dayofmonth(order_date) = 15 OR order_date >= '2001-07-01'")
    tables.write_table(some, folder, "raw_order")
    path = f"{folder}/raw_order"

    def files():
        return {p for p in (tmp_path / "raw_order").rglob("*.parquet")}

    def stored():
        return tables.read_table(spark, folder, "raw_order")

    for touched, change in (
        (updates.expired_days(AS_OF), lambda t: updates.expire_orders(t, AS_OF, RUN_TS)),
        (deletes.failed_days(AS_OF), lambda t: deletes.old_failed(t, AS_OF)),
    ):
        before, want = files(), change(stored())
        want = want.exceptAll(spark.createDataFrame([], want.schema)).toPandas()
        done = tables.change_partitions(stored(), path, ["order_day"], touched, change)
        gone = before - files()
        assert gone and {str(p.parent.relative_to(path)) for p in gone} <= set(done)
        assert before & files() and all(str(p.parent.relative_to(path)) not in done for p in before & files())
        got = stored().toPandas()
        key = ["order_id", "order_status"]
        assert want.sort_values(key)[key].values.tolist() == got.sort_values(key)[key].values.tolist()
    assert [p.name for p in tmp_path.iterdir()] == ["raw_order"]


def test_change_may_empty_a_partition_but_not_leave_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("p", F.concat(F.lit("a b="), F.col("id") % 2)).write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    with pytest.raises(ValueError, match="has not read"):
        tables.change_partitions(table, path, ["p"], F.col("p") == "a b=1", lambda t: t.withColumn("p", F.lit("a b=0")))
    assert spark.read.parquet(path).count() == 10
    tables.change_partitions(table, path, ["p"], F.col("p") == "a b=1", lambda t: t.filter("id < 0"))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 1


def test_declared_buckets(spark, tmp_path):
    tables.write_table(Warehouse(spark, SMALL).raw_customer(), str(tmp_path), "raw_customer", catalog="kept_customer")
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED kept_customer").collect()}
    assert described["Num Buckets"] == "10" and "customer_id" in described["Bucket Columns"]
    spark.sql("DROP TABLE kept_customer")


def test_bucketed_join_needs_no_exchange(spark):
    count, key = tables.CUSTOMER_BUCKETS
    w = Warehouse(spark, SMALL)
    customers, orders = w.raw_customer(), w.raw_order()
    tables.write_bucketed(customers, "bucketed_customer", count, key)
    tables.write_bucketed(orders, "bucketed_order", count, key)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_customer").join(spark.table("bucketed_order"), key)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == customers.join(orders, key).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_customer")
        spark.sql("DROP TABLE bucketed_order")


def test_buckets_below_partitions(spark):
    customers = Warehouse(spark, SMALL).raw_customer()
    tables.write_bucketed(customers, "laid_out_customer", *tables.CUSTOMER_BUCKETS, partition_by=["country"])
    try:
        stored = spark.table("laid_out_customer")
        assert stored.count() == customers.count()
        pruned = stored.filter("country = 'NATION_1'")
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(country" in plan
        assert pruned.count() == customers.filter("country = 'NATION_1'").count()
    finally:
        spark.sql("DROP TABLE laid_out_customer")


def test_catalog_partitions_are_dropped_by_day(spark):
    orders = tables.with_order_day(Warehouse(spark, SMALL).raw_order()).filter(
        "order_day > '1999-12-20' AND order_day < '2000-01-10'"
    )
    orders.write.mode("overwrite").partitionBy("order_day").saveAsTable("stored_order")
    try:
        dropped = tables.drop_catalog_partitions_before(spark, "stored_order", date(2000, 1, 1))
        assert dropped and max(dropped) < "2000-01-01"
        left = spark.table("stored_order")
        assert left.count() == orders.filter("order_day >= '2000-01-01'").count() > 0
    finally:
        spark.sql("DROP TABLE stored_order")


def test_unload(spark, tmp_path):
    sql = """SELECT * FROM VALUES (1, 'a "q", b', ''), (2, ' x\ny ', NULL) AS t(n, `text`, e);"""
    assert sinks.unload(spark, sql, str(tmp_path / "out")) == 2
    header, data = csv_rows(tmp_path / "out")
    assert header == ["n", "text", "e"]
    assert sorted(data) == [["1", 'a "q", b', ""], ["2", " x\ny ", ""]]
    with pytest.raises(ValueError):
        sinks.unload(spark, "  ", str(tmp_path / "none"))


def test_unload_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT id FROM range(5)")
    path, count = sinks.unload_file(spark, str(tmp_path / "q"), str(tmp_path / "out"), "20240101_000000")
    assert count == 5 and path.endswith("/out/q_unload_20240101_000000")
    assert len(csv_rows(path)[1]) == 5


def test_names():
    assert sinks.table_name("prog", "/a/My_Dir/", "DETAIL") == "prog_My_Dir_detail"
    assert sinks.csv_name("prog", "/a/b", "emrput", "2024-01-02 03:04:05") == "prog_b_emrput_20240102_030405"


def test_database_options():
    """No database may be started here, so only the options are checked."""
    assert sinks.database_options("jdbc:x", "SELECT 1", fetch=5) == {
        "url": "jdbc:x", "fetchsize": "5", "query": "SELECT 1",
    }
    split = sinks.database_options("jdbc:x", "SELECT 1", ("id", 0, 9, 3))
    assert split["dbtable"] == "(SELECT 1) q" and split["numPartitions"] == "3" and "query" not in split


def test_texts_must_fit_their_columns(spark):
    df = spark.createDataFrame([("x" * 31, "ok"), (None, "y" * 10)], "run_id string, target_type string")
    with pytest.raises(ValueError, match=r"'run_id': 31"):
        sinks.check_widths(df, sinks.LINEAGE_TYPES)
    sinks.check_widths(df.filter("run_id IS NULL"), sinks.LINEAGE_TYPES)


def test_whole_run(spark, tmp_path):
    w = Warehouse(spark, SMALL)
    source = tmp_path / "corpus"
    for row in w.scripts().limit(60).collect():
        path = source / row["dir_file"].removeprefix("/corpus/")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(row["content"], encoding="utf-8")
    env = tmp_path / "names.env"
    env.write_text("\n".join(f"{k}={v}" for k, v in SCRIPT_VARIABLES.items()))
    out = run_lineage(spark, str(source), str(tmp_path / "out"), "2024-01-31 00:00:00", "DETAIL", str(env))
    header, data = csv_rows(out.folders["detail"])
    assert header[:4] == ["base_directory", "file_name", "dir_file", "crud_type"] and header[-1] == "op_dtm"
    assert len(data) == out.rows["detail"] > 60
    assert {r[header.index("tgt_schema")] for r in data} >= {"dwh", "m"}
    header, data = csv_rows(out.folders["query_text"])
    assert len(data) == out.rows["query_text"] > 30
    assert sorted(int(r[header.index("id")]) for r in data) == list(range(1, len(data) + 1))
    assert all(r[header.index("query_text")] for r in data)
    assert csv_rows(out.folders["emrput"])[0] == ["base_directory", "file_name", "dir_file", "emrput_type", "emrput_line"]
    assert out.rows["default"] == out.rows["key_mst"] == out.rows["emrput"] // 2 > 0


def test_updated_table_can_be_put_in_place(spark, tmp_path, rows):
    w = Warehouse(spark, SMALL)
    folder = str(tmp_path)
    tables.write_table(w.customer_master(), folder, "customer_master")
    stored = tables.read_table(spark, folder, "customer_master")
    new = updates.update_by_key(stored, "7", {"customer_name": "N"}, datetime(2001, 8, 1))
    expected = rows(new)
    tables.overwrite(new, f"{folder}/customer_master", ["country"])
    back = tables.read_table(spark, folder, "customer_master")
    assert rows(back) == expected
    assert back.filter("customer_name = 'N'").count() == 1
