"""Changes of some files and partitions: which files go, and that all of a change happens or none."""

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, RUN_TS, Warehouse
from rowloom.plans import deletes, filechange, updates
from rowloom.sources import commits, rewrite, tables
from tests.conftest import SMALL

CONTACT = {"customer_name": "Updated Name", "email": "newemail@example.com", "phone": "010-1234-5678"}


def files(path):
    """Data files with their times."""
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet") if not p.name.startswith(".")}


def hidden(path):
    return [p.name for p in path.iterdir() if p.name.startswith("_") and p.name != "_SUCCESS"]


def many_files(spark, df, path, key, n):
    """``df`` in ``n`` files by ranges of its key."""
    df.repartitionByRange(n, F.col(key).cast("long")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_one_key_replaces_one_file_of_200(spark, tmp_path, rows):
    path = tmp_path / "customer_master"
    master = spark.range(1, 4001).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("n").alias("customer_name"), F.lit("e").alias("email"),
        F.lit("p").alias("phone"), F.lit(datetime(2001, 1, 1)).alias("updated_at"),
    )
    table = many_files(spark, master, str(path), "customer_id", 200)
    before = files(path)
    assert len(before) == 200
    want = rows(updates.update_by_key(table, "77", CONTACT, RUN_TS))
    done = rewrite.change_files(
        table, str(path), F.col("customer_id") == "77", lambda part: updates.update_by_key(part, "77", CONTACT, RUN_TS)
    )
    after = files(path)
    assert len(done.removed) == 1 and len(set(before) - set(after)) == 1 and sorted(set(after) - set(before)) == done.added
    assert all(after[n] == before[n] for n in set(before) & set(after)) and len(set(before) & set(after)) == 199
    assert rows(spark.read.schema(master.schema).parquet(str(path))) == want and not hidden(path)
    # Deletes drop the file if nothing of it is left.
    gone = rewrite.change_files(
        spark.read.schema(master.schema).parquet(str(path)), str(path), F.col("customer_id").cast("long") <= 20,
        lambda part: part.filter(F.col("customer_id").cast("long") > 20),
    )
    assert len(gone.removed) == 1 and gone.added == [] and spark.read.parquet(str(path)).count() == 3980


def test_merge_adds_files_for_new_rows(spark, tmp_path):
    path = tmp_path / "raw_order"
    w = Warehouse(spark, SMALL)
    orders = many_files(spark, w.raw_order(), str(path), "order_id", 40)
    staging = w.order_staging()
    before = files(path)
    fresh = staging.withColumn("order_id", F.concat(F.lit("new-"), "order_id"))
    # Only new keys: nothing is replaced.
    done = filechange.merge_orders(orders, str(path), fresh, RUN_TS)
    after = files(path)
    assert done.removed == [] and done.added and set(before) < set(after)
    assert all(after[n] == before[n] for n in before)
    live = fresh.filter(~F.col("is_deleted")).count()
    assert spark.read.parquet(str(path)).count() == w.raw_order().count() + live


def test_every_change_by_key_equals_the_whole_table(spark, tmp_path, rows):
    """The eight statements, on tables with partitions and without, against the whole-table form."""
    w = Warehouse(spark, SMALL)
    master, orders, items = w.customer_master(), w.raw_order(), w.raw_order_item()
    cases = {
        "u01": (master, ["country"], lambda t: updates.update_by_key(t, "77", CONTACT, RUN_TS),
                lambda t, p: filechange.update_by_key(t, p, "77", CONTACT, RUN_TS, ["country"])),
        "u03": (master, ["country"], lambda t: updates.merge_customers(t, w.customer_staging(), RUN_TS),
                lambda t, p: filechange.merge_customers(t, p, w.customer_staging(), RUN_TS, ["country"])),
        "u04": (orders, [], lambda t: updates.merge_orders(t, w.order_staging(), RUN_TS),
                lambda t, p: filechange.merge_orders(t, p, w.order_staging(), RUN_TS)),
        "u11": (master, [], lambda t: updates.merge_aggregated(t, w.customer_staging(), orders, RUN_TS),
                lambda t, p: filechange.merge_aggregated(t, p, w.customer_staging(), orders, RUN_TS)),
        "d01": (master, [], lambda t: deletes.by_key(t, "77"), lambda t, p: filechange.by_key(t, p, "77")),
        "d03": (orders, [], lambda t: deletes.orphan_orders(t, master), lambda t, p: filechange.orphan_orders(t, p, master)),
        "d07": (items, [], lambda t: deletes.cancelled_items(t, orders, AS_OF),
                lambda t, p: filechange.cancelled_items(t, p, orders, AS_OF)),
        "d20": (master, ["country"], lambda t: deletes.mask_deleted(t, w.customer_staging(), RUN_TS),
                lambda t, p: filechange.mask_deleted(t, p, w.customer_staging(), RUN_TS, ["country"])),
    }
    for name, (given, by, whole, step) in cases.items():
        path = tmp_path / name
        if by:
            tables.write_partitioned(given, str(path), by)
        else:
            given.repartition(20).write.parquet(str(path))
        table = spark.read.schema(given.schema).parquet(str(path))
        want, before = rows(whole(table).select(*sorted(given.columns))), files(path)
        done = step(table, str(path))
        got = spark.read.schema(given.schema).parquet(str(path))
        assert rows(got.select(*sorted(given.columns))) == want, name
        after = files(path)
        assert set(before) - set(after) == set(done.removed) and set(after) - set(before) == set(done.added), name
        assert all(after[n] == before[n] for n in set(before) & set(after)), name
        assert not hidden(path), name


def test_not_in_an_empty_table_deletes_all(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "a"), ("2", None)], "order_id string, customer_id string").write.parquet(path)
    none = spark.createDataFrame([], "customer_id string")
    filechange.orphan_orders(spark.read.parquet(path), path, none)
    left = spark.read.parquet(path)
    assert left.count() == 0 and left.columns == ["order_id", "customer_id"]


def test_a_table_without_rows_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).repartition(1).write.parquet(path)
    done = rewrite.change_files(spark.read.parquet(path), path, F.lit(True), lambda part: part.filter("id < 0"))
    assert len(done.removed) == len(done.added) == 1 and spark.read.parquet(path).columns == ["id"]


def test_touched_files_are_found_by_the_columns_of_the_condition(spark, tmp_path):
    path = str(tmp_path / "t")
    table = many_files(spark, spark.range(1000).withColumn("wide", F.repeat(F.lit("x"), 50)), path, "id", 10)
    marked = table.withColumn(rewrite.FILE, F.col("_metadata.file_path")).filter("id = 5").select(rewrite.FILE).distinct()
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "EqualTo(id,5)" in plan
    names = rewrite.files_of(table, F.col("id") == 5)
    part = table.filter(F.col("_metadata.file_path").isin(names))
    part.count()
    scan = part._jdf.queryExecution().executedPlan()
    part.collect()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_the_search_for_files_joins_numbers_not_names(spark, tmp_path):
    """Sorted for a join, names of a hundred letters took three quarters of a task's memory."""
    table = many_files(spark, spark.range(1000), str(tmp_path / "a b=%1"), "id", 10)
    keys = spark.createDataFrame([(5,), (6,), (500,), (None,), (5000,)], "id long")
    types = []

    def touched(rows):
        found = rewrite.rows_with(keys)(rows)
        types.append(found.schema[rewrite.FILE].dataType.simpleString())
        return found

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = rewrite.files_of(table, touched)
        none = rewrite.files_of(table, lambda rows: touched(rows).filter("id < 0"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert types == ["bigint", "bigint"] and none == []
    assert names == rewrite.files_of(table, F.col("id").isin(5, 6, 500)) and len(names) == 2


class Lost(BaseException):
    """The driver is gone: nothing after this runs."""


def partitioned(spark, path):
    spark.range(40).select("id", (F.col("id") % 5).alias("p")).repartition(2).write.partitionBy("p").parquet(path)
    return spark.read.parquet(path)


def change(spark, path):
    return tables.change_partitions(
        spark.read.parquet(path), path, ["p"], F.col("p") < 4, lambda t: t.withColumn("id", F.col("id") + 1000).filter("p > 0")
    )


OLD = {(i, i % 5) for i in range(40)}
NEW = {(i + 1000 if i % 5 < 4 else i, i % 5) for i in range(40) if i % 5}


def stored(spark, path):
    return {(r.id, r.p) for r in spark.read.parquet(path).select("id", "p").collect()}


class Broken:
    """Renames that fail, or end the driver, from the n-th one on."""

    def __init__(self, monkeypatch, n, kind, until=None):
        self.calls, real = 0, commits.Files.rename

        def rename(files, source, target):
            self.calls += 1
            if self.calls >= n and (until is None or self.calls < until):
                if kind is Lost:
                    raise Lost
                return False
            return real(files, source, target)

        monkeypatch.setattr(commits.Files, "rename", rename)


def test_a_failing_rename_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    for n in itertools.count(1):
        path = str(tmp_path / f"t{n}")
        partitioned(spark, path)
        with monkeypatch.context() as patch:
            broken = Broken(patch, n, OSError, until=n + 1)
            try:
                change(spark, path)
                failed = False
            except OSError:
                failed = True
        if not failed:
            break
        assert stored(spark, path) == OLD and not hidden(tmp_path / f"t{n}")
    # The plan and each of the 16 old and 6 or more new files had its turn.
    assert broken.calls == n - 1 > 10 and stored(spark, path) == NEW


@pytest.mark.parametrize("step", range(1, 13))
def test_a_lost_driver_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    partitioned(spark, path)
    with monkeypatch.context() as patch:
        Broken(patch, step, Lost)
        with pytest.raises(Lost):
            change(spark, path)
    # The first rename is that of the plan: before it nothing has happened.
    assert commits.settle(spark, path) == (None if step == 1 else "finished")
    assert stored(spark, path) == (OLD if step == 1 else NEW)
    assert step == 1 or not hidden(tmp_path / "t")
    assert commits.settle(spark, path) is None


@pytest.mark.parametrize("step", [3, 8, 12])
def test_a_driver_lost_while_it_undoes(spark, tmp_path, monkeypatch, step):
    """A rename fails, and then every one: the plan stays as one to be undone, whoever comes next."""
    path = str(tmp_path / "t")
    partitioned(spark, path)
    with monkeypatch.context() as patch:
        # One refusal, then one success for the name of the plan, then the end.
        real, calls = commits.Files.rename, []

        def rename(files, source, target):
            calls.append(source)
            if len(calls) == step:
                return False
            if len(calls) > step + 1:
                raise Lost
            return real(files, source, target)

        patch.setattr(commits.Files, "rename", rename)
        with pytest.raises(Lost):
            change(spark, path)
    assert commits.settle(spark, path) == "undone"
    assert stored(spark, path) == OLD and not hidden(tmp_path / "t")


def test_readers_settle_first(spark, tmp_path, monkeypatch):
    """``read_table`` never shows a mix."""
    w = Warehouse(spark, SMALL)
    tables.write_table(w.data_quality_log(), str(tmp_path), "data_quality_log")
    path = str(tmp_path / "data_quality_log")
    whole = tables.read_table(spark, str(tmp_path), "data_quality_log")
    every = whole.count()
    with monkeypatch.context() as patch:
        Broken(patch, 3, Lost)
        with pytest.raises(Lost):
            tables.change_partitions(whole, path, ["table_name"], F.lit(True), lambda t: t.withColumn("result", F.lit("new")))
    after = tables.read_table(spark, str(tmp_path), "data_quality_log")
    assert after.count() == every == after.filter("result = 'new'").count()


def test_a_second_change_is_refused_while_one_is_under_way(spark, tmp_path):
    path = str(tmp_path / "t")
    partitioned(spark, path)
    step = commits.Change(spark, path)
    commits.Files(spark, path).write(commits.PLAN, '{"remove": [], "add": [], "new": "_new_x", "old": "_old_x"}')
    with pytest.raises(OSError, match="under way"):
        step.commit([], [])
    assert commits.settle(spark, path) == "finished" and stored(spark, path) == OLD


def test_a_failed_change_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    table = partitioned(spark, path)
    with pytest.raises(Exception, match="no"):
        rewrite.change_files(table, path, F.col("id") == 1, lambda t: t.withColumn("id", F.raise_error("no").cast("long")))
    assert stored(spark, path) == OLD and not hidden(tmp_path / "t")


def test_a_swap_cut_off_between_its_renames(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(3).write.parquet(str(path))
    spark.range(7).write.parquet(str(tmp_path / "t__new_1"))
    path.rename(tmp_path / "t__old_1")
    assert commits.settle(spark, str(path)) == "finished"
    assert spark.read.parquet(str(path)).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["t"]
    # Not complete: the old table comes back.
    path.rename(tmp_path / "t__old_2")
    spark.range(9).write.parquet(str(tmp_path / "t__new_2"))
    (tmp_path / "t__new_2" / "_SUCCESS").unlink()
    assert commits.settle(spark, str(path)) == "undone" and spark.read.parquet(str(path)).count() == 7
    assert commits.settle(spark, str(tmp_path / "nothing")) is None


def test_names_that_need_escapes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).withColumn("p", F.concat(F.lit("a b=%1[x]*"), F.col("id") % 2)).write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    done = rewrite.change_files(table, path, F.col("id") == 3, lambda t: t.filter("id <> 3"), ["p"])
    assert done.removed and sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 4, 5]
    assert len({n.rpartition("/")[0] for n in files(tmp_path / "t")}) == 2



