"""UPDATE, DELETE, MERGE: NULL rules, clause order, hot keys, empty input."""

import pytest
from pyspark.sql import functions as F

from rowloom.operators.joins import drop_members, left_join_many, not_in
from rowloom.operators.rowchange import (
    Delete,
    Insert,
    Update,
    apply_delete,
    apply_merge,
    apply_update,
    drop_duplicate_keys,
)
from rowloom.plans import deletes, updates

T = "k string, v int"


def test_update_leaves_unknown_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 5)], T)
    out = apply_update(df, F.col("v") > 2, {"v": F.col("v") + 1})
    assert rows(out) == [("a", 1), ("b", None), ("c", 6)]
    assert out.schema == df.schema


def test_update_right_sides_see_the_old_row(spark, rows):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(apply_update(df, F.lit(True), {"a": F.col("b"), "b": F.col("a")})) == [(2, 1)]


def test_delete_keeps_unknown_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", 5)], T)
    assert rows(apply_delete(df, F.col("v") > 2)) == [("a", 1), ("b", None)]


@pytest.mark.parametrize(
    "members, expected",
    [
        (["a"], [("a", False), ("b", True), (None, None)]),
        (["a", None], [("a", False), ("b", None), (None, None)]),
        ([], [("a", True), ("b", True), (None, True)]),
        ([None], [("a", None), ("b", None), (None, None)]),
    ],
)
def test_not_in(spark, rows, members, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([(m,) for m in members], "m string")
    assert rows(not_in(df, "k", known, "x")) == sorted(expected, key=repr)


def test_drop_members_keeps_null_keys_and_unknown_conditions(spark, rows):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", None), (None, True)], "k string, f boolean")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    assert rows(drop_members(df, "k", known, when=F.col("f"))) == sorted(
        [("a", False), ("a", None), (None, True)], key=repr
    )


def test_left_join_many_equals_left_join(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12), (None, 13)], "k string, y int")
    assert rows(left_join_many(left, right, ["k"])) == rows(left.join(right, "k", "left"))


def merge(spark, target, source, **clauses):
    t = spark.createDataFrame(target, T)
    s = spark.createDataFrame(source, "k string, v int, gone boolean")
    return apply_merge(t, s, "k", **clauses)


def test_merge_all_clauses(spark, rows):
    out = merge(
        spark,
        [("a", 1), ("b", 2), ("c", 3), (None, 4)],
        [("a", 10, False), ("b", 20, True), ("d", 30, False), ("e", 40, True), (None, 50, False), ("c", 60, None)],
        matched=[Update({"v": F.col("s.v")}, F.col("s.gone") == F.lit(False)), Delete(F.col("s.gone"))],
        not_matched=[Insert({"k": F.col("s.k"), "v": F.col("s.v")}, F.col("s.gone") == F.lit(False))],
    )
    assert rows(out) == sorted([("a", 10), ("c", 3), (None, 4), ("d", 30), (None, 50)], key=repr)


def test_merge_first_clause_wins(spark, rows):
    out = merge(
        spark, [("a", 1)], [("a", 10, False)],
        matched=[Update({"v": F.col("t.v") + F.col("s.v")}, F.col("t.v") == 1), Delete()],
    )
    assert rows(out) == [("a", 11)]


def test_merge_several_targets_for_one_source(spark, rows):
    out = merge(spark, [("a", 1), ("a", 2)], [("a", 9, False)], matched=[Update({"v": F.col("s.v")})])
    assert rows(out) == [("a", 9), ("a", 9)]


def test_merge_refuses_two_sources_for_one_target(spark):
    out = merge(spark, [("a", 1)], [("a", 1, False), ("a", 2, False)], matched=[Update({"v": F.col("s.v")})])
    with pytest.raises(Exception, match="several source rows"):
        out.collect()


def test_merge_allows_equal_unmatched_sources(spark, rows):
    out = merge(
        spark, [("a", 1)], [("z", 1, False), ("z", 2, False)],
        matched=[Update({"v": F.col("s.v")})], not_matched=[Insert({"k": F.col("s.k"), "v": F.col("s.v")})],
    )
    assert rows(out) == [("a", 1), ("z", 1), ("z", 2)]


def test_merge_into_empty_and_from_empty(spark, rows):
    clauses = {
        "matched": [Update({"v": F.col("s.v")})],
        "not_matched": [Insert({"k": F.col("s.k"), "v": F.col("s.v")})],
    }
    assert rows(merge(spark, [], [("a", 1, False)], **clauses)) == [("a", 1)]
    assert rows(merge(spark, [("a", 1)], [], **clauses)) == [("a", 1)]


def test_merge_insert_leaves_other_columns_null(spark, rows):
    out = merge(spark, [], [("a", 1, False)], not_matched=[Insert({"k": F.col("s.k")})])
    assert rows(out) == [("a", None)]


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "q"), (None, 1, "n"), (None, 1, "n")],
        "k string, at int, name string",
    )
    assert rows(drop_duplicate_keys(df, "k", "at", "none")) == sorted(
        [("b", None, "q"), (None, 1, "n"), (None, 1, "n")], key=repr
    )
    assert rows(drop_duplicate_keys(df, "k", "at", "latest")) == sorted(
        [("a", 3, "y"), ("b", None, "q"), (None, 1, "n"), (None, 1, "n")], key=repr
    )
    with pytest.raises(ValueError):
        drop_duplicate_keys(df, "k", "at", "all")


def test_duplicate_addresses_go(spark, rows):
    schema = "address_id string, customer_id string, address_type string, is_primary boolean"
    df = spark.createDataFrame(
        [
            ("1", "a", "HOME", False),
            ("2", "a", "HOME", True),
            ("3", "a", "HOME", False),
            ("4", "a", "SHIP", False),
            ("0", "a", "SHIP", None),
        ],
        schema,
    )
    assert [r[0] for r in rows(deletes.duplicate_addresses(df))] == ["0", "2", "3", "4"]
    # An address without an id makes every NOT IN unknown when it is the largest of its group.
    lone = spark.createDataFrame([(None, "b", "HOME", False)], schema)
    assert deletes.duplicate_addresses(df.union(lone)).count() == 6


def test_one_primary_address(spark, rows):
    df = spark.createDataFrame(
        [("1", "a", True), ("2", "a", True), ("3", "a", False), ("4", "b", True), (None, "a", True)],
        "address_id string, customer_id string, is_primary boolean",
    )
    assert rows(updates.one_primary(df)) == sorted(
        [("1", "a", True), ("2", "a", False), ("3", "a", False), ("4", "b", True), (None, "a", True)], key=repr
    )
