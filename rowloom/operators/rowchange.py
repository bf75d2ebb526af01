"""UPDATE, DELETE and MERGE as functions from old table to new table.

Plain Parquet tables cannot be changed row by row, so each operator returns the whole new
table, to be put in place with ``rowloom.sources.tables.overwrite``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import group_apart, keys_of


def apply_update(target: DataFrame, when: Column, sets: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``when`` is TRUE; FALSE and NULL leave the row alone.

    All right sides see the old row.  Types stay those of the table.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    changed = {
        name: F.when(when, value.cast(types[name])).otherwise(F.col(name)) for name, value in sets.items()
    }
    return target.withColumns(changed)


def apply_delete(target: DataFrame, when: Column) -> DataFrame:
    """Remove rows where ``when`` is TRUE; FALSE and NULL keep the row."""
    return target.filter(~F.coalesce(when, F.lit(False)))


@dataclass(frozen=True)
class Update:
    """WHEN MATCHED [AND when] THEN UPDATE SET ..."""

    sets: Mapping[str, Column]
    when: Column = field(default_factory=lambda: F.lit(True))


@dataclass(frozen=True)
class Delete:
    """WHEN MATCHED [AND when] THEN DELETE"""

    when: Column = field(default_factory=lambda: F.lit(True))


@dataclass(frozen=True)
class Insert:
    """WHEN NOT MATCHED [AND when] THEN INSERT; columns left out become NULL."""

    values: Mapping[str, Column]
    when: Column = field(default_factory=lambda: F.lit(True))


def apply_merge(
    target: DataFrame,
    source: DataFrame,
    on: str,
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
) -> DataFrame:
    """MERGE on equality of the column ``on``.

    Conditions and values name columns as ``t.x`` (target) and ``s.x`` (source).  The first
    clause that applies wins; a matched row without one stays, an unmatched source row
    without one is left out.  NULL keys never match.  Two source rows for one target row
    fail the job while the new table is computed, before it replaces the old one.

    The matched part is a left join of the target to one row per source key, the insert part
    an anti join of the source to the target's distinct keys: both can be cut at a hot
    key, which the single full outer join could not.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    partners = (
        group_apart(source.filter(F.col(on).isNotNull()), on)
        .agg(F.count(F.lit(1)).alias("__times"), F.first(F.struct(*source.columns)).alias("s"))
        .select(F.col(f"__key.{on}").alias("__key"), "__times", "s")
    )
    t = target.select(F.struct(*target.columns).alias("t"), F.col(on).alias("__on"))
    joined = t.join(partners, F.col("__on") == F.col("__key"), "left")
    hit = F.when(F.col("__times") > 1, F.raise_error(F.lit(f"MERGE: several source rows for one {on}"))).otherwise(
        F.col("__times") == 1
    )
    joined = joined.withColumn("__hit", F.coalesce(hit.cast("boolean"), F.lit(False)))

    clause = F.lit(-1)
    for number in reversed(range(len(matched))):
        clause = F.when(F.col("__hit") & F.coalesce(matched[number].when, F.lit(False)), F.lit(number)).otherwise(clause)
    joined = joined.withColumn("__clause", clause)
    deletes = [n for n, c in enumerate(matched) if isinstance(c, Delete)]
    joined = joined.filter(~F.col("__clause").isin(deletes)) if deletes else joined
    columns = []
    for name in target.columns:
        value = F.col(f"t.{name}")
        for number, action in enumerate(matched):
            if isinstance(action, Update) and name in action.sets:
                value = F.when(F.col("__clause") == number, action.sets[name].cast(types[name])).otherwise(value)
        columns.append(value.alias(name))
    kept = joined.select(*columns)
    if not not_matched:
        return kept

    known = keys_of(target, on).select(F.col(on).alias("__known"))
    fresh = source.join(known, F.col(on) == F.col("__known"), "left_anti").select(F.struct(*source.columns).alias("s"))
    clause = F.lit(-1)
    for number in reversed(range(len(not_matched))):
        clause = F.when(F.coalesce(not_matched[number].when, F.lit(False)), F.lit(number)).otherwise(clause)
    fresh = fresh.withColumn("__clause", clause).filter(F.col("__clause") >= 0)
    columns = []
    for name in target.columns:
        value = F.lit(None).cast(types[name])
        for number, action in enumerate(not_matched):
            if name in action.values:
                value = F.when(F.col("__clause") == number, action.values[name].cast(types[name])).otherwise(value)
        columns.append(value.alias(name))
    return kept.unionByName(fresh.select(*columns))


def drop_duplicate_keys(target: DataFrame, key: str, newest_by: str, keep: str) -> DataFrame:
    """Clear keys that occur more than once.

    ``keep='none'`` removes every row of such a key, ``keep='latest'`` all but the newest by
    ``newest_by`` (ties by the other columns).  Rows without a key stay.  One aggregation with
    map-side combining: a hot key shrinks to one row per map task before the shuffle.
    """
    if keep not in ("none", "latest"):
        raise ValueError("keep is 'none' or 'latest'")
    others = [c for c in target.columns if c != newest_by]
    best = F.max(F.struct(newest_by, *others))
    grouped = (
        target.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__times"), best.alias("__row"))
    )
    if keep == "none":
        grouped = grouped.filter(F.col("__times") == 1)
    kept = grouped.select(*[F.col(f"__row.{c}").alias(c) for c in target.columns])
    return kept.unionByName(target.filter(F.col(key).isNull()))
