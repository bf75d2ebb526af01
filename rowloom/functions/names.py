"""Table names as they stand in scripts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are never a table name.
NO_TABLE = (
    "SET", "WHERE", "AND", "OR", "ON", "WHEN", "THEN", "ELSE",
    "VALUES", "SELECT", "UPDATE", "INSERT", "DELETE", "MERGE",
    "USING", "FROM", "JOIN", "INTO", "GROUP", "ORDER", "BY",
    "HAVING", "TABLE", "OVERWRITE", "POSITION", "SUBSTRING",
    "CAST", "TRIM", "COUNT", "SUM", "MAX", "MIN", "AVG", "SESSION",
    "DUAL",
)


def tidy(name: Column) -> Column:
    """Cut what may stick to a name: brackets anywhere, commas and semicolons at the end."""
    return F.regexp_replace(F.regexp_replace(name, r"[;,]++\z", ""), r"[()]", "")


def is_table_name(name: Column) -> Column:
    """Not empty, not a reserved word and not starting with a digit."""
    return ~name.rlike(rf"(?isU)^(?:|\d.*|{'|'.join(NO_TABLE)})$")


def _substitute(name: Column, pattern: str, variables: Column) -> Column:
    """Replace every piece matching ``pattern`` that names a variable; keep unknown ones."""
    pieces = F.regexp_extract_all(name, F.lit(rf"(?U){pattern}|[^$]+|\$"), F.lit(0))
    known = F.transform(
        pieces,
        lambda piece: F.when(
            piece.rlike(rf"(?U)^{pattern}$"),
            F.coalesce(F.try_element_at(variables, F.regexp_replace(piece, r"[${}]", "")), piece),
        ).otherwise(piece),
    )
    return F.array_join(known, "")


def map_of(variables: Mapping[str, str]) -> Column:
    pairs = [F.lit(part) for pair in sorted(variables.items()) for part in pair]
    return F.create_map(*pairs) if pairs else F.map_from_arrays(*[F.array().cast("array<string>")] * 2)


def resolve(name: Column, variables: Mapping[str, str] | Column) -> Column:
    """``name`` with ``${X}`` and then ``$X`` replaced by the value of X; ``variables`` may be a map column."""
    table = variables if isinstance(variables, Column) else map_of(variables)
    braced = _substitute(name, r"\$\{\w+\}", table)
    bare = _substitute(braced, r"\$\w+", table)
    return F.when(F.contains(name, F.lit("$")), bare).otherwise(name)


def schema_part(resolved: Column) -> Column:
    """What stands before the first dot, or nothing."""
    return F.when(F.contains(resolved, F.lit(".")), F.trim(F.substring_index(resolved, ".", 1))).otherwise(F.lit(""))


def table_part(resolved: Column) -> Column:
    """What stands after the first dot, or everything."""
    return F.trim(F.regexp_replace(resolved, r"(?s)^[^.]*+\.", ""))
