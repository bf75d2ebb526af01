"""CSV and database outputs, and the query unload."""

from __future__ import annotations

import re
from collections.abc import Mapping
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Column types of the database tables.
LINEAGE_TYPES = (
    "run_id VARCHAR(30), base_directory VARCHAR(500), file_name VARCHAR(500), crud_type VARCHAR(1), "
    "sql_type VARCHAR(30), source_table VARCHAR(500), source_type VARCHAR(10), target_table VARCHAR(500), "
    "target_type VARCHAR(10), src_schema VARCHAR(200), src_table VARCHAR(300), tgt_schema VARCHAR(200), "
    "tgt_table VARCHAR(300)"
)
QUERY_TEXT_TYPES = (
    "base_directory VARCHAR(500), file_name VARCHAR(500), crud_type VARCHAR(1), sql_type VARCHAR(30)"
)


def last_directory(source_dir: str) -> str:
    return PurePosixPath(source_dir.rstrip("/") or "/").name


def table_name(program: str, source_dir: str, mode: str) -> str:
    """Name of the lineage table of a run; the statement table adds ``_query_text``."""
    return f"{program}_{last_directory(source_dir)}_{mode.lower()}"


def csv_name(program: str, source_dir: str, part: str, op_dtm: str) -> str:
    """Name of a CSV output: program, directory, mode or keyword, time without marks."""
    stamp = op_dtm.replace("-", "").replace(":", "").replace(" ", "_")
    return f"{program}_{last_directory(source_dir)}_{part}_{stamp}"


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, every value as it is.

    Quotes are doubled, blanks at the ends kept, empty texts written as nothing.  No byte order mark.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows with a count that is known once they have been written; no second pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def unload(spark: SparkSession, sql: str, path: str) -> int:
    """Run a query and write its rows as CSV with header; returns their number.

    The executors write the files, no row passes the driver.
    """
    if not sql.strip():
        raise ValueError("the query is empty")
    rows, seen = counted(spark.sql(sql.strip().removesuffix(";")))
    write_csv(rows, path)
    return seen.get["rows"]


def unload_file(spark: SparkSession, sql_file: str, out_dir: str, stamp: str) -> tuple[str, int]:
    """Unload the query in a file (``.sql`` may be left out); returns the CSV folder and row count."""
    name = sql_file if sql_file.lower().endswith(".sql") else f"{sql_file}.sql"
    [row] = spark.read.text(name, wholetext=True).select(F.make_valid_utf8("value").alias("text")).collect() or [None]
    path = f"{out_dir.rstrip('/')}/{PurePosixPath(name).stem}_unload_{stamp}"
    return path, unload(spark, row["text"].replace("�", "") if row else "", path)


def check_widths(df: DataFrame, column_types: str) -> None:
    """Fail with the columns and lengths if a text does not fit its VARCHAR, before anything is dropped or written."""
    widths = {name: int(width) for name, width in re.findall(r"(\w+) VARCHAR\((\d+)\)", column_types) if name in df.columns}
    if not widths:
        return
    longest = df.agg(*[F.max(F.length(F.col(name).cast("string"))).alias(name) for name in widths]).first()
    over = {name: longest[name] for name, width in widths.items() if (longest[name] or 0) > width}
    if over:
        raise ValueError(f"texts longer than their columns: {over}; widths are {({n: widths[n] for n in over})}")


def write_database(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column_types: str = "",
    connections: int = 16,
    batch: int = 10_000,
) -> None:
    """Drop, create and fill a database table; at most ``connections`` tasks write at a time.

    ``column_types`` gives widths of text columns, which are checked first.
    """
    check_widths(df, column_types)
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**properties)
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch)
    )
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def database_options(
    url: str, sql: str, split: tuple[str, int, int, int] | None = None, fetch: int = 10_000
) -> dict[str, str]:
    """Reader options of a database query.

    ``split`` is (column, lowest, highest, parts): the query is then read by that many tasks.
    """
    options = {"url": url, "fetchsize": str(fetch)}
    if split is None:
        return {**options, "query": sql}
    column, low, high, parts = split
    return {
        **options,
        "dbtable": f"({sql}) q",
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def read_database(
    spark: SparkSession,
    url: str,
    sql: str,
    properties: Mapping[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Rows of a database query."""
    return spark.read.format("jdbc").options(**properties).options(**database_options(url, sql, split)).load()
