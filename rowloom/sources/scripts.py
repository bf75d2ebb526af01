"""Script files and name variables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.text import strip

# File endings of scripts, matched without regard to case.
SCRIPT_ENDINGS = ("sql", "hql", "uld", "ld", "sh")


def is_script(path: Column) -> Column:
    return path.rlike(rf"(?i)\.(?:{'|'.join(SCRIPT_ENDINGS)})\z")


def _file_filter() -> str:
    """Any-case glob, so other files are not even opened."""
    letters = ("".join(f"[{c}{c.upper()}]" for c in ending) for ending in SCRIPT_ENDINGS)
    return "*.{" + ",".join(letters) + "}"


def _local_path(address: Column) -> Column:
    """Plain path of a file on this machine, the full address of any other."""
    return F.regexp_replace(address, r"^file:/+", "/")


def _decoded(address: Column) -> Column:
    """An address with its escapes undone; a plus sign is no escape in a path."""
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))


def _readable(raw: Column) -> Column:
    """Text without the bytes that are not UTF-8."""
    return F.regexp_replace(F.make_valid_utf8(raw), "\ufffd", "")


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", _file_filter())


@dataclass(frozen=True)
class Listing:
    """How many scripts a folder holds, and how many of them Spark's readers never see."""

    scripts: int
    empty: int
    hidden: int


def list_scripts(spark: SparkSession, folder: str) -> Listing:
    """Count the scripts below ``folder`` by name and size; no file is opened.

    A script is hidden if its name, or that of a folder between, starts with ``.`` or ``_``.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = files.makeQualified(path).toUri().getPath().rstrip("/")
    scripts = empty = hidden = 0
    listed = files.listFiles(path, True)
    while listed.hasNext():
        found = listed.next()
        name = found.getPath().toUri().getPath().removeprefix(root)
        if name.rpartition(".")[2].lower() in SCRIPT_ENDINGS:
            scripts += 1
            empty += found.getLen() == 0
            hidden += "/." in name or "/_" in name
    return Listing(scripts, empty, hidden)


def check_hidden(listing: Listing, skip_hidden: bool) -> None:
    if listing.hidden and not skip_hidden:
        raise ValueError(
            f"{listing.hidden} scripts have names, or lie in folders, that start with '.' or '_', which Spark does not read; "
            "rename them or leave them out with skip_hidden=True"
        )


def scan_scripts(spark: SparkSession, folder: str, skip_hidden: bool = False) -> DataFrame:
    """Every script below ``folder``: (dir_file, content), one row per file.

    A file is one row and therefore limited to 2 GB.  Empty files hold nothing and give no row; ``list_scripts`` counts
    them.  Spark does not read names that start with ``.`` or ``_``: such scripts are an error unless they are skipped on purpose.
    """
    check_hidden(list_scripts(spark, folder), skip_hidden)
    found = _reader(spark).format("binaryFile").load(folder)
    return found.select(
        _local_path(F.col("path")).alias("dir_file"), _readable(F.col("content").cast("string")).alias("content")
    )


def scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every script below ``folder``: (dir_file, line).

    Large files are split between tasks; use this where whole files are not needed.
    """
    return _reader(spark).text(folder).select(
        _local_path(_decoded(F.col("_metadata.file_path"))).alias("dir_file"), _readable(F.col("value")).alias("line")
    )


def only_scripts(files: DataFrame) -> DataFrame:
    """Rows of a (dir_file, ...) table that are scripts by name."""
    return files.filter(F.col("dir_file").isNotNull() & is_script(F.col("dir_file")))


def split_path(df: DataFrame) -> DataFrame:
    """Put base_directory and file_name in front of dir_file."""
    name = F.substring_index("dir_file", "/", -1)
    directory = F.substring(F.col("dir_file"), F.lit(1), F.length("dir_file") - F.length(name) - 1)
    rest = [c for c in df.columns if c != "dir_file"]
    return df.select(directory.alias("base_directory"), name.alias("file_name"), "dir_file", *rest)


def scan_variables(spark: SparkSession, path: str) -> DataFrame:
    """``NAME=value`` lines of a settings file: (name, value), the last one of a name.

    Blank lines and ``#`` lines are skipped, one pair of quotes is cut off.
    """
    line = strip(F.col("value"))
    # Fixed value: the form of a line.
    pattern = r"""(?U)^(\w+)=["']?([^"']*)["']?$"""
    # A settings file is one small file and is read whole, which keeps its line order.
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("place", "value"))
    return (
        lines.select("place", line.alias("line"))
        .filter((F.col("line") != "") & ~F.startswith("line", F.lit("#")) & F.col("line").rlike(pattern))
        .select(
            "place",
            F.regexp_extract("line", pattern, 1).alias("name"),
            strip(F.regexp_extract("line", pattern, 2)).alias("value"),
        )
        .groupBy("name")
        .agg(F.max_by("value", "place").alias("value"))
    )


def variable_map(variables: DataFrame) -> Column:
    """The variables as one map inside the plan: a scalar subquery over the settings file, which is one file."""
    return variables.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("map")).scalar()
