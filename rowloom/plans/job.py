"""The whole script run: scan, split, relate, write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.plans.lineage import lineage
from rowloom.plans.lines import JOB_WORDS, KEYWORDS, emrput_lines, has_any, script_keyword_lines
from rowloom.plans.statements import EXCLUDED, query_text, scan_once
from rowloom.session import use_utc
from rowloom.sources import sinks
from rowloom.sources.scripts import check_hidden, list_scripts, scan_lines, scan_scripts, scan_variables, variable_map
from rowloom.sources.tables import kept


@dataclass(frozen=True)
class Database:
    """Where the two tables of a run go."""

    url: str
    properties: Mapping[str, str]


@dataclass(frozen=True)
class Outputs:
    """What a run wrote: CSV folders, and rows per output."""

    folders: Mapping[str, str]
    rows: Mapping[str, int]


def run_lineage(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    op_dtm: str,
    mode: str = "SIMPLE",
    variables_file: str | None = None,
    program: str = "script_lineage",
    database: Database | None = None,
    excluded: Sequence[str] = EXCLUDED,
    skip_hidden: bool = False,
) -> Outputs:
    """Read every script below ``source_dir`` and write all outputs of a run.

    ``op_dtm`` is the stamp of the run, ``YYYY-MM-DD HH:MM:SS``.  The scripts are read twice, whole for statements and
    temporary names, line by line for words.  What is found is kept in the shared folder: lineage and statement text both read that
    table, and a lost executor costs a re-read, not the scan.  ``excluded`` are texts whose statements are left out.
    Scripts whose names Spark does not read fail the run unless ``skip_hidden``; empty files count as files.
    """
    use_utc(spark)
    run_id = op_dtm.replace("-", "").replace(":", "").replace(" ", "_")
    variables = variable_map(scan_variables(spark, variables_file)) if variables_file else {}
    listing = list_scripts(spark, source_dir)
    check_hidden(listing, skip_hidden)

    files = scan_scripts(spark, source_dir, skip_hidden)
    statements, temps = scan_once(files, excluded)

    # One pass over the lines for all words; the outputs below are parts of the kept hits.
    wanted = has_any(F.col("line"), KEYWORDS) | has_any(F.col("line"), JOB_WORDS, case_sensitive=True)
    lines = kept(scan_lines(spark, source_dir).filter(wanted), "lines")
    tables: dict[str, DataFrame] = {
        mode.lower(): lineage(statements, temps, variables, mode, run_id, op_dtm),
        "query_text": query_text(statements, op_dtm),
        "emrput": emrput_lines(lines),
        "default": script_keyword_lines(lines, ["default"]),
        "key_mst": script_keyword_lines(lines, ["key_mst"]),
    }
    if database is not None:
        # Written twice, computed once.
        for part in (mode.lower(), "query_text"):
            tables[part] = kept(tables[part], part)
    folders, rows = {}, {}
    for part, table in tables.items():
        # The run id goes to the database only.
        shown = table.drop("run_id")
        folders[part] = f"{out_dir.rstrip('/')}/{sinks.csv_name(program, source_dir, part, op_dtm)}"
        shown, seen = sinks.counted(shown)
        sinks.write_csv(shown, folders[part])
        rows[part] = seen.get["rows"]
    if database is not None:
        name = sinks.table_name(program, source_dir, mode)
        sinks.write_database(
            tables[mode.lower()], database.url, name, database.properties, sinks.LINEAGE_TYPES
        )
        sinks.write_database(
            tables["query_text"], database.url, f"{name}_query_text", database.properties, sinks.QUERY_TEXT_TYPES
        )
    rows["files"] = listing.scripts
    rows["hidden_files"] = listing.hidden
    return Outputs(folders, rows)
