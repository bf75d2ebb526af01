"""Source-to-target rows of scripts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.names import is_table_name, map_of, resolve, schema_part, table_part, tidy
from rowloom.functions.text import QUOTED_TEXT, count_file_lines, has_keyword, lead
from rowloom.plans.lines import count_lines, has_any, job_word
from rowloom.plans.statements import CREATED, classify, split_statements
from rowloom.plans.tokens import LONG, STATEMENT_KEY, read_names, reads_and_ctes, spread_texts
from rowloom.sources.scripts import split_path

# What stands in front of the name of a changed object.
TARGET_LEADS = (
    "INSERT INTO|OVERWRITE [TABLE]", f"{CREATED} [IF NOT EXISTS]", "UPDATE", "DELETE FROM", "MERGE [INTO]",
    "ALTER TABLE|VIEW", "REPLACE VIEW", "UPSERT [INTO]", "TRUNCATE TABLE", "DROP TABLE|VIEW [IF EXISTS]",
)
# ON UPDATE and FOR UPDATE change nothing; they are taken as one piece, however much white space they hold.
NO_CHANGE = r"(?:ON|FOR)\s++UPDATE\b"
TARGET = rf"(?isU)\b(?:{NO_CHANGE}|(?:{'|'.join(map(lead, TARGET_LEADS))})([^\s(;]+))"

# Words that may follow in place of a name.
NO_TARGET = (
    "PARTITION", "CLUSTER", "STORED", "LOCATION", "ROW", "FORMAT",
    "FIELDS", "LINES", "TERMINATED", "WITH", "SELECT", "AS", "SET",
    "WHERE", "VALUES", "ON", "USING", "IF",
)

MODES = ("SIMPLE", "DETAIL")


def target_names(text: Column) -> Column:
    """Distinct names a statement creates, fills, changes or drops, sorted."""
    found = F.regexp_extract_all(F.regexp_replace(text, QUOTED_TEXT, "''"), F.lit(TARGET), F.lit(1))
    names = F.filter(
        F.transform(found, tidy), lambda n: is_table_name(n) & ~n.rlike(rf"(?i)^(?:{'|'.join(NO_TARGET)})$")
    )
    return F.array_sort(F.array_distinct(names))


def statement_facts(statements: DataFrame, long: int | None = None) -> DataFrame:
    """One row per statement: types, targets, reads and WITH names.

    Both sides of the join hang on the same exchange of the statement texts.  ``long`` as in ``tokens.token_table``.
    """
    known = classify(spread_texts(statements)).withColumn("targets", target_names(F.col("query_text"))).drop("query_text")
    return (
        known.join(reads_and_ctes(statements, long), list(STATEMENT_KEY), "left")
        .selectExpr("* EXCEPT (reads, ctes)", "coalesce(reads, array()) AS reads", "coalesce(ctes, array()) AS ctes")
        .withColumn("sources", read_names(F.col("reads")))
    )


def _bound(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _sweep(depths: str, forward: bool) -> str:
    """One pass over the names in written order, or against it: a name gets its depth once all it reads have theirs.

    Depths are an array by place, 0 where open.  ``acc`` holds the places passed so far, with what this pass has found.
    """
    if forward:
        known, joined, places = f"IF(r < i, acc[r], {depths}[r])", "concat(acc, array({}))", "sequence(0, n - 1)"
    else:
        known, joined, places = f"IF(r > i, acc[r - i - 1], {depths}[r])", "concat(array({}), acc)", "sequence(n - 1, 0, -1)"
    read = f"transform(direct[i], r -> IF(r = i, 0, {known}))"
    new = _bound("d", read, "IF(exists(d, x -> x = 0), 0, 1 + coalesce(array_max(d), 0))")
    value = f"IF({depths}[i] > 0, {depths}[i], {new})"
    return f"aggregate({places}, CAST(array() AS ARRAY<INT>), (acc, i) -> {joined.format(value)})"


def cte_depths() -> Column:
    """WITH name → 1 + the largest depth of the names it reads, whatever order they are written in.

    A name that is read by what it reads, itself included, counts as depth 1 there.

    Names are places in the list.  Passes over the list, forwards and backwards, close every name whose reads are closed, until
    nothing changes: one pass for lists in order, as names are mostly written.  What is left reads a ring.  For these names
    alone ``reach`` is the closure of the reads, doubled until it must be complete, and depths are repeated once per name.
    """
    direct = """transform(ctes, c -> array_distinct(filter(transform(filter(reads, r -> r.owner = c),
                    r -> CAST(array_position(ctes, upper(r.name)) AS INT) - 1), p -> p >= 0)))"""
    both = _bound("f", _sweep("s.depths", True), f"IF(exists(f, x -> x = 0), {_sweep('f', False)}, f)")
    step = _bound("b", both, "struct(b AS depths, b = s.depths OR NOT exists(b, x -> x = 0) AS done)")
    start = "struct(transform(ctes, c -> 0) AS depths, false AS done)"
    swept = f"aggregate(sequence(1, n), {start}, (s, k) -> IF(s.done, s, {step}), s -> s.depths)"
    # Reads among the open places, and the largest depth among the closed ones.
    inner = "map_from_arrays(open, transform(open, i -> filter(direct[i], r -> swept[r] = 0)))"
    floor = "map_from_arrays(open, transform(open, i -> coalesce(array_max(transform(direct[i], r -> swept[r])), 0)))"
    closure = """aggregate(sequence(0, CAST(ceil(log2(size(open) + 1)) AS INT)), inner, (reach, i) ->
                     transform_values(reach, (c, seen) -> array_union(seen, flatten(transform(seen, s -> reach[s])))))"""
    ringed = """aggregate(sequence(1, size(open)), map_from_arrays(open, transform(open, i -> 1)), (depth, k) ->
                    transform_values(depth, (c, d) -> 1 + greatest(floor[c], coalesce(array_max(transform(inner[c],
                        s -> IF(array_contains(reach[s], c), 1, depth[s]))), 0))))"""
    rings = _bound("inner", inner, _bound("floor", floor, _bound("reach", closure, ringed)))
    merged = "transform(swept, (d, i) -> IF(d > 0, d, rings[i]))"
    closed = f"IF(size(open) = 0, swept, {_bound('rings', rings, merged)})"
    opened = _bound("open", "filter(sequence(0, n - 1), i -> swept[i] = 0)", closed)
    whole = _bound("n", "size(ctes)", _bound("direct", direct, _bound("swept", swept, opened)))
    return F.expr(f"IF(size(ctes) = 0, CAST(map() AS MAP<STRING, INT>), map_from_arrays(ctes, {whole}))")


def edges(statements: DataFrame, mode: str = "SIMPLE", long: int | None = None) -> DataFrame:
    """(dir_file, stmt_no, types, source, target, depth), unique pairs per statement.

    SIMPLE looks through WITH names: physical sources to targets.  DETAIL adds what each WITH
    name reads and which of them feed the targets.  A missing side is NULL.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    nothing = "array(CAST(NULL AS STRING))"
    facts = (
        statement_facts(statements, long)
        .filter("size(sources) > 0 OR size(targets) > 0")
        .selectExpr(
            "*",
            "filter(sources, s -> NOT array_contains(ctes, upper(s))) AS __physical",
            "filter(sources, s -> array_contains(ctes, upper(s))) AS __read_ctes",
        )
        .selectExpr(
            "*",
            f"IF(size(__physical) > 0, __physical, {nothing}) AS __from",
            f"IF(size(targets) > 0, targets, {nothing}) AS __to",
        )
    )
    edge = "named_struct('source', {}, 'target', {}, 'depth', {})"
    through = f"flatten(transform(__to, t -> transform(__from, s -> {edge.format('s', 't', '1')})))"
    if mode == "DETAIL":
        # No list of WITH names without a target, and every one of them if none is read.
        facts = facts.withColumn("__depths", cte_depths()).selectExpr(
            "*",
            "IF(size(targets) > 0, ctes, slice(ctes, 1, 0)) AS __shown",
            "IF(size(__read_ctes) > 0, __read_ctes, array_sort(ctes)) AS __feeding",
        )
        into = f"""flatten(transform(__shown, c -> transform(array_sort(filter(reads, r -> r.owner = c)),
                       r -> {edge.format('r.name', 'c', '__depths[c]')})))"""
        out = f"""flatten(transform(IF(size(__shown) > 0, __feeding, slice(ctes, 1, 0)),
                      c -> transform(targets, t -> {edge.format('c', 't', '__depths[upper(c)] + 1')})))"""
        found = f"concat({through}, {into}, {out})"
    else:
        found = through
    kept = [*STATEMENT_KEY, "sql_type", "crud_type", "ctes"]
    rows = facts.selectExpr(*kept, f"posexplode({found}) AS (place, edge)").select(*kept, "place", "edge.*")
    if mode == "DETAIL":
        # The first of equal pairs wins; the key is the one the rows are spread by already.
        same = Window.partitionBy(*STATEMENT_KEY, "source", "target").orderBy("place")
        rows = rows.withColumn("__nth", F.row_number().over(same)).filter("__nth = 1")
    return rows.selectExpr(
        *STATEMENT_KEY, "sql_type", "crud_type", "source", "target", "depth",
        "array_contains(ctes, upper(source)) AS source_is_cte", "array_contains(ctes, upper(target)) AS target_is_cte",
    )


def with_object_types(rows: DataFrame, temps: DataFrame) -> DataFrame:
    """CTE before TEMP before TABLE; nothing for no name.

    The temporary names may be many, so they are joined without a hint: Spark measures them
    and broadcasts only what fits.
    """
    for side in ("source", "target"):
        flags = temps.select(F.col("temp_name").alias(f"__{side}_key"), F.lit(True).alias(f"__{side}_temp"))
        rows = rows.join(flags, F.upper(side) == F.col(f"__{side}_key"), "left")
        rows = rows.withColumn(
            f"{side}_type",
            F.when(F.col(side).isNull(), "")
            .when(F.col(f"{side}_is_cte"), "CTE")
            .when(F.col(f"__{side}_temp"), "TEMP")
            .otherwise("TABLE"),
        ).drop(f"__{side}_key", f"__{side}_temp")
    return rows


def with_resolved_names(rows: DataFrame, variables: Mapping[str, str] | Column) -> DataFrame:
    """Empty text for a missing side, and schema and table of both names, variables replaced."""
    # As a column, since a subquery cannot stand inside the functions that look names up.
    out = rows.withColumn("__variables", variables if isinstance(variables, Column) else map_of(variables))
    for side, short in (("source", "src"), ("target", "tgt")):
        out = out.withColumn(f"{side}_table", F.coalesce(F.col(side), F.lit("")))
        resolved = resolve(F.col(f"{side}_table"), F.col("__variables"))
        out = out.withColumn(f"{short}_schema", schema_part(resolved)).withColumn(f"{short}_table", table_part(resolved))
    return out.drop("__variables")


# The columns of the lineage table in order.
LINEAGE_COLUMNS = (
    "run_id", "base_directory", "file_name", "dir_file", "crud_type", "sql_type", "source_table", "source_type",
    "target_table", "target_type", "depth", "src_schema", "src_table", "tgt_schema", "tgt_table", "op_dtm",
)


def lineage(
    statements: DataFrame,
    temps: DataFrame,
    variables: Mapping[str, str] | Column,
    mode: str,
    run_id: str,
    op_dtm: str,
    long: int | None = LONG,
) -> DataFrame:
    """The lineage table of one run.  ``statements`` should be a kept table, as long ones are looked for first."""
    rows = with_resolved_names(with_object_types(edges(statements, mode, long), temps), variables)
    return (
        split_path(rows)
        .withColumn("run_id", F.lit(run_id))
        .withColumn("op_dtm", F.to_timestamp(F.lit(op_dtm)))
        .select(*LINEAGE_COLUMNS)
    )


def run_summary(files: DataFrame, mode: str = "SIMPLE") -> DataFrame:
    """One row of counts for a run over (dir_file, content) files.

    Lines are counted inside each file in one pass.
    """
    content = F.col("content")

    def lines_having(word: str) -> Column:
        count = count_lines(content, lambda line: has_keyword(line, word))
        return F.when(has_keyword(content, word), count).otherwise(0)

    def job_lines(word: str) -> Column:
        count = count_lines(content, lambda line: F.coalesce(job_word(line) == word, F.lit(False)))
        return F.when(has_any(content, [word], case_sensitive=True), count).otherwise(0)

    measured = {
        "file_lines": count_file_lines(content),
        "emrputf_lines": job_lines("EMRPUTF"),
        "emrput_lines": job_lines("EMRPUT"),
        "default_lines": lines_having("default"),
        "key_mst_lines": lines_having("key_mst"),
    }
    per_file = files.select(*[value.alias(name) for name, value in measured.items()])
    counts = per_file.agg(
        F.count(F.lit(1)).alias("files"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in measured],
    )
    # Both hang on the same exchange of the statement texts, so statements are cut once.
    statements = split_statements(files)
    rows = edges(statements, mode).agg(F.count(F.lit(1)).alias("n"))
    queries = spread_texts(statements).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("queries", queries.scalar()).select(
        "files",
        "queries",
        "file_lines",
        rows.scalar().alias("lineage_rows"),
        F.col("queries").alias("query_text_rows"),
        "emrputf_lines",
        "emrput_lines",
        "default_lines",
        "key_mst_lines",
    )
