"""The token table: one row per word or mark of a statement.

Every question about brackets, clauses and WITH names is a running value over the rows of a
statement.  The statement texts are spread by (dir_file, stmt_no) once, before they are cut into
tokens; everything after that stays in the same partition, so the text is shuffled and the
many times larger token table never is.  A window covers one statement, never a file.

A statement with more than ``long`` characters, such as a generated one, is cut into pieces of ``PIECE`` tokens.  A running value is then
that of its piece combined with the totals of the pieces before: sums add up, the lowest is the lower one, the first and the
last are the first and the last that there are.  Steps between pieces are kept tables.  Such statements must be looked for, so
``statements`` is read twice then and should be a kept table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.names import is_table_name, tidy
from rowloom.plans.statements import without_quotes
from rowloom.sources.tables import kept

STATEMENT_KEY = ("dir_file", "stmt_no")

# A name keeps its dots, variables, quotes and link marks; everything else is one mark.
NAME = r"[\w$&{}.\-`@#:%\[\]]+"
TOKEN = rf"(?U)''|{NAME}|[^\s\w]"

# Words after which a bracket does not open function arguments.
NO_FUNCTION = (
    "FROM", "JOIN", "USING", "WITH", "ON", "AS",
    "SELECT", "WHERE", "HAVING", "SET",
    "INSERT", "UPDATE", "DELETE", "MERGE",
    "CREATE", "TABLE", "VIEW", "INTO",
    "WHEN", "THEN", "ELSE", "AND", "OR", "NOT",
    "EXISTS", "IN", "ANY", "ALL", "CASE",
    "UNION", "INTERSECT", "EXCEPT", "DISTINCT",
)

# Words that start a clause, and so end the list of names before them.
CLAUSES = (
    "SELECT", "FROM", "JOIN", "USING", "WHERE", "ON", "SET", "GROUP", "ORDER", "BY", "HAVING", "WHEN", "VALUES",
    "UNION", "INTERSECT", "EXCEPT", "LIMIT", "VIEW", "WINDOW", "QUALIFY",
)

# The words that end a WITH list.
MAIN_WORDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "VALUES")

# Bytes of text for which there is one partition of statements, and the most partitions there are.
TEXT_BYTES, MOST_PARTS = 32 << 20, 200_000

WITH_LEADS = ("WITH", "RECURSIVE", ",")
LIST_LEADS = ("FROM", "JOIN", "USING", ",")


# Characters from which a statement is cut, and tokens of a piece.
LONG, PIECE = 4_000_000, 200_000

# A total of a piece, and the running value of totals, for each kind of running value.
TOTALS = {
    "sum": ("sum({0})", "sum({0})"),
    "min": ("min({0})", "min({0})"),
    "first": ("min_by({0}, pos) FILTER (WHERE ({0}) IS NOT NULL)", "first({0}, true)"),
    "last": ("max_by({0}, pos) FILTER (WHERE ({0}) IS NOT NULL)", "last({0}, true)"),
}
# How the value inside a piece and that of the pieces before are one.
COMBINED = {
    "sum": "coalesce({carried}, 0) + {inside}",
    "min": "least({carried}, {inside})",
    "first": "coalesce({carried}, {inside})",
    "last": "coalesce({inside}, {carried})",
}


def running(
    table: DataFrame, values: dict[str, tuple[str, str, bool]], keys: Sequence[str] = STATEMENT_KEY, pieces: bool = False
) -> DataFrame:
    """``table`` with running values over the rows of ``keys`` in written order.

    ``values`` are by name: the kind (sum, min, first or last, both not NULL), the expression, and whether the row itself counts.
    """

    def inside(*parts: str) -> list[str]:
        frame = f"PARTITION BY {', '.join(parts)} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND"
        return [
            f"{TOTALS[kind][1].format(value)} OVER ({frame} {'CURRENT ROW' if through else '1 PRECEDING'}) AS {name}"
            for name, (kind, value, through) in values.items()
        ]

    if not pieces:
        return table.selectExpr("*", *inside(*keys))
    table = kept(table, "token-pieces")
    totals = table.groupBy(*keys, "__piece").agg(
        *[F.expr(TOTALS[kind][0].format(value)).alias(f"__t_{name}") for name, (kind, value, _) in values.items()]
    )
    before = f"(PARTITION BY {', '.join(keys)} ORDER BY __piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = totals.selectExpr(
        *keys, "__piece",
        *[f"{TOTALS[kind][1].format(f'__t_{name}')} OVER {before} AS __c_{name}" for name, (kind, *_) in values.items()],
    )
    both = table.selectExpr("*", *inside(*keys, "__piece")).join(carried, [*keys, "__piece"])
    combined = [
        f"{COMBINED[kind].format(carried=f'__c_{name}', inside=name)} AS {name}" for name, (kind, *_) in values.items()
    ]
    return both.selectExpr(*table.columns, *combined)


def _in(column: str, words: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(w) for w in words)})"


def _is_word(column: str) -> str:
    pattern = f"(?U)^{NAME}$".replace("\\", "\\\\")
    return f"{column} RLIKE '{pattern}'"


def spread_texts(statements: DataFrame) -> DataFrame:
    """Statement texts hashed by their key.

    The number of partitions is given, so that adaptive execution does not merge them by the size
    of the texts: the work per byte is many times that of a usual shuffle.  It is the session's number, or one for
    each ``TEXT_BYTES`` of the files behind the statements if that is more; the planner's estimate knows their size.
    """
    parts = int(statements.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(statements._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A table without files has no known size; the planner then assumes the largest number there is.
    by_size = min(size // TEXT_BYTES, MOST_PARTS) if size < 1 << 60 else 0
    return statements.select(*STATEMENT_KEY, "query_text").repartition(max(parts, by_size), *STATEMENT_KEY)


def _shifted(array: Column, by: int) -> Column:
    """The same array with every element ``by`` places later."""
    return F.concat(F.array(*[F.lit("")] * by), array)


def tokens(statements: DataFrame, pieces: bool = False) -> DataFrame:
    """The tokens that decide something, each with its neighbours by position.

    Columns: ``pos``, ``tok`` and its upper-case form ``up``; ``p1``, ``p2``, ``p3`` the upper-case
    tokens before it and ``p1_tok``, ``p2_tok`` as written; ``next_up`` the token after it;
    ``first_up`` the first token of the statement.  Brackets, clause words and words after FROM,
    JOIN, USING or a comma are kept, everything else only serves as a neighbour: the running
    values below change at kept tokens alone.  ``pieces`` adds the piece of a row.
    """
    found = F.regexp_extract_all(without_quotes(F.col("query_text")), F.lit(TOKEN), F.lit(0))
    # A long text is a row that no shuffle spreads any better.
    cut = (statements if pieces else spread_texts(statements)).select(*STATEMENT_KEY, found.alias("__toks"))
    toks = F.col("__toks")
    row = F.arrays_zip(
        toks.alias("tok"),
        _shifted(toks, 1).alias("p1_tok"),
        _shifted(toks, 2).alias("p2_tok"),
        _shifted(toks, 3).alias("p3_tok"),
        F.slice(toks, 2, F.greatest(F.size(toks), F.lit(1))).alias("next_tok"),
    )
    rows = cut.select(
        *STATEMENT_KEY, F.upper(F.try_element_at(toks, F.lit(1))).alias("first_up"), F.posexplode(row).alias("pos", "t")
    ).select(*STATEMENT_KEY, "first_up", "pos", "t.*")
    upper = {"up": "tok", "p1": "p1_tok", "p2": "p2_tok", "p3": "p3_tok", "next_up": "next_tok"}
    rows = rows.filter(F.col("tok").isNotNull()).select(
        *STATEMENT_KEY, "first_up", "pos", "tok", "p1_tok", "p2_tok",
        *[F.upper(column).alias(name) for name, column in upper.items()],
    )
    decide = rows.filter(
        f"tok IN ('(', ')') OR {_in('up', ('WITH', *CLAUSES, *MAIN_WORDS))} OR {_in('p1', LIST_LEADS)}"
    )
    return decide.withColumn("__piece", F.floor(F.col("pos") / PIECE)) if pieces else decide


def with_depth(table: DataFrame, pieces: bool = False) -> DataFrame:
    """Bracket depth, both brackets inside; a closing bracket too many does not go below 0."""
    table = running(table, {"__sum": ("sum", "CASE tok WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END", True)}, pieces=pieces)
    table = running(table, {"__low": ("min", "__sum", True), "__low_before": ("min", "__sum", False)}, pieces=pieces)
    return table.selectExpr(
        "* EXCEPT (__sum, __low, __low_before)",
        """CAST(IF(tok = ')', __sum + 1 - least(0, coalesce(__low_before, 0)), __sum - least(0, __low)) AS INT) AS depth""",
    )


def with_owner(table: DataFrame, pieces: bool = False) -> DataFrame:
    """The WITH name a row belongs to, and the rows that open the body of one.

    The list may stand at any depth; names may carry a column list.  ``cte_opens`` is the
    upper-case name on the opening bracket of its body, ``owner`` the same on every row inside.
    """
    opens = "(tok = '(' AND depth = __base + 1)"
    main = _in("up", ("WITH", *MAIN_WORDS))
    named = f"""CASE WHEN {_is_word('p2_tok')} AND {_in('p3', WITH_LEADS)} THEN upper(p2_tok)
                     WHEN p2 = ')' AND {_in('__list_lead', WITH_LEADS)} THEN upper(__list_name) END"""
    table = running(table, {"__base": ("first", "IF(up = 'WITH', depth, NULL)", True)}, pieces=pieces)
    table = running(
        table,
        {
            "__main": ("last", f"IF(depth = __base AND {main}, up, NULL)", True),
            # The bracket before this one at the same depth: a column list, if this opens a body.
            "__list_name": ("last", f"IF({opens}, p1_tok, NULL)", False),
            "__list_lead": ("last", f"IF({opens}, p2, NULL)", False),
        },
        pieces=pieces,
    )
    table = table.selectExpr("*", f"IF({opens} AND __main = 'WITH' AND p1 = 'AS', {named}, NULL) AS cte_opens")
    table = running(table, {"__inside": ("last", f"IF({opens}, coalesce(cte_opens, ''), NULL)", True)}, pieces=pieces)
    return table.selectExpr(
        "* EXCEPT (__base, __main, __list_name, __list_lead, __inside)",
        "IF(depth > __base, nullif(__inside, ''), NULL) AS owner",
    )


def with_group(table: DataFrame, pieces: bool = False) -> DataFrame:
    """The bracket a row stands in (-1 outside), and whether that bracket holds function arguments."""
    call = f"({_is_word('p1')} AND NOT {_in('p1', NO_FUNCTION)} AND coalesce(next_up, '') NOT IN ('SELECT', 'WITH'))"
    opened = {"__at": ("last", "IF(tok = '(', pos, NULL)", True), "__call": ("last", f"IF(tok = '(', {call}, NULL)", True)}
    return running(table, opened, [*STATEMENT_KEY, "depth"], pieces).selectExpr(
        "* EXCEPT (__at, __call)",
        "IF(depth = 0, -1, __at) AS grp",
        "depth > 0 AND coalesce(__call, false) AS in_call",
    )


def with_clause(table: DataFrame, pieces: bool = False) -> DataFrame:
    """The last clause word before a row in its own bracket."""
    last = {"clause": ("last", f"IF({_in('up', CLAUSES)}, up, NULL)", False)}
    return running(table, last, [*STATEMENT_KEY, "grp"], pieces)


def token_table(statements: DataFrame, long: int | None = None) -> DataFrame:
    """All tokens that decide something with their running values; statements above ``long`` characters go in pieces."""

    def whole(texts: DataFrame, pieces: bool) -> DataFrame:
        table = tokens(texts, pieces)
        for step in (with_depth, with_owner, with_group, with_clause):
            table = step(table, pieces)
        return table

    if long is None:
        return whole(statements, False)
    above = F.length("query_text") > long
    cut = statements.filter(above)
    if cut.isEmpty():
        return whole(statements, False)
    return whole(statements.filter(~above), False).unionByName(whole(cut, True).drop("__piece"))


def source_name() -> Column:
    """The table read at this row, or NULL.

    A name after FROM or JOIN, after USING of a MERGE or DELETE, or after a comma of such a list;
    function arguments (``EXTRACT(x FROM y)``) and IS DISTINCT FROM do not count.
    """
    using = "first_up IN ('MERGE', 'DELETE')"
    reads = F.expr(
        f"""NOT in_call AND {_is_word('tok')} AND CASE p1
            WHEN 'FROM' THEN p2 <> 'DISTINCT'
            WHEN 'JOIN' THEN p2 <> 'DISTINCT'
            WHEN 'USING' THEN {using}
            WHEN ',' THEN clause IN ('FROM', 'JOIN') OR (clause = 'USING' AND {using})
            ELSE false END"""
    )
    name = tidy(F.col("tok"))
    return F.when(reads & is_table_name(name), name)


def reads_and_ctes(statements: DataFrame, long: int | None = None) -> DataFrame:
    """One row per statement: ``reads`` (owner, name) pairs and ``ctes`` names in written order.

    Grouped by the key the tokens are already spread by, so no further shuffle.
    """
    table = token_table(statements, long)
    marked = table.select(*STATEMENT_KEY, "pos", "owner", source_name().alias("name"), "cte_opens").filter(
        F.col("name").isNotNull() | F.col("cte_opens").isNotNull()
    )
    grouped = marked.groupBy(*STATEMENT_KEY).agg(
        F.collect_set(F.when(F.col("name").isNotNull(), F.struct("owner", "name"))).alias("reads"),
        F.collect_list(F.when(F.col("cte_opens").isNotNull(), F.struct("pos", "cte_opens"))).alias("__ctes"),
    )
    written = F.transform(F.array_sort("__ctes"), lambda c: c["cte_opens"])
    return grouped.select(*STATEMENT_KEY, "reads", F.array_distinct(written).alias("ctes"))


def read_names(reads: Column) -> Column:
    """The distinct names of ``reads``, sorted."""
    return F.array_sort(F.array_distinct(F.transform(reads, lambda r: r["name"])))
