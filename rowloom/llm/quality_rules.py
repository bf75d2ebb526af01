"""Quality rules whose cutoffs are chosen by exact binomial bounds on labelled documents.

Each rule rejects documents whose measure is above a cutoff.  In each stratum and for each rule, the labelled
good documents are the holdout: a cutoff is admissible if, were its true rate of false rejections above the rule's
share of the allowed risk, as few rejections as seen would have a binomial probability of at most the error level.
The level is divided by the number of all tests (strata x rules x cutoffs), so with probability ``1 - error`` no
chosen cutoff in any stratum exceeds its risk.  The lowest admissible cutoff is taken; without one the
rule stays off in that stratum.

Everything is column expressions.  The text is read once into a slim kept table; the labelled counts are an
aggregation over it, and the chosen cutoffs are one row per stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import BETWEEN, bounded, kept, table, text_of, words

#: Words of a window that counts as repeated.
WINDOW = 8
#: The base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Allowed rate of false rejections of a stratum, and probability that any stratum exceeds it.
RISK, ERROR = 0.04, 0.05
#: Measures, each rejecting above its cutoff, and the cutoffs that are tried.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "word_length")
CUTOFFS = {
    "symbol_share": [round(0.01 * 1.35**i, 4) for i in range(16)],
    "dup_line_share": [round(0.002 * 1.45**i, 4) for i in range(16)],
    "repeat_share": [round(0.01 * 1.26**i, 4) for i in range(16)],
    "word_length": [round(5.0 * 1.12**i, 3) for i in range(16)],
}
#: Strata up to this number are broadcast.
STRATA_ROWS = 50_000
TRIM = " \t\n\x0b\x0c\r"


def measures(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """The counts of every document, without its text."""
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text_of(text_col).alias("text")
    )
    cut = (
        given.withColumn("w", F.split(F.trim(F.col("text"), F.lit(TRIM)), BETWEEN))
        .withColumn("n_words", F.when(F.element_at("w", 1) == "", 0).otherwise(F.size("w")).cast("long"))
        .withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(TRIM)) != ""))
        .select(
            "doc_id",
            "stratum",
            "n_words",
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.transform("w", lambda x: F.xxhash64(x)).alias("w"),
        )
    )
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
    )
    hashed = cut.withColumn("h", F.when(F.col("n_words") > WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    # Nearly all texts have no repeated window, which one pass over a set shows.  For the others the windows are
    # sorted by hash and the places of those with an equal neighbour kept; their starts in order cover 8 words
    # each or the distance from the start before.
    marked = (
        hashed.drop("w")
        .withColumn("repeats", F.size(F.array_distinct("h")) < F.size("h"))
        .withColumn(
            "p",
            F.when(
                F.col("repeats"), F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            ),
        )
        .drop("h")
    )
    starts = F.sort_array(
        F.filter(
            F.transform(
                "p",
                lambda x, k: F.when(
                    (F.get("p", k - 1)["h"] == x["h"]) | (F.get("p", k + 1)["h"] == x["h"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
    )
    placed = marked.withColumn("s", F.when(F.col("repeats"), starts)).drop("p")
    covered = F.aggregate(
        F.transform("s", lambda x, k: F.least(F.lit(WINDOW), x - F.coalesce(F.get("s", k - 1), x - WINDOW))),
        F.lit(0),
        lambda a, b: a + b,
    )
    n_repeat = F.when(F.col("repeats"), covered).otherwise(0).cast("long")
    return placed.withColumn("n_repeat_words", n_repeat).select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )


def with_rules(df: DataFrame) -> DataFrame:
    """Add the base verdict and the measures of the rules; a text without words measures 0."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (
        df.withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
        )
        .withColumn("symbol_share", F.col("n_symbols") / n)
        .withColumn("dup_line_share", F.col("n_dup_lines") / n)
        .withColumn("repeat_share", F.col("n_repeat_words") / n)
        .withColumn("word_length", F.col("word_chars") / n)
    )


def log_factorial(x: Column) -> Column:
    """ln(x!) to double precision: Stirling's series eight places up, stepped back."""
    z = x.cast("double") + 9
    steps = sum((F.log(z - k) for k in range(2, 9)), F.log(z - 1))
    series = (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi))
    return series + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p) with k below n p, 1 at or above.

    The terms are summed downwards from k until they no longer count: about 40 standard deviations' worth of terms for
    the largest counts, never all of them.
    """
    first = F.exp(
        log_factorial(n)
        - log_factorial(k)
        - log_factorial(n - k)
        + k * F.lit(math.log(p))
        + (n - k) * F.lit(math.log1p(-p))
    )
    reach = F.least(k, F.ceil(F.sqrt(n * p) * 40 + 60)).cast("int")
    zero = F.struct(first.alias("term"), first.alias("total"))
    step = lambda acc, i: F.struct(
        (acc["term"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)).alias("term"),
        (acc["total"] + acc["term"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)).alias("total"),
    )
    downwards = F.when(reach > 0, F.sequence(F.lit(1), reach)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(downwards, zero, step, lambda acc: acc["total"])
    return F.when(k < n * p, F.least(total, F.lit(1.0))).otherwise(1.0)


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """One row per stratum with the cutoff of each rule, null where the rule stays off.

    ``labels`` has doc_id and quality; documents labelled good by all their labels are the holdout.
    """
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    held = measured.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    above = [
        F.struct(
            F.lit(rule).alias("rule"),
            sum((F.when(F.col(rule) > c, 1).otherwise(0) for c in CUTOFFS[rule]), F.lit(0)).alias("above"),
        )
        for rule in RULES
    ]
    # Rows: strata x rules x 17, whatever the number of labelled documents.
    counts = (
        held.select("stratum", F.explode(F.array(*above)).alias("r"))
        .groupBy("stratum", "r.rule", "r.above")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_rule = Window.partitionBy("stratum", "rule")
    rejected = F.sum("n").over(per_rule.orderBy(F.col("above").desc()).rowsBetween(Window.unboundedPreceding, 0))
    tried = (
        counts.withColumn("k_to", rejected)
        .withColumn("all", F.sum("n").over(per_rule))
        .withColumn("higher", F.coalesce(F.lag("k_to").over(per_rule.orderBy(F.col("above").desc())), F.lit(0)))
        .withColumn(
            "tests", F.lit(len(RULES) * 16) * F.max(F.dense_rank().over(Window.orderBy("stratum"))).over(Window.partitionBy())
        )
    )
    # A document above exactly `above` cutoffs is rejected by the first `above` ones.  Between two seen values
    # the lowest cutoff that rejects only what lies higher is number `above` + 1.
    admissible = binomial_tail(F.col("higher"), F.col("all"), risk / len(RULES)) <= F.lit(error) / F.col("tests")
    values = F.create_map(*[x for r in RULES for x in (F.lit(r), F.array(*[F.lit(c) for c in CUTOFFS[r]]))])
    lowest = tried.filter(admissible & (F.col("above") < 16)).groupBy("stratum", "rule").agg(F.min("above").alias("at"))
    return (
        lowest.withColumn("cutoff", F.element_at(values[F.col("rule")], F.col("at") + 1))
        .groupBy("stratum")
        .pivot("rule", list(RULES))
        .agg(F.first("cutoff"))
        .select(F.col("stratum").alias("s"), *[F.col(r).alias(f"{r}_cutoff") for r in RULES])
    )


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept``, and the rules that reject it.

    A null text counts as empty and fails the base rules.  A null stratum is a stratum.  A stratum without enough labelled
    documents gets no cutoff, so its documents are judged by the base rules alone.  Labels of unknown or null
    ids are ignored; a document with both labels is not a good one.  Repeated rows are judged each.  Empty tables give no
    rows.  Other columns are not read.
    """
    measured = with_rules(kept(measures(docs, id_col, text_col, stratum_col), "rule-measures"))
    slim_labels = labels.select(F.col("doc_id"), F.col("quality"))
    cutoffs = bounded(kept(choose_cutoffs(measured, slim_labels, risk, error), "rule-cutoffs"), STRATA_ROWS)
    judged = measured.join(cutoffs, F.col("s").eqNullSafe(F.col("stratum")), "left")
    broken = F.filter(
        F.array(*[F.when(F.col(r) > F.col(f"{r}_cutoff"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull()
    )
    return judged.withColumn("broken", broken).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
        F.array_join("broken", ",").alias("broken_rules"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _rules_sql() -> tuple[str, str]:
    shares = {"symbol_share": "n_symbols", "dup_line_share": "n_dup_lines", "repeat_share": "n_repeat_words", "word_length": "word_chars"}
    rows = ", ".join(
        f"('{rule}', {j}, {c!r}::DOUBLE)" for rule in RULES for j, c in enumerate(CUTOFFS[rule])
    )
    case = " ".join(f"WHEN '{rule}' THEN {column}" for rule, column in shares.items())
    return f"(VALUES {rows}) AS c(rule, j, cutoff)", f"CASE rule {case} END::DOUBLE / greatest(n_words, 1)"


def _oracle() -> str:
    grid, share = _rules_sql()
    p = RISK / len(RULES)
    return rf"""
WITH cut AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], chr(10)) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM cut WHERE len(w) > 8)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
steps AS (SELECT doc_id, least(8, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 8)) AS step FROM twice),
covered AS (SELECT doc_id, sum(step) AS n FROM steps GROUP BY doc_id),
measured AS (
  SELECT doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
counted AS (
  SELECT lang, rule, j, cutoff, count(*) AS n, count(*) FILTER ({share} > cutoff) AS k
  FROM judged, {grid} WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY lang, rule, j, cutoff),
tails AS (
  SELECT *, list_sum(list_transform(range(0, k + 1), lambda x: exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1)
              + x * ln({p!r}) + (n - x) * ln(1 - {p!r})))) AS tail,
         {ERROR} / ({len(RULES)} * 16 * (SELECT count(DISTINCT coalesce(lang, '-')) FROM counted)) AS level
  FROM counted),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM tails WHERE tail <= level AND k < n * {p!r} GROUP BY lang, rule),
broken AS (
  SELECT j.doc_id, array_to_string(list(c.rule ORDER BY list_position({list(RULES)!r}, c.rule)), ',') AS rules
  FROM judged j JOIN chosen c ON c.lang IS NOT DISTINCT FROM j.lang WHERE {share} > c.cutoff GROUP BY j.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rules IS NULL AS kept, coalesce(rules, '') AS broken_rules
FROM judged LEFT JOIN broken USING (doc_id)
"""


ORACLE_SQL = _oracle()
