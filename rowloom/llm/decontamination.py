"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a mask over nine neighbouring words: the words at its ones are hashed, those at its zeros ignored, so a
substituted word at a zero does not hide the passage.  The three masks together find every run of twelve words of which any
two are substituted.  Seeds of the benchmark are a small table that meets the seeds of all documents in one join;
around each hit the words are compared on the same diagonal, and a hit counts if some ``SPAN`` words that contain it
agree in ``AGREE`` places.

Words are lower-case with everything but letters and digits removed, so punctuation and case do not matter.
Everything is column expressions; the documents are not shuffled while the benchmark's seeds are below ``SEED_ROWS``.  Beyond that
each seed goes to the join with the ``SPAN + 3`` words around it, so what is shuffled grows with the words of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import BETWEEN, kept, table, text_of

#: Together they hit every twelve words of which any two are substituted.
MASKS = ("110110101", "111010011", "100110111")
SEED = len(MASKS[0])
#: Words of a verified passage, and how many of them must agree.
SPAN, AGREE = 12, 10
#: Words of a document that a hit is verified on: a passage holds the whole seed, so it starts up to three words earlier.
AROUND = 2 * SPAN - SEED
#: Seeds of the benchmark up to which they are broadcast, about 40 bytes each plus the words of their items.
SEED_ROWS = 400_000


def plain_words(text: Column) -> Column:
    """Hashes of the plain words of a text, in order; empty array without one."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\x20\x09-\x0D]", "")
    return F.transform(F.array_remove(F.split(plain, BETWEEN), ""), lambda w: F.xxhash64(w))


def seeds(df: DataFrame, place: str) -> DataFrame:
    """One row per window and mask: the columns of ``df`` (with ``words``), ``place`` and ``seed``.

    Generation, hashing and what follows run in one generated loop; the words are not copied.
    """
    starts = F.sequence(F.lit(0), F.size("words") - SEED)
    windows = df.filter(F.size("words") >= SEED).select("*", F.explode(starts).alias(place))
    hashed = [
        F.xxhash64(F.lit(n), *[F.get("words", F.col(place) + k) for k, on in enumerate(mask) if on == "1"])
        for n, mask in enumerate(MASKS)
    ]
    return windows.select("*", F.explode(F.array(*hashed)).alias("seed"))


def around() -> dict[str, Column]:
    """``near``, the words around ``place``, where they start, and ``n_words``."""
    start = F.greatest(F.col("place") + (SEED - SPAN), F.lit(0))
    return {"near": F.slice("words", start + 1, AROUND), "near_at": start, "n_words": F.size("words")}


def passages() -> Column:
    """The best run of ``SPAN`` words around a hit as an array of (n, at), empty if too few of them agree.

    ``at`` is its start before the hit: it holds the whole seed, so it starts up to three words earlier.  As a
    function of arrays this stays out of the generated loop that hashes and probes, which the compiler would otherwise
    refuse as too large.
    """
    first = SEED - SPAN

    def agree(k: Column) -> Column:
        same = F.get("near", F.col("place") - F.col("near_at") + k) == F.get("item_words", F.col("at") + k)
        return F.coalesce(same.cast("int"), F.lit(0))

    def run(a: Column) -> Column:
        places = F.sequence(a, a + (SPAN - 1))
        return F.struct(F.aggregate(places, F.lit(0), lambda acc, k: acc + agree(k)).alias("n"), a.alias("at"))

    needed = F.ceil(F.least(F.size("item_words"), F.lit(SPAN)) * AGREE / SPAN)
    best = F.array_max(F.transform(F.sequence(F.lit(first), F.lit(0)), run))
    return F.filter(F.array(best), lambda x: x["n"] >= needed)


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """``find_leaks`` for each text of an id, told apart by ``digest``."""
    items = benchmark.select(
        F.col(item_col).alias("item_id"), plain_words(text_of(item_text_col)).alias("words")
    ).distinct()
    tests = kept(
        seeds(items, "at").select("seed", "item_id", "at", F.col("words").alias("item_words")).distinct(), "leak-seeds"
    )
    text = text_of(text_col)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), plain_words(text).alias("words"))
    windows = seeds(texts, "place")
    if tests.limit(SEED_ROWS + 1).count() <= SEED_ROWS:
        hits = windows.join(F.broadcast(tests), "seed").withColumns(around())
    else:
        hits = windows.withColumns(around()).drop("words").join(tests, "seed")
    found = hits.select("doc_id", "digest", "item_id", "place", "n_words", F.explode(passages()).alias("passage"))
    first_word = F.col("place") + F.col("passage.at")
    first = F.greatest(first_word, F.lit(0))
    last = F.least(first_word + SPAN, F.col("n_words")) - 1
    return found.groupBy("doc_id", "digest", "item_id").agg(F.min(first).alias("first_word"), F.max(last).alias("last_word"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item that share a passage: ``doc_id, item_id, first_word, last_word``.

    The two numbers bound the shared words in the document, plain words counted from 0.  Of items of 9 to 11
    plain words five of six must agree, and a seed must hit (sure without a substitution); shorter items prove nothing and
    never match.  Null texts count as empty.  Null ids are ids like others.  Repeated rows give one row together.  Empty tables give no rows.
    Other columns are not read.
    """
    found = _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col)
    return found.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")
    )


def leaks_by_document(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **named: str) -> DataFrame:
    """One row per document with a leak: ``doc_id, n_items, items``, the ids of the items in order."""
    return (
        find_leaks(docs, benchmark, id_col, **named)
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"))
    )


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that share no passage with the benchmark; other texts under the id of one that does stay."""
    found = _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col)
    leaked = kept(found.select(F.col("doc_id").alias("leaked_id"), "digest").distinct(), "leaked")
    same = docs[id_col].eqNullSafe(leaked["leaked_id"]) & (F.xxhash64(text_of(text_col)) == leaked["digest"])
    return docs.join(leaked, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaked = leaks_by_document(docs, table(spark, sf_dir, "benchmark")).withColumnRenamed("doc_id", "leaked_id")
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col("leaked_id")), "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
    )


def _oracle() -> str:
    def plain(text: str) -> str:
        clean = rf"regexp_replace(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]', '', 'g')"
        return rf"regexp_extract_all({clean}, '[^\x20\x09-\x0D]+')"

    def seeds_sql(source: str, name: str) -> str:
        keys = ", ".join(
            "concat_ws(' ', " + ", ".join([f"'{n}'", *[f"w[i + {k + 1}]" for k, on in enumerate(mask) if on == "1"]]) + ")"
            for n, mask in enumerate(MASKS)
        )
        return (
            f"SELECT {name}, i, unnest([{keys}]) AS seed FROM "
            f"(SELECT {name}, w, unnest(range(0, len(w) - {SEED - 1})) AS i FROM {source} WHERE len(w) >= {SEED})"
        )

    agree = {
        k: f"CASE WHEN d.i + {k} >= 0 AND b.i + {k} >= 0 AND dw.w[d.i + {k + 1}] = bw.w[b.i + {k + 1}] THEN 1 ELSE 0 END"
        for k in range(SEED - SPAN, SPAN)
    }
    sums = ", ".join("(" + " + ".join(agree[a + k] for k in range(SPAN)) + ")" for a in range(SEED - SPAN, 1))
    return f"""
WITH dw AS (SELECT doc_id, {plain("text")} AS w FROM documents),
bw AS (SELECT item_id, {plain("text")} AS w FROM benchmark),
d AS ({seeds_sql("dw", "doc_id")}), b AS ({seeds_sql("bw", "item_id")}),
leaks AS (
  SELECT DISTINCT doc_id, item_id FROM d JOIN b USING (seed) JOIN dw USING (doc_id) JOIN bw USING (item_id)
  WHERE greatest({sums}) >= ceil(least(len(bw.w), {SPAN}) * {AGREE} / {SPAN}.0)),
listed AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items FROM leaks GROUP BY doc_id)
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0) AS n_items, coalesce(items, '') AS items
FROM documents LEFT JOIN listed USING (doc_id)
"""


ORACLE_SQL = _oracle()
