"""Which of many words stand in which texts: a table of words against a table of texts.

A text is cut into tokens where it has a letter that no word has, so a word stands inside a token, and a token counts once in
a text.  Most tokens of a text are met often: the words in each of the ``TOKENS`` commonest ones of a sample are looked for once, and
a token is joined with that list.  Words that stand in most texts would come with most tokens; each text is searched for them alone.

In the other tokens a word is found by one of its grams, its runs of ``GRAM`` letters, the one that is rarest in the common tokens.  The
grams at every place of such a token meet that index in a join; where one is met, the word is compared with the letters around it.

A word counts where it stands first, so a pair comes once without being gathered.  A text is read once
whatever the number of words; the sample only decides which way a word is found, never the result.  The index is a kept
table, so Spark knows its size and broadcasts what is small.

Long tokens are cut into pieces first, since to find a letter by its number Spark counts from the beginning of a string.  All
that runs for each place is compiled with the join, so a text is not copied for its places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import keys_of
from rowloom.sources.tables import kept

#: Letters of a gram, places of a piece, the share of texts that is sampled.
GRAM, PIECE, SHARE = 4, 32, 0.01
#: The common tokens: how many, their letters, and the words in one of them; and how many words each text is searched for alone.
TOKENS, LETTERS, MOST, ALONE = 100_000, 64, 64, 256
SEED = 42
#: Texts are dealt in blocks of 2 ** ``BLOCK`` neighbours, which often have more in common; bytes of a task; the most tasks.
BLOCK, TASK_BYTES, MOST_PARTS = 6, 2 << 20, 200_000


def _spread(texts: DataFrame, *keys: str) -> DataFrame:
    """``texts`` hashed by ``keys`` into one partition for each ``TASK_BYTES`` of the files behind them, or the session's number if that
    is more.  The number is given, so adaptive execution does not merge partitions whose search takes long.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A table without files has no known size; the planner then assumes the largest number there is.
    by_size = min(size // TASK_BYTES, MOST_PARTS) if size < 1 << 60 else 0
    return texts.repartition(max(parts, by_size), *keys)


def _places(texts: DataFrame, sizes: Sequence[int], around: int, searched: Column | None = None) -> DataFrame:
    """``texts`` once for each place of ``__text`` and size of gram, with ``__gram``; the ``__piece`` of the text that has at
    least ``around`` letters on both sides, as far as there are any; the place in it, ``__in``, from 1; and the text ``__before`` the
    places of the piece.  Texts that are not ``searched`` come once.
    """
    filled = F.concat(F.lit(" " * around), F.col("__text"))
    most = PIECE + 2 * around + GRAM
    pieces = F.regexp_extract_all(filled, F.lit(f"(?s)(?=(.{{1,{most}}})).{{1,{PIECE}}}"), F.lit(1))
    cut = texts.select("*", F.posexplode_outer(pieces if searched is None else F.when(searched, pieces)).alias("__number", "__filled"))
    begin = F.col("__number") * PIECE
    fill = F.greatest(F.lit(around) - begin, F.lit(0))
    cut = cut.withColumns({
        "__own": F.substring("__filled", around + 1, PIECE + GRAM - 1),
        "__piece": F.substring(F.col("__filled"), fill + 1, F.lit(most)),
        "__left": F.lit(around) - fill,
        "__before": F.left("__text", begin),
    })
    size = F.length("__own")
    numbers = F.when(size > 0, F.sequence(F.lit(1), F.least(size, F.lit(PIECE))))
    each = cut.select("*", F.explode_outer(numbers).alias("__n"))
    each = each.withColumn("__run", F.substring(F.col("__own"), F.col("__n"), F.lit(sizes[-1])))
    # A run that the end of the text cuts short is none.
    grams = F.array(*[F.when(F.length("__run") >= n, F.left("__run", F.lit(n))) for n in sizes])
    each = each.withColumn("__in", F.col("__n") + F.col("__left"))
    grams = F.explode_outer(F.when(F.col("__run").isNotNull(), grams))
    return each.select(*texts.columns, "__piece", "__in", "__before", grams.alias("__gram"))


def _stands_first() -> Column:
    """Whether ``look`` stands at the place where its gram was met, and nowhere before in ``__text``."""
    start = F.col("__in") - F.col("place") + 1
    stands = F.substring(F.col("__piece"), start, F.length("look")) == F.col("look")
    stands = (start > 0) & ((F.col("gram") == F.col("look")) | stands)
    # One that stood earlier lies before the places of this piece, or reaches into them and so lies in the piece.
    first = (F.instr(F.col("__piece"), F.col("look")) == start) & ~F.contains(F.col("__before"), F.col("look"))
    return F.when(stands, first).otherwise(False)


def _index(looks: DataFrame, common: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``look, words, gram, place``: each word under one gram and the gram's place in it, with the ways it is written."""
    size = F.least(F.length("look"), F.lit(GRAM))
    each = looks.select("*", F.explode(F.sequence(F.lit(1), F.length("look") - size + 1)).alias("place"))
    each = each.withColumn("gram", F.substring(F.col("look"), F.col("place"), size))
    sampled = _places(common.select("__text"), sizes, 0).select(F.col("__gram").alias("gram"))
    seen = sampled.join(keys_of(each, "gram"), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("places"))
    shared = each.groupBy("gram").agg(F.count(F.lit(1)).alias("looks"))
    rated = each.join(shared, "gram").join(seen, "gram", "left")
    order = F.struct(F.coalesce("places", F.lit(0)), "looks", "gram", "place")
    best = rated.groupBy("look").agg(F.first("words").alias("words"), F.min(order).alias("best"))
    return best.select("look", "words", "best.gram", "best.place")


def _letters(looks: DataFrame) -> set[str]:
    """The ASCII letters of the words; at most 128 rows come to the driver."""
    ascii_only = F.regexp_replace("look", r"[^\x00-\x7f]", "")
    return {r["c"] for r in looks.select(F.explode(F.split(ascii_only, "")).alias("c")).distinct().collect()}


def _tokens(text: Column, between: str) -> Column:
    """The distinct tokens of a text in the order they stand first, after an empty one that stands for the whole text."""
    cut = F.array(text)
    if between:
        cut = F.split(text, "[" + "".join(f"\\x{ord(c):02x}" for c in between) + "]+")
    return F.array_distinct(F.concat(F.array(F.lit("")), cut))


def _common(texts: DataFrame, between: str) -> DataFrame:
    """``__text, n``: the commonest tokens of the texts and in how many of them they stand."""
    each = texts.select(F.explode(_tokens(F.col("__text"), between)).alias("__text"))
    counted = each.groupBy("__text").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.xxhash64("__text"), "__text").limit(TOKENS)


def _alone(found: DataFrame, common: DataFrame) -> DataFrame:
    """``look, words``: the words that stand in one token of a text or more, on average; at most ``ALONE``."""
    texts = common.filter(F.col("__text") == "").agg(F.max("n")).scalar()
    often = found.groupBy("look").agg(F.first("words").alias("words"), F.sum("n").alias("n"))
    often = often.filter(F.col("n") >= texts).orderBy(F.desc("n"), "look").limit(ALONE)
    return often.select("look", "words")


def _words_of_tokens(found: DataFrame, common: DataFrame) -> DataFrame:
    """``__token, __here``: the words in each common token, as they are written; none in the empty one."""
    here = found.groupBy("__text").agg(F.flatten(F.collect_list("words")).alias("__here"))
    known = common.filter((F.length("__text") > 0) & (F.length("__text") <= LETTERS)).join(here, "__text", "left")
    none = F.array().cast("array<string>")
    known = known.select(F.col("__text").alias("__token"), F.coalesce("__here", none).alias("__here"), "n")
    empty = found.sparkSession.range(1).select(F.lit("").alias("__token"), none.alias("__here"), F.lit((1 << 63) - 1).alias("n"))
    return known.filter(F.size("__here") <= MOST).unionByName(empty)


def _as_broadcast(lists: DataFrame) -> DataFrame:
    """The commonest of the kept ``lists``, as many as Spark broadcasts by their size; all if it broadcasts nothing.

    Tokens without a list are met by their grams.
    """
    limit = int(lists.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    while True:
        joined = lists.select("__token", "__here")
        size = int(str(joined._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        rows = lists.count() if size > limit > 0 else 1
        if rows <= 1:
            return joined
        lists = kept(lists.orderBy(F.desc("n"), "__token").limit(max(1, int(rows * limit / size * 0.8))), "word-lists")


def find_words(
    texts: DataFrame,
    words: DataFrame,
    text_col: str = "line",
    case_sensitive: bool = False,
    share: float = SHARE,
) -> DataFrame:
    """The rows of ``texts`` once for each word they hold, with a column ``word``.

    ``words`` has one column; repeated words count once, as written, and NULL and empty ones stand nowhere.  Without
    ``case_sensitive`` letters of either case are equal.  NULL texts hold nothing.
    """
    [column] = words.columns

    def look(value: Column) -> Column:
        return value if case_sensitive else F.lower(value)

    known = words.filter(F.length(column) > 0).select(F.col(column).alias("word")).distinct()
    known = known.withColumn("look", look(F.col("word")))
    # At most ``GRAM`` rows: the lengths of grams that occur, and of the longest word.
    rows = known.groupBy(F.least(F.length("look"), F.lit(GRAM)).alias("n")).agg(F.max(F.length("look")).alias("most")).collect()
    sizes, around = sorted(r["n"] for r in rows), max((r["most"] for r in rows), default=0)
    given = texts.filter(F.col(text_col).isNotNull())
    if not sizes:
        return given.limit(0).withColumn("word", F.lit(None).cast("string"))
    text = look(F.col(text_col)).alias("__text")
    letters = _letters(known)
    between = "".join(c for c in map(chr, range(128)) if c not in letters)
    common = kept(_common(given.select(text).sample(share, SEED), between), "word-tokens")
    looks = known.groupBy("look").agg(F.collect_list("word").alias("words"))
    index = kept(_index(looks, common, sizes), "word-index")

    short = common.filter(F.length("__text") <= LETTERS)
    found = _places(short, sizes, around).join(index, F.col("__gram") == F.col("gram")).filter(_stands_first())
    found = kept(found.select("__text", "n", "look", "words"), "word-found")
    alone = kept(_alone(found, common), "word-alone")
    rest = alone.select("look")
    tokens = _as_broadcast(kept(_words_of_tokens(found.join(rest, "look", "left_anti"), common), "word-lists"))
    index = kept(index.join(rest, "look", "left_anti"), "word-index")
    # At most ``GRAM`` rows, and ``ALONE``.
    sizes = sorted(r["n"] for r in index.select(F.length("gram").alias("n")).distinct().collect()) or [GRAM]
    often = [word for r in alone.collect() for word in r["words"]]

    gathered = _search(given.select("*", text), tokens, index, sizes, around, between)
    tried = F.array(*map(F.lit, often)) if often else F.array().cast("array<string>")
    each = gathered.select("*", F.posexplode(F.concat("__words", tried)).alias("__at", "word"))
    stands = F.when(F.col("__at") >= F.size("__words"), F.contains("__whole", look(F.col("word")))).otherwise(True)
    return each.filter(stands).select(*texts.columns, "word")


def _search(texts: DataFrame, tokens: DataFrame, index: DataFrame, sizes: Sequence[int], around: int, between: str) -> DataFrame:
    """``texts`` with ``__words``, those of ``tokens`` and ``index`` that stand in ``__text``, which becomes ``__whole``.

    Texts are dealt by a number, and what their tokens hold is gathered by that number without another shuffle.
    """
    columns = [*(c for c in texts.columns if c != "__text"), "__whole"]
    given = texts.withColumnRenamed("__text", "__whole").withColumn("__id", F.monotonically_increasing_id())
    given = _spread(given.withColumn("__deal", F.shiftright("__id", BLOCK)), "__deal")
    each = given.select("*", F.posexplode(_tokens(F.col("__whole"), between)).alias("__at", "__text"))
    # The text goes along with its first token alone.
    each = each.select("__deal", "__id", "__text", *[F.when(F.col("__at") == 0, F.col(c)).alias(c) for c in columns], "__at")
    each = each.join(tokens, F.col("__text") == F.col("__token"), "left").drop("__token")
    unknown = F.col("__here").isNull()
    each = each.filter(unknown | (F.size("__here") > 0) | (F.col("__at") == 0))
    met = _places(each, sizes, around, unknown)
    # Known tokens meet no gram, each by another key, so that none is a hot one.
    key = F.when(unknown, F.col("__gram")).otherwise(F.concat(F.lit(between[:1]), F.col("__text")) if between else F.lit(None))
    met = met.withColumn("__key", key).join(index, F.col("__key") == F.col("gram"), "left")
    met = met.filter(F.when(unknown, F.col("look").isNotNull() & _stands_first()).otherwise(True))
    words = F.when(unknown, F.col("words")).otherwise(F.col("__here"))
    gathered = met.groupBy("__deal", "__id").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in columns],
        F.array_distinct(F.flatten(F.collect_list(words))).alias("__words"),
    )
    return gathered.drop("__deal", "__id")
