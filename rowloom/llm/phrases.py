"""Phrase collocations counted in quotient filters.

Texts are cut into words once, in blocks of ``BLOCK`` bytes of one language: a block is the list of its distinct words and
the sequence of their numbers.  Only those lists are shuffled to count words over all documents.  Words that occur often enough to
stand in a candidate get dense ids, one for a word of a language, and come back to the blocks as numbers.

The ids of two or three neighbouring words are packed into one number of three equal parts, which an invertible permutation
(a Feistel network) spreads evenly.  Its high bits name a range of the key space, the next ones are the quotient, the
rest is the remainder; all bits are kept, so counts are exact.  A block turns its n-grams of each range into one counting quotient filter: per
quotient the number of its remainders in unary, the remainders in order, small counters.  Filters are sorted, so those of a
range are merged in one pass, and only there are frequent n-grams unpacked again.  The number of ranges grows with the
words of the corpus, so a range stays small, and a very frequent phrase is one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import bounded, kept, table, text_of

#: Occurrences from which a phrase is a candidate, and the share (in hundredths) of a longer one that drops it.
LEAST, SHARE = 10, 50
#: Phrases a language returns.
TOP = 2000
#: Bytes of text of a block; n-grams of a range.
BLOCK, RANGE = 8 << 20, 1 << 20
#: Words whose n-grams are packed at once.
STRETCH = 1 << 18
#: Partitions up to which the first ids of each are broadcast.
PARTS = 100_000
#: Groups of a language that are ranked on their own first.
SPREAD = 64
# The language of texts without one, and what words are not joined across.
NO_LANG = "und"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Never part of UTF-8: stands for a break.
BREAK = b"\xff"
LOWER = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + BREAK * len(BREAKS) + b" "
)
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts, a break first, and all words in order as numbers, with 0 for breaks."""
    # A break in front takes number 0.
    words = BREAK.join([b"", *texts]).translate(LOWER).replace(BREAK, b" \xff ").split()
    of = dict.fromkeys(words)
    for n, word in enumerate(of):
        of[word] = n
    return list(of), np.fromiter(map(of.__getitem__, words), np.uint32, len(words))


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their low halves first; the high halves are mostly zero and compress to nothing."""
    return numbers.astype("<u4").view("<u2").reshape(-1, 2).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(2, -1).T).view("<u4").ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, text) as blocks: ``block, lang, n, words, counts, sequence``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            order = np.argsort(langs.indices.to_numpy(), kind="stable")
            kind = langs.indices.to_numpy()[order]
            texts = batch.column("text").cast(pa.large_binary()).take(pa.array(order))
            ends = np.frombuffer(texts.buffers()[1], np.int64)[1 : len(order) + 1]
            at = 0
            while at < len(order):
                # Texts of one language up to the size of a block; a longer text is a block of its own.
                through = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right"))
                to = min(max(through, at + 1), int(np.searchsorted(kind, kind[at], "right")))
                words, numbers = numbered(texts[at:to].to_pylist())
                counts = np.bincount(numbers, minlength=len(words))
                counts[0] = 0
                row = {
                    "block": [made], "lang": [langs.dictionary[int(kind[at])].as_py()], "n": [int(counts.sum())],
                    "words": [[w.decode() for w in words[1:]]], "counts": [counts[1:]], "sequence": [_planes(numbers)],
                }
                yield pa.RecordBatch.from_pydict(row, SCHEMA)
                made, at = made + 1, to

    columns = "block long, lang string, n long, words array<string>, counts array<long>, sequence binary"
    return docs.mapInArrow(run, columns)


SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())), ("sequence", pa.binary()),
    ]
)


def _dense_ids(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` kept with ids from 1 on in a column ``id``, without a sort, and their number."""
    part, place = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = kept(df.withColumns({"__part": part, "__place": place}), name)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept(rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")), f"{name}-parts")
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    with_ids = rows.join(bounded(starts, PARTS), "__part").withColumn("id", F.col("__start") + F.col("__place") + 1)
    return with_ids.drop("__part", "__place", "__start"), sizes.agg(F.sum("__n")).first()[0] or 0


@dataclass(frozen=True)
class Packing:
    """How three ids of ``bits`` bits become a range of ``ranges`` bits and a key of the rest, at most 64."""

    bits: int
    ranges: int

    @classmethod
    def fitting(cls, ids: int, ngrams: int) -> Packing:
        bits = max(ids.bit_length(), 1)
        wanted = max(-(-ngrams // RANGE) - 1, 0).bit_length()
        return cls(bits, min(bits, max(wanted, 3 * bits - 64)))

    @property
    def key_bits(self) -> int:
        return 3 * self.bits - self.ranges

    def _rounds(self, high: np.ndarray, low: np.ndarray, factors: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        one, two = np.uint64((1 << self.bits) - 1), np.uint64((1 << 2 * self.bits) - 1)
        for n, factor in enumerate(factors):
            if (n % 2 == 0) != back:
                mixed = (high + np.uint64(1)) * factor
                low = low ^ ((mixed ^ mixed >> np.uint64(31)) & two)
            else:
                mixed = (low + np.uint64(1)) * factor
                high = high ^ ((mixed ^ mixed >> np.uint64(31)) & one)
        return high, low

    def pack(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges and keys of n-grams; a third id of 0 stands for two words."""
        b = np.uint64(self.bits)
        high, low = self._rounds(first, second << b | third, MIX, back=False)
        rest = np.uint64(self.bits - self.ranges)
        key = low if not rest else (high & np.uint64((1 << int(rest)) - 1)) << np.uint64(2 * self.bits) | low
        return high >> rest, key

    def unpack(self, range_: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b, rest = np.uint64(self.bits), np.uint64(self.bits - self.ranges)
        low = keys & np.uint64((1 << 2 * self.bits) - 1)
        high = np.full(len(keys), range_, np.uint64) << rest
        if rest:
            high = high | keys >> np.uint64(2 * self.bits)
        # An even number of rounds, each its own inverse, in the opposite order.
        high, low = self._rounds(high, low, MIX[::-1], back=True)
        return high, low >> b, low & np.uint64((1 << self.bits) - 1)


def to_filter(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """The counting quotient filter of distinct ``keys`` in order, numbers of ``bits`` bits."""
    n = len(keys)
    q = min(max(n - 1, 0).bit_length(), bits)
    r = bits - q
    quotients = (keys >> np.uint64(r)).astype(np.int64) if r < 64 else np.zeros(n, np.int64)
    # A one for each remainder and a zero behind the run of each quotient.
    runs = np.zeros(n + (1 << q), np.uint8)
    runs[quotients + np.arange(n)] = 1
    width = -(-r // 8)
    rests = (keys & np.uint64((1 << r) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    small = np.minimum(counts, 255).astype(np.uint8)
    head = np.array([n, q, bits], "<u4")
    large = counts[small == 255].astype("<u8")
    return b"".join(part.tobytes() for part in (head, np.packbits(runs), rests.T.copy(), small, large))


def from_filter(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and their counts."""
    n, q, bits = np.frombuffer(data, "<u4", 3).tolist()
    r = bits - q
    width, at = -(-r // 8), 12
    runs = np.unpackbits(np.frombuffer(data, np.uint8, -(-(n + (1 << q)) // 8), at), count=n + (1 << q))
    at += -(-len(runs) // 8)
    keys = np.zeros((n, 8), np.uint8)
    keys[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
    keys = keys.view("<u8").ravel()
    if q:
        keys = keys | (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64) << np.uint64(r)
    at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", -1, at + n).astype(np.int64)
    return keys, counts


def merged(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and counts of several filters as one."""
    parts = [from_filter(f) for f in filters]
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    # A stable sort merges runs that are in order already.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    opens = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[opens], np.add.reduceat(counts[order], opens) if len(opens) else counts


def _ngrams(words: np.ndarray, packing: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Ranges and keys of all pairs and triples of neighbouring ids; 0 is no id."""
    kind = np.uint16 if packing.ranges <= 16 else np.uint32
    ranges, keys = [np.zeros(0, kind)], [np.zeros(0, np.uint64)]
    for at in range(0, len(words), STRETCH):
        # Two words more, so that every n-gram starts in exactly one stretch.
        some = words[at : at + STRETCH + 2]
        first, second, third = some, np.append(some[1:], np.uint64(0)), np.append(some[2:], np.zeros(2, np.uint64))[: len(some)]
        two = np.flatnonzero((first > 0) & (second > 0))
        two = two[two < STRETCH]
        three = two[third[two] > 0]
        for places, last in ((two, np.zeros(len(two), np.uint64)), (three, third[three])):
            r, k = packing.pack(first[places], second[places], last)
            ranges.append(r.astype(kind))
            keys.append(k)
    return np.concatenate(ranges), np.concatenate(keys)


def _filters(blocks: DataFrame, packing: Packing) -> DataFrame:
    """``blocks`` (sequence, places, ids) as ``range, filter``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sequence, places, ids in zip(*(batch.column(c) for c in ("sequence", "places", "ids")), strict=True):
                numbers = _from_planes(sequence.as_buffer())
                of = np.zeros(int(numbers.max()) + 1 if len(numbers) else 1, np.uint64)
                of[places.values.to_numpy()] = ids.values.to_numpy()
                ranges, keys = _ngrams(of[numbers], packing)
                if not len(keys):
                    continue
                order = np.argsort(ranges, kind="stable")
                ranges, keys = ranges[order], keys[order]
                cuts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
                found = []
                for part in np.split(keys, cuts[1:]):
                    part.sort()
                    opens = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                    found.append(to_filter(part[opens], np.diff(np.append(opens, len(part))), packing.key_bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges[cuts].astype(np.int64)), pa.array(found, pa.binary())], names=["range", "filter"]
                )

    return blocks.mapInArrow(run, "range long, filter binary")


def _frequent(filters: DataFrame, packing: Packing, least: int) -> DataFrame:
    """N-grams with at least ``least`` occurrences: ``w1, w2, w3, a``; ``w3`` is 0 for two words."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merged(rows["filter"].tolist())
        often = counts >= least
        words = packing.unpack(int(key[0]), keys[often])
        return pd.DataFrame({**{f"w{n + 1}": w.astype(np.int64) for n, w in enumerate(words)}, "a": counts[often]})

    return filters.groupBy("range").applyInPandas(run, "w1 long, w2 long, w3 long, a long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), in whole numbers of up to 38 digits."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    top = F.lit(1_000_000).cast("decimal(7,0)") * (a * a)
    return F.call_function("div", top, left * right)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """The first ``top`` phrases of two or three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are lower-cased in A-Z; phrases do not cross ``.,;:!?`` or line ends and occur ``least`` times or more.  The cut of a
    phrase with the lowest score gives ``l``, ``r`` and ``score``.  Phrases go if a longer one that holds them occurs in at least ``share``
    hundredths of their places.  A null text is empty, a null language is ``und``; repeated rows count each.  Empty input,
    or no frequent phrase, gives no rows.  Other columns are not read.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    blocks = kept(_blocks(docs.select(lang.alias("lang"), text_of(text_col).alias("text"))), "phrase-blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    listed = blocks.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("f"))))
    often = listed.groupBy("lang", "word").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    vocabulary, ids = _dense_ids(often, "phrase-words")
    vocabulary = kept(vocabulary, "phrase-ids")
    packing = Packing.fitting(ids, 2 * all_words)

    # The vocabulary has one row a word, so Spark can cut a word that is in very many blocks.
    placed = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    known = placed.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    numbers = known.groupBy("block").agg(F.collect_list(F.struct((F.col("place") + 1).alias("place"), "id")).alias("of"))
    ready = blocks.select("block", "sequence").join(numbers, "block")
    ready = ready.select("sequence", F.col("of.place").alias("places"), F.col("of.id").alias("ids"))
    found = kept(_frequent(_filters(ready, packing), packing, least), "phrases")

    two, three = found.filter("w3 = 0"), found.filter("w3 > 0")
    pairs = two.select("w1", "w2", F.col("a").alias("f"))

    def pair(first: str, second: str, name: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("f").alias(name))

    inside = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = inside.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    alone = two.join(longest, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    shapes = alone.select("w1", "w2", "w3", "a", F.lit(None).cast("long").alias("f12"), F.lit(None).cast("long").alias("f23"))
    shapes = shapes.unionByName(three.join(pair("w1", "w2", "f12"), ["w1", "w2"]).join(pair("w2", "w3", "f23"), ["w2", "w3"]))
    for n in (1, 2, 3):
        names = vocabulary.select(
            F.col("id").alias(f"w{n}"), F.col("word").alias(f"t{n}"), F.col("f").alias(f"f{n}"), *(["lang"] if n == 1 else [])
        )
        shapes = shapes.join(names, f"w{n}", "left" if n == 3 else "inner")
    long = F.col("w3") > 0
    cuts = shapes.select(
        "lang",
        F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"),
        "a",
        F.col("f1").alias("l1"),
        F.when(long, F.col("f23")).otherwise(F.col("f2")).alias("r1"),
        F.col("f12").alias("l2"),
        F.col("f3").alias("r2"),
    )
    cuts = cuts.withColumns({"s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    later = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = cuts.select(
        "lang", "phrase", "a",
        *[F.when(later, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))],
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order)))
    first = some.filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
ones AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(ws) AS w FROM lists) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
twos AS (
  SELECT lang, g[1] AS w1, g[2] AS w2, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]])) AS g FROM lists)
  GROUP BY ALL HAVING count(*) >= 10),
threes AS (
  SELECT lang, g[1] AS w1, g[2] AS w2, g[3] AS w3, count(*) AS f
  FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS g FROM lists)
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(f) AS f
  FROM (SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN ones y ON y.lang = t.lang AND y.w = t.w2
  LEFT JOIN longer o ON o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2
  WHERE o.f IS NULL OR 100 * o.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w = t.w3),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
