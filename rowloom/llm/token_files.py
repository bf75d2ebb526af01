"""Token ids in ORC files, in ascending order of document ids.

Texts are dealt to ranges of ids and sorted inside each, so that the files, one a range, are in order; encoding comes after that shuffle
and moves nothing.  A row holds a document's ids as an integer list, which ORC writes with its integer run-length encoding,
in stripes of ``STRIPE`` bytes.  Spark reads stripes in parallel; row indexes every ``STRIDE`` rows and Bloom
filters on the document ids let a reader of some documents skip stripes and row groups by their metadata.

Rows carry their place in the range and the ids before them there, so the place of a document in the whole corpus is
that plus one running sum over ranges.

Encoding is that of the ``tokenizers`` library on whole texts.  A byte-level BPE vocabulary with the usual pattern never joins
two words across a single space or line end, nor a word and the mark behind it, so a text may be cut there.  The cuts are found
on the bytes of a batch at once, the pieces of a batch are made distinct, and the library encodes those that the task
has not met lately, many in one text; ids are dealt back to pieces by their lengths in bytes.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from rowloom.llm.common import bounded, table, text_of
from rowloom.session import shared_folder

#: Where the vocabulary is; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: The id put behind each document.
END = 2
#: Bytes of a stripe, rows between two entries of a row index, share of wrong hits of a Bloom filter.
STRIPE, STRIDE, WRONG = 16 << 20, 1000, 0.01
#: Bytes of text that a task encodes at once.
SLICE = 16 << 20
#: Pieces of one generation that a task remembers; it keeps two.
KNOWN = 250_000
#: New words that are joined to one text for the library.
JOINED = 500
#: Ranges up to which their running sums are broadcast.
RANGES = 100_000
COLUMNS = "shard int, place long, before long, doc_id {id}, n_tokens long, ids array<int>"

SPACE, LINE = 0x20, 0x0A
# First bytes of UTF-8 characters among which there is white space beyond ASCII.
WIDE_STARTS = (0xC2, 0xE1, 0xE2, 0xE3)


def _table(values: Iterable[int]) -> np.ndarray:
    made = np.zeros(256, bool)
    made[list(values)] = True
    return made


# Fixed value: how a byte-level vocabulary shows bytes.  Printable ones stand for themselves, the others follow from 256 on.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
HIDDEN = [n for n in range(256) if n not in PRINTABLE]
SHOWN = {n: chr(256 + k) for k, n in enumerate(HIDDEN)}
#: A space and Latin letters; the group is found if one has an accent.
WORD = re.compile(rb" [A-Za-z]*((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)?").fullmatch


def shown(text: bytes) -> str:
    """Words and spaces as a byte-level vocabulary shows them."""
    if text.isascii():
        return text.decode("ascii").replace(" ", SHOWN[SPACE])
    return text.decode("latin-1").translate(SHOWN)


#: Bytes that are white space, bytes that may open such a character, letters, marks behind words.
LOW = _table(range(SPACE + 1))
WIDE = _table(WIDE_STARTS)
LETTER = _table(n for n in range(128) if chr(n).isalpha())
MARK = _table(b",.;:!?")


def piece_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where pieces of the joined texts start.

    These are the starts of texts, single spaces between other characters, both sides of single line ends, and marks that follow an
    ASCII letter.  White space beside a character that may be white space is no cut, which makes a piece longer, never wrong.
    """
    # Three bytes on the left and one on the right; zeros, which are no cuts, stand beyond the ends.
    wide = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)])
    blank = np.flatnonzero((data == SPACE) | (data == LINE))
    last, follow = wide[blank + 2], wide[blank + 4]
    open_left = LOW[last] | ((last >= 0x80) & (WIDE[wide[blank + 1]] | WIDE[wide[blank]]))
    blank = blank[~(open_left | LOW[follow] | WIDE[follow])]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = cut[blank] = True
    cut[blank[data[blank] == LINE] + 1] = True
    cut[1:-1] |= MARK[data[1:]] & LETTER[data[:-1]]
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Ids of pieces under one vocabulary file, with the pieces met lately."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The same merges for bytes that are shown already, cut before each space.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Split(SHOWN[SPACE], "merged_with_next")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # A character of a byte-level token is one byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, n in vocabulary.items():
            self.bytes_of[n] = len(token)
        # Ids are held as the bytes of 32-bit numbers.
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _words(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of words with their spaces.  Each is one piece of the pattern too, so many go through the merges at once, cut at the spaces."""
        groups = [b"".join(pieces[at : at + JOINED]) for at in range(0, len(pieces), JOINED)]
        texts = [shown(group) for group in groups]
        made = self.merges.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(one.ids, np.int32) for one in made])
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        cuts = ((np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def _others(self, pieces: list[bytes]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(one.ids, np.int32).tobytes() for one in made]

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece."""
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        new = [n for n, known in enumerate(found) if known is None]
        words, accented, others = [], [], []
        for n in new:
            piece = pieces[n]
            known = old.get(piece)
            if known is not None:
                found[n] = young[piece] = known
            else:
                kind = WORD(piece)
                (others if kind is None else accented if kind[1] else words).append(n)
        for places, encode in ((words, self._words), (accented, self._words), (others, self._others)):
            if places:
                for n, ids in zip(places, encode([pieces[n] for n in places]), strict=True):
                    found[n] = young[pieces[n]] = ids
        if len(young) > KNOWN:
            self.young, self.old = {}, young
        return found

    def documents(self, data: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the joined texts ``data`` that open at ``starts``, ``end`` behind each, and where the next one's open."""
        filled = np.append(starts[1:], len(data)) > starts
        cuts = piece_starts(data, starts[filled]) if len(data) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(data)) if len(cuts) else cuts
        offsets = np.append(cuts, ends[-1:]).astype(np.int64)
        given = pa.Array.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        lists = [*self.ids(given.dictionary.to_pylist()), np.int32(end).tobytes()]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        pool = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(lists), np.int32))
        # Pieces of each text, then the end.
        behind = np.searchsorted(cuts, np.append(starts[1:], len(data)))
        behind[-1:] = len(cuts)
        order = np.insert(given.indices.to_numpy(zero_copy_only=False).astype(np.int64), behind, len(lists) - 1)
        through = np.cumsum(sizes[order])
        return pool.take(pa.array(order)).flatten().to_numpy(), through[behind + np.arange(len(starts))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; read once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def _slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    first, held = 0, 0
    for n, size in enumerate(sizes.tolist()):
        if n > first and held + size > limit:
            yield first, n
            first, held = n, 0
        held += size
    if len(sizes):
        yield first, len(sizes)


def encoded(texts: pa.Array, path: str, end: int, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of ``texts``, none of them null: first and last row (excluded), their ids, and where the ids of each one stop."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    for a, b in _slices(np.diff(offsets), limit):
        part = data[offsets[a] : offsets[b]]
        yield a, b, *encoder(path).documents(part, offsets[a:b] - offsets[a], end)


def _rows(docs: DataFrame, path: str, end: int) -> DataFrame:
    """``docs`` (doc_id, text) in their order, encoded, with the places in their partition."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for a, b, ids, stops in encoded(batch.column("text"), path, end):
                sizes = np.diff(stops, prepend=0)
                columns = [
                    pa.array(np.full(b - a, shard, np.int32)),
                    pa.array(np.arange(place, place + b - a)),
                    pa.array(before + stops - sizes),
                    batch.column("doc_id")[a:b],
                    pa.array(sizes),
                    pa.ListArray.from_arrays(np.append(0, stops).astype(np.int32), pa.array(ids)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                place, before = place + b - a, before + len(ids)

    return docs.mapInArrow(run, COLUMNS.format(id=docs.schema["doc_id"].dataType.simpleString()))


def write_tokens(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = VOCABULARY,
    end: int = END,
    stripe: int = STRIPE,
    stride: int = STRIDE,
) -> None:
    """Write the token ids of ``docs`` to ORC files below ``folder``: ``shard, place, before, doc_id, n_tokens, ids``.

    Rows are ordered by id, null ids last; rows of one id by the digest of their text, and equal rows in any order, so a hot id
    or text is cut into several files.  A null or empty text is the end id alone.  The strings of special tokens in a text
    become their ids, as the library does by default.  Empty input writes files without rows.  Other columns are not read.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    given = given.withColumn("__digest", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_last(), F.col("__digest"), F.col("__row")]
    sorted_ = given.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    (
        _rows(sorted_, path, end)
        .write.option("orc.stripe.size", stripe)
        .option("orc.row.index.stride", stride)
        # How often a writer looks at the size of its stripe, in rows.
        .option("orc.rows.between.memory.checks", 100)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", WRONG)
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``folder`` with ``start``, the ids of all documents before.  A filter on ``doc_id`` skips stripes by their metadata."""
    rows = spark.read.orc(folder)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("all"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range, that is a file.
    starts = totals.select("shard", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("__start"))
    return rows.join(bounded(starts, RANGES), "shard").withColumn("start", F.col("__start") + F.col("before")).drop("__start")


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` instead of ``ids``: the checksum of the ids as little-endian 32-bit numbers."""
    out = T.StructType([f for f in rows.schema.fields if f.name != "ids"]).add("ids_crc32", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = memoryview(lists.values.to_numpy().astype("<u4", copy=False).view(np.uint8))
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            found = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column(n) for n in batch.schema.names if n != "ids"]
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], names=[*names, "ids_crc32"])

    return rows.mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are written as token files in the shared folder; the result comes from the files."""
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return checksums(read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids"))


ORACLE_SQL = None
