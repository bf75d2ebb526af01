"""Token counts that follow edits.

A text is cut into pre-tokens, the pieces a byte-level BPE vocabulary encodes on their own; its token count is the sum over its
pre-tokens.  Each document keeps a segment tree: leaves of ``LEAF`` pre-tokens with their characters and tokens,
inner nodes with sums.  An edit is located by its character place in the tree.  Pre-tokens are found from left to
right and a cut looks at most two characters ahead, so everything up to one leaf before the edit stays; re-encoding starts
there and ends at the first cut behind the edit that coincides with an old leaf boundary.  The leaves between are replaced and
the sums above them updated.

The table of trees is made once, in Arrow batches; edits meet it by id.  Pre-tokens repeat a lot, so each
task keeps the counts of the ones it has seen, up to a bound.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import table, text_of

#: Pre-tokens of a leaf.
LEAF = 32
#: Pre-tokens whose counts a task keeps.
KNOWN = 1_000_000
#: Where the vocabulary is; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TREE = "array<int>"


class Encoder:
    """Counts of pre-tokens under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(PATTERN).findall
        self.one = regex.compile(PATTERN).match
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(self.known) < KNOWN:
                self.known[piece] = n
        return n

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves of a whole text."""
        pieces = self.cut(text)
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        known = self.known
        tokens = np.fromiter([known.get(p) or self.count(p) for p in pieces], np.int64, len(pieces))
        starts = np.arange(0, len(pieces), LEAF)
        if not len(starts):
            return chars, tokens
        return np.add.reduceat(chars, starts), np.add.reduceat(tokens, starts)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; read once."""
    return Encoder(path)


class Tree:
    """Sums of characters and tokens over leaves: two binary trees in arrays, node i above 2i and 2i+1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.n = len(chars)
        self.base = 1 << max(0, (self.n - 1).bit_length())
        self.chars, self.tokens = (np.zeros(2 * self.base, np.int64) for _ in range(2))
        self.chars[self.base : self.base + self.n] = chars
        self.tokens[self.base : self.base + self.n] = tokens
        level = self.base
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place``, the last one for the end, and the characters before it."""
        node, before = 1, 0
        while node < self.base:
            node *= 2
            if place - before >= self.chars[node] and self.chars[node + 1]:
                before += int(self.chars[node])
                node += 1
        return node - self.base, before

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> "Tree":
        """Leaves ``first`` to ``last`` (excluded) replaced.  As many new ones as old are updated in place, on their paths alone."""
        if len(chars) == last - first:
            for k, (c, t) in enumerate(zip(chars, tokens, strict=True)):
                node = self.base + first + k
                by = c - int(self.chars[node]), t - int(self.tokens[node])
                while node:
                    self.chars[node] += by[0]
                    self.tokens[node] += by[1]
                    node //= 2
            return self
        old = slice(self.base, self.base + self.n)
        return Tree(
            *(
                np.concatenate([sums[old][:first], np.array(new, np.int64), sums[old][last:]])
                for sums, new in ((self.chars, chars), (self.tokens, tokens))
            )
        )


def edit(tree: Tree, text: str, start: int, end: int, put: str, code: Encoder) -> tuple[Tree, str, int]:
    """Replace characters ``start`` to ``end`` by ``put``: the new tree, the new text, the characters encoded again."""
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    new = text[:start] + put + text[end:]
    if not tree.n:
        made = Tree(*code.leaves(new))
        return made, new, len(new)
    leaf, before = tree.find(start)
    # A cut looks up to two characters ahead, so an edit at the front of a leaf reaches into the one before; the same
    # holds for the leaf before that if this one is a single character.
    while leaf and start - before < 3:
        leaf -= 1
        before -= int(tree.chars[tree.base + leaf])
    shift = len(put) - (end - start)
    after, old_end = leaf, before
    at, chars, tokens, held = before, [], [], 0
    while at < len(new):
        # Old leaf boundaries behind the edit, moved along with the text, are where this may end.
        while after < tree.n and (old_end < end or old_end + shift < at):
            old_end += int(tree.chars[tree.base + after])
            after += 1
        if at == old_end + shift and old_end >= end and at > start + len(put):
            break
        piece = code.one(new, at).group()
        if held % LEAF == 0:
            chars.append(0)
            tokens.append(0)
        chars[-1] += len(piece)
        tokens[-1] += code.count(piece)
        held += 1
        at += len(piece)
    else:
        after = tree.n
    return tree.replace(leaf, after, chars, tokens), new, at - before


def with_trees(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``leaf_chars`` and ``leaf_tokens``, the leaves of the tree of each text."""

    @F.pandas_udf(f"leaf_chars {TREE}, leaf_tokens {TREE}")
    def leaves(texts: pd.Series) -> pd.DataFrame:
        made = [encoder(path).leaves(t) for t in texts]
        return pd.DataFrame(
            {
                "leaf_chars": pd.Series([c.astype(np.int32) for c, _ in made], dtype=object),
                "leaf_tokens": pd.Series([t.astype(np.int32) for _, t in made], dtype=object),
            }
        )

    return docs.withColumn("__tree", leaves(text_of(text_col))).select("*", "__tree.*").drop("__tree")


def apply_edits(trees: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_tokens_after, n_encoded, text, leaf_chars, leaf_tokens`` after its edits.

    ``trees`` has ``doc_id, text``, the leaves, and ``edits``, an array of (start, end, put) that are applied one after the other to the
    text as the last one left it; null or empty leaves a document as it is.  Places beyond the text are moved to its end.
    ``n_encoded`` counts characters.
    """
    columns = f"doc_id long, n_tokens long, n_tokens_after long, n_encoded long, text string, leaf_chars {TREE}, leaf_tokens {TREE}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(path)
        for rows in batches:
            made = []
            for r in rows.itertuples(index=False):
                tree, text, encoded = Tree(np.asarray(r.leaf_chars), np.asarray(r.leaf_tokens)), r.text or "", 0
                before = int(tree.tokens[1]) if tree.n else 0
                for e in r.edits if r.edits is not None else ():
                    tree, text, n = edit(tree, text, e["start"], e["end"], e["put"] or "", code)
                    encoded += n
                leaves = slice(tree.base, tree.base + tree.n)
                made.append(
                    (
                        r.doc_id, before, int(tree.tokens[1]) if tree.n else 0, encoded, text,
                        tree.chars[leaves].astype(np.int32), tree.tokens[leaves].astype(np.int32),
                    )
                )
            yield pd.DataFrame(made, columns=[c.split()[0] for c in columns.split(", ")])

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInPandas(run, columns)


def count_with_edits(
    docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY
) -> DataFrame:
    """Trees of ``docs``, brought up to date with ``edits`` (doc_id, step, start, end, put).

    Edits of a document are applied by step, ties by place; edits of unknown or null ids are dropped.  A null text counts as empty and
    null places as 0.  Documents with a null id are counted and never edited; of repeated ids each row is edited.
    Empty input gives no rows.  Other columns are not read.
    """
    order = F.struct("step", F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("end", F.lit(0)).alias("end"), "put")
    listed = edits.groupBy(F.col("doc_id").alias("edited")).agg(F.sort_array(F.collect_list(order)).alias("edits"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return apply_edits(with_trees(slim, path=path).join(listed, F.col("doc_id") == F.col("edited"), "left"), path)


def sample_edits(docs: DataFrame) -> DataFrame:
    """Two edits for every document at places drawn from its id: words put in, and a stretch of up to 40 characters taken out."""
    n = F.length(text_of("text"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(n, F.lit(1))).cast("int")
    other = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.greatest(n, F.lit(1))).cast("int")
    length = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(41)).cast("int")

    def step(n: int, start: Column, end: Column, put: Column) -> Column:
        return F.struct(F.lit(n).alias("step"), start.alias("start"), end.alias("end"), put.alias("put"))

    put_in = F.concat(F.lit(" edit-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        "doc_id", "text", F.array(step(1, draw, draw, put_in), step(2, other, other + length, F.lit(""))).alias("edits")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with two edits each, which come with the rows here, so nothing is shuffled."""
    docs = sample_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return apply_edits(with_trees(docs)).select("doc_id", "n_tokens", "n_tokens_after", "n_encoded")


ORACLE_SQL = None
