"""Exact substring dedup by interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document with a smaller id is found.

Texts are cut into overlapping segments by minimizers: a string of ``LENGTH`` bytes is named by the smallest hash of the
``ANCHOR``-byte strings in it, and a segment holds all strings around one such anchor.  Equal strings have equal anchors.  So
anchors are compared first, a few packed bytes each; only segments whose anchor is in several documents are dealt to
blocks, by anchor, and blocks are independent.  The number of blocks grows with the bytes of the corpus, so a block stays
small.  Strings never cross a segment, and segments never cross a document.

In a block, equal segments are one text of the smallest document, and the transform of all texts is expanded: starting from the empty string, intervals of suffixes are extended
backwards by one byte, breadth first, and each right end that is new sets a common-prefix length (Beller and others,
2013).  Lengths come in increasing order, so the expansion stops at ``LENGTH``; suffixes without a boundary
between them then share that many bytes.

An anchor that very many documents share would fill one block.  Such anchors are estimated from a sample of the ids, and their strings are
hashed one by one and compared in a plain aggregation instead, which no key can clog.  The route changes the cost, never the result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from rowloom.llm.common import kept, table, text_of

#: Bytes of a repeated string, and of an anchor.
LENGTH, ANCHOR = 50, 16
#: Bytes of segments with a shared anchor for which there is one block.
BLOCK_BYTES = 3 << 19
#: Bytes of text that a task cuts at once.
PART_BYTES = 16 << 20
#: Occurrences from which an anchor is taken out of the blocks, and the share of ids this is estimated from.
HOT, SAMPLED = 50_000, 64
#: Never part of UTF-8: stands between segments.
SEPARATOR = 0xFF
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Longer than any string.
FAR = 1 << 40


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, first starts and last starts of the segments of one text."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Unaligned 8-byte views: the string at i and the one 8 bytes on.
    count = len(data) - ANCHOR + 1
    eight = np.ndarray(len(data) - 7, np.uint64, data, strides=(1,))
    h = (eight[:count] * MIX) ^ (eight[ANCHOR - 8 :] * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    # Smallest hash of each window, by doubling.
    window, have = length - ANCHOR + 1, 1
    low = h
    while have * 2 <= window:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < window:
        low = np.minimum(low[: n], low[window - have : window - have + n])
    opens = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    return low[opens], opens, np.append(opens[1:], n) - 1


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``text`` ordered by at least their first ``depth`` bytes, by prefix doubling."""
    n = len(text)
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    key = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    rank = np.empty(n, np.int64)
    head = np.append(True, ordered[1:] != ordered[:-1])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    done = 8
    while done < depth:
        # Only groups of several suffixes are sorted on.
        single = head & np.append(head[1:], True)
        at = np.flatnonzero(~single)
        if not len(at):
            break
        some = order[at]
        follow = np.where(some + done < n, rank[np.minimum(some + done, n - 1)] + 1, 0)
        by = rank[some] * (n + 1) + follow
        turn = np.argsort(by, kind="stable")
        order[at] = some[turn]
        by = by[turn]
        fresh = np.append(True, by[1:] != by[:-1])
        head[at] |= fresh
        rank[order[at]] = np.maximum.accumulate(np.where(head, np.arange(n), 0))[at]
        done *= 2
    return order


def _shared_bytes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many of its first eight bytes each suffix in ``order`` shares with the one before; none for the first."""
    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    key = np.ndarray(len(text), ">u8", padded, strides=(1,)).astype(np.uint64)[order]
    differ = key[1:] ^ key[:-1]
    shared = np.zeros(len(text), np.int8)
    for n in range(1, 9):
        shared[1:] += differ < np.uint64(1 << (64 - 8 * n)) if n < 8 else differ == 0
    return shared


def boundaries(
    text: np.ndarray, order: np.ndarray, length: int, owners: np.ndarray | None = None, depths: np.ndarray | None = None
) -> np.ndarray:
    """For each place in ``order`` whether it shares fewer than ``length`` bytes with the one before.

    The intervals of one string length are extended by all bytes before them together.  The last occurrence of a byte in an
    interval leads to the right end of the longer string's interval, the first one to its left end.  The first eight bytes
    are compared directly; the expansion starts with the strings of eight bytes.

    With ``owners``, the document of each place in ``text``, an interval of one document alone is not extended: no string that
    ends in its string is in another document.  The length of its string goes to ``depths``, by place in ``text``, where that is
    shorter.  Boundaries between strings of fewer documents than two may then be missing, behind which ``depths`` tells them.
    """
    n, first = len(text), min(8, length)
    shared = _shared_bytes(text, order)
    known = np.append(shared < first, True)
    known[0] = True
    if owners is not None:
        of = owners[order]
        change = np.maximum.accumulate(np.where(np.append(True, of[1:] != of[:-1]), np.arange(n), 0))

    def several(left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        if owners is None:
            return left, right
        alone = change[right] <= left
        places = order[_ranges(left[alone], right[alone] - left[alone] + 1)]
        depths[places] = np.minimum(depths[places], size)
        return left[~alone], right[~alone]

    left = np.flatnonzero(known[:n])
    left, right = several(left, np.append(left[1:], n) - 1, first)
    if first == length:
        return known[:n]
    # Only ends that this length has set: the others belong to shorter strings.
    fresh = np.append(shared, 0)[right + 1] == first - 1
    fresh &= right + 1 < n
    left, right = left[fresh], right[fresh]
    before = text[order - 1]
    # The text ends with a separator, so the first suffix too has a byte before it: texts are taken as a ring.
    by_byte = np.argsort(before, kind="stable")
    leads = np.empty(n, np.int64)
    leads[by_byte] = np.arange(n)
    same = before[by_byte][1:] == before[by_byte][:-1]
    later, earlier = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    later[by_byte[:-1][same]] = by_byte[1:][same]
    earlier[by_byte[1:][same]] = by_byte[:-1][same]
    for size in range(first + 1, length + 1):
        if not len(left):
            break
        sizes = right - left + 1
        at = _ranges(left, sizes)
        ends = leads[at[later[at] > np.repeat(right, sizes)]]
        starts = leads[at[earlier[at] < np.repeat(left, sizes)]]
        ends.sort()
        starts.sort()
        new = ~known[ends + 1]
        left, right = starts[new], ends[new]
        known[right + 1] = True
        left, right = several(left, right, size)
    return known[:n]


def repeated_in_block(
    anchors: np.ndarray, docs: np.ndarray, starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, starts and ends in bytes of the repeated stretches of a block's segments."""
    none = (np.zeros(0, np.int64),) * 3
    # Segments whose anchor is in several documents.
    by_anchor = np.argsort(anchors, kind="stable")
    heads = np.flatnonzero(np.append(True, anchors[by_anchor][1:] != anchors[by_anchor][:-1]))
    low = np.minimum.reduceat(docs[by_anchor], heads)
    high = np.maximum.reduceat(docs[by_anchor], heads)
    several = np.zeros(len(anchors), bool)
    several[by_anchor] = np.repeat(low < high, np.diff(np.append(heads, len(anchors))))
    chosen = np.flatnonzero(several)
    if not len(chosen):
        return none
    places = np.cumsum(sizes) - sizes
    raw = data.tobytes()
    # Equal segments are one text, of the smallest document.
    number: dict[bytes, int] = {}
    of = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(places[chosen].tolist(), (places + sizes)[chosen].tolist(), strict=True)])
    owner = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(owner, of, docs[chosen])
    later = docs[chosen] > owner[of]
    joined = np.frombuffer(b"\xff".join([*number, b""]), np.uint8)
    lengths = np.fromiter(map(len, number), np.int64, len(number))
    order = suffix_order(joined, length)
    owners = np.repeat(owner, lengths + 1)
    depths = np.full(len(joined), FAR, np.int64)
    fewer = boundaries(joined, order, length, owners, depths)
    # Strings that reach the end of a segment are none.  Nor is one that holds a string of one document alone: its
    # end lies at the smallest end of such strings from its start on.
    within = _ranges(np.zeros(len(lengths), np.int64), lengths + 1)
    places = np.arange(len(joined))
    alone = np.minimum.accumulate((depths + places)[::-1])[::-1] - places <= length
    whole = (within + length <= np.repeat(lengths, lengths + 1)) & ~alone
    # The smallest document of each class of strings.
    seen = np.where(whole, owners, np.iinfo(np.int64).max)[order]
    classes = np.flatnonzero(fewer)
    smallest = np.empty(len(joined), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(seen, classes), np.diff(np.append(classes, len(order))))
    repeated = whole & (smallest < owners)
    # Runs of repeated starts in each text, for the occurrences in its own document.
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    run_starts, run_ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_at = np.cumsum(lengths + 1) - (lengths + 1)
    run_of = np.searchsorted(text_at, run_starts, side="right") - 1
    first_run = np.searchsorted(run_of, np.arange(len(lengths)))
    n_runs = np.bincount(run_of, minlength=len(lengths))
    own = chosen[~later]
    own_of = of[~later]
    runs = _ranges(first_run[own_of], n_runs[own_of])
    shift = np.repeat(starts[own] - text_at[own_of], n_runs[own_of])
    copied = chosen[later]
    return (
        np.concatenate([docs[copied], np.repeat(docs[own], n_runs[own_of])]),
        np.concatenate([starts[copied], run_starts[runs] + shift]),
        np.concatenate([starts[copied] + sizes[copied], run_ends[runs] + shift + length - 1]),
    )


def _pack(*parts: np.ndarray) -> bytes:
    """Arrays as one compressed value, the bytes of equal weight next to each other."""
    raw = [np.ascontiguousarray(p) for p in parts]
    planes = [r.view(np.uint8).reshape(-1, r.itemsize).T.tobytes() for r in raw]
    head = struct.pack(f"<{len(raw)}q", *map(len, planes))
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(types), []
    for kind, size in zip(types, struct.unpack_from(f"<{len(types)}q", raw), strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size
    return out


def _texts(rows: pd.DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The texts of a batch in parts of bounded size, each with a document's id."""
    part, held = [], 0
    for doc_id, text in zip(rows["doc_id"].tolist(), rows["text"].tolist(), strict=True):
        data = text.encode("utf-8", "surrogatepass")
        part.append((doc_id, data))
        held += len(data)
        if held >= PART_BYTES:
            yield part
            part, held = [], 0
    if part:
        yield part


def _cut(part: list[tuple[int, bytes]], length: int):
    """The segments of a part: anchors, documents, starts, sizes, places in the joined bytes, and those bytes."""
    data = np.frombuffer(b"".join([d for _, d in part]), np.uint8)
    found, at = [], 0
    for doc_id, d in part:
        anchors, opens, closes = segments(data[at : at + len(d)], length)
        found.append((anchors, np.full(len(anchors), doc_id, np.int64), opens, closes - opens + length, opens + at))
        at += len(d)
    return [np.concatenate(x) for x in zip(*found, strict=True)], data


def _by_block(anchors: np.ndarray, blocks: int, within: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places ``within`` by block of their anchors."""
    block = ((anchors[within] >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    if len(order):
        heads = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1]))
        yield from zip(block[order][heads].tolist(), np.split(within[order], heads[1:]), strict=True)


def shared_anchors(docs: DataFrame, length: int, blocks: int, apart: np.ndarray) -> DataFrame:
    """``shared_id, anchors`` (their lower halves) of the documents with anchors that other documents have too."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part in _texts(rows):
                (anchors, ids, *_), _ = _cut(part, length)
                kept_here = np.flatnonzero(~np.isin(anchors, apart)) if len(apart) else np.arange(len(anchors))
                made = []
                for block, some in _by_block(anchors, blocks, kept_here):
                    # An anchor counts once in a document; sorted, differences of neighbours are small.
                    some = some[np.lexsort((ids[some], anchors[some].astype(np.uint32)))]
                    low, of = anchors[some].astype(np.uint32), ids[some]
                    once = np.append(True, (low[1:] != low[:-1]) | (of[1:] != of[:-1]))
                    low, of = low[once], of[once]
                    made.append((block, _pack(np.diff(low, prepend=np.uint32(0)), of)))
                yield pd.DataFrame(made, columns=["block", "blob"])

    def in_block(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b, np.uint32, np.int64) for b in rows["blob"]]
        low = np.concatenate([np.cumsum(p[0], dtype=np.uint32) for p in parts])
        ids = np.concatenate([p[1] for p in parts])
        order = np.argsort(low, kind="stable")
        low, ids = low[order], ids[order]
        heads = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        several = np.minimum.reduceat(ids, heads) < np.maximum.reduceat(ids, heads)
        chosen = np.repeat(several, np.diff(np.append(heads, len(low))))
        return pd.DataFrame({"shared_id": ids[chosen], "anchor": low[chosen].view(np.int32)})

    dealt = docs.mapInPandas(deal, "block long, blob binary").groupBy("block")
    found = dealt.applyInPandas(in_block, "shared_id long, anchor int")
    return found.groupBy("shared_id").agg(F.collect_list("anchor").alias("anchors"))


def repeated_stretches(docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, start, end`` in bytes of repeated stretches of ``docs`` (doc_id, text), overlapping and in no order."""
    total = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    apart = np.array(sorted(hot_anchors(docs, length, hot)), np.uint64)
    # Anchors are a few bytes each, so their blocks may hold those of more text.
    shared = kept(shared_anchors(docs, length, max(8, total // (5 * block_bytes)), apart), "shared-anchors")
    # A segment is a string and the places its anchor stays the smallest, half a window on average.
    segment = length + (length - ANCHOR) // 2
    blocks = max(8, -(-(shared.agg(F.sum(F.size("anchors"))).first()[0] or 0) * segment // block_bytes))
    texts = docs.join(shared, F.col("doc_id") == F.col("shared_id")).select("doc_id", "text", "anchors")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = 0
            for part in _texts(rows):
                (anchors, ids, starts, sizes, places), data = _cut(part, length)
                lists = rows["anchors"].iloc[at : at + len(part)]
                at += len(part)
                # Per document, by its place in the part: its number above the anchor makes one sorted search of all.
                number = np.repeat(np.arange(len(part)), [len(x) for x in lists]).astype(np.uint64) << np.uint64(32)
                wanted = np.sort(number | np.concatenate([np.asarray(x, np.int32).view(np.uint32) for x in lists]))
                sizes_of = [0, *np.cumsum([len(d) for _, d in part]).tolist()]
                own = (np.searchsorted(sizes_of, places, side="right") - 1).astype(np.uint64) << np.uint64(32)
                own |= anchors & np.uint64(0xFFFFFFFF)
                spot = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                chosen = np.flatnonzero(wanted[spot] == own)
                made = [
                    (
                        block,
                        _pack(
                            anchors[some].astype(np.uint32), ids[some], starts[some].astype(np.int32),
                            sizes[some].astype(np.int32), data[_ranges(places[some], sizes[some])],
                        ),
                    )
                    for block, some in _by_block(anchors, blocks, chosen)
                ]
                yield pd.DataFrame(made, columns=["block", "blob"])

    def in_block(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = (np.uint32, np.int64, np.int32, np.int32, np.uint8)
        arrays = [np.concatenate(x) for x in zip(*(_unpack(b, *kinds) for b in rows["blob"]), strict=True)]
        anchors, ids, starts, sizes, data = arrays
        found = repeated_in_block(anchors, ids, starts.astype(np.int64), sizes.astype(np.int64), data, length)
        return pd.DataFrame(dict(zip(("doc_id", "start", "end"), found, strict=True)))

    spans = "doc_id long, start int, end int"
    cold = texts.mapInPandas(deal, "block long, blob binary").groupBy("block").applyInPandas(in_block, spans)
    if not len(apart):
        return cold
    return cold.unionByName(_hot_stretches(docs, apart, length))


def hot_anchors(docs: DataFrame, length: int, hot: int) -> set[int]:
    """Anchors that about ``hot`` documents or more share, estimated from one id in ``SAMPLED``.

    Each anchor of the result stands for at least ``hot / SAMPLED`` sampled segments, which bounds their number.
    """
    def anchors_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part in _texts(rows):
                found = _cut(part, length)[0][0]
                values, counts = np.unique(found, return_counts=True)
                yield pd.DataFrame({"anchor": values.view(np.int64), "n": counts})

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)
    counted = sample.mapInPandas(anchors_of, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counted.filter(F.col("n") >= max(2, hot // SAMPLED)).collect()
    return {r["anchor"] % (1 << 64) for r in rows}


def _hot_stretches(docs: DataFrame, apart: np.ndarray, length: int) -> DataFrame:
    """The same for segments of hot anchors: strings by 128-bit digest, counted where they are before they meet."""

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for part in _texts(rows):
                (anchors, ids, starts, sizes, places), data = _cut(part, length)
                some = np.flatnonzero(np.isin(anchors, apart))
                raw, n = data.tobytes(), sizes[some] - length + 1
                at = _ranges(places[some], n).tolist()
                made = pd.DataFrame(
                    {
                        "high": np.array([xxh3_64_intdigest(raw[a : a + length], 1) for a in at], np.uint64).view(np.int64),
                        "low": np.array([xxh3_64_intdigest(raw[a : a + length], 2) for a in at], np.uint64).view(np.int64),
                        "doc_id": np.repeat(ids[some], n),
                        "start": _ranges(starts[some], n).astype(np.int32),
                    }
                )
                yield made

    found = kept(docs.mapInPandas(strings, "high long, low long, doc_id long, start int"), "hot-strings")
    first = found.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeats = found.join(first.filter("first < last").drop("last"), ["high", "low"]).filter("first < doc_id")
    return repeats.select("doc_id", "start", (F.col("start") + length).cast("int").alias("end"))


def _joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches as separate runs in order; stretches that touch are one run."""
    turn = np.argsort(starts, kind="stable")
    starts, reach = starts[turn], np.maximum.accumulate(ends[turn])
    opens = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return starts[opens], reach[np.append(opens[1:], len(starts)) - 1]


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``, the bytes that stay.

    A null text counts as empty.  Rows with a null id keep all bytes and are no source for others.  Rows of one id are one document to the
    search, so none is a repeat of another, and what is found in one is removed from each at the same places; ids
    should be distinct.  Texts below ``length`` bytes keep all.  Empty input gives no rows.  Other columns are not read.
    """
    # Both joins with the texts are by id, so the texts are shuffled once.  Spark sees that only if the two sides look
    # alike, which an alias of a column to its own name prevents.
    plain = id_col == "doc_id" and docs.schema[id_col].dataType == T.LongType()
    name = F.col(id_col) if plain else F.col(id_col).cast("long").alias("doc_id")
    slim = docs.select(name, text_of(text_col).alias("text"))
    named = slim.filter("doc_id IS NOT NULL")
    found = repeated_stretches(named, length, hot, block_bytes)
    stretches = (
        found.groupBy(F.col("doc_id").alias("found_id"))
        .agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = []
            for text, starts, ends in zip(rows["text"], rows["starts"], rows["ends"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                removed = spans = 0
                rest = data
                if starts is not None:
                    a, b = _joined(np.asarray(starts), np.minimum(np.asarray(ends), len(data)))
                    spans, removed = len(a), int((b - a).sum())
                    keep = zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)
                    rest = b"".join([data[x:y] for x, y in keep])
                made.append((len(data), removed, spans, hashlib.sha256(rest).hexdigest(), rest))
            out = pd.DataFrame(made, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            out.insert(0, "doc_id", rows["doc_id"].to_numpy())
            yield out

    unnamed = slim.filter("doc_id IS NULL").select("*", *[F.lit(None).cast("array<int>").alias(c) for c in ("starts", "ends")])
    joined = named.join(stretches, F.col("doc_id") == F.col("found_id"), "left").drop("found_id").unionByName(unnamed)
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.mapInPandas(cut, columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


ORACLE_SQL = None
