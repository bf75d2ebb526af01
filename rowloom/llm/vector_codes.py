"""Product codes of vectors, with codebooks found by dual-tree Lloyd rounds in whole numbers.

Vectors become whole numbers and are cut into parts.  The vectors of a block form, for each part, a tree: halves
by the widest coordinate down to leaves of ``LEAF``, with boxes and cached sums.  The entries of a part's codebook form a tree of their
own.  A round walks both trees at once, from pairs of large nodes to pairs of small ones, and drops a node of entries where
its least distance to a box of vectors is above the greatest one of another.  Single entries are dropped where another one is nearer to
all of a box: the difference of two distances is linear, so its maximum over a box is exact.  A node of vectors for which one entry is left is
assigned as a whole, by its cached sums; leaves with several are compared vector by vector.  All bounds are whole numbers, so
equal distances are kept until the lower index decides, and the result is that of plain Lloyd rounds.

Trees are made once and kept.  A round is one pass over them with the codebooks, whose size does not depend on the number of
vectors; it sends sums and counts of entries only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import kept, table
from rowloom.operators.joins import group_apart

#: Parts of a vector, entries of a codebook, rounds; what a component is multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block and of a leaf.
BLOCK, LEAF = 4096, 32


def cuts(n: int, level: int) -> np.ndarray:
    """Where the nodes of one level of a tree over ``n`` rows open, and the end."""
    return n * np.arange((1 << level) + 1) >> level


def order_of(rows: np.ndarray, height: int) -> np.ndarray:
    """An order of ``rows`` in which every node is a stretch: halves by the widest coordinate."""
    n, order = len(rows), np.arange(len(rows))
    if not rows.shape[1]:
        return order
    for level in range(height):
        bounds, halves = cuts(n, level).tolist(), cuts(n, level + 1).tolist()
        for i in range(1 << level):
            a, b, middle = bounds[i], bounds[i + 1], halves[2 * i + 1]
            some = rows[order[a:b]]
            by = some[:, np.argmax(some.max(axis=0) - some.min(axis=0))]
            order[a:b] = order[a:b][np.argpartition(by, middle - a)]
    return order


def height_of(n: int, leaf: int) -> int:
    """Levels below the root, so that leaves hold about ``leaf`` rows and none is empty."""
    return max((n // leaf).bit_length() - 1, 0) if n else 0


class Boxes:
    """Lowest and highest coordinates, and sums, of the nodes of each level, the root first."""

    def __init__(self, lowest: np.ndarray, highest: np.ndarray, sums: np.ndarray | None = None):
        self.lowest, self.highest, self.sums = [lowest], [highest], [sums]
        while len(self.lowest[0]) > 1:
            self.lowest.insert(0, np.minimum(self.lowest[0][::2], self.lowest[0][1::2]))
            self.highest.insert(0, np.maximum(self.highest[0][::2], self.highest[0][1::2]))
            if sums is not None:
                self.sums.insert(0, self.sums[0][::2] + self.sums[0][1::2])

    @classmethod
    def over(cls, rows: np.ndarray, height: int) -> Boxes:
        opens = cuts(len(rows), height)[:-1]
        return cls(*(by.reduceat(rows, opens, axis=0) for by in (np.minimum, np.maximum, np.add)))

    @property
    def height(self) -> int:
        return len(self.lowest) - 1


class Codebook:
    """The entries of one part with their tree."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        height = height_of(len(entries), 1)
        self.order = order_of(entries, height)
        self.boxes = Boxes.over(entries[self.order], height)
        self.bounds = cuts(len(entries), height)
        self.norms = (entries * entries).sum(axis=1)


def _apart(boxes: Boxes, at: int, nodes: np.ndarray, book: Codebook, level: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of pairs of boxes."""
    low, high = boxes.lowest[at][nodes], boxes.highest[at][nodes]
    low_c, high_c = book.boxes.lowest[level][others], book.boxes.highest[level][others]
    gap = np.maximum(np.maximum(low - high_c, low_c - high), 0)
    far = np.maximum(high - low_c, high_c - low)
    return (gap * gap).sum(axis=1), (far * far).sum(axis=1)


def _nearer(boxes: Boxes, at: int, nodes: np.ndarray, book: Codebook, entries: np.ndarray) -> np.ndarray:
    """Pairs (node, entry) that stay: no other entry is nearer in all of the box, or as near with a lower index."""
    low, high = boxes.lowest[at][nodes], boxes.highest[at][nodes]
    c = book.entries
    middle = low + high - 2 * c[entries]
    middle = (middle * middle).sum(axis=1)
    size = len(boxes.lowest[at])
    least = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(least, nodes, middle)
    rival = np.full(size, len(c))
    best = middle == least[nodes]
    np.minimum.at(rival, nodes[best], entries[best])
    rival = rival[nodes]
    toward = c[rival] - c[entries]
    lead = book.norms[rival] - book.norms[entries] - 2 * np.where(toward > 0, low * toward, high * toward).sum(axis=1)
    return ~((lead < 0) | ((lead == 0) & (rival < entries)))


def _pairs(a: np.ndarray, b: np.ndarray, split_a: bool, split_b: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the children of pairs."""
    if split_a:
        a, b = np.concatenate([2 * a, 2 * a + 1]), np.concatenate([b, b])
    if split_b:
        a, b = np.concatenate([a, a]), np.concatenate([2 * b, 2 * b + 1])
    return a, b


def assign(rows: np.ndarray, boxes: Boxes, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each of ``rows``, in the order of their tree; sums and counts of the rows of each entry."""
    n, c = len(rows), book.entries
    chosen = np.zeros(n, np.int64)
    sums, counts = np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64)
    nodes, others, level, at = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    # Entries go down two levels for one of the vectors, so that large nodes meet single entries early.
    while level < book.boxes.height:
        for last in (False, True):
            if level < book.boxes.height:
                split = last and at < boxes.height
                nodes, others = _pairs(nodes, others, split, True)
                level, at = level + 1, at + split
                least, greatest = _apart(boxes, at, nodes, book, level, others)
                bound = np.full(len(boxes.lowest[at]), np.iinfo(np.int64).max)
                np.minimum.at(bound, nodes, greatest)
                stay = least <= bound[nodes]
                nodes, others = nodes[stay], others[stay]
    sizes = np.diff(book.bounds)[others]
    nodes = np.repeat(nodes, sizes)
    ends = np.cumsum(sizes)
    entries = book.order[np.arange(ends[-1]) - np.repeat(ends - sizes - book.bounds[:-1][others], sizes)]
    while True:
        stay = _nearer(boxes, at, nodes, book, entries)
        nodes, entries = nodes[stay], entries[stay]
        left = np.bincount(nodes, minlength=len(boxes.lowest[at]))
        whole = left[nodes] == 1
        bounds = cuts(n, at)
        np.add.at(sums, entries[whole], boxes.sums[at][nodes[whole]])
        np.add.at(counts, entries[whole], np.diff(bounds)[nodes[whole]])
        for node, entry in zip(nodes[whole].tolist(), entries[whole].tolist(), strict=True):
            chosen[bounds[node] : bounds[node + 1]] = entry
        nodes, entries = nodes[~whole], entries[~whole]
        if at == boxes.height:
            break
        nodes, entries = _pairs(nodes, entries, True, False)
        at += 1
    by = np.lexsort((entries, nodes))
    nodes, entries = nodes[by], entries[by]
    opens = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, np.int64)
    for node, some in zip(nodes[opens].tolist(), np.split(entries, opens[1:]), strict=False):
        part = rows[bounds[node] : bounds[node + 1]]
        apart = part[:, None, :] - c[some]
        # The first of equal distances has the lowest index.
        nearest = some[np.argmin((apart * apart).sum(axis=2), axis=1)]
        chosen[bounds[node] : bounds[node + 1]] = nearest
        np.add.at(sums, nearest, part)
        counts += np.bincount(nearest, minlength=len(c))
    return chosen, sums, counts


def _bounds(size: int, parts: int) -> list[tuple[int, int]]:
    step = -(-size // parts)
    return [(min(p * step, size), min((p + 1) * step, size)) for p in range(parts)]


def _whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    made = np.floor(vectors * scale)
    # Distances over all components, also of doubled box centres, have to fit 64 bits.
    if made.size and np.abs(made).max() >= 2.0**29 / made.shape[1] ** 0.5:
        raise ValueError("vector components are too large for exact 64-bit distances")
    return made.astype(np.int64)


def _valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    given = vectors.select(
        F.col(id_col).alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return given.filter(F.col("vector").isNotNull() & finite)


def _blocks(valid: DataFrame, size: int, parts: int, scale: int) -> DataFrame:
    """Vectors in blocks: ids, labels, and for each part an order of its rows and the boxes and sums of its leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                some = batch.slice(a, BLOCK)
                values = some.column("vector").flatten().to_numpy()
                rows = _whole(values.reshape(-1, size), scale)
                orders, leaves = [], []
                height = height_of(len(rows), LEAF)
                for x, y in _bounds(size, parts):
                    order = order_of(rows[:, x:y], height)
                    boxes = Boxes.over(rows[order, x:y], height)
                    orders.append(order.astype("<i4"))
                    leaves += [b[-1] for b in (boxes.lowest, boxes.highest, boxes.sums)]
                columns = [
                    pa.array([some.column("vec_id").to_pylist()], pa.list_(some.schema.field("vec_id").type)),
                    pa.array([some.column("label").to_pylist()], pa.list_(some.schema.field("label").type)),
                    pa.array([rows.astype("<i8").tobytes()], pa.binary()),
                    pa.array([b"".join(o.tobytes() for o in orders)], pa.binary()),
                    pa.array([b"".join(b.astype("<i8").tobytes() for b in leaves)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "rows", "orders", "leaves"])

    id_type, label_type = (valid.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    out = f"ids array<{id_type}>, labels array<{label_type}>, rows binary, orders binary, leaves binary"
    return valid.mapInArrow(run, out)


def _parts(row: dict, size: int, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray, Boxes]]:
    """For each part of a block: the order of its rows, the ordered rows, their boxes."""
    rows = np.frombuffer(row["rows"], "<i8")
    n = len(np.frombuffer(row["orders"], "<i4")) // parts
    rows = rows.reshape(n, size)
    orders = np.frombuffer(row["orders"], "<i4").reshape(parts, n)
    leaves, at = np.frombuffer(row["leaves"], "<i8"), 0
    nodes = 1 << height_of(n, LEAF)
    for (x, y), order in zip(_bounds(size, parts), orders, strict=True):
        boxes = []
        for _ in range(3):
            boxes.append(leaves[at : at + nodes * (y - x)].reshape(nodes, y - x))
            at += nodes * (y - x)
        yield order, rows[order, x:y], Boxes(*boxes)


def _books(codebooks: list[np.ndarray]) -> list[Codebook]:
    return [Codebook(entries) for entries in codebooks]


def _round(blocks: DataFrame, codebooks: list[np.ndarray], size: int) -> list[np.ndarray]:
    """The codebooks after one round."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, sums, counts = _books(codebooks), None, None
        for batch in batches:
            for row in batch.to_pylist():
                for p, (_, rows, boxes) in enumerate(_parts(row, size, parts)):
                    _, s, c = assign(rows, boxes, books[p])
                    if sums is None:
                        sums, counts = ([np.zeros_like(b.entries) for b in books], [np.zeros(len(b.entries), np.int64) for b in books])
                    sums[p] += s
                    counts[p] += c
        for p in range(parts if sums is not None else 0):
            used = np.flatnonzero(counts[p])
            columns = [
                pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)),
                pa.array(counts[p][used]), pa.array(sums[p][used].tolist(), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    found = blocks.select("rows", "orders", "leaves").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    # Never more rows than the codebooks have numbers.
    exact = F.sum(F.col("total").cast("decimal(20,0)"))
    totals = (
        found.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), exact.alias("total"))
        .collect()
    )
    new = [entries.copy() for entries in codebooks]
    for r in totals:
        new[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return new


def codebooks_of(blocks: DataFrame, first: np.ndarray, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of ``blocks`` after ``rounds`` rounds from the vectors ``first``, whole numbers."""
    books = [first[:, x:y].copy() for x, y in _bounds(first.shape[1], parts)]
    for _ in range(rounds):
        books = _round(blocks, books, first.shape[1])
    return books


def _codes(blocks: DataFrame, codebooks: list[np.ndarray], size: int) -> DataFrame:
    """``vec_id, label, codes, error`` for the vectors of ``blocks``."""
    parts = len(codebooks)
    id_type, label_type = (blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks)
        for batch in batches:
            for at, row in enumerate(batch.select(["rows", "orders", "leaves"]).to_pylist()):
                ids, labels = batch.column("ids")[at].values, batch.column("labels")[at].values
                codes, error = np.zeros((len(ids), parts), np.int32), np.zeros(len(ids), np.int64)
                for p, (order, rows, boxes) in enumerate(_parts(row, size, parts)):
                    chosen, _, _ = assign(rows, boxes, books[p])
                    apart = rows - books[p].entries[chosen]
                    codes[order, p] = chosen
                    error[order] += (apart * apart).sum(axis=1)
                columns = [ids, labels, pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "codes", "error"])

    return blocks.mapInArrow(run, f"vec_id {id_type}, label {label_type}, codes array<int>, error long")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, label, codes, error)`` of every vector, and the codebooks, one array (entry, place) a part.

    Vectors that are null or hold null or non-finite components are dropped, and those that have not as many components as the one
    with the smallest id.  Codebooks start with the smallest ids, of equal ids with the smaller vector; a null id
    comes last.  Repeated rows count each.  If the length is no multiple of ``parts``, the last parts are shorter.  Without
    vectors there are no rows and no codebooks.  Whole numbers of 2^29 / sqrt(length) and more, beyond exact 64-bit distances, are refused.
    Other columns are not read.
    """
    valid = _valid(vectors, id_col, vector_col, label_col)
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    lead = valid.orderBy(*order).select("vector").first()
    if lead is None:
        return valid.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), []
    size = len(lead[0])
    valid = valid.filter(F.size("vector") == size)
    # Bounded by the size of a codebook.
    first = valid.orderBy(*order).select("vector").limit(entries).collect()
    start = _whole(np.array([r[0] for r in first], np.float64).reshape(len(first), size), scale)
    blocks = kept(_blocks(valid, size, parts, scale), "vector-blocks")
    books = codebooks_of(blocks, start, parts, rounds)
    return _codes(blocks, books, size), books


def digest(codebooks: list[np.ndarray]) -> str:
    """The digest of all numbers of the codebooks, by part, entry and place."""
    numbers = ",".join(str(n) for book in codebooks for n in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def code_string(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    found = kept(codes.select("vec_id", "label", code_string(F.col("codes")).alias("code"), "error"), "vector-codes")
    sums = group_apart(found, "label").agg(F.sum("error").alias("label_error")).select(F.col("__key.label").alias("of"), "label_error")
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """Plain Lloyd rounds over all pairs, one table a round."""
    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""
near{n} AS (
  SELECT r, p, e, d FROM (
    SELECT r, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM parts JOIN book{n} USING (p, k) GROUP BY r, p, e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if n < ROUNDS:
            steps.append(f"""
sums{n} AS (
  SELECT p, e, k, sum(x)::BIGINT AS s, count(*) AS m FROM parts JOIN near{n} USING (r, p) GROUP BY p, e, k),
book{n + 1} AS (
  SELECT p, e, k, CASE WHEN m IS NULL THEN c ELSE (s - ((s % m) + m) % m) // m END AS c
  FROM book{n} LEFT JOIN sums{n} USING (p, e, k))""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT r, unnest(embedding) AS x, unnest(range(len(embedding))) AS j, len(embedding) // 4 AS w FROM kept),
parts AS (SELECT r, (j // w) AS p, (j % w) AS k, floor(x::DOUBLE * 1024)::BIGINT AS x FROM flat),
book0 AS (SELECT p, r - 1 AS e, k, x AS c FROM parts WHERE r <= 256),{",".join(steps)},
codes AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, k)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""


ORACLE_SQL = _oracle()
