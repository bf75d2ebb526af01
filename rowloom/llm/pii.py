"""Personal data: proposed spans, scored by gradient-boosted trees, cut at a calibrated threshold.

Four strict patterns with checks (octets, Luhn, digit counts) give the base spans, which always stay.  Two generators
of high recall, one for runs of digits and the runs of whole groups in them, one for addresses with spelt-out signs, propose further
spans that may overlap.
Format and context of a proposal become small whole numbers.  Proposals that overlap a base span are the positive
examples; whatever only the checks see (the plus sign, the checksum) is not a feature, so a
proposal of the same format and context as most validated ones scores high without them.

All proposals of all documents are counted into cells, one per combination of features, label and fold: the table of
cells has at most ``CELLS`` rows by construction, whatever the corpus, and is all that boosting needs.  The trees become
one column expression.  Everything on the rows is column expressions.

Positions are code points.  The pieces between matches and the matches themselves give the positions by running
sums, in blocks, so that texts with very many matches stay linear.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import kept, table, text_of

# The kinds in their order, and their patterns.  Runs are possessive and start where a run starts or the
# last match ended, which finds the same matches without trying every place of a long run.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PROPOSED = {
    "number": r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
    r"(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]++)++",
}
CONTEXT = r"(?i)(?:phone|tel|call|mobile|fax|card|visa|account|host|server|mail|contact|address)[^\n]{0,12}$"

#: Features and the number of their values.
FEATURES = {"source": 2, "digits": 7, "marks": 16, "groups": 5, "left": 3, "right": 3, "context": 2}
#: Rows that the table of cells can have: values x label x fold.
CELLS = math.prod(FEATURES.values()) * 4
#: Boosting: trees, splits along a path, learning rate, smallest weight of a leaf, L2.
TREES, DEPTH, RATE, LEAF, L2 = 20, 3, 0.3, 5.0, 1.0
#: Share of validated spans that proposals above the threshold must reach on the held-out fold.
PRECISION = 0.9
BLOCK = 64


def _running(lengths: Column) -> Column:
    """Sum of the elements before each one, in blocks of ``BLOCK``."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))

    def scan(items: Column, size) -> Column:
        return F.aggregate(
            items,
            zero,
            lambda acc, x: F.struct(
                (acc["total"] + size(x)).cast("int").alias("total"),
                F.concat(acc["out"], F.array(acc["total"])).alias("out"),
            ),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: scan(F.slice(lengths, b * BLOCK + 1, BLOCK), lambda x: x),
    )
    bases = scan(blocks, lambda x: x["total"])["out"]
    return F.flatten(F.zip_with(bases, blocks, lambda base, x: F.transform(x["out"], lambda o: o + base)))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found, before, after) of all matches of ``pattern``, empty without one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(found, gaps, lambda m, g: F.coalesce(F.length(m), F.lit(0)) + F.length(g))
    made = F.transform(
        F.arrays_zip(
            _running(lengths).alias("at"), gaps.alias("gap"), found.alias("found"), F.slice(gaps, 2, 2**30).alias("next")
        ),
        lambda x: F.struct(
            (x["at"] + F.length(x["gap"])).alias("start"),
            (x["at"] + F.length(x["gap"]) + F.length(x["found"])).alias("end"),
            x["found"].alias("found"),
            F.right(x["gap"], F.lit(24)).alias("before"),
            F.left(x["next"], F.lit(1)).alias("after"),
        ),
    )
    kind = "array<struct<start:int,end:int,found:string,before:string,after:string>>"
    return F.when(F.size(found) > 0, F.filter(made, lambda x: x["found"].isNotNull())).otherwise(F.array().cast(kind))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + weighed(i))
    return total % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    n = F.length(_digits(found))
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(found))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) by start, then kind, of the strict patterns; kind is its place in ``KINDS``."""

    def of_kind(n: int, kind: str) -> Column:
        return F.transform(
            F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["found"])),
            lambda m: F.struct(m["start"].alias("start"), F.lit(n).alias("kind"), m["end"].alias("end")),
        )

    return F.sort_array(F.concat(*[of_kind(n, kind) for n, kind in enumerate(KINDS)]))


def _features(source: int, m: Column) -> dict[str, Column]:
    found, digits = m["found"], F.length(_digits(m["found"]))

    def bucket(value: Column, *ends: int) -> Column:
        return sum(((value > end).cast("int") for end in ends), F.lit(0))

    def has(pattern: str, worth: int) -> Column:
        return F.when(found.rlike(pattern), worth).otherwise(0)

    def side(c: Column) -> Column:
        return F.when(c.rlike(r"[\p{L}0-9]"), 1).when(c.rlike(r"[_/=#:\"]"), 2).otherwise(0)

    return {
        "source": F.lit(source),
        "digits": bucket(digits, 0, 8, 11, 15, 16, 19),
        "marks": has(r"\x20", 1) + has("-", 2) + has(r"\.", 4) + has(r"[()\[\]]", 8),
        "groups": bucket(F.size(F.split(found, r"[^0-9]+")), 1, 2, 4, 6),
        "left": side(F.right(m["before"], F.lit(1))),
        "right": side(m["after"]),
        "context": m["before"].rlike(CONTEXT).cast("int"),
    }


def _kind(source: int, m: Column) -> Column:
    if source == 1:
        return F.lit(KINDS.index("email"))
    four = m["found"].rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$")
    long = F.length(_digits(m["found"])) >= 12
    return F.when(four, KINDS.index("ip")).when(long, KINDS.index("card")).otherwise(KINDS.index("phone"))


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def windows(found: Column) -> Column:
    """The matches of ``found`` and, like them, every shorter run of whole digit groups in one with 7 to 19 digits.

    A run of digits may hold several numbers side by side.  A window has at most 19 groups, so their number is linear.
    """
    grouped = F.transform(found, lambda m: F.struct(m.alias("m"), matches(m["found"], "[0-9]++").alias("groups")))

    def of_match(x: Column) -> Column:
        m, groups = x["m"], x["groups"]

        def between(g: Column, h: Column) -> Column:
            size = h["end"] - g["start"]
            return F.struct(
                (m["start"] + g["start"]).alias("start"),
                (m["start"] + h["end"]).alias("end"),
                F.substring(m["found"], g["start"] + 1, size).alias("found"),
                F.right(F.concat(m["before"], F.left(m["found"], g["start"])), F.lit(24)).alias("before"),
                F.left(F.concat(F.substring(m["found"], h["end"] + 1, F.lit(1)), m["after"]), F.lit(1)).alias("after"),
            )

        made = F.flatten(F.transform(groups, lambda g, i: F.transform(F.slice(groups, i + 1, 19), lambda h: between(g, h))))
        return F.filter(
            made,
            lambda w: F.length(_digits(w["found"])).between(7, 19) & (F.length(w["found"]) < F.length(m["found"])),
        )

    return F.flatten(F.transform(F.filter(grouped, lambda x: F.size(x["groups"]) > 1), of_match))


def proposals(text: Column, base: Column) -> Column:
    """Array of (start, kind, end, known, free, features) of all proposals.

    ``free`` if no base span overlaps.  A whole match is ``known`` if one does, a window inside it if it passes the
    checksum of cards; windows that overlap a base span are left out.
    """

    def described(n: int, found: Column, known, keep=None) -> Column:
        made = F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"),
                _kind(n, m).alias("kind"),
                m["end"].alias("end"),
                known(m).alias("known"),
                (~F.exists(base, lambda b: _meets(m, b))).alias("free"),
                *[c.cast("int").alias(name) for name, c in _features(n, m).items()],
            ),
        )
        return F.filter(made, keep) if keep else made

    whole = [
        described(n, matches(text, pattern), lambda m: F.exists(base, lambda b: _meets(m, b)))
        for n, pattern in enumerate(PROPOSED.values())
    ]
    inner = described(0, windows(matches(text, PROPOSED["number"])), lambda w: _valid("card", w["found"]), lambda w: w["free"])
    return F.concat(*whole, inner)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its base spans in ``__base`` and proposals in ``__proposed``."""
    text = text_of(text_col)
    with_base = docs.withColumn("__base", base_spans(text))
    return with_base.withColumn("__proposed", proposals(text, F.col("__base")))


def cells(scanned: DataFrame, id_col: str) -> list[dict]:
    """Counts of proposals by features, label and fold: at most ``CELLS`` rows."""
    fold = F.coalesce((F.crc32(F.col(id_col).cast("string")) % 4 == 0).cast("int"), F.lit(0))
    counted = (
        scanned.select(fold.alias("fold"), F.explode("__proposed").alias("p"))
        .groupBy("fold", F.col("p.known").cast("int").alias("known"), *[F.col(f"p.{f}").alias(f) for f in FEATURES])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = ("fold", "known", *FEATURES, "n")
    return sorted((r.asDict() for r in counted.collect()), key=lambda r: tuple(r[k] for k in names))


def _grow(rows: list[tuple[dict, float, float]], depth: int):
    """A tree on (cell, gradient, hessian): a number, or (feature, value, left, right) for ``<= value`` and the rest."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    for feature, values in FEATURES.items() if depth else ():
        sums: dict[int, list[float]] = {}
        for cell, a, b in rows:
            s = sums.setdefault(cell[feature], [0.0, 0.0])
            s[0] += a
            s[1] += b
        left_g = left_h = 0.0
        for value in range(values - 1):
            a, b = sums.get(value, (0.0, 0.0))
            left_g, left_h = left_g + a, left_h + b
            if min(left_h, h - left_h) * 4 < LEAF:
                continue
            gain = left_g**2 / (left_h + L2) + (g - left_g) ** 2 / (h - left_h + L2) - g**2 / (h + L2)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                best = (gain, feature, value)
    if best is None:
        return -RATE * g / (h + L2)
    _, feature, value = best
    low = [r for r in rows if r[0][feature] <= value]
    high = [r for r in rows if r[0][feature] > value]
    return feature, value, _grow(low, depth - 1), _grow(high, depth - 1)


def _value(tree, cell: dict) -> float:
    while isinstance(tree, tuple):
        feature, value, low, high = tree
        tree = low if cell[feature] <= value else high
    return tree


def _expression(tree, p: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, value, low, high = tree
    return F.when(p[feature] <= value, _expression(low, p)).otherwise(_expression(high, p))


def boost(counted: Sequence[dict]) -> tuple[list, float]:
    """Trees, and the threshold of their sum; without enough examples no tree and an unreachable threshold.

    Cells of fold 0 train.  On fold 1 the threshold is the lowest score from which on the share of validated proposals is at
    least ``PRECISION`` at every score above it as well.
    """
    train = [c for c in counted if c["fold"] == 0]
    held = [c for c in counted if c["fold"] == 1]
    margin = [0.0] * len(train)
    trees = []
    for _ in range(TREES if {c["known"] for c in train} == {0, 1} else 0):
        rows = []
        for c, m in zip(train, margin, strict=True):
            p = 1 / (1 + math.exp(-m))
            rows.append((c, (p - c["known"]) * c["n"], p * (1 - p) * c["n"]))
        tree = _grow(rows, DEPTH)
        trees.append(tree)
        margin = [m + _value(tree, c) for c, m in zip(train, margin, strict=True)]
    by_score: dict[float, list[int]] = {}
    for c in held if trees else ():
        s = by_score.setdefault(sum(_value(t, c) for t in trees), [0, 0])
        s[0] += c["n"] * c["known"]
        s[1] += c["n"]
    threshold, good, every = math.inf, 0, 0
    for score in sorted(by_score, reverse=True):
        good, every = good + by_score[score][0], every + by_score[score][1]
        if good < PRECISION * every:
            break
        # Between this score and the next lower one, so that rounding cannot move a cell across.
        threshold = score - 1e-9
    return trees, threshold


def with_spans(scanned: DataFrame, model: tuple[list, float]) -> DataFrame:
    """``scanned`` with ``spans``, array of (start, kind, end) by start, then kind: the base and what is added.

    A proposal is added from the threshold on if it overlaps neither a base span nor a better proposal that is added.
    """
    trees, threshold = model
    if not trees or math.isinf(threshold):
        return scanned.withColumn("spans", F.col("__base"))
    scored = F.filter(
        F.transform(
            F.filter("__proposed", lambda p: p["free"]),
            lambda p: F.struct(
                (-sum((_expression(t, p) for t in trees), F.lit(0.0))).alias("rank"),
                # No kind has more than 19 digits: of equal scores the numbers in such a run come first.
                (p["digits"] == FEATURES["digits"] - 1).alias("long"),
                p["start"].alias("start"),
                p["kind"].alias("kind"),
                (-p["end"]).alias("back"),
                p["end"].alias("end"),
            ),
        ),
        lambda p: p["rank"] <= -threshold,
    )
    span = "array<struct<start:int,kind:int,end:int>>"
    added = F.aggregate(
        F.sort_array(scored),
        F.array().cast(span),
        lambda acc, p: F.when(F.exists(acc, lambda q: _meets(p, q)), acc).otherwise(
            F.concat(acc, F.array(F.struct(p["start"], p["kind"], p["end"])).cast(span))
        ),
    )
    return scanned.withColumn("spans", F.sort_array(F.concat("__base", added)))


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch covered by spans replaced by the kind of its first span, in angle brackets."""
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.when(
            s["start"] >= acc["at"],
            F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(tags, s["kind"] + 1)),
        ).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    done = F.aggregate(spans, zero, step)
    return F.when(
        F.size(spans) > 0,
        F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))),
    ).otherwise(text)


def remove_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in its texts replaced; null texts stay null, all rows and columns stay.

    The texts are scanned twice, once for the cells and once for the spans, and never shuffled.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scanned = scan(whole)
    spanned = with_spans(scanned, boost(cells(scanned, "doc_id")))
    cleaned = redact(F.col("text"), F.col("spans"))
    return spanned.select(*[cleaned.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts by kind, digest of the base spans, all spans as text.

    A null text counts as empty and has no spans.  Null ids are in the training fold.  Repeated rows are scanned each.  Empty input gives no
    rows.  Other columns are not read.  Proposals that overlap are settled by score, then (runs of over 19 digits
    last) start, then kind, then length.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scanned = kept(scan(slim).drop("text"), "pii-scan")
    spanned = with_spans(scanned, boost(cells(scanned, "doc_id")))

    def count_of(n: int) -> Column:
        return F.size(F.filter("__base", lambda s: s["kind"] == n)).cast("long")

    return spanned.select(
        "doc_id",
        *[count_of(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
