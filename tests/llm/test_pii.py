import re

import pytest
from pyspark.sql import functions as F

from rowloom.llm import pii
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts, sha


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4))
    return total % 10 == 0


def plain(text):
    """The contract's patterns as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


HARD = [
    "a@b.c_x@d.e a@b.c@d.e x@y.z", "1.2.3.4.5.6.7.8 01.002.0003.255 256.1.1.1 1.2.3.4.5", "+1 (212) 555-0100. +44 20 7946 0958 +1+2 345 678 901",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111", "é😀 a.b@c.de 😀 +1 212 555 0100", "@@@", "a" * 3000 + "@", "9" * 500,
    "1-2-3 " * 200, "+123456789 " * 300, "a@b.i,d@e.f;g@h.i", "x@y..z u@v.w.", "+1  2..3--4((5))6 7 8 9",
]


def test_hard_texts(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for r in pii.find_personal_data(docs).collect():
        assert r.base_sha256 == sha(listed(plain(HARD[r.doc_id]))), HARD[r.doc_id][:80]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == sha(listed(base))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in base) for n in range(4))
        assert not base or set(listed(base).split(",")) <= set(r.spans.split(","))
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 50


def test_proposals_are_added(spark):
    """Numbers in the format of validated ones but without their plus sign are found; other numbers are not."""
    rows = [(i, f"please call +1 (212) 555-{i:04d} today") for i in range(400)]
    rows += [(1000 + i, f"build 20{i:03d}1234567{i:03d} of file x{i:07d}y") for i in range(400)]
    rows += [(5000, "please call 1 (212) 555-0199 today"), (5001, "write to me [at] home [dot] org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert rows[5000].spans == "phone:12:28" and rows[5000].n_phone == 0
    # What passes the checksum is a base span; nothing is added to the others.
    assert all((rows[1000 + i].spans != "") == (rows[1000 + i].n_card == 1) for i in range(400))
    left = {r.doc_id: r.text for r in pii.remove_personal_data(docs).collect()}
    assert left[5000] == "please call <PHONE> today" and left[7] == "please call <PHONE> today"


def test_odd_rows(spark):
    rows = pii.find_personal_data(odd_docs(spark)).collect()
    assert len(rows) == len(odd_texts())
    assert sorted(r.base_sha256 for r in rows) == sorted(sha(listed(plain(t or ""))) for _, t, *_ in odd_texts())
    cleaned = pii.remove_personal_data(odd_docs(spark))
    assert cleaned.columns == odd_docs(spark).columns
    by_id = {r.doc_id: r for r in cleaned.collect()}
    assert by_id[1].text is None and by_id[13].text == "Mail <EMAIL> or <PHONE>, <CARD> at <IP>." and by_id[13].start == "clash"
    assert pii.find_personal_data(empty_docs(spark)).collect() == []


def test_cells_are_bounded(spark):
    scanned = pii.scan(spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string"))
    for row in pii.cells(scanned, "doc_id"):
        assert all(0 <= row[f] < n for f, n in pii.FEATURES.items())
    assert pii.CELLS < 100_000


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_running_sums(spark, n):
    df = spark.range(1).select(pii._running(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("int"))).alias("r"))
    assert df.first().r == [i * (i + 1) // 2 for i in range(n)]


def test_numbers_side_by_side(spark):
    """Valid card numbers that stand next to each other are one run of digits, and both are found."""
    def card(i):
        head = f"44657583{i:07d}"
        return next(head + c for c in "0123456789" if luhn(head + c))

    rows = [(i, f"paid with {card(i)} today") for i in range(400)]
    rows += [(1000 + i, f"order 88{i:05d} of lot {i:09d}") for i in range(400)]
    one, two = card(5001), card(5002)
    rows += [(5000, f"paid with {one} {two} today"), (5001, f"paid with {one} {two} {one} today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert found[5000].n_card == found[5001].n_card == 0
    assert found[5000].spans == "card:10:26,card:27:43"
    assert found[5001].spans == "card:10:26,card:27:43,card:44:60"
    left = {r.doc_id: r.text for r in pii.remove_personal_data(docs).collect()}
    assert left[5000] == "paid with <CARD> <CARD> today"
