"""Token files against whole encodings by the library, and against the metadata of the files."""

import glob
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import orc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowloom.llm import token_files as tf
from rowloom.llm.common import table

ODD = ["a  b", "a   b", " a", "a \n b", "\n\n a", "a\n  b  ", "  ", "", "x  y", "a\tb c\t d", "it's  'll we've, 'tis",
       "<|endoftext|> a<|endoftext|> b", "\x1c \x1c a", " \x85 b  \n", "  x   y ", "é à é", "　   z ", "… … a … b",
       "x" * 3000 + " " + "é" * 999, "漢字 かな b", "1,000. 2!a", "a.\nWas b;\r\nc", "﻿ a"]


TOKENIZER = Tokenizer.from_file(tf.VOCABULARY)


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [tf.END]


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_pieces_encode_like_whole_texts(limit):
    got = []
    for a, b, ids, stops in tf.encoded(pa.array(ODD), tf.VOCABULARY, tf.END, limit):
        got += [part.tolist() for part in np.split(ids, stops[:-1])] if b > a else []
    assert got == [whole(t) for t in ODD]


def test_the_cache_turns_over(monkeypatch):
    monkeypatch.setattr(tf, "KNOWN", 3)
    one = tf.Encoder(tf.VOCABULARY)
    texts = ["alpha beta gamma delta", "beta gamma omega", "alpha psi beta"] * 3
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = one.documents(data, np.array([0]), tf.END)
        assert ids.tolist() == whole(text)
    assert len(one.young) < 10


def expected(rows):
    """Rows (id, text) in order as (id, start, n, crc)."""
    out, start = [], 0
    for key, text in rows:
        ids = whole(text)
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, tf.query(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == expected([tuple(r) for r in docs])


def test_odd_rows(spark, tmp_path):
    rows = [(3, "c c", 1), (None, "last", 2), (1, None, 3), (2, "same", 4), (2, "same", 5), (2, "other", 6), (4, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumn("start", F.lit("x"))
    tf.write_tokens(docs.repartition(3), str(tmp_path / "t"))
    got = [tuple(r) for r in tf.checksums(tf.read_tokens(spark, str(tmp_path / "t")).orderBy("start"))
           .select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert [g[0] for g in got] == [1, 2, 2, 2, 3, 4, None]
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    texts = {zlib.crc32(np.array(whole(t), "<u4").tobytes()) for _, t, _ in rows}
    assert {g[3] for g in got} == texts and got[0][2] == 1


def test_empty_table(spark, tmp_path):
    tf.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "t"))
    assert tf.checksums(tf.read_tokens(spark, str(tmp_path / "t"))).collect() == []


def test_text_ids(spark, tmp_path):
    docs = spark.createDataFrame([("b", "x"), ("a", "y z")], "key string, body string")
    tf.write_tokens(docs, str(tmp_path / "t"), "key", "body")
    assert [r[0] for r in tf.read_tokens(spark, str(tmp_path / "t")).orderBy("start").select("doc_id").collect()] == ["a", "b"]


def test_a_hot_id_is_cut_into_several_files(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id")).alias("doc_id"), F.lit("the same text").alias("text")
    )
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tf.write_tokens(docs, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    rows = tf.read_tokens(spark, str(tmp_path / "t"))
    assert rows.filter("doc_id = 77").select("shard").distinct().count() > 1
    starts = [r[0] for r in rows.select("start").orderBy("start").collect()]
    assert starts == list(range(0, 4000 * 4, 4))


def test_stripes_and_metadata_pruning(spark, tmp_path):
    """Several stripes a file; a lookup reads few rows, also of an id inside the range of the file but not in it."""
    path = str(tmp_path / "t")
    docs = spark.range(0, 40_000, 1, 2).select((F.col("id") * 2).alias("doc_id"), F.md5(F.col("id").cast("string")).alias("text"))
    tf.write_tokens(docs.coalesce(1), path, stripe=1 << 18)
    files = [orc.ORCFile(f) for f in glob.glob(f"{path}/*.orc")]
    assert max(f.nstripes for f in files) > 1
    assert all(f.row_index_stride == tf.STRIDE for f in files)
    for key, rows in ((20_000, 1), (20_001, 0)):
        found = spark.read.orc(path).filter(F.col("doc_id") == key)
        assert found.count() == rows
        plan = found.select("ids")
        plan.collect()
        scan = plan._jdf.queryExecution().executedPlan()
        while scan.children().size():
            scan = scan.children().apply(0)
        assert "EqualTo(doc_id" in scan.toString()
        read = scan.metrics().apply("numOutputRows").value()
        assert read <= (2 * tf.STRIDE if rows else 0)
