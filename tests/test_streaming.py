"""Stateless per-row steps give the same rows on a stream as in a batch job."""

import shutil
import tempfile


from wordmill.functions.text import sentence_proc
from wordmill.constants import DEFAULT_STOPWORDS
from wordmill.streaming.incremental import encode_stream, read_stream, segment_stream, start_parquet_sink

SRC = "/root/testdata/sf0.001/documents.parquet"


def test_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="wm-stream-")
    shutil.copy(SRC, f"{d}/part-0.parquet")
    batch = spark.read.parquet(SRC)
    stream = read_stream(spark, d, batch.schema)
    out = tempfile.mkdtemp(prefix="wm-stream-out-")
    q = start_parquet_sink(segment_stream(stream, ["text"]).select("doc_id", "text"), out, "seg-test", trigger_once=True)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in batch.select("doc_id", sentence_proc("text", DEFAULT_STOPWORDS).alias("text")).collect())
    assert got == want


def test_encode_stream(spark):
    d = tempfile.mkdtemp(prefix="wm-stream-")
    shutil.copy(SRC, f"{d}/part-0.parquet")
    batch = spark.read.parquet(SRC)
    vocab = spark.createDataFrame([("the", 0), ("and", 1)], "word string, idx long")
    q = (
        encode_stream(read_stream(spark, d, batch.schema), "doc_id", "text", vocab)
        .writeStream.format("memory").queryName("enc_test").outputMode("append").start()
    )
    q.processAllAvailable()
    q.stop()
    n = spark.sql("SELECT count(*) AS n FROM enc_test").first()["n"]
    assert n > 0
