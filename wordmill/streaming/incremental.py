"""Incremental preparation of newly arriving Q&A files with Structured Streaming.

The original has no streaming path; its per-row steps, however, carry no
cross-row state (cleaning, segmentation, stopword removal, encoding against a
fixed vocabulary), so the same column expressions run unchanged on a stream.
New files under a directory become micro-batches; the vocabulary is a static
table joined to each batch.  Jobs that need the whole corpus (vocabulary
build, positions, batches, length caps) stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wordmill.constants import DEFAULT_STOPWORDS
from wordmill.functions.text import mark_punctuation, pipe_to_space, segment_regex, sentence_proc
from wordmill.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", max_files: int = 64) -> DataFrame:
    """New files under ``path`` as a stream (bounded files per micro-batch)."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def segment_stream(stream: DataFrame, cols: list[str], stopwords=DEFAULT_STOPWORDS) -> DataFrame:
    """F5/F6 on every arriving row: the present ``cols`` become space-joined tokens."""
    return stream.withColumns({c: sentence_proc(c, stopwords) for c in cols if c in stream.columns})


def encode_stream(stream: DataFrame, key_col: str, text_col: str, vocab: DataFrame) -> DataFrame:
    """F14 + J1 on arriving rows: ``key, pos, idx`` via a stream-static join with the vocabulary."""
    toks = stream.select(
        key_col, F.posexplode(segment_regex(pipe_to_space(mark_punctuation(F.col(text_col))))).alias("pos", "token")
    )
    return toks.join(vocab.select(F.col("word").alias("token"), "idx"), "token").select(key_col, "pos", "idx")


def start_parquet_sink(df: DataFrame, path: str, name: str, trigger_once: bool = False) -> StreamingQuery:
    """Append results to parquet; progress is kept under the session's checkpoint directory."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{base}/stream-{name}")
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()
