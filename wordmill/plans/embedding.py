"""Skip-gram training data, embeddings, lookup and the vocabulary-indexed matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import SG_BATCH, SUBSAMPLE_TH
from wordmill.operators.embeddings import embedding_matrix, line_tokens, subword_vectors, word_vectors
from wordmill.operators.pairs import full_batches, global_position, subsample_frequent
from wordmill.operators.vocab import encode, stopword_frame, text_tokens
from wordmill.plans.corpus import padded, segmented, training_corpus
from wordmill.session import cut_lineage, drop_cut
from wordmill.sources.driver_tables import qa_cells


def encoded_corpus(spark: SparkSession, sf_dir: str, vocab: DataFrame) -> DataFrame:
    """J1 over both files' text columns (stopwords and OOV removed)."""
    return encode(text_tokens(qa_cells(spark, sf_dir)), vocab, stopword_frame(spark))


def skipgram_batches(spark: SparkSession, sf_dir: str, vocab: DataFrame, th: float | None = SUBSAMPLE_TH, batch_size: int = SG_BATCH) -> DataFrame:
    """J1 -> P8 -> W2 -> W4: ``gidx, idx, batch`` of the sub-sampled corpus in full batches."""
    encoded = cut_lineage(encoded_corpus(spark, sf_dir, vocab), "encoded", compression="zstd")
    kept = subsample_frequent(encoded, th)
    positioned = global_position(kept, stage=False, keep=["idx"])
    total = F.lit(positioned.count())
    drop_cut(encoded)  # numbered, the tokens are read from files of their own
    return full_batches(positioned, batch_size, total=total)


def batch_sentences(batched: DataFrame) -> DataFrame:
    """R3 input: each full batch (``batch_size`` ids, in corpus order) is one sentence.

    The group is one batch, so its size is the fixed batch size.
    """
    return batched.groupBy("batch").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("gidx", "idx"))), lambda x: x["idx"].cast("string")).alias("tokens")
    )


def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged training corpus (F7) as whitespace token arrays."""
    return line_tokens(training_corpus(segmented(spark, sf_dir)).select(F.col("merged").alias("line")))


def extended_lines(spark: SparkSession, sf_dir: str, vocab: DataFrame) -> DataFrame:
    """R5 corpus: the merged corpus plus the padded train-X, test-X and train-Y corpora."""
    pads = padded(spark, sf_dir, vocab).select(F.col("seq").alias("line"))
    return merged_lines(spark, sf_dir).unionByName(line_tokens(pads))


def vectors_from_table(spark: SparkSession, sf_dir: str, vocab_all: DataFrame) -> DataFrame:
    """Stand-in word vectors from the driver's ``embeddings`` table: ``vec_id`` is a vocabulary idx."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return emb.join(vocab_all.select(F.col("idx").alias("vec_id"), "word"), "vec_id").select(
        "word", F.col("embedding").alias("vector")
    )


def matrix_from_files(spark: SparkSession, vocab_path: str, model_path: str, out_path: str | None = None, subword: bool = False) -> DataFrame:
    """R8 from files: a vocabulary TSV and a saved model in, ``idx, vector`` out (and the matrix file).

    ``subword`` gives words without a vector the mean of their n-grams (R7).
    """
    from wordmill.sources.io import load_embeddings, read_vocab, write_embedding_matrix

    vocab, _ = read_vocab(spark, vocab_path)
    vectors = word_vectors(load_embeddings(model_path))
    if subword:
        vectors = subword_vectors(vocab, vectors).where(F.col("vector").isNotNull()).select("word", "vector")
    matrix = embedding_matrix(vocab, vectors)
    if out_path:
        matrix = cut_lineage(matrix, "matrix")
        write_embedding_matrix(matrix, out_path)
    return matrix
