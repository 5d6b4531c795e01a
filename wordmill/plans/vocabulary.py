"""Vocabulary job over the Q&A tables (scan -> tokens -> count -> first-appearance idx -> cut)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import DEFAULT_STOPWORDS, RARE_WORD_CUT
from wordmill.session import cut_lineage
from wordmill.sources.driver_tables import SPECIAL_COLUMNS, TEXT_COLUMNS, qa_cells
from wordmill.sources.io import read_corpus, read_dictionary, read_stopwords, write_vocab
from wordmill.operators.vocab import (
    build_vocab,
    special_tokens,
    stopword_frame,
    to_cells,
    vocab_tokens,
    word_count,
)


def vocabulary(
    spark: SparkSession,
    sf_dir: str,
    drop_lt_freq: int | None = RARE_WORD_CUT,
    stopwords=DEFAULT_STOPWORDS,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """``word, idx, freq`` built from both files, all text and special columns."""
    cells = qa_cells(spark, sf_dir)
    return build_vocab(vocab_tokens(cells, dictionary), stopword_frame(spark, stopwords), drop_lt_freq)


def special_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-cell counts of the special columns over both files."""
    return word_count(special_tokens(qa_cells(spark, sf_dir))).select(F.col("word").alias("token"), "freq")


def vocabulary_from_files(
    spark: SparkSession,
    paths: list[str],
    stopwords_path: str | None = None,
    stopwords=DEFAULT_STOPWORDS,
    drop_lt_freq: int | None = None,
    text_columns: list[str] = TEXT_COLUMNS,
    special_columns: list[str] = SPECIAL_COLUMNS,
    out_path: str | None = None,
    save_freq: bool = True,
    dictionary_path: str | None = None,
) -> DataFrame:
    """E1 from Q&A CSV files (read in the given order), optionally written as TSV.

    Only the wanted columns a file has are used (P1/U5); a stopword file,
    when given, replaces the stopword list (S3), and a dictionary file (S4)
    segments the text columns.
    """
    cells = None
    for file_no, path in enumerate(paths):
        part = to_cells(read_corpus(spark, path), text_columns, special_columns, file_no)
        cells = part if cells is None else cells.unionByName(part)
    sw = read_stopwords(spark, stopwords_path) if stopwords_path else stopword_frame(spark, stopwords)
    dictionary = read_dictionary(spark, dictionary_path) if dictionary_path else None
    vocab = build_vocab(vocab_tokens(cells, dictionary), sw, drop_lt_freq)
    if out_path:
        vocab = cut_lineage(vocab, "vocab")
        write_vocab(vocab, out_path, save_freq)
    return vocab
