"""Registry of the queries exposed to the driver, bench and tests.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
carry the same names as the matching statement in :mod:`oracle_sql`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import (
    DEFAULT_STOPWORDS,
    SG_EPOCHS,
    SG_SIZE,
    SG_WINDOW,
    SUBSAMPLE_TH,
    WV_MIN_COUNT,
    WV_SIZE,
    WV_WINDOW,
)
from wordmill.functions.text import clean_sentence, mark_punctuation, pipe_to_space, sentence_proc
from wordmill.operators import embeddings as EMB
from wordmill.operators import pairs as P
from wordmill.operators.factors import extended, factorise
from wordmill.operators.indexing import range_index
from wordmill.operators.negatives import log_uniform_weight, negative_samples
from wordmill.operators.sequences import batch_rows
from wordmill.operators.subwords import fit_buckets, subword_means, word_buckets
from wordmill.operators.vocab import decode, encode, stopword_frame, text_tokens
from wordmill.plans import corpus as E2
from wordmill.plans import embedding as E3
from wordmill.plans import vocabulary as E1
from wordmill.plans.oracle_sql import PPMI_SIZE
from wordmill.operators.segment import map_partitions, segment_dictionary
from wordmill.session import cut_lineage, ensure_checkpoint_dir
from wordmill.sources import io as IO
from wordmill.sources.driver_tables import dialogues, qa_cells, qa_table, table

Query = Callable[[SparkSession, str], DataFrame]


def q_vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E1.vocabulary(spark, sf_dir)


def q_vocab_special_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E1.special_column_counts(spark, sf_dir)


def q_mark_punctuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", pipe_to_space(mark_punctuation("text")).alias("text"))


def q_clean_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean_sentence("text").alias("text"))


def q_dialogue_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).select(
        F.col("row_id").alias("conv_id"), sentence_proc("Dialogue", DEFAULT_STOPWORDS, "spaced").alias("text")
    )


def q_segmented_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E2.segmented(spark, sf_dir).select("split", "row_id", *E2.PROCESSED)


def q_training_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E2.training_corpus(E2.segmented(spark, sf_dir)).select("split", "row_id", "merged")


def q_max_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E2.length_caps(E2.xy_corpora(E2.segmented(spark, sf_dir)))


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The vocabulary feeds several joins and scalar subqueries: materialise it once.
    return cut_lineage(E1.vocabulary(spark, sf_dir))


def q_pad_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E2.padded(spark, sf_dir, _vocab(spark, sf_dir)).select("split", "row_id", "kind", "seq")


def q_model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E2.padded(spark, sf_dir, _vocab(spark, sf_dir))
    return batch_rows(rows, ["file_no", "kind"], "row_id", 100).select("split", "row_id", "kind", "batch", "ids")


def q_corpus_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_tokens(qa_cells(spark, sf_dir))


def q_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(text_tokens(qa_cells(spark, sf_dir)), _vocab(spark, sf_dir), stopword_frame(spark))


def q_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    return decode(encode(text_tokens(qa_cells(spark, sf_dir)), vocab, stopword_frame(spark)), vocab)


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E3.skipgram_batches(spark, sf_dir, _vocab(spark, sf_dir))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(E3.encoded_corpus(spark, sf_dir, _vocab(spark, sf_dir)), "encoded")


def q_relative_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rf = P.relative_frequency(_encoded(spark, sf_dir))
    return rf.select("idx", "n", F.round("freq", 6).alias("freq"), F.round("p_drop", 6).alias("p_drop"))


def q_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.subsample_frequent(_encoded(spark, sf_dir), SUBSAMPLE_TH)


def q_global_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = P.subsample_frequent(_encoded(spark, sf_dir), SUBSAMPLE_TH)
    return P.global_position(kept).select("gidx", "idx")


def q_full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("idx").cast("long").alias("idx_sum")
    )


def _context(spark: SparkSession, sf_dir: str, random: bool) -> DataFrame:
    ctx = P.context_sets(_batches(spark, sf_dir), SG_WINDOW, random)
    return ctx.select("batch", "gidx", "center", F.array_join(F.transform("context", lambda x: x.cast("string")), " ").alias("context"))


def q_context_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir, False)


def q_context_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir, True)


def q_skipgram_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.skipgram_pairs(_batches(spark, sf_dir), SG_WINDOW)


def q_skipgram_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pair_rows(_batches(spark, sf_dir), SG_WINDOW)


def q_extend_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the even batches, extended by those of the odd ones."""
    batches = cut_lineage(_batches(spark, sf_dir), "batches")
    even, odd = (P.cooccurrence(batches.where(F.col("batch") % 2 == k), SG_WINDOW) for k in (0, 1))
    return P.extend_cooccurrence(even, odd)


def q_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.cooccurrence(_batches(spark, sf_dir), SG_WINDOW)


def q_ppmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    co = cut_lineage(P.cooccurrence(_batches(spark, sf_dir), SG_WINDOW), "cooc")
    return P.ppmi(co).select("w", "c", "n", F.round("pmi", 6).alias("pmi"), F.round("ppmi", 6).alias("ppmi"))


# Library default epochs of the original's embedding trainer.
WV_EPOCHS = 5


def _dims(vectors: DataFrame) -> DataFrame:
    """Length of each vector, and whether all its values are finite and not all zero."""
    norm = F.aggregate("vector", F.lit(0.0), lambda n, x: n + x.cast("double") * x.cast("double"))
    sound = (norm > 0) & ~F.isnan(norm) & (norm < float("inf"))
    return vectors.select("word", F.size("vector").cast("long").alias("dims"), sound.alias("sound"))


def _w2v_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = EMB.train_embeddings(E3.merged_lines(spark, sf_dir), WV_SIZE, WV_WINDOW, WV_MIN_COUNT, WV_EPOCHS)
    return EMB.word_vectors(model)


def q_train_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dims(_w2v_vectors(spark, sf_dir))


def q_skipgram_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = E3.batch_sentences(_batches(spark, sf_dir))
    model = EMB.train_embeddings(sentences, SG_SIZE, SG_WINDOW, 1, SG_EPOCHS)
    return _dims(EMB.word_vectors(model))


def q_extend_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = E3.extended_lines(spark, sf_dir, _vocab(spark, sf_dir))
    return _dims(EMB.word_vectors(EMB.train_embeddings(lines, WV_SIZE, WV_WINDOW, WV_MIN_COUNT, WV_EPOCHS)))


def q_lookup_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = E1.vocabulary(spark, sf_dir, drop_lt_freq=None).select("word")
    return _dims(EMB.lookup_vectors(words, _w2v_vectors(spark, sf_dir)))


def q_subword_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _vocab(spark, sf_dir).select("word")
    out = EMB.subword_vectors(words, _w2v_vectors(spark, sf_dir))
    return out.select("word", "source", F.coalesce(F.size("vector"), F.lit(0)).cast("long").alias("dims"))


def q_embedding_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab_all = cut_lineage(E1.vocabulary(spark, sf_dir, drop_lt_freq=None), "vocab_all")
    vectors = E3.vectors_from_table(spark, sf_dir, vocab_all)
    cut = vocab_all.where(F.col("freq") >= WV_MIN_COUNT)
    matrix = EMB.embedding_matrix(cut, vectors)
    return matrix.select("idx", F.posexplode("vector").alias("dim", "value")).select(
        "idx", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


def q_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cut_lineage(E3.merged_lines(spark, sf_dir), "lines")
    counts = lines.select(F.explode("tokens").alias("w")).groupBy("w").count()
    return lines.agg(F.count(F.lit(1)).alias("corpus_count")).select(
        "corpus_count",
        _vocab(spark, sf_dir).agg(F.countDistinct("word")).scalar().alias("vocab_size"),
        counts.where(F.col("count") >= WV_MIN_COUNT).agg(F.count(F.lit(1))).scalar().alias("min_count_vocab"),
    )


def q_io_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write each artifact in the original's text format, read it back, count rows and weigh them by place."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}"
    vocab = _vocab(spark, sf_dir)
    IO.write_vocab(vocab, f"{base}/vocab")
    w2i, i2w = IO.read_vocab(spark, f"{base}/vocab")
    seg = cut_lineage(E2.segmented(spark, sf_dir), "seg")
    IO.write_segmented(seg.select("split", "row_id", *E2.PROCESSED), f"{base}/seg")
    seg_back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{base}/seg")
    IO.write_lines(E2.training_corpus(seg), "merged", f"{base}/merged")
    # lines numbered as they stand in the files: content and order both count
    lines_back = range_index(IO.read_lines(spark, f"{base}/merged", order=True), IO.FILE_ORDER, "idx").withColumnRenamed("line", "word")
    vocab_all = cut_lineage(E1.vocabulary(spark, sf_dir, drop_lt_freq=None), "vocab_all")
    matrix = EMB.embedding_matrix(vocab_all.where(F.col("freq") >= WV_MIN_COUNT), E3.vectors_from_table(spark, sf_dir, vocab_all))
    IO.write_embedding_matrix(matrix, f"{base}/matrix")
    # a line of the vocabulary and of the matrix counts by its place in the files
    in_place = lambda name: range_index(IO.read_lines(spark, f"{base}/{name}", order=True), IO.FILE_ORDER, "place")
    vocab_lines = in_place("vocab").select(F.col("line").alias("word"), F.col("place").alias("idx"))
    cells = F.split(F.regexp_replace("line", "\r$", ""), "\t")
    matrix_back = cut_lineage(in_place("matrix").select(cells[0].alias("word"), F.col("place").alias("idx"), cells[1].alias("values")), "matrix-lines")
    numbers = F.split(F.translate("values", "[] ", ""), ",")
    values = matrix_back.select("idx", F.posexplode(F.transform(numbers, lambda v: v.cast("float").cast("double"))).alias("dim", "value"))
    matrix_values = values.select(F.round(F.col("value") * 1e6).cast("long").cast("string").alias("word"), (F.col("idx") * 64 + F.col("dim")).alias("idx"))
    stop_lines = stopword_frame(spark).union(stopword_frame(spark)).select(F.concat(F.lit(" "), "word").alias("value"))
    stop_lines.write.mode("overwrite").text(f"{base}/stop")
    stop_back = IO.read_stopwords(spark, f"{base}/stop").withColumn("idx", F.lit(0))

    def n(name: str, df: DataFrame) -> DataFrame:
        place = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("decimal(38,0)") * (F.col("idx") % 1000 + 1)
        digest = F.sum(place).cast("string") if "idx" in df.columns else F.lit(None).cast("string")
        return df.agg(F.count(F.lit(1)).alias("n"), digest.alias("digest")).select(F.lit(name).alias("artifact"), "n", "digest")

    out = n("vocab_word_to_idx", w2i)
    for name, df in [("vocab_idx_to_word", i2w), ("vocab_lines", vocab_lines), ("segmented_csv", seg_back), ("merged_lines", lines_back),
                     ("matrix_lines", matrix_back.drop("values")), ("matrix_values", matrix_values), ("stopwords", stop_back)]:
        out = out.unionByName(n(name, df))
    return out


def q_csv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Q&A table as train and test CSV files, read back: rows in file order, cells unchanged."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    qa = cut_lineage(qa_table(spark, sf_dir), "qa")
    for split in ("train", "test"):
        cols = [c for c in IO.QA_COLUMNS if split == "train" or c != "Report"]
        IO.write_segmented(qa.where(F.col("split") == split), f"{base}/{split}", cols)
    back = IO.load_splits(spark, f"{base}/train", f"{base}/test")
    cells = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in IO.QA_COLUMNS])
    return back.select("split", F.col("row_id").cast("long").alias("row_id"), F.md5(cells).alias("cells_md5"))


def q_dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary words without blanks as a dictionary file, read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dictionary-{uuid.uuid4().hex}"
    words = _vocab(spark, sf_dir).where(~F.col("word").rlike(r"\s"))
    words.select(F.concat_ws(" ", "word", F.col("freq").cast("string")).alias("value")).write.text(path)
    return IO.read_dictionary(spark, path)


def q_saved_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a model that was saved and loaded."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    IO.save_embeddings(EMB.train_embeddings(E3.merged_lines(spark, sf_dir), 16, WV_WINDOW, WV_MIN_COUNT), path)
    return _dims(EMB.word_vectors(IO.load_embeddings(path)))


def q_map_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas function over slices of the documents."""

    def lengths(pdf):
        return pdf.assign(n=pdf["text"].str.len())[["doc_id", "n"]]

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_partitions(docs, lengths, "doc_id long, n long")


def q_segment_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 dictionary mode over every document, with the vocabulary (and its counts) as dictionary."""
    docs = table(spark, sf_dir, "documents")
    text = pipe_to_space(mark_punctuation("text"))
    return segment_dictionary(docs, ["doc_id"], text, _vocab(spark, sf_dir).select("word", "freq"))


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of the run mode with its counts, as a user's dictionary would be."""
    return _vocab(spark, sf_dir).select("word", "freq")


def q_dictionary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14 in dictionary mode: tokens of all text cells in reading order."""
    return text_tokens(qa_cells(spark, sf_dir), _dictionary(spark, sf_dir))


def q_dictionary_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 in dictionary mode: vocabulary of the dictionary's tokens and the special cells."""
    return E1.vocabulary(spark, sf_dir, dictionary=_dictionary(spark, sf_dir))


def q_dictionary_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F7 in dictionary mode: the merged training corpus of all columns."""
    seg = E2.segmented(spark, sf_dir, dictionary=_dictionary(spark, sf_dir))
    return E2.training_corpus(seg).select("split", "row_id", "merged")


def q_negative_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3's data side: negatives of every batch, drawn from the vocabulary by rank."""
    weights = _vocab(spark, sf_dir).select("idx", log_uniform_weight(F.col("idx")).alias("w"))
    keys = cut_lineage(_batches(spark, sf_dir).select("batch").distinct(), "batch-keys")
    return negative_samples(keys, weights)


#: Rounds that give the first column of the vectors by factorisation to nine digits.
PPMI_ROUNDS = 10


def _ppmi_rows(co: DataFrame) -> DataFrame:
    return P.ppmi(co).where(F.col("ppmi") > 0).select(F.col("w").alias("r"), F.col("c"), F.col("ppmi").alias("value"))


def q_ppmi_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 from the PPMI table: length of each word's vector and its first coordinate over ``sqrt(sigma)``."""
    co = cut_lineage(P.cooccurrence(_batches(spark, sf_dir), SG_WINDOW), "cooc")
    found = factorise(_ppmi_rows(co), PPMI_SIZE, rounds=PPMI_ROUNDS)
    first = F.get("x", F.lit(0)) / F.lit(float(found.sigma[0]) ** 0.5)
    return found.words.select(F.col("id").alias("idx"), F.size("x").cast("long").alias("dims"), F.round(first, 5).alias("first"))


def q_fold_in_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 without retraining: vectors of the even batches, and words that only the odd ones hold folded in."""
    batches = cut_lineage(_batches(spark, sf_dir), "batches")
    even, odd = (cut_lineage(P.cooccurrence(batches.where(F.col("batch") % 2 == k), SG_WINDOW), "cooc") for k in (0, 1))
    base = factorise(_ppmi_rows(even), PPMI_SIZE, rounds=2)
    more = _ppmi_rows(cut_lineage(P.extend_cooccurrence(even, odd), "cooc"))
    out = extended(base.words, base.contexts, more, ridge=1.0)
    norm = F.aggregate("x", F.lit(0.0), lambda n, v: n + v * v)
    return out.select(F.col("id").alias("idx"), "source", F.size("x").cast("long").alias("dims"), ((norm > 0) & (norm < float("inf"))).alias("sound"))


def q_fitted_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 trained: n-gram buckets fitted to the factorised vectors; a vector for every word of the whole vocabulary."""
    co = cut_lineage(P.cooccurrence(_batches(spark, sf_dir), SG_WINDOW), "cooc")
    trained = factorise(_ppmi_rows(co), PPMI_SIZE, rounds=2).words
    words = cut_lineage(E1.vocabulary(spark, sf_dir, drop_lt_freq=None).select(F.col("idx").alias("id"), "word"), "words")
    shares = cut_lineage(word_buckets(words), "shares")
    fitted = subword_means(shares, fit_buckets(shares, trained, rounds=4), PPMI_SIZE)
    known = trained.select("id", F.lit(True).alias("known"))
    return words.join(fitted, "id").join(known, "id", "left").select(
        "word", F.when(F.col("known"), "word").otherwise("ngram").alias("source"), F.size("x").cast("long").alias("dims")
    )


def q_bucketed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary and vectors kept in buckets by word, and the matrix joined from them."""
    tag = uuid.uuid4().hex
    vocab_all = cut_lineage(E1.vocabulary(spark, sf_dir, drop_lt_freq=None), "vocab_all")
    vectors = IO.write_bucketed(E3.vectors_from_table(spark, sf_dir, vocab_all), f"vectors_{tag}", buckets=16)
    vocab = IO.write_bucketed(vocab_all.where(F.col("freq") >= WV_MIN_COUNT), f"vocab_{tag}", buckets=16)
    matrix = EMB.embedding_matrix(vocab, vectors)
    return matrix.select("idx", F.posexplode("vector").alias("dim", "value")).select(
        "idx", F.col("dim").cast("long").alias("dim"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


QUERIES: dict[str, Query] = {
    "vocab_build": q_vocab_build,
    "vocab_special_columns": q_vocab_special_columns,
    "mark_punctuation": q_mark_punctuation,
    "clean_sentence": q_clean_sentence,
    "dialogue_clean": q_dialogue_clean,
    "segmented_table": q_segmented_table,
    "training_corpus": q_training_corpus,
    "max_len": q_max_len,
    "pad_sequences": q_pad_sequences,
    "model_inputs": q_model_inputs,
    "corpus_tokens": q_corpus_tokens,
    "encode": q_encode,
    "decode": q_decode,
    "relative_frequency": q_relative_frequency,
    "subsample": q_subsample,
    "global_position": q_global_position,
    "full_batches": q_full_batches,
    "context_fixed": q_context_fixed,
    "context_random": q_context_random,
    "skipgram_pairs": q_skipgram_pairs,
    "skipgram_pair_rows": q_skipgram_pair_rows,
    "cooccurrence": q_cooccurrence,
    "extend_cooccurrence": q_extend_cooccurrence,
    "ppmi": q_ppmi,
    "train_embeddings": q_train_embeddings,
    "skipgram_embeddings": q_skipgram_embeddings,
    "extend_embeddings": q_extend_embeddings,
    "lookup_vectors": q_lookup_vectors,
    "subword_vectors": q_subword_vectors,
    "embedding_matrix": q_embedding_matrix,
    "corpus_stats": q_corpus_stats,
    "io_roundtrip": q_io_roundtrip,
    "segment_dictionary": q_segment_dictionary,
    "dictionary_tokens": q_dictionary_tokens,
    "dictionary_vocab": q_dictionary_vocab,
    "dictionary_corpus": q_dictionary_corpus,
    "negative_samples": q_negative_samples,
    "ppmi_vectors": q_ppmi_vectors,
    "fold_in_vectors": q_fold_in_vectors,
    "fitted_subwords": q_fitted_subwords,
    "bucketed_matrix": q_bucketed_matrix,
    "csv_splits": q_csv_splits,
    "dictionary_file": q_dictionary_file,
    "saved_embeddings": q_saved_embeddings,
    "map_partitions": q_map_partitions,
}

# Headline queries timed by bench.py (one per operator family, whole tables).
BENCH_QUERIES = [
    "vocab_build",
    "clean_sentence",
    "training_corpus",
    "max_len",
    "pad_sequences",
    "model_inputs",
    "encode",
    "relative_frequency",
    "global_position",
    "skipgram_pairs",
    "ppmi",
]
