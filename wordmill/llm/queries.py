"""The registered queries of the training-data operators: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import (
    chat, decontaminate, infill, lines, minhash, mixing, packing, paragraphs, pii, quality, spelling, tokens, warc,
)
from wordmill.llm.stage import Stages


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with its closest run."""
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Stages(spark))
    return found.select("doc_id", "item_id", "distance", "start_word", "n_words").distinct()


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), Stages(spark))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document."""
    return tokens.token_counts(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    return quality.quality(read(spark, sf_dir, "documents"), Stages(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the digest of the remaining text of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.line_dedup(docs, Stages(spark)).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a repeated paragraph; all but the first are removed."""
    return paragraphs.repeated_paragraphs(read(spark, sf_dir, "documents"), Stages(spark))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.placed(docs, Stages(spark)).select(
        F.col("_id").alias("doc_id"), mixing.source_of("_src").alias("source"), "position", "slot", "block"
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of one that quotes the template."""
    quote = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", quote), (-7, 1, "assistant", quote)], "conv_id long, turn long, role string, text string"
    )
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    return chat.digests(chat.format_chats(rows.unionByName(more)))


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    stages = Stages(spark)
    manifest = warc.write_archive(read(spark, sf_dir, "pages"), stages)
    return warc.resolved(stages.cut(warc.read_archive(manifest), "warc-records"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents."""
    stages = Stages(spark)
    return spelling.spelling_variants(spelling.word_counts(read(spark, sf_dir, "documents")), stages)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document cut for infilling and of the text restored from it."""
    return infill.restore(infill.fill_in_middle(read(spark, sf_dir, "documents")), texts=False)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, Stages(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_personal_data": op6_personal_data,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_warc_archive": op10_warc_archive,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLE: dict[str, str] = {
    "op5_line_dedup": lines.ORACLE,
    "op9_chat_formatting": chat.ORACLE,
    "op10_warc_archive": warc.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_fill_in_middle": infill.ORACLE,
}
