"""The corpus pipeline: each stage works on all that its predecessor kept.

``run`` writes every stage as Parquet under the shared checkpoint folder and the
next stage reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import decontaminate, lines, minhash, mixing, quality
from wordmill.llm.queries import read
from wordmill.llm.stage import Stages


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or are outliers of their language and source go.

    Null and empty texts have no words and go; a null language or source is a value of its own; repeated
    rows are judged alike.
    """
    return quality.keep_good(docs, Stages(spark))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all texts but the first that has them; a text they leave without a word goes.

    Null texts stay; null sources are no site; rows that repeat an id and a text keep the same lines; a null id
    sorts first.
    """
    return lines.drop_boilerplate(docs, Stages(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the least id.

    Texts without words stay; rows that repeat an id are one document; rows without an id stay.
    """
    return minhash.keep_one(docs, Stages(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts and items match nothing; items of under eight words are not searched; repeated rows go or
    stay together.
    """
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), Stages(spark))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mix.

    A null source is a source of its own; a null id sorts first; rows of one id are ordered by a hash of their text,
    equal rows in any order.
    """
    return mixing.mix(docs, Stages(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: An outlier model, signatures and a schedule are not SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``documents`` that all stages keep, with ``mix_position``."""
    stages = Stages(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.cut(stage(spark, docs, sf_dir), name, narrow=False)
    return docs
