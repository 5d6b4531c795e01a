"""Map the driver's parquet tables onto the Q&A data model.

The original works on a Q&A table ``Brand, Model, Question, Dialogue, Report``
split into a train file and a test file (the test file has no ``Report``).
The driver tables stand in for it, keyed by ``row_id``:

============  ===============================================  ===========
column        driver source                                    col_no
============  ===============================================  ===========
Question      ``documents.text`` (``row_id = doc_id``)          0
Dialogue      ``conversations`` turns of ``conv_id = row_id``   1
Report        ``benchmark.text`` (``row_id = item_id``)         2
Brand         ``part.p_brand`` (``row_id = p_partkey``)         3
Model         ``part.p_type``                                   4
============  ===============================================  ===========

A Q&A record exists for every key found in any of the four sources, so every
row of every table is used.  The original's test file has no ``Report``
column: records with a Report (a ``benchmark`` row) form the train file
(``file_no 0``), the rest the test file (``file_no 1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import OWNER_LABEL, TECHNICIAN_LABEL, TURN_SEPARATOR

TEXT_COLUMNS = ["Question", "Dialogue", "Report"]
SPECIAL_COLUMNS = ["Brand", "Model"]
COL_NO = {"Question": 0, "Dialogue": 1, "Report": 2, "Brand": 3, "Model": 4}
TRAIN, TEST = 0, 1


# Text tables whose per-row work (regex, segmentation) dominates, with their key.
_TEXT_TABLE_KEYS = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """A driver table; text tables are spread over the cores unless only keys are read."""
    path = f"{sf_dir}/{name}.parquet"
    memo = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(memo)
    df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    _SCHEMAS.setdefault(memo, df.schema)
    key = _TEXT_TABLE_KEYS.get(name)
    return spread(df, key, path) if key and spread_rows else df


# Scan split counts and file schemas per (application, path): properties of
# the file layout, looked up once instead of on every read.
_SPLITS: dict[tuple[str, str], int] = {}
_SCHEMAS: dict = {}


def spread(df: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Hash-spread a scan that yields fewer splits than the cluster has cores.

    A parquet file with one row group is read by one task, which would then do
    all regex work alone.  Large inputs already have many splits and are left
    untouched (no extra shuffle at scale).  Hashing on the key keeps retries
    deterministic.
    """
    sc = df.sparkSession.sparkContext
    cores = sc.defaultParallelism
    memo = (sc.applicationId, path) if path else None
    splits = _SPLITS.get(memo) if memo else None
    if splits is None:
        splits = df.rdd.getNumPartitions()
        if memo:
            _SPLITS[memo] = splits
    return df if splits >= cores else df.repartition(cores, key)


def report_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id`` of the records that have a Report: the train file.

    Keys only (no text is read); de-duplicated so a repeated key cannot
    multiply the cells it is joined to.
    """
    return (
        table(spark, sf_dir, "benchmark", spread_rows=False)
        .select(F.col("item_id").alias("row_id"))
        .distinct()
        .withColumn("has_report", F.lit(True))
    )


def file_no(has_report: Column) -> Column:
    return F.when(has_report, F.lit(TRAIN)).otherwise(F.lit(TEST)).cast("int")


def split_name(file_no_col: Column) -> Column:
    return F.when(file_no_col == TRAIN, F.lit("train")).otherwise(F.lit("test"))


def labelled_turn(role: Column, text: Column) -> Column:
    """Speaker label + turn text (system turns carry no label)."""
    label = (
        F.when(role == "user", F.lit(OWNER_LABEL))
        .when(role == "assistant", F.lit(TECHNICIAN_LABEL))
        .otherwise(F.lit(""))
    )
    return F.concat(label, text)


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``Dialogue`` cell per conversation: labelled turns in turn order joined by ``|``.

    A cell is a single row by the data model; the group is one conversation,
    whose size is bounded by Spark's row size like any other cell.  The
    token-level jobs use :func:`qa_cells` instead, which never regroups turns.
    """
    conv = table(spark, sf_dir, "conversations")
    turns = F.collect_list(F.struct(F.col("turn"), labelled_turn(F.col("role"), F.col("text")).alias("t")))
    return conv.groupBy(F.col("conv_id").alias("row_id")).agg(
        F.array_join(F.transform(F.array_sort(turns), lambda x: x["t"]), TURN_SEPARATOR).alias("Dialogue")
    )


def qa_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide Q&A table: ``file_no, split, row_id, Brand, Model, Question, Dialogue, Report``.

    One record per key found in any source.  All sources are stacked in long
    form and grouped once on ``row_id`` (one shuffle, no chain of outer
    joins); each source holds a key at most once, so every column is the
    single value collected for it.  A conversation's turns are ordered and
    joined inside the same aggregate.
    """

    def cells(
        name: str, key: str, col_no: int, text: Column, sub: Column | None = None, text2: Column | None = None
    ) -> DataFrame:
        # No pre-spread: the grouping shuffle below spreads the rows, and the
        # per-cell text work runs after it.
        return table(spark, sf_dir, name, spread_rows=False).select(
            F.col(key).alias("row_id"),
            F.lit(col_no).alias("col_no"),
            (sub if sub is not None else F.lit(0)).cast("long").alias("sub"),
            text.alias("text"),
            (text2 if text2 is not None else F.lit(None).cast("string")).alias("text2"),
        )

    # Brand and Model come from one ``part`` row: one branch, ``text2`` = Model.
    long = (
        cells("documents", "doc_id", COL_NO["Question"], F.col("text"))
        .unionByName(
            cells(
                "conversations", "conv_id", COL_NO["Dialogue"], labelled_turn(F.col("role"), F.col("text")), F.col("turn")
            )
        )
        .unionByName(cells("benchmark", "item_id", COL_NO["Report"], F.col("text")))
        .unionByName(cells("part", "p_partkey", COL_NO["Brand"], F.col("p_brand"), text2=F.col("p_type")))
    )

    def single(name: str, no: str | None = None, value: str = "text") -> Column:
        picked = F.when(F.col("col_no") == COL_NO[no or name], F.col(value))
        # a repeated key keeps all its texts, in a fixed order
        texts = F.array_sort(F.collect_list(picked))
        return F.when(F.size(texts) > 0, F.array_join(texts, " ")).alias(name)

    is_turn = F.col("col_no") == COL_NO["Dialogue"]
    turns = F.array_sort(F.collect_list(F.when(is_turn, F.struct(F.col("sub"), F.col("text")))))
    wide = long.groupBy("row_id").agg(
        single("Brand"),
        single("Model", "Brand", "text2"),
        single("Question"),
        # A conversation with no turns (or only null turns) has no Dialogue cell.
        F.when(F.bool_or(is_turn & F.col("text").isNotNull()), F.array_join(F.transform(turns, lambda x: x["text"]), TURN_SEPARATOR))
        .alias("Dialogue"),
        single("Report"),
        F.bool_or(F.col("col_no") == COL_NO["Report"]).alias("has_report"),
    )
    fno = file_no(F.col("has_report"))
    return wide.select(
        fno.alias("file_no"), split_name(fno).alias("split"), "row_id", "Brand", "Model", "Question", "Dialogue", "Report"
    )


def qa_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of the Q&A table: one row per cell, dialogue turns as separate cells.

    Columns ``file_no int, row_id long, col_no int, sub long, text string,
    special boolean``; ``sub`` is the turn number inside a Dialogue (0
    elsewhere).  Tokenising turn by turn gives the same tokens as tokenising
    the joined cell because the ``|`` joiner is always a token boundary, so no
    regroup of conversations is needed.  Every row of every source is a cell;
    null cells are kept (callers skip them).  The file number comes from one
    join with the Report keys, which AQE broadcasts when their measured size
    is small and sort-merges otherwise.
    """
    question = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.lit(0).alias("col_no"), F.lit(0).cast("long").alias("sub"), F.col("text")
    )
    dialogue = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("row_id"),
        F.lit(1).alias("col_no"),
        F.col("turn").cast("long").alias("sub"),
        labelled_turn(F.col("role"), F.col("text")).alias("text"),
    )
    report = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("row_id"), F.lit(2).alias("col_no"), F.lit(0).cast("long").alias("sub"), F.col("text")
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.inline(
            F.array(
                F.struct(F.lit(3).alias("col_no"), F.lit(0).cast("long").alias("sub"), F.col("p_brand").alias("text")),
                F.struct(F.lit(4).alias("col_no"), F.lit(0).cast("long").alias("sub"), F.col("p_type").alias("text")),
            )
        ),
    )
    cells = question.unionByName(dialogue).unionByName(report).unionByName(part)
    flagged = cells.join(report_keys(spark, sf_dir), "row_id", "left")
    return flagged.select(
        file_no(F.col("has_report")).alias("file_no"),
        "row_id",
        F.col("col_no").cast("int").alias("col_no"),
        "sub",
        "text",
        (F.col("col_no") >= 3).alias("special"),
    )
