"""End-to-end jobs, model persistence and the per-partition operator."""

import glob
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from wordmill.operators.embeddings import line_tokens, train_embeddings, word_vectors
from wordmill.operators.segment import map_partitions
from wordmill.plans.corpus import export_padded, export_training_data
from wordmill.plans.vocabulary import vocabulary
from wordmill.sources import io as IO

SF = "/root/testdata/sf0.001"


def test_export_training_data_and_padded(spark):
    out = tempfile.mkdtemp(prefix="wm-e2-")
    merged = export_training_data(spark, SF, out)
    n = merged.count()
    assert spark.read.text(f"{out}/merge_train_test_seg_data").count() == n
    train = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/train_seg_data")
    test = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/test_seg_data")
    assert "Report" in train.columns and "Report" not in test.columns
    assert train.count() + test.count() == n
    rows = export_padded(spark, SF, vocabulary(spark, SF), out)
    lens = {len(r["seq"].split(" ")) for r in rows.where(F.col("kind") == "x").collect()}
    assert len(lens) == 1  # every X line has max_len + 2 tokens
    assert glob.glob(f"{out}/trainY_pad/part-*")


def test_save_and_load_embeddings(spark):
    lines = spark.createDataFrame([("a b c a b",), ("b c a c",)] * 5, "line string")
    model = train_embeddings(line_tokens(lines), vector_size=8, window=2, min_count=1, epochs=1, seed=7)
    path = tempfile.mkdtemp(prefix="wm-w2v-") + "/model"
    IO.save_embeddings(model, path)
    again = IO.load_embeddings(path)
    a = {r["word"]: list(r["vector"]) for r in word_vectors(model).collect()}
    b = {r["word"]: list(r["vector"]) for r in word_vectors(again).collect()}
    assert a == b and set(a) == {"a", "b", "c"} and all(len(v) == 8 for v in a.values())


def test_map_partitions(spark):
    df = spark.range(100).withColumnRenamed("id", "x")

    def double(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(y=pdf["x"] * 2)

    out = map_partitions(df, double, "x long, y long")
    assert out.where("y <> 2 * x").count() == 0 and out.count() == 100
