"""CSV files in splits against a parser that reads them whole."""

from __future__ import annotations

import csv
import io
import os
import random
import tempfile

import pytest

from wordmill.sources import csv as CSV
from wordmill.sources import io as IO

ALPHABET = ["a", "b", ",", '"', '""', "\n", "\r\n", " ", '5" disc', "é", "中", ",,", "x" * 9]


def _rows(rng, n):
    return [["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 6))) for _ in range(3)] for _ in range(n)]


def _written(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def _read(spark, path):
    got = IO.read_corpus(spark, path, ["A", "B", "C"], null_markers=["", None])
    return [("" if r.A is None else r.A, "" if r.B is None else r.B, "" if r.C is None else r.C) for r in got.orderBy("row_id").collect()]


@pytest.fixture
def small_splits(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in keys}
    yield lambda size: [spark.conf.set(k, str(size)) for k in keys]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [64, 700, 1 << 20])
def test_any_split_gives_the_same_cells(spark, small_splits, size):
    rng = random.Random(size)
    d = tempfile.mkdtemp(prefix="wm-csv-")
    want = []
    for k in range(3):
        rows = [r for r in _rows(rng, 60) if any(r)]
        rows += [["q", "line one\n" * 40, "z"]] * 2  # a cell over several splits
        with open(f"{d}/part-{k}.csv", "w", encoding="utf-8", newline="") as fp:
            fp.write(_written([["A", "B", "C"], *rows]) + "\n\n")
        want += [tuple(r) for r in rows]
    small_splits(size)
    assert _read(spark, d) == want
    if size == 64:
        assert CSV.lines(spark, d).rdd.getNumPartitions() > 30
        assert IO.read_corpus(spark, d).agg({"row_id": "max"}).first()[0] == len(want) - 1


def test_quotes_inside_plain_cells_and_blank_lines(spark, small_splits):
    d = tempfile.mkdtemp(prefix="wm-csv-")
    text = 'A,B,C\n\n5" disc,x,"y"\n  \n"a\n\nb",2" x 4",\r\n"say ""hi""\r\nthere",,"","extra"\nlast,"open'
    with open(f"{d}/t.csv", "w", encoding="utf-8", newline="") as fp:
        fp.write(text)
    for size in (16, 1 << 20):
        small_splits(size)
        assert _read(spark, f"{d}/t.csv") == [('5" disc', "x", "y"), ("a\n\nb", '2" x 4"', ""), ('say "hi"\r\nthere', "", ""), ("last", "open", "")]


def test_files_without_rows(spark):
    d = tempfile.mkdtemp(prefix="wm-csv-")
    for name, text in (("a", "A,B,C\n"), ("b", ""), ("c", "A,B,C\n1,2,3\n"), ("d", "A,B,C\n\n\n4,5,6")):
        with open(f"{d}/{name}.csv", "w") as fp:
            fp.write(text)
    assert _read(spark, d) == [("1", "2", "3"), ("4", "5", "6")]
    assert [r.row_id for r in IO.read_corpus(spark, d, ["A", "B", "C"]).orderBy("row_id").collect()] == [0, 1]


def test_no_whole_file_reader(spark):
    d = tempfile.mkdtemp(prefix="wm-csv-")
    with open(f"{d}/t.csv", "w") as fp:
        fp.write('A,B,C\n1,"2\n3",4\n')
    plan = IO.read_corpus(spark, f"{d}/t.csv")._jdf.queryExecution().executedPlan().toString()
    assert "Format: CSV" not in plan and os.path.exists(d)
