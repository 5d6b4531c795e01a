"""File formats: vocabulary duplicates, stopword stripping, matrix lines, CSV null markers."""

import tempfile

from wordmill.sources import io as IO


def test_read_vocab_duplicates(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    with open(f"{d}/vocab.txt", "w", encoding="utf-8") as fp:
        fp.write("a\t0\nb\t1\na\t2\r\n")
    w2i, i2w = IO.read_vocab(spark, f"{d}/vocab.txt")
    assert {r["word"]: r["idx"] for r in w2i.collect()} == {"a": 2, "b": 1}
    assert {r["idx"]: r["word"] for r in i2w.collect()} == {0: "a", 1: "b", 2: "a"}


def test_stopwords_and_csv(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    with open(f"{d}/sw.txt", "w", encoding="utf-8") as fp:
        fp.write("  the\nof \nthe\n")
    assert sorted(r["word"] for r in IO.read_stopwords(spark, f"{d}/sw.txt").collect()) == ["of", "the"]
    with open(f"{d}/train.csv", "w", encoding="utf-8") as fp:
        fp.write('Brand,Model,Question,Dialogue,Report\n甲牌,NA,"a ""q""\nline 2",,null\n')
    df = IO.read_corpus(spark, f"{d}/train.csv")
    row = df.first()
    assert row["Brand"] == "甲牌" and row["Model"] is None and row["Report"] is None
    assert row["Question"] == 'a "q"\nline 2'


def test_matrix_and_vocab_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    m = spark.createDataFrame([(3, [0.0, 1.0]), (0, [1.0, 0.5])], "idx long, vector array<float>")
    IO.write_embedding_matrix(m, f"{d}/m")
    text = "".join(open(p, encoding="utf-8", newline="").read() for p in sorted(__import__("glob").glob(f"{d}/m/part-*")))
    assert text == "0\t[1.0, 0.5]\r\n3\t[0.0, 1.0]\r\n"
    v = spark.createDataFrame([("x", 0, 3), ("y", 1, 2), ("t\tab", 2, 9)], "word string, idx long, freq long")
    IO.write_vocab(v, f"{d}/v")
    w2i, _ = IO.read_vocab(spark, f"{d}/v")
    assert sorted((r["word"], r["idx"]) for r in w2i.collect()) == [("t\tab", 2), ("x", 0), ("y", 1)]


def test_every_word_survives_the_vocabulary_file(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    words = ["a", "\\", "\\t", "\t", "\r\n", "a\\nb\n", "\\\\t", "é x"]
    IO.write_vocab(spark.createDataFrame([(w, k, 1) for k, w in enumerate(words)], "word string, idx long, freq long"), f"{d}/v")
    w2i, i2w = IO.read_vocab(spark, f"{d}/v")
    assert {r["word"]: r["idx"] for r in w2i.collect()} == {w: k for k, w in enumerate(words)}


def test_a_vocabulary_from_elsewhere_is_read_as_it_stands(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    words = ["a\\tb", "\\", "\\\\n", "plain", '"q"']
    with open(f"{d}/vocab.txt", "w", encoding="utf-8") as fp:
        fp.write("".join(f"{w}\t{k}\n" for k, w in enumerate(words)))
    for path in (f"{d}/vocab.txt", d):
        w2i, _ = IO.read_vocab(spark, path)
        assert {r["word"]: r["idx"] for r in w2i.collect()} == {w: k for k, w in enumerate(words)}


def test_last_line_wins_over_several_parts(spark):
    d = tempfile.mkdtemp(prefix="wm-io-")
    with open(f"{d}/part-0.txt", "w", encoding="utf-8") as fp:
        fp.write("a\t0\n")
    with open(f"{d}/part-1.txt", "w", encoding="utf-8") as fp:
        fp.write("".join(f"w{k}\t{k}\n" for k in range(3, 300)) + "a\t2\n")
    w2i, _ = IO.read_vocab(spark, d)
    assert {r["word"]: r["idx"] for r in w2i.where("word = 'a'").collect()} == {"a": 2}


def test_repeated_keys_keep_all_texts(spark):
    from wordmill.sources.driver_tables import qa_table

    d = tempfile.mkdtemp(prefix="wm-io-")
    tables = {
        "documents": ("doc_id long, text string", [(1, "b"), (1, "a"), (2, "c")]),
        "conversations": ("conv_id long, turn long, role string, text string", [(1, 0, "user", "hi")]),
        "benchmark": ("item_id long, text string", [(1, "r")]),
        "part": ("p_partkey long, p_brand string, p_type string", [(1, "B", "M")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    got = {r["row_id"]: r["Question"] for r in qa_table(spark, d).collect()}
    assert got == {1: "a b", 2: "c"}


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from wordmill.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
