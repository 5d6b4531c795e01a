"""Golden rows from FIXTURES.md for the scalar, vocabulary, padding and pair operators."""

import pytest
from pyspark.sql import functions as F

from wordmill.functions.text import clean_sentence, drop_stopwords_array, mark_punctuation
from wordmill.operators.embeddings import char_ngrams, embedding_matrix
from wordmill.operators.pairs import context_sets, full_batches, relative_frequency, subsample_frequent
from wordmill.operators.segment import segment_dictionary
from wordmill.operators.sequences import max_len, pad_and_encode
from wordmill.operators.vocab import build_vocab, stopword_frame


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(expr(F.col("s")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("ABS Light. On?", "abs light<PERIOD> on<QUESTION_MARK>"),
        ("漏油，怎么办？", "漏油<COMMA> 怎么办？"),
        ('a---b (c); "d": e!', "a<HYPHENS>-b <LEFT_PAREN>c<RIGHT_PAREN><SEMICOLON> <QUOTATION_MARK>d<QUOTATION_MARK><COLON> e<EXCLAMATION_MARK>"),
        ("x,y。z", "x<COMMA>y<PERIOD>z"),
        ("", ""),
    ],
)
def test_mark_punctuation(spark, text, expected):
    assert one(spark, text, mark_punctuation) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("技师说：你好！请问里程多少|车主说：[语音]|车主说：8万公里", "请问里程多少8万公里"),
        ("发动机（1.8T）漏油？", "发动机18T漏油"),
        ("你 好", "你好"),
        ("您您好好", "您好"),
        ("车主 说:车主说", "车主说"),
        ("a;b；c<d>=e", "a;b；c<d>=e"),
        (None, ""),
        ("a　b c\u001cd", "abcd"),
    ],
)
def test_clean_sentence(spark, text, expected):
    assert one(spark, text, clean_sentence) == expected


def test_drop_stopwords_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],)], "t array<string>")
    assert df.select(drop_stopwords_array("t", ["b"]).alias("o")).first()["o"] == ["a", "a", "c"]


def _tokens(spark, words):
    rows = [(0, 0, 0, 0, i, w) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "file_no int, row_id long, col_no int, sub long, pos long, token string")


def test_vocab_first_appearance_and_gaps(spark):
    sw = stopword_frame(spark, ["s"])
    toks = _tokens(spark, "x s y x z y x".split())
    got = sorted(tuple(r) for r in build_vocab(toks, sw, 2).collect())
    assert got == [("x", 0, 3), ("y", 1, 2)]
    got = sorted(tuple(r) for r in build_vocab(toks, sw, None).collect())
    assert got == [("x", 0, 3), ("y", 1, 2), ("z", 2, 1)]
    toks2 = _tokens(spark, "z x s y x y x".split())
    got = sorted(tuple(r) for r in build_vocab(toks2, sw, 2).collect())
    assert got == [("x", 1, 3), ("y", 2, 2)]


def test_pad_sequence(spark):
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate("abcde")], "word string, idx long")
    cases = {
        0: ("a b", "<start> a b <end> <pad> <pad>"),
        1: ("a b c d e", "<start> a b c d <end>"),
        2: ("a zz b", "<start> a <unkonw> b <end> <pad>"),
        3: ("", "<start> <unkonw> <end> <pad> <pad> <pad>"),
        4: (" a  b ", "<start> a <unkonw> b <end> <pad>"),
    }
    df = spark.createDataFrame([(k, v[0], 4) for k, v in cases.items()], "k long, s string, cap long")
    out = {r["k"]: r for r in pad_and_encode(df, ["k"], "s", "cap", vocab).collect()}
    for k, (_, expected) in cases.items():
        assert out[k]["seq"] == expected
    # ids: pad=5, start=6, end=7, unknown=8 (after the largest idx 4)
    assert out[2]["ids"] == "6 0 8 1 7 5"


def test_max_len_population_std(spark):
    df = spark.createDataFrame([("a b",), ("a b c",), ("a",), ("a b c d e f g h",)], "s string")
    assert max_len(df, "s", []).first()["max_len"] == 8


@pytest.mark.parametrize("t, th, kept", [(0.001, 0.8, {3}), (0.001, 0.95, {2, 3}), (0.05, 0.5, {2, 3})])
def test_subsample(spark, t, th, kept):
    ids = [1] * 90 + [2] * 9 + [3]
    enc = spark.createDataFrame([(i,) for i in ids], "idx long")
    assert {r["idx"] for r in subsample_frequent(enc, th, t).collect()} == kept
    drop = {r["idx"]: round(r["p_drop"], 6) for r in relative_frequency(enc, t).collect()}
    if t == 0.001:
        assert drop == {1: 0.966667, 2: 0.894591, 3: 0.683772}
    else:
        assert drop == {1: 0.764298, 2: 0.254644, 3: -1.236068}


def test_batches_and_fixed_context(spark):
    ids = [10, 11, 10, 12, 13, 14, 15]
    pos = spark.createDataFrame([(g, i) for g, i in enumerate(ids)], "gidx long, idx long")
    batched = full_batches(pos, 3)
    got = {r["gidx"]: (r["batch"], r["center"], set(r["context"])) for r in context_sets(batched, 2, random=False).collect()}
    assert got == {
        0: (0, 10, {10, 11}),
        1: (0, 11, {10}),
        2: (0, 10, {10, 11}),
        3: (1, 12, {13, 14}),
        4: (1, 13, {12, 14}),
        5: (1, 14, {12, 13}),
    }


def test_embedding_matrix_joins_on_word(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3)], "word string, idx long")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "word string, vector array<float>")
    got = sorted((r["idx"], list(r["vector"])) for r in embedding_matrix(vocab, vec).collect())
    assert got == [(0, [1.0, 0.0]), (3, [0.0, 1.0])]


def test_char_ngrams(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "w string")
    got = {r["w"]: set(r["g"]) for r in df.select("w", char_ngrams(F.col("w")).alias("g")).collect()}
    assert got["ab"] == {"<ab", "ab>", "<ab>"}
    assert got["abcd"] == {"<ab", "abc", "bcd", "cd>", "<abc", "abcd", "bcd>", "<abcd", "abcd>", "<abcd>"}


def test_dictionary_segmentation(spark):
    dic = spark.createDataFrame(
        [("发动机", 100), ("发动", 50), ("机油", 80), ("漏油", 70), ("车主", 60), ("机", 20), ("油", 20), ("漏", 9), ("动", 5), ("发", 5)],
        "word string, freq long",
    )
    df = spark.createDataFrame([(0, "发动机漏油"), (1, "机油车主")], "id long, text string")
    out = segment_dictionary(df, ["id"], F.col("text"), dic).orderBy("id", "run_no", "k").collect()
    got = {}
    for r in out:
        got.setdefault(r["id"], []).append(r["token"])
    assert got == {0: ["发动机", "漏油"], 1: ["机油", "车主"]}


def test_vocab_first_appearance_order(spark):
    sw = stopword_frame(spark, ["s"])
    for far in (0, 1 << 40, (1 << 61) - 7):  # row ids at any place in a long
        rows = [(f, far + r, c, t, p, w) for f in (0, 1) for r in (3, 1) for c in (0, 2) for t in (0, 5) for p, w in enumerate("q w e q".split())]
        toks = spark.createDataFrame(rows, "file_no int, row_id long, col_no int, sub long, pos long, token string")
        assert sorted(tuple(r) for r in build_vocab(toks, sw, None).collect()) == [("e", 2, 16), ("q", 0, 32), ("w", 1, 16)]


def test_packed_key_orders_like_the_tuple_and_unpacks(spark):
    import random

    from pyspark.sql import functions as F

    from wordmill.operators.vocab import PLACE, pack_key, unpack_key

    rng = random.Random(4)
    top = {"row_id": 1 << 63, "col_no": 64, "sub": 1 << 25, "pos": 1 << 31}
    least = {"row_id": -(1 << 63)}
    rows = [tuple(rng.choice([least.get(k, 0), 1, top[k] - 1, rng.randrange(top[k])]) for k in PLACE) for _ in range(300)]
    df = spark.createDataFrame(rows, "row_id long, col_no int, sub long, pos long")
    out = df.select("*", pack_key().alias("okey")).select("*", F.array(*[c.cast("long") for c in unpack_key("okey")]).alias("back")).collect()
    assert all(tuple(r["back"]) == tuple(r[k] for k in PLACE) for r in out)
    assert sorted(tuple(r[k] for k in PLACE) for r in out) == [tuple(r[k] for k in PLACE) for r in sorted(out, key=lambda r: r["okey"])]


def test_vocabulary_takes_any_number_of_files_and_negative_rows(spark):
    from wordmill.operators.vocab import vocab_tokens

    rows = [(f, r, 0, 0, f"w{f % 7} x{r}", False) for f in (100, 0, 1_000_000, 37) for r in (-7, 3, 1 << 62)]
    cells = spark.createDataFrame(rows, "file_no int, row_id long, col_no int, sub long, text string, special boolean")
    vocab = build_vocab(vocab_tokens(cells), stopword_frame(spark, ["s"]), None)
    got = [r["word"] for r in vocab.orderBy("idx").collect()]
    assert got == list(dict.fromkeys(w for _, _, _, _, t, _ in sorted(rows) for w in t.replace("-", " ").split()))
    plan = vocab_tokens(cells).groupBy("token", "file_no").agg(F.min("pos"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    words = build_vocab(vocab_tokens(cells), stopword_frame(spark, ["s"]), None)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in words
