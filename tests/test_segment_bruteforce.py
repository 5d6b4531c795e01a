"""Dictionary segmentation vs exhaustive enumeration on small random fixtures."""

import math
import random
from functools import lru_cache

from pyspark.sql import functions as F

from wordmill.operators.segment import segment_dictionary


def brute(run: str, dic: dict[str, int]) -> list[str]:
    log_total = math.log(sum(dic.values()))

    @lru_cache(maxsize=None)
    def best(i: int):
        """(score, first length, first known, pieces) of the best segmentation of run[i:]."""
        if i == len(run):
            return (0.0, 0, False, ())
        options = []
        for j in range(i + 1, len(run) + 1):
            piece = run[i:j]
            known = piece in dic
            if not known and j - i > 1:
                continue
            lp = math.log(dic[piece]) - log_total if known else -log_total
            rest = best(j)
            options.append((lp + rest[0], j - i, known, ((piece, known),) + rest[3]))
        return max(options, key=lambda o: (o[0], o[1], o[2]))

    tokens, buf = [], ""
    for piece, known in best(0)[3]:
        if not known and len(piece) == 1 and piece.isascii() and piece.isalnum():
            buf += piece
            continue
        if buf:
            tokens.append(buf)
            buf = ""
        tokens.append(piece)
    if buf:
        tokens.append(buf)
    return tokens


def test_matches_enumeration(spark):
    rng = random.Random(11)
    alphabet = "ab发动机油x"
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3))) for _ in range(14)}
    dic = {w: rng.randint(1, 50) for w in words}
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    dic_df = spark.createDataFrame(list(dic.items()), "word string, freq long")
    out = segment_dictionary(df, ["id"], F.col("text"), dic_df).orderBy("id", "run_no", "k").collect()
    got: dict[int, list[str]] = {}
    for r in out:
        got.setdefault(r["id"], []).append(r["token"])
    for i, t in enumerate(texts):
        assert got.get(i, []) == brute(t, dic), (t, dic)


def test_long_runs_take_linear_time(spark):
    import sys
    import time

    rng = random.Random(3)
    dic = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))): rng.randint(1, 50) for _ in range(30)}
    dic["abcd" * 30] = 40  # longer than a piece
    dic_df = spark.createDataFrame(list(dic.items()), "word string, freq long")
    texts = ["".join(rng.choice("abcdx") for _ in range(n)) for n in (63, 64, 65, 129)] + ["x" + "abcd" * 50, "abcd" * 31]
    sys.setrecursionlimit(10_000)
    long = "".join(rng.choice("abcdx") for _ in range(100_000))
    df = spark.createDataFrame(list(enumerate([*texts, long])), "id long, text string")
    start = time.time()
    out = segment_dictionary(df, ["id"], F.col("text"), dic_df).orderBy("id", "run_no", "k").collect()
    assert time.time() - start < 60
    for i, t in enumerate(texts):
        assert [r[3] for r in out if r[0] == i] == brute(t, dic)
    assert "".join(r[3] for r in out if r[0] == len(texts)) == long


def test_only_spans_that_a_prefix_allows_become_rows(spark):
    """One long word does not make a row for every length up to its own."""
    from wordmill.operators.segment import _pieces, dictionary_table, word_spans

    rng = random.Random(5)
    words = [("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))), 5) for _ in range(200)] + [("ab" * 100, 5)]
    dic = dictionary_table(spark.createDataFrame(words, "word string, freq long"))
    runs = ["".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(runs)), "rid long, run string")
    spans = word_spans(_pieces(table, 200), dic)
    every = sum(min(200, len(r) - s) for r in runs for s in range(len(r)))
    assert spans.count() < every / 100
    found = {(r.rid, r.at + r.o, r.l) for r in spans.join(dic, "word").collect()}
    own = {w for w, _ in words}
    assert found == {(i, s, len(w)) for i, r in enumerate(runs) for w in own for s in range(len(r)) if r.startswith(w, s)}


def test_dictionary_positions_are_dense_in_a_cell(spark):
    from wordmill.operators.vocab import text_tokens

    dic = spark.createDataFrame([("发动机", 10), ("漏油", None), ("机油", 8)], "word string, freq long")
    cells = spark.createDataFrame(
        [(0, 5, 0, 0, "发动机漏油, 机油x1y。", False), (0, 5, 0, 1, None, False), (0, 6, 3, 0, "发动机", True)],
        "file_no int, row_id long, col_no int, sub long, text string, special boolean",
    )
    got = [(r.row_id, r.sub, r.pos, r.token) for r in text_tokens(cells, dic).orderBy("row_id", "sub", "pos").collect()]
    assert [t[3] for t in got] == brute("发动机漏油", {"发动机": 10, "漏油": 1, "机油": 8}) + ["<", "COMMA", ">", "机油", "x1y", "<", "PERIOD", ">"]
    assert [t[:3] for t in got] == [(5, 0, k) for k in range(len(got))]


def test_dictionary_mode_in_the_table_flow(spark):
    from wordmill.plans.corpus import process_table

    dic = spark.createDataFrame([("发动机", 10), ("漏油", 5), ("机油", 8), ("车", 3)], "word string, freq long")
    df = spark.createDataFrame([(0, 0, "你好，发动机 漏油！", None), (1, 0, None, "x")], "file_no int, row_id long, Question string, Report string")
    out = {r.file_no: (r.Question, r.Report) for r in process_table(df, stopwords=["车"], dictionary=dic).collect()}
    assert out == {0: ("发动机 漏油", ""), 1: ("", None)}


def test_a_table_of_stopwords_equals_a_list(spark):
    from wordmill.operators.vocab import stopword_frame
    from wordmill.plans.corpus import process_table

    df = spark.createDataFrame([(0, 0, "a the b, the", "the"), (0, 1, None, "c-d the"), (1, 0, "", None)], "file_no int, row_id long, Question string, Report string")
    for mode in ("spaced", "joined"):
        one = process_table(df, stopwords=["the"], mode=mode).orderBy("file_no", "row_id").collect()
        assert one == process_table(df, stopwords=stopword_frame(spark, ["the"]), mode=mode).orderBy("file_no", "row_id").collect()
