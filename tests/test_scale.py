"""What a plan moves, and where: joins, partitions and stages that would not scale."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordmill.constants import CLEAN_LITERALS, CLEAN_WHITESPACE, clean_pattern
from wordmill.functions.text import clean_sentence, strip_ws
from wordmill import session
from wordmill.llm import links
from wordmill.llm.stage import Stages
from wordmill.operators import embeddings as EMB
from wordmill.operators import joins as J
from wordmill.operators import negatives as N
from wordmill.operators import pairs as P
from wordmill.operators import segment as S
from wordmill.operators import sequences as SEQ
from wordmill.operators import vocab as V


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_no_row_a_place_is_broadcast(spark):
    pieces = S._pieces(spark.createDataFrame([(0, "abcdabce"), (1, "zabc")], "rid long, run string"), 4)
    dic = spark.createDataFrame([("abc", 2.0), ("abcd", 1.0), ("zz", 1.0), ("e", 1.0)], "word string, freq double")
    for few in (True, False):
        spans = S.word_spans(pieces, dic, few)
        # abc and abcd share a prefix of four at place 0; zz does not begin at z
        assert sorted((r["rid"], r["at"], r["o"], r["word"]) for r in spans.collect() if r["word"] in ("abc", "abcd", "zz", "e")) == [
            (0, 0, 0, "abc"), (0, 0, 0, "abcd"), (0, 0, 4, "abc"), (0, 0, 7, "e"), (1, 0, 1, "abc")
        ]
        optimized = spans._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("Join Inner") == 1, optimized  # with the prefixes; none with the pieces
        assert ("rightHint=(strategy=broadcast)" if few else "rightHint=(strategy=merge)") in optimized


def test_training_partitions_are_bounded_by_the_cores(spark, monkeypatch):
    seen = []

    class Trainer:
        def __init__(self, **params):
            seen.append(params["numPartitions"])

        def fit(self, df):
            return None

    monkeypatch.setattr(EMB, "Word2Vec", Trainer)
    lines = spark.range(40).select(F.array_repeat(F.lit("w"), 50).alias("tokens"))
    monkeypatch.setattr(EMB, "TOKENS_PER_PARTITION", 10)  # 200 parts' worth
    EMB.train_embeddings(lines)
    monkeypatch.setattr(EMB, "TOKENS_PER_PARTITION", 1000)
    EMB.train_embeddings(lines)
    cores = spark.sparkContext.defaultParallelism
    assert seen == [min(200, cores), min(2, cores)]


def test_vectors_of_a_model_are_read_from_files(spark):
    lines = spark.createDataFrame([(["a", "b", "c"] * 4,)], "tokens array<string>")
    vectors = EMB.word_vectors(EMB.train_embeddings(lines, 4, 2, 1, 1))
    assert "LocalRelation" not in plan_of(vectors) and vectors.inputFiles()
    assert sorted(r["word"] for r in vectors.collect()) == ["a", "b", "c"]


def test_draws_stay_where_they_are_when_the_table_is_small(spark):
    weights = spark.range(5000).select(F.col("id").alias("idx"), N.log_uniform_weight(F.col("id")).alias("w"))
    drawn = N.negative_samples(spark.range(4).select(F.col("id").alias("batch")), weights, n=100, blocks=16)
    assert drawn.count() == 400
    plan = drawn._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("random", [True, False])
@pytest.mark.parametrize("size", [1, 7, 300])
def test_skipgram_pairs_are_those_of_the_context_sets(spark, random, size):
    ids = [(i * i + 3 * (i // 5)) % 6 for i in range(900)]
    rows = [(g // size, g, None if g % 50 == 7 else ids[g]) for g in range(900)]
    batched = spark.createDataFrame(rows, "batch long, gidx long, idx long").repartition(5)
    context = P.context_sets(batched, 3, random)
    brute = Counter()
    reach = {r["gidx"]: r["r"] for r in batched.select("gidx", (P.random_reach(F.col("gidx"), 3) if random else F.lit(3)).alias("r")).collect()}
    for b, g, x in rows:
        near = {rows[h][2] for h in range(max(0, g - reach[g]), min(len(rows), g + reach[g] + 1)) if h != g and rows[h][0] == b}
        brute.update((b, x, c) for c in near - {None})
    for small in (spark, None):  # batches that go over several Arrow batches, and whole ones
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16" if small else "10000")
        found = P.skipgram_pairs(batched, 3, random)
        assert {(r["batch"], r["center"], r["context"]): r["n"] for r in found.collect()} == dict(brute)
    listed = Counter((r["batch"], r["center"], c) for r in context.collect() for c in r["context"])
    assert listed == brute
    assert all(list(r["context"]) == sorted(set(r["context"])) for r in context.collect())
    # no table of a partition's pairs
    assert "HashAggregate" not in found._jdf.queryExecution().sparkPlan().toString()


def test_cleaning_tells_letters_first_and_deletes_what_it_did(spark):
    every = [chr(c) for c in range(0x3100) if c] + [chr(c) for c in range(0xFF00, 0xFFF0)]
    texts = ["a" + c + "Z" + c + c + "9" for c in every] + [f"x{w}y{w[:1]}{w}" for w in CLEAN_LITERALS] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for gap in ("", " "):
        plain = F.regexp_replace(F.coalesce("t", F.lit("")), F.lit(clean_pattern()), F.lit(gap))
        assert df.where(clean_sentence("t", gap) != plain).count() == 0
    assert "(?![0-9A-Za-z])" in plan_of(df.select(clean_sentence("t")))


def test_only_the_ends_of_a_text_are_read_to_strip_it(spark):
    texts = [e + "a" + chr(c) + " b" + e for c in CLEAN_WHITESPACE for e in ("", chr(c), "\n" + chr(c) + "\r\n")] + ["", " \u3000\n", "\u200bx\u200b"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", strip_ws("t").alias("s"))
    assert [(r["t"], r["s"]) for r in df.collect()] == [(t, t.strip("".join(map(chr, CLEAN_WHITESPACE)))) for t in texts] + [(None, None)]
    assert "regexp" not in plan_of(df)


def test_places_of_tokens_are_longs_where_they_fit(spark):
    schema = "file_no int, row_id long, col_no int, sub long, text string, special boolean"
    rows = [(f, r, c, t, f"w{r % 5} x{c} y{t} w{f}", c == 3) for f in (1, 0) for r in (9, -4, 2) for c in (3, 0, 1) for t in (6, 0)]
    rows += [(0, None, 0, 0, "late words", False), (0, 1, 0, 0, None, False), (1, 3, 1, 1, "", False)]
    far = (1, (1 << 62) + 5, 40, 1 << 24, "far away", False)  # leaves no room in a long
    for more, kind in (([], "bigint"), ([far], "decimal(38,0)"), ([(0, -(1 << 63), 0, 0, "least", False), (1, (1 << 63) - 1, 0, 0, "most", False)], "decimal(38,0)")):
        cells = spark.createDataFrame([*rows, *more], schema)
        tokens = V.vocab_tokens(cells)
        assert tokens.schema[V.CELL].dataType.simpleString() == kind
        packed = V.build_vocab(tokens.where("row_id is not null"), V.stopword_frame(spark, ["x1"]))
        plain = V.build_vocab(tokens.where("row_id is not null").drop(V.CELL), V.stopword_frame(spark, ["x1"]))
        assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, plain.collect()))
        freq = {r["word"]: r["freq"] for r in V.build_vocab(tokens, V.stopword_frame(spark, [])).collect()}
        assert freq["late"] == 1 and freq["w0"] == tokens.where("token = 'w0'").count()
    with pytest.raises(Exception, match="out of the range"):
        V.build_vocab(V.vocab_tokens(spark.createDataFrame([(0, 1, 0, -1, "a", False)], schema)), V.stopword_frame(spark, [])).collect()
    empty = V.vocab_tokens(spark.createDataFrame([], schema))
    assert V.build_vocab(empty, V.stopword_frame(spark, ["x"])).count() == 0


def test_buckets_name_their_least_size(spark):
    live = spark.createDataFrame([(1, 5, 9, 5), (1, 6, 4, 6), (2, 5, 9, 5), (2, 7, 8, 5)], "key long, id long, size long, root long")
    for table in (live, live.withColumn("least", F.lit(0).cast("long"))):
        left = links._undecided(table, Stages(spark))
        assert sorted((r["key"], r["id"], r["size"], r["least"]) for r in left.collect()) == [(1, 5, 9, 4), (1, 6, 4, 4)]


def shuffle_blocks(spark) -> int:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return sum(b.startswith("shuffle_") for b in blocks)


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = spark.conf.get(session._CLEANUP)
    n = shuffle_blocks(spark)
    assert session.cut_lineage(spark.range(1000).repartition(7).groupBy(F.col("id") % 13).count()).count() == 13
    for _ in range(50):
        if shuffle_blocks(spark) <= n + 3:  # the count of the rows has one
            break
        time.sleep(0.2)
    assert shuffle_blocks(spark) <= n + 3 and spark.conf.get(session._CLEANUP) == before


@pytest.mark.parametrize("rows, size", [(1 << 19, 1 << 24), (5, 1 << 24), (1 << 19, 10), (0, 0)])
def test_rows_stay_where_they_are_for_frequent_words(spark, monkeypatch, rows, size):
    monkeypatch.setattr(session, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(session, "BROADCAST_BYTES", size)
    tokens = spark.createDataFrame([(i, f"w{i % 9}" if i % 7 else None) for i in range(200)], "pos long, token string")
    words = spark.createDataFrame([(f"w{i}", i, None if i == 3 else 30 - 3 * i) for i in range(8)] + [("w1", 50, 27)], "token string, idx long, freq long")
    plain = tokens.join(words.drop("freq"), "token")
    found = J.join_words(tokens, words, "token", ["pos"])
    assert found.columns == plain.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in optimized and (("Union" in optimized) == (rows < 1 << 19 or size < 1 << 24))


@pytest.mark.parametrize("random", [True, False])
def test_cooccurrence_is_that_of_the_context_sets(spark, monkeypatch, random):
    monkeypatch.setattr(P, "PAIRS", 300)
    monkeypatch.setattr(P, "POSITIONS", 200)
    rows = [(g // 40, g, None if g % 50 == 7 else (g * g + 3 * (g // 5)) % 23 * (-1) ** (g // 400)) for g in range(900)]
    batched = spark.createDataFrame(rows, "batch long, gidx long, idx long").repartition(5)
    brute = Counter((r["center"], c) for r in P.context_sets(batched, 3, random).collect() for c in r["context"])
    found = P.cooccurrence(batched, 3, random)
    assert Counter({(r["w"], r["c"]): r["n"] for r in found.collect()}) == brute and found.count() == len(brute)
    even, odd = (P.cooccurrence(batched.where(F.col("batch") % 2 == k), 3, random) for k in (0, 1))
    both = P.extend_cooccurrence(even, odd)
    assert both.dtypes == found.dtypes and Counter({(r["w"], r["c"]): r["n"] for r in both.collect()}) == brute and both.count() == len(brute)
    # lists of pairs move, not a row for each
    assert all("HashAggregate" not in t._jdf.queryExecution().sparkPlan().toString() for t in (found, both))
    assert P.cooccurrence(batched.where("false"), 3).count() == 0 == P.extend_cooccurrence(even.where("false"), odd.where("false")).count()


def test_sentences_are_made_once(spark, monkeypatch):
    read = []

    class Trainer:
        def __init__(self, **params):
            pass

        def fit(self, df):
            read.extend(df.inputFiles())

    monkeypatch.setattr(EMB, "Word2Vec", Trainer)
    EMB.train_embeddings(spark.range(40).select(F.array_repeat(F.lit("w"), 50).alias("tokens")))
    assert read and all("sentences" in f for f in read)


@pytest.mark.parametrize("rows", [1 << 19, 2])
def test_tokens_of_sentences_move_once(spark, monkeypatch, rows):
    monkeypatch.setattr(session, "BROADCAST_ROWS", rows)
    vocab = spark.createDataFrame([("a", 0), ("b", 4), ("c", 7)], "word string, idx long")
    texts = spark.createDataFrame([(1, "a x  b", 3), (2, "c", 3), (3, "", 2)], "k long, s string, cap int")
    found = SEQ.pad_and_encode(texts, ["k"], "s", "cap", vocab)
    assert {r["k"]: (r["seq"], r["ids"]) for r in found.collect()} == {
        1: ("<start> a <unkonw> <unkonw> <end>", "9 0 11 11 10"),
        2: ("<start> c <end> <pad> <pad>", "9 7 10 8 8"),
        3: ("<start> <unkonw> <end> <pad>", "9 11 10 8"),
    }
    assert ("strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()) == (rows > 2)
