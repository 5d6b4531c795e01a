"""Two-level numbering equals a plain sort, across bucket and super-bucket edges."""

from pyspark.sql import functions as F

from wordmill.operators import indexing


def test_sequential_index_matches_sort(spark, monkeypatch):
    monkeypatch.setattr(indexing, "SUPER_BUCKET", 3)
    rows = [(g, (k * 7919) % 1009, k % 5) for g in (0, 1) for k in range(400)]
    df = spark.createDataFrame(rows, "g int, row_id long, pos long").dropDuplicates(["g", "row_id", "pos"])
    out = indexing.sequential_index(df, [F.expr("row_id div 7")], ["row_id", "pos"], "idx", ["g"]).collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r["g"], []).append(((r["row_id"], r["pos"]), r["idx"]))
    for items in by_group.values():
        items.sort()
        assert [i for _, i in items] == list(range(len(items)))


def test_ordered_index_hot_row_matches_sort(spark):
    # One row holds most of the tokens: numbering by range must equal a plain sort.
    rows = [(0, 5, p) for p in range(3000)] + [(f, r, p) for f in (0, 1) for r in range(40) for p in range(3)]
    df = spark.createDataFrame(rows, "file_no int, row_id long, pos long").dropDuplicates()
    out = indexing.ordered_index(df, ["file_no", "row_id", "pos"], "idx").collect()
    got = sorted(((r["file_no"], r["row_id"], r["pos"]), r["idx"]) for r in out)
    assert [i for _, i in got] == list(range(len(got)))
    assert sorted(out[0].asDict()) == ["file_no", "idx", "pos", "row_id"]


def test_hot_words_are_dealt_over_tasks(spark):
    """A word with a third of all tokens: same result, and no task of the join holds its rows alone."""
    from pyspark.sql import functions as F

    from wordmill.operators.vocab import KEY, decode, encode

    rows = spark.range(0, 60_000, 1, 6).select(
        F.lit(0).alias("file_no"), F.col("id").alias("row_id"), F.lit(0).alias("col_no"), F.lit(0).cast("long").alias("sub"), F.lit(0).cast("long").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 5000)).alias("token"),
    )
    counts = {r["token"]: r["count"] for r in rows.groupBy("token").count().collect()}
    vocab = spark.createDataFrame([(w, k, n) for k, (w, n) in enumerate(sorted(counts.items()))], "word string, idx long, freq long")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(keep, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        out = encode(rows, vocab)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        plain = rows.join(vocab.select(F.col("word").alias("token"), "idx"), "token")
        before = [r["n"] for r in plain.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(before) > 20_000 and max(sizes) < 8_000 and sum(sizes) == 60_000
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.select(*KEY, "idx").collect()))
        back = decode(out, vocab)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select(*KEY, "token").collect()))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_subsampling_does_not_move_the_corpus(spark):
    from wordmill.operators.pairs import relative_frequency, subsample_frequent

    enc = spark.range(0, 3000).selectExpr("id as row_id", "case when id % 2 = 0 then 1 else id end as idx")
    out = subsample_frequent(enc, 0.8)
    kept = relative_frequency(enc).where("p_drop < 0.8").select("idx")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, enc.join(kept, "idx", "left_semi").select("row_id", "idx").select(*out.columns).collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
    # with room for more dropped words than are broadcast, the plain join gives the same
    assert subsample_frequent(enc, 0.8, t=1e-9).count() == 0 and subsample_frequent(enc, None).count() == 3000
