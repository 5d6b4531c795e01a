"""Segmentation modes and the per-partition escape hatch.

Regex mode (:func:`wordmill.functions.text.segment_regex`) is a column expression.
Dictionary mode finds the maximum-probability path of every maximal letter/digit run:
``score(word) = ln(freq) - ln(total)``, an unknown single character counting as
frequency 1; ties prefer the longer word.  Consecutive unknown ASCII letters/digits
are kept together as one token, as in dictionary segmenters without an unknown-word
model.

There is one path for dictionaries of any size; nothing of a dictionary but its total and
its longest word's length is collected, and no Python runs:

1. Each distinct run is cut into pieces of ``PIECE`` characters (and the longest word's overlap).
2. The first ``PREFIX`` characters at each place are joined to the table of the words' prefixes,
   which says what lengths words of that prefix have.  Only spans of such lengths become rows,
   a few a character, whatever the longest word.
3. The spans are joined to the dictionary; what is found is gathered piece by piece.
4. The best path is a fold over places from the end (an ``aggregate`` over the characters of a
   piece, inside one over pieces): its state is the best scores of the places a word can reach,
   so a run of any length takes time in proportion to it.
5. Tokens go back to every occurrence of their run by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.constants import TOKEN_PATTERN
from wordmill.operators.joins import join_words
from wordmill.session import cut_lineage, drop_cut

#: Characters of a run in one row, before the longest word's overlap.
PIECE = 64
#: Characters of a word that its prefix holds.
PREFIX = 4
#: Most words of a dictionary that is broadcast.
MOST_BROADCAST = 250_000

# Stand after a token: a whole one, and an unknown ASCII letter or digit, which goes on with the next such.
_END, _LOOSE = "\u0001", "\u0002"


def dictionary_table(dictionary: DataFrame) -> DataFrame:
    """``word, freq``: each word once, its counts added up (a null count is 1)."""
    rows = dictionary.select("word", F.coalesce(F.col("freq"), F.lit(1)).cast("double").alias("freq"))
    return rows.where((F.col("freq") > 0) & (F.col("word") != "")).groupBy("word").agg(F.sum("freq").alias("freq"))


def _pieces(runs: DataFrame, longest: int) -> DataFrame:
    """``rid, n, at, text``: pieces of each run, long enough for every word that begins in them."""
    starts = F.sequence(F.lit(0), F.length("run") - 1, F.lit(PIECE))
    cut = F.transform(starts, lambda p: F.struct(p.alias("at"), F.substring("run", p + 1, F.lit(PIECE + longest - 1)).alias("text")))
    return runs.select("rid", F.length("run").alias("n"), F.inline(cut))


def word_spans(pieces: DataFrame, dic: DataFrame, few: bool = False) -> DataFrame:
    """``rid, at, o, l, word``: spans at place ``o`` of a piece that a dictionary word of that prefix and length may be."""
    prefixes = dic.groupBy(F.substring("word", 1, PREFIX).alias("key")).agg(F.collect_set(F.length("word")).alias("lengths"))
    places = pieces.select("rid", "at", "text", F.explode(F.sequence(F.lit(0), F.least(F.lit(PIECE), F.col("n") - F.col("at")) - 1)).alias("o"))
    # the text from each place on goes along: a join back to the pieces would move, or broadcast, every span
    rests = places.select("rid", "at", "o", F.expr("substring(text, o + 1)").alias("rest"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(PREFIX), F.length("rest")))
    keys = rests.select("rid", "at", "o", "rest", F.explode(F.transform(sizes, lambda k: F.substring("rest", F.lit(1), k))).alias("key"))
    # a prefix shorter than PREFIX is a whole word, so its only length is its own
    hits = keys.join(prefixes.hint(_side(few)), "key").select("rid", "at", "o", "rest", F.explode("lengths").alias("l")).where(F.col("l") <= F.length("rest"))
    return hits.select("rid", "at", "o", "l", F.substring("rest", F.lit(1), F.col("l")).alias("word"))


def _side(few: bool) -> str:
    """How a dictionary's table is joined.

    Spark takes exploded rows for as small as the file they come from, so the side to broadcast is named.
    """
    return "broadcast" if few else "merge"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _choices(unknown: float, longest: int) -> Column:
    """Per block of ``blocks``: for each place, twice the length taken there, and one more if it is a word."""

    def place(edges: Column) -> Callable[[Column, Column], Column]:
        def step(acc: Column, o: Column) -> Column:
            score = F.get(acc["w"], F.lit(0)) + F.lit(unknown)
            alone = F.struct(score.alias("s"), F.lit(1).alias("l"), F.lit(False).alias("known"))
            words = F.transform(
                F.filter(edges, lambda e: e["o"] == o),
                lambda e: F.struct((e["lp"] + F.get(acc["w"], e["l"] - 1)).alias("s"), e["l"].alias("l"), F.lit(True).alias("known")),
            )
            return _bound(
                F.array_max(F.concat(F.array(alone), words)),
                lambda t: F.struct(
                    F.slice(F.concat(F.array(t["s"]), acc["w"]), 1, longest).alias("w"),
                    F.concat(F.array((t["l"] * 2 + t["known"].cast("int")).cast("int")), acc["c"]).alias("c"),
                ),
            )

        return step

    def block(acc: Column, b: Column) -> Column:
        start = F.struct(acc["w"].alias("w"), F.array().cast("array<int>").alias("c"))
        places = F.sequence(F.least(F.lit(PIECE), F.col("n") - b["at"]) - 1, F.lit(0), F.lit(-1))
        return _bound(
            F.aggregate(places, start, place(b["edges"])),
            lambda x: F.struct(x["w"].alias("w"), F.concat(F.array(x["c"]), acc["c"]).alias("c")),
        )

    start = F.struct(F.array(F.lit(0.0)).alias("w"), F.array().cast("array<array<int>>").alias("c"))
    return F.aggregate(F.reverse("blocks"), start, block, lambda acc: acc["c"])


def _tokens() -> Column:
    """Tokens along the chosen path of ``blocks`` and ``choices``."""

    def block(acc: Column, z: Column) -> Column:
        def place(a: Column, o: Column) -> Column:
            choice = F.get(z["c"], o)
            token = F.substring(z["text"], o + 1, F.floor(choice / 2).cast("int"))
            loose = (choice % 2 == 0) & token.rlike("^[0-9A-Za-z]$")
            taken = F.struct(
                (a["next"] + F.floor(choice / 2)).cast("int").alias("next"),
                F.concat(a["out"], token, F.when(loose, _LOOSE).otherwise(_END)).alias("out"),
            )
            return F.when(z["at"] + o == a["next"], taken).otherwise(a)

        start = F.struct(acc["next"].alias("next"), F.lit("").alias("out"))
        return _bound(
            F.aggregate(F.sequence(F.lit(0), F.size(z["c"]) - 1), start, place),
            lambda x: F.struct(x["next"].alias("next"), F.concat(acc["out"], F.array(x["out"])).alias("out")),
        )

    zipped = F.zip_with("blocks", "choices", lambda b, c: F.struct(b["at"].alias("at"), b["text"].alias("text"), c.alias("c")))
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("out"))
    marked = F.array_join(F.aggregate(zipped, start, block, lambda acc: acc["out"]), "")
    joined = F.regexp_replace(marked, F.lit(f"{_LOOSE}(?=[0-9A-Za-z]{_LOOSE})"), F.lit(""))
    parts = F.split(joined, f"[{_END}{_LOOSE}]", -1)
    return F.slice(parts, 1, F.size(parts) - 1)  # nothing stands after the last mark


def segment_runs(runs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``run, tokens, freq`` of each distinct ``run``, written: it is read to see how many there are, and by the join."""
    counted = runs.groupBy("run").agg(F.count(F.lit(1)).alias("freq"))
    numbered = cut_lineage(counted.withColumn("rid", F.monotonically_increasing_id()), "runs")
    dic = cut_lineage(dictionary_table(dictionary), "dictionary")
    # three numbers: lambdas take no subqueries
    stats = dic.agg(F.log(F.sum("freq")).alias("total"), F.max(F.length("word")).alias("longest"), F.count(F.lit(1)).alias("words")).first()
    total, longest = float(stats["total"] or 0.0), int(stats["longest"] or 1)
    few = stats["words"] <= MOST_BROADCAST
    pieces = _pieces(numbered, longest)
    known = word_spans(pieces, dic, few).join(dic.hint(_side(few)), "word")
    edge = F.struct("o", "l", (F.log("freq") - F.lit(total)).alias("lp"))
    edges = known.groupBy("rid", "at").agg(F.collect_list(edge).alias("edges"))
    none = F.array().cast("array<struct<o:int,l:int,lp:double>>")
    block = F.struct("at", "text", F.coalesce("edges", none).alias("edges"))
    blocks = pieces.hint("merge").join(edges, ["rid", "at"], "left").groupBy("rid").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(block)).alias("blocks")
    )
    chosen = blocks.withColumn("choices", _choices(-total, longest))
    told = numbered.hint("merge").join(chosen.select("rid", _tokens().alias("tokens")), "rid").select("run", "tokens", "freq")
    told = cut_lineage(told, "told")
    drop_cut(numbered, dic)
    return told


def segment_dictionary(
    df: DataFrame, key_cols: list[str], text: Column, dictionary: DataFrame, pattern: str = TOKEN_PATTERN
) -> DataFrame:
    """R1 dictionary mode: ``key_cols..., run_no, k, token`` (reading order is ``run_no, k``).

    ``dictionary`` has ``word`` and ``freq`` (null freq counts as 1); ``pattern`` says what a run is.
    """
    runs = df.select(*key_cols, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("run_no", "run"))
    told = join_words(runs, segment_runs(runs, dictionary), "run", [*key_cols, "run_no"])
    return told.select(*key_cols, "run_no", F.posexplode("tokens").alias("k", "token"))


def positioned_tokens(df: DataFrame, key_cols: list[str], text: Column, dictionary: DataFrame) -> DataFrame:
    """F14 in dictionary mode: ``key_cols..., pos, token`` with ``pos`` the token's number in its cell (one cell a group)."""
    runs = df.select(*key_cols, F.posexplode(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))).alias("run_no", "run"))
    told = join_words(runs, segment_runs(runs, dictionary), "run", [*key_cols, "run_no"])
    before = Window.partitionBy(*key_cols).orderBy("run_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = told.withColumn("base", F.coalesce(F.sum(F.size("tokens")).over(before), F.lit(0)))
    return placed.select(*key_cols, "base", F.posexplode("tokens").alias("k", "token")).select(
        *key_cols, (F.col("base") + F.col("k")).cast("long").alias("pos"), "token"
    )


def map_partitions(df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """Apply a pandas DataFrame -> DataFrame function to every Arrow batch of every partition.

    The original splits a table into one slice per core and maps a function
    over a process pool; here the slices are Spark partitions.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield func(pdf)

    return df.mapInPandas(run, schema)
