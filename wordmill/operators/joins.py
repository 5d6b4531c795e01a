"""Joins of many rows to a table of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.session import may_broadcast

#: A word is hot if it holds this share of a vocabulary's occurrences: there are at most ``1 / HOT_SHARE`` such words.
HOT_SHARE = 1 / 1000
#: Parts that a hot word's rows are dealt to when they are shuffled.
HOT_PARTS = 64


def join_words(rows: DataFrame, words: DataFrame, key: str, spread: list[str]) -> DataFrame:
    """``rows`` joined to ``words`` on ``key``, those of hot words dealt to ``HOT_PARTS`` parts by ``spread``.

    ``words`` has the ``freq`` that tells which are hot; without it the join is a plain one.
    Words that are few enough are broadcast, and the rows stay where they are.  Of more words the
    most frequent are, and only the rows of the others are shuffled.  Where broadcasts are turned
    off both sides are shuffled, and no task gets more of a hot word than its part.
    """
    if "freq" not in words.columns:
        return rows.join(words, key)
    chars = sum([_held(c, kind) for c, kind in words.dtypes], F.lit(0).cast("long"))
    seen = words.agg(F.count(F.lit(1)).alias("n"), F.sum("freq").alias("total"), F.sum(chars).alias("chars")).first()
    if may_broadcast(words.sparkSession, seen["n"], seen["chars"] or 0):
        return rows.join(F.broadcast(words.drop("freq")), key)
    if may_broadcast(words.sparkSession, 0):
        is_common = F.coalesce("freq", F.lit(0)) >= _least_common(words, chars)
        common, rest = (words.where(w).drop("freq") for w in (is_common, ~is_common))
        others = rows.join(F.broadcast(common.select(key)), key, "left_anti")
        return rows.join(F.broadcast(common), key).unionByName(others.join(rest, key))
    total = seen["total"] or 0
    hot = [r[key] for r in words.where(F.col("freq") >= max(1.0, total * HOT_SHARE)).select(key).collect()]  # at most 1 / HOT_SHARE
    if not hot:
        return rows.join(words.drop("freq"), key)
    is_hot = F.col(key).isin(hot)
    part = F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(HOT_PARTS))).otherwise(F.lit(0).cast("long"))
    parts = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(HOT_PARTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    dealt = words.drop("freq").withColumn("_part", F.explode(parts))
    return rows.withColumn("_part", part).join(dealt, [key, "_part"]).drop("_part")


def _held(col: str, kind: str) -> Column:
    """Bytes of a value besides its row."""
    if kind == "array<string>":
        return F.greatest(F.size(col), F.lit(0)) * 16 + F.coalesce(F.octet_length(F.array_join(col, "")), F.lit(0))
    return F.coalesce(F.octet_length(col), F.lit(0)) if kind == "string" else F.lit(0)


def _least_common(words: DataFrame, chars: Column) -> int:
    """The least frequency such that the words that have it or more may be broadcast."""
    sizes = words.groupBy(F.coalesce("freq", F.lit(0)).alias("freq")).agg(F.count(F.lit(1)).alias("n"), F.sum(chars).alias("chars")).collect()
    least, n, held = None, 0, 0
    for r in sorted(sizes, key=lambda r: -r["freq"]):
        n, held = n + r["n"], held + r["chars"]
        if not may_broadcast(words.sparkSession, n, held):
            break
        least = r["freq"]
    return max(r["freq"] for r in sizes) + 1 if least is None else least
