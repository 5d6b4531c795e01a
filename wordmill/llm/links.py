"""From LSH buckets to classes: verify links against hubs, never all pairs of a bucket.

Round by round each bucket names hubs, every member of another class is compared
with the hubs of its bucket, verified links merge classes, and a bucket ends when
all its members are in one class or every member has been a hub.  A link between
two members of a bucket is therefore either verified or implied by others; none is
lost, and a bucket of copies costs one comparison a member.

What is left after the first round are mostly members of dense groups that lie apart from their
class by a little more than the threshold allows.  They are told by exact counting:
weight in elements that no other member still in question holds cannot be shared, so
a member with too much of it cannot reach the threshold with any of them, and leaves.
Pairs of the rest are compared by long one-bit sketches, made for them alone, before
they become rows: a pair five standard deviations below the threshold is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.components import components
from wordmill.llm.stage import Stages

Verify = Callable[[DataFrame], DataFrame]
Prepare = Callable[[DataFrame], tuple[Verify, Verify, Verify | None]]

#: Times as many hubs a bucket as in the round before, unless the caller says otherwise.
FANS = 8

#: Bits of the long sketches (similarity to 0.0094), and deviations below the threshold that rule a pair out.
FINE_BITS, FINE_DEVIATIONS = 4096, 5


def bits_apart(a: str, b: str) -> Column:
    """Bits in which two sketches (arrays of longs) differ."""
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda n, x: n + x)


def most_apart(bits: int, threshold: float, deviations: float = 6) -> int:
    """Most bits in which sketches of a pair at ``threshold`` differ, but for one in a billion (six deviations)."""
    agree = (1 + threshold) / 2
    return bits - math.floor(bits * agree - deviations * math.sqrt(bits * agree * (1 - agree)))


def _hubs(live: DataFrame, degree: DataFrame | None, fan: int) -> DataFrame:
    """One hub for each bucket and each of ``fan`` shares of its members: most links, then least id.

    From the second round on, all members of a bucket of at most ``fan`` are hubs, so that it ends with the round.
    """
    if degree is not None:
        live = live.join(degree, "id", "left")
        rank = F.struct((-F.coalesce("links", F.lit(0))).alias("d"), "id", "root", "size", "shared")
    else:
        rank = F.struct(F.lit(0).cast("long").alias("d"), "id", "root", "size", "shared")
    share = F.pmod(F.xxhash64("id"), F.lit(fan))
    if fan > 1:
        share = F.when(F.col("members") <= fan, F.col("id")).otherwise(share)
    least = live.groupBy("key", share.alias("share")).agg(F.min(rank).alias("h"))
    return least.select(
        "key", F.col("h.id").alias("hub"), F.col("h.root").alias("hub_root"), F.col("h.size").alias("hub_size"), F.col("h.shared").alias("hub_shared")
    )


def _undecided(live: DataFrame, stages: Stages) -> DataFrame:
    """Members of the buckets that hold more than one class, each with the ``least`` size and the number of ``members`` of its bucket."""
    alive = live.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("size").alias("least"), F.count(F.lit(1)).alias("members"))
    return stages.cut(live.drop("least", "members").join(alive.where("lo < hi").select("key", "least", "members"), "key"), "buckets")


def classes(buckets: DataFrame, prepare: Prepare, stages: Stages, threshold: float, fans: int = FANS) -> tuple[DataFrame, DataFrame]:
    """``buckets(key, id, size)`` -> (``(id, root)`` of linked ids, verified ``links(a, b)``).

    ``size`` is the weight of an id's set: sets further apart than ``threshold`` in
    size cannot be as similar, and are not compared.  ``prepare`` takes the ``(id)`` that
    share a bucket with another and returns three functions: one keeps those pairs
    ``(a, b)`` whose exact similarity reaches the threshold; one takes ``(id)`` and
    returns ``(id, alone)``, the weight of elements that no other of these ids holds; one
    (or None) takes ``(id)`` and returns ``(id, fine)``, their long sketches.  Ids without a link have no row; a root is the least id
    of its class and has none either.
    """
    spark = buckets.sparkSession
    # a bucket of one id, however often, is of no use
    size = buckets.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    whole = {"root": F.col("id"), "shared": F.col("size").cast("double")}
    live = stages.cut(buckets.join(size.select("key"), "key").distinct().withColumns(whole), "buckets")
    verify, alone, sketch = prepare(live.select("id").distinct())
    links = tested = roots = fine = None
    fan = 1
    overlap = threshold / (1 + threshold)  # least shared weight, of the sum of two sizes
    while stages.rows(live):
        degree = None
        if links is not None:
            ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
            degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("links"))
        hubs = stages.cut(_hubs(live, degree, fan), "hubs")
        near, far = live, hubs
        if fine is not None:
            # a bucket may have members times ``fan`` comparisons: not all in one task, small as the tables are
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
            near = live.join(fine, "id").repartition(tasks, "key")
            far = hubs.join(fine.select(F.col("id").alias("hub"), F.col("fine").alias("hub_fine")), "hub").repartition(tasks, "key")
        pairs = near.join(far, "key").where("id <> hub and root <> hub_root")
        # what two sets share is at most the smaller one, and at most what either shares at all
        pairs = pairs.where(F.least("size", "hub_size") >= threshold * F.greatest("size", "hub_size") - 1e-9)
        pairs = pairs.where(F.least("shared", "hub_shared") >= overlap * (F.col("size") + F.col("hub_size")) - 1e-9)
        if fine is not None:
            pairs = pairs.where(bits_apart("fine", "hub_fine") <= most_apart(FINE_BITS, threshold, FINE_DEVIATIONS))
        pairs = pairs.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stages.cut(pairs, "pairs")
        found = stages.cut(verify(pairs), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        # merge classes: components over the roots that the new links tie together
        if roots is None or stages.rows(found):
            roots = stages.cut(components(links, stages), "roots")
        left = live.drop("root").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        left = left.join(hubs.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
        # hubs have met every member, so only the others can hold an unseen link
        nxt = _undecided(left, stages)
        if stages.rows(nxt):
            told = nxt.join(alone(nxt.select("id").distinct()), "id", "left")
            told = told.withColumn("shared", F.col("size") - F.coalesce("alone", F.lit(0.0)))
            could = told.where(F.col("shared") >= overlap * (F.col("size") + F.col("least")) - 1e-9)
            before, nxt = nxt, _undecided(could.drop("alone"), stages)
            stages.drop(before)
            # later rounds have no other ids
            if sketch and fine is None and stages.rows(nxt):
                fine = stages.cut(sketch(nxt.select("id").distinct()), "fine", narrow=False)
        stages.drop(live, hubs)
        live = nxt
        fan *= FANS if fan == 1 else fans
    if links is None:
        none = spark.createDataFrame([], "id long, root long")
        return none, spark.createDataFrame([], "a long, b long")
    return roots, links
