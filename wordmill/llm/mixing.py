"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling of blocks.

Documents of a source, in order of ``doc_id``, form blocks of ``block`` rows, one a
slot.  The target is a fluid that serves all sources at once in proportion to their
weights; when it has served the whole of a source, the others go on faster, in their
relative weights.  A block is released at the slot in which the fluid begins it and
due when the fluid has served it; at every slot the released block that is due first
goes first (Baruah et al. 1996).  The fluid itself meets all releases and deadlines, so
each source stays within one block of the fluid after every slot, at any length.

Weights are used as they are, not rounded to parts of a period.  One task holds a few
numbers a source and writes the blocks' slots as it goes; rows meet them in a join.
With a ``period`` given, weights are rounded to its parts instead, and a source that
runs out starts the schedule of the others anew.  Every row keeps its place: none is
dropped or repeated.

Positions are numbered by per-range counts and offsets, so a source may hold any
share of the rows.

Defined results: a null source is a source of its own; sources without a given weight
weigh their number of rows to a power; sources of weight zero follow all others, in equal
shares; a null ``doc_id`` sorts first; rows equal in
``doc_id`` are ordered by a hash of their text, equal rows in any order.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import cycle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.stage import OWN, Stages

#: Rows in a block.
BLOCK = 16


def apportion(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots of each source in a period, at least one each (largest remainder)."""
    period = max(period, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    k = 0
    while sum(slots.values()) < period:
        slots[order[k % len(order)]] += 1
        k += 1
    while sum(slots.values()) > period:
        big = max(slots, key=lambda s: (slots[s], s))
        slots[big] -= 1
    return slots


def pfair_period(slots: dict[str, int]) -> list[str]:
    """The source of each slot of one period."""
    period = sum(slots.values())
    waiting = [(0, s, 0) for s in sorted(slots)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // slots[s]), s, j))
        _, s, j = heapq.heappop(ready)
        out.append(s)
        if j + 1 < slots[s]:
            heapq.heappush(waiting, ((j + 1) * period // slots[s], s, j + 1))
    return out


def _fair(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int]]:
    """Source and block of each slot; all weights are positive.

    Block ``j`` of a source of weight ``w`` begins in the fluid at the virtual time
    ``j / w`` and ends at ``(j + 1) / w``; a slot takes ``1 / W`` of it while sources of
    weight ``W`` in all are left.
    """
    total = math.fsum(weights[s] for s in blocks)
    w = {s: weights[s] / total for s in blocks}
    gone = sorted((n / w[s], s) for s, n in blocks.items())
    # virtual time, slots and weight at which each piece of the fluid begins
    rest, after = [0.0] * (len(gone) + 1), 0.0
    for k in range(len(gone) - 1, -1, -1):
        after += w[gone[k][1]]
        rest[k] = after
    piece, v0, t0 = 0, 0.0, 0.0
    waiting = [(0.0, s, 0) for s in blocks]
    heapq.heapify(waiting)
    ready: list[tuple[float, str, int]] = []
    for t in range(sum(blocks.values())):
        while piece + 1 < len(gone) and t0 + (gone[piece][0] - v0) * rest[piece] <= t + 1:
            t0 += (gone[piece][0] - v0) * rest[piece]
            v0 = gone[piece][0]
            piece += 1
        # what the fluid begins before the slot's end; a hair less, so that rounding releases none too early
        now = (v0 + (t + 1 - t0) / rest[piece]) * (1 - 1e-13)
        while waiting and (waiting[0][0] < now or not ready):
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, ((j + 1) / w[s], s, j))
        _, s, j = heapq.heappop(ready)
        yield s, j
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, ((j + 1) / w[s], s, j + 1))


def schedule(blocks: dict[str, int], weights: dict[str, float], period: int | None = None) -> Iterator[tuple[str, int]]:
    """Source and block of each slot until all blocks are served."""
    if period is None:
        some = {s: n for s, n in blocks.items() if weights[s] > 0}
        yield from _fair(some, weights)
        last = {s: n for s, n in blocks.items() if s not in some}
        yield from _fair(last, dict.fromkeys(last, 1.0))
        return
    left, done = dict(blocks), dict.fromkeys(blocks, 0)
    while left:  # a phase: until the first source runs out
        order = pfair_period(apportion({s: weights[s] for s in left}, period))
        for s in cycle(order):
            yield s, done[s]
            done[s] += 1
            if done[s] == left[s]:
                del left[s]
                break


def _slots(weights: dict[str, float], block: int, period: int | None, exponent: float):
    """Sources ``(_src, n)`` of one task -> ``_s, _b, _slot, _first``: slot and first position of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, int] = {}
        for batch in batches:
            rows.update(zip(batch.column("_src").to_pylist(), batch.column("n").to_pylist()))
        weight = {s: float(weights.get(s, n**exponent)) for s, n in rows.items()}
        names = ["_s", "_b", "_slot", "_first"]
        out: list[list] = [[], [], [], []]
        first = 0
        for slot, (s, j) in enumerate(schedule({s: -(-n // block) for s, n in rows.items()}, weight, period)):
            for col, x in zip(out, (s, j, slot, first)):
                col.append(x)
            first += min(block, rows[s] - j * block)
            if len(out[0]) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *[pa.array(x, pa.int64()) for x in out[1:]]], names)
                out = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *[pa.array(x, pa.int64()) for x in out[1:]]], names)

    return run


def _row_key() -> Column:
    return F.xxhash64(F.col("text").cast("string"), F.col("source").cast("string"))


def source_key(col: str) -> Column:
    """A source's name as a key without nulls: no name stands for no source."""
    name = F.col(col).cast("string")
    return F.when(name.isNull(), _NO_SOURCE).when(name.startswith("\u0000"), F.concat(F.lit("\u0000"), name)).otherwise(name)


def source_of(col: str) -> Column:
    """Inverse of :func:`source_key`."""
    key = F.col(col)
    return F.when(key == _NO_SOURCE, F.lit(None)).when(key.startswith("\u0000"), key.substr(F.lit(2), F.length(key))).otherwise(key)


_NO_SOURCE = "\u0000null"


def _numbered(docs: DataFrame, spread: int, stages: Stages) -> DataFrame:
    """``(_src, _id, _key, rn)``: place of each row within its source by ``doc_id``, from 0.

    Rows fall into ranges of ``doc_id`` found by Spark's own sampling of the order; the
    local number comes from the sorted partition and the offset from counts.
    """
    keys = docs.select(
        source_key("source").alias("_src"),
        F.col("doc_id").cast("long").alias("_id"),
        _row_key().alias("_key"),
    )
    keys = keys.groupBy("_src", "_id", "_key").agg(F.count(F.lit(1)).alias("_n"))
    ranged = keys.repartitionByRange(spread, "_id", "_src", "_key").withColumn("_p", F.spark_partition_id())
    ranged = stages.cut(ranged, "mix-keys")
    within = Window.partitionBy("_p", "_src").orderBy(F.col("_id").asc_nulls_first(), "_key")
    counts = ranged.groupBy("_src", "_p").agg(F.sum("_n").alias("_c"))
    before = Window.partitionBy("_src").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_src", "_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return (
        ranged.withColumn("_l", F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .join(offsets, ["_src", "_p"])
        .select("_src", "_id", "_key", "_n", (F.col("_off") + F.col("_l")).alias("rn"))
    )


def placed(
    docs: DataFrame,
    stages: Stages,
    weights: dict[str, float] | None = None,
    block: int = BLOCK,
    period: int | None = None,
    max_sources: int | None = None,
    exponent: float = 0.5,
) -> DataFrame:
    """``(_src, _id, _key, _copy, position, slot, block)`` of every row of ``docs``.

    ``weights`` names target weights by source; a source without one weighs its number
    of rows to the power ``exponent`` (0.5 lifts small sources, 1 keeps shares).
    ``position`` is the row's place in the mix from 0; ``slot`` its block's slot and
    ``block`` the block's number within its source.  More than ``max_sources`` sources,
    if given, are an error.
    """
    spread = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = stages.cut(_numbered(docs, spread, stages), "mix-rows")
    sizes = stages.cut(rows.groupBy("_src").agg(F.sum("_n").alias("n")), "mix-sources")
    if max_sources is not None and Stages.rows(sizes) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    run = _slots(dict(weights or {}), block, period, exponent)
    plan = stages.cut(sizes.coalesce(1).mapInArrow(run, "_s string, _b long, _slot long, _first long"), "mix-slots", narrow=False)
    each = rows.select(
        "_src", "_id", "_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_copy"), "rn"
    ).select("_src", "_id", "_key", "_copy", (F.col("rn") + F.col("_copy")).alias("rn"))
    each = each.withColumn("_j", F.expr(f"rn div {block}"))
    at = each.join(plan, (F.col("_src") == F.col("_s")) & (F.col("_j") == F.col("_b")))
    position = F.col("_first") + F.expr(f"rn % {block}")
    return at.select(
        "_src", "_id", "_key", "_copy", position.alias("position"), F.col("_slot").alias("slot"), F.col("_j").alias("block")
    )


def mix(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """``docs``, all rows and columns, with ``mix_position`` (replacing a column of that name)."""
    docs = docs.drop("mix_position")
    at = placed(docs, stages, **params).select(
        *[F.col(f"_{c}").alias(f"{OWN}at_{c}") for c in ("id", "key", "copy")], F.col("position").alias("mix_position")
    )
    same = Window.partitionBy(OWN + "id", OWN + "key").orderBy(F.lit(0))
    keyed = docs.withColumns({OWN + "id": F.col("doc_id").cast("long"), OWN + "key": _row_key()})
    keyed = keyed.withColumn(OWN + "copy", (F.row_number().over(same) - 1).cast("long"))
    met = F.col(OWN + "id").eqNullSafe(F.col(OWN + "at_id")) & (F.col(OWN + "key") == F.col(OWN + "at_key")) & (F.col(OWN + "copy") == F.col(OWN + "at_copy"))
    return keyed.join(at, met).select(*docs.columns, "mix_position")
