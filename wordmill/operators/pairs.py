"""Corpus positions, sub-sampling, batches, context windows, pairs, co-occurrence.

W2-W5, O3, U3, P8, A4, J6, F12, R4.  The corpus is a table of ids with a
total reading order; positions are assigned with the two-level prefix sum of
:mod:`indexing`, so nothing is ordered on a single task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.constants import SUBSAMPLE_T
from wordmill.operators.indexing import ordered_index
from wordmill.operators.vocab import KEY
from wordmill.session import cut_lineage, may_broadcast

# tasks get this module's functions by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Positions whose pairs a task counts at once; blocks of the table of all pairs; pairs put together at once, about.
POSITIONS, BLOCKS, PAIRS = 1 << 19, 1 << 13, 1 << 21

#: Most dropped words that are broadcast.
MOST_DROPPED = 100_000

# Seeded reach generator constants (a classic linear congruential step).
LCG_MUL, LCG_ADD, LCG_MOD = 1103515245, 12345, 2147483648


def relative_frequency(encoded: DataFrame, t: float = SUBSAMPLE_T) -> DataFrame:
    """A4 (+P8's drop value): ``idx, n, freq = n / N, p_drop = 1 - sqrt(t / freq)``."""
    total = encoded.agg(F.count(F.lit(1))).scalar()
    freq = F.col("n") / total
    return (
        encoded.groupBy("idx")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("idx", "n", freq.alias("freq"), (1 - F.sqrt(F.lit(t) / freq)).alias("p_drop"))
    )


def subsample_frequent(encoded: DataFrame, th: float | None, t: float = SUBSAMPLE_T) -> DataFrame:
    """P8 + J6: keep occurrences whose word has ``1 - sqrt(t / f) < th``.

    Deterministic threshold (not random).  ``th`` of ``None`` or ``0`` means
    no filter.  Word frequencies are one partial/final aggregate.  A word is
    dropped if ``f >= t / (1 - th)^2``, so at most ``(1 - th)^2 / t`` words are:
    a broadcast of that bound, and the corpus does not move.
    """
    if not th:
        return encoded
    rf = relative_frequency(encoded, t)
    if th < 1 and (1 - th) ** 2 / t <= MOST_DROPPED:
        return encoded.join(F.broadcast(rf.where(F.col("p_drop") >= th).select("idx")), "idx", "left_anti")
    return encoded.join(rf.where(F.col("p_drop") < th).select("idx"), "idx", "left_semi")


def global_position(encoded: DataFrame, key: list[str] = KEY, name: str = "gidx", stage: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Position of each token in the flattened corpus (file, row, column, turn, pos)."""
    return ordered_index(encoded, key, name, stage=stage, keep=keep)


def full_batches(positioned: DataFrame, batch_size: int, name: str = "gidx", total: Column | None = None) -> DataFrame:
    """``batch = gidx div B``; the incomplete last batch is dropped.

    ``total`` (number of positions) may come from a cheaper source than
    re-counting the positioned table, e.g. the staged input of the numbering.
    """
    if total is None:
        total = positioned.agg(F.count(F.lit(1))).scalar()
    limit = total - total % batch_size
    return positioned.where(F.col(name) < limit).withColumn("batch", F.expr(f"`{name}` div {batch_size}"))


def random_reach(gidx: Column, window: int) -> Column:
    """reach in ``[1, window]`` from a seeded hash of the position (retries agree)."""
    step = (F.pmod(gidx, F.lit(LCG_MOD)) * LCG_MUL + LCG_ADD) % LCG_MOD
    return (1 + F.floor(step / 65536) % window).cast("int")


def context_sets(batched: DataFrame, window: int, random: bool = True) -> DataFrame:
    """Per position the distinct neighbour ids within its reach, inside its batch.

    Positions inside a batch are consecutive, so the neighbour at distance
    ``k`` is ``lag(k)`` / ``lead(k)`` over the batch ordered by position:
    offset windows (no per-row frame buffers), partitioned by batch so each
    group is one fixed-size batch and context never crosses a batch edge.
    """
    reach = random_reach(F.col("gidx"), window) if random else F.lit(window)
    w = Window.partitionBy("batch").orderBy("gidx")
    sides = [side("idx", k).over(w).alias(f"{side.__name__}{k}") for k in range(1, window + 1) for side in (F.lag, F.lead)]
    near = [F.when(F.lit(k) <= F.col("r"), F.col(f"{side}{k}")) for k in range(1, window + 1) for side in ("lag", "lead")]
    # the reach is a function of the position, so it does not move with it
    with_r = batched.select("batch", "gidx", "idx", *sides).withColumn("r", reach)
    ctx = with_r.select("batch", "gidx", F.col("idx").alias("center"), F.array(*near).alias("near"))
    # one set operation drops nulls and repeats, without a lambda a row
    none = F.array(F.lit(None).cast(batched.schema["idx"].dataType))
    return ctx.select("batch", "gidx", "center", F.sort_array(F.array_except("near", none)).alias("context")).where(F.size("context") > 0)


def pair_rows(batched: DataFrame, window: int, random: bool = True) -> DataFrame:
    """One ``batch, gidx, center, context`` row per neighbour."""
    return context_sets(batched, window, random).select("batch", "gidx", "center", F.explode("context").alias("context"))


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Small numbers for the values of a column, 0 for null, and the value of each."""
    coded = column.dictionary_encode()
    return coded.indices.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False) + 1, coded.dictionary


def _near(rows: pa.RecordBatch, batch: np.ndarray, idx: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and context (of ``m`` codes) of whole batches whose rows are in order of position, each pair once."""
    reach = rows.column("r").to_numpy(zero_copy_only=False)
    at, near = [], []
    for k in range(1, min(window, len(idx) - 1) + 1):
        i = np.flatnonzero(batch[:-k] == batch[k:])
        on = i[(reach[i] >= k) & (idx[i + k] > 0)]
        back = i[(reach[i + k] >= k) & (idx[i] > 0)]
        at += [on, back + k]
        near += [idx[on + k], idx[back]]
    # a word counts once for each position, however often it is near
    return np.divmod(np.unique(np.concatenate([*at, np.zeros(0, np.int64)]) * m + np.concatenate([*near, np.zeros(0, np.int64)])), m)


def _counted(rows: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """``batch, center, context, n`` of whole batches whose rows are in order of position."""
    batch, batches = _codes(rows.column("batch"))
    idx, words = _codes(rows.column("idx"))
    m = len(words) + 1
    row, context = _near(rows, batch, idx, window, m)
    owner, place = np.unique(batch[row] * m + idx[row], return_inverse=True)
    pair, n = np.unique(place * m + context, return_counts=True)
    place, context = np.divmod(pair, m)
    of_batch, center = np.divmod(owner[place], m)
    take = lambda values, codes: values.take(pa.array(codes - 1, mask=codes == 0))
    columns = [take(batches, of_batch), take(words, center), take(words, context), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["batch", "center", "context", "n"])


def skipgram_pairs(batched: DataFrame, window: int, random: bool = True) -> DataFrame:
    """The pairs counted per batch.

    A batch is of fixed size and in one task, so its pairs are counted there, a few batches at a
    time: a hash table of all of a partition's pairs would not fit a task's memory.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_batches(parts, 1):
            yield _counted(rows, window)

    kind = lambda c: batched.schema[c].dataType.simpleString()
    schema = f"batch {kind('batch')}, center {kind('idx')}, context {kind('idx')}, n long"
    return _by_batch(batched, window, random).mapInArrow(run, schema)


def _by_batch(batched: DataFrame, window: int, random: bool) -> DataFrame:
    reach = random_reach(F.col("gidx"), window) if random else F.lit(window)
    rows = batched.select("batch", "gidx", "idx").repartition("batch").sortWithinPartitions("batch", "gidx")
    return rows.withColumn("r", reach)


def _whole_batches(parts: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in order of batch, ``least`` or more at a time, no batch divided."""
    held: list[pa.RecordBatch] = []  # rows of a batch that may go on, behind whole ones
    n = 0
    for part in parts:
        if not part.num_rows:
            continue
        held.append(part)
        n += part.num_rows
        if n < least or held[0].column("batch")[0] == part.column("batch")[-1]:
            continue
        rows = pa.concat_batches(held)
        batch = _codes(rows.column("batch"))[0]
        whole = int(np.flatnonzero(batch != batch[-1])[-1]) + 1
        yield rows.slice(0, whole)
        held, n = [rows.slice(whole)], rows.num_rows - whole
    if held:
        yield pa.concat_batches(held)


_BLOCKED = "block long, k long, pairs binary"
#: Contexts of a word are dealt to so many blocks, as a frequent word has pairs for more than one.
_DEALT = 64


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of whole numbers, 0 for null, and which are null."""
    return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)


def _summed(w: np.ndarray, none: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pairs in order, each once with the sum of its counts; ``none``: where ``w`` is null."""
    span = int(c.max(initial=0)) + 1
    small = min(w.min(initial=0), c.min(initial=0)) >= 0 and (int(w.max(initial=0)) + 2) * span < 1 << 62
    order = np.argsort(np.where(none, 0, w + 1) * span + c) if small else np.lexsort((c, w, none))
    w, none, c = w[order], none[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1]) | (none[1:] != none[:-1])])[: len(w)])
    return w[first], none[first], c[first], np.add.reduceat(n[order], first) if len(w) else n


def _packed(pairs: np.ndarray) -> bytes:
    """Three rows of numbers, byte by byte from the first to the last, so that equal bytes stand together."""
    return pa.compress(np.ascontiguousarray(pairs.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, k: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=24 * k, codec="zstd"), np.uint8).reshape(8, 3 * k)
    return np.ascontiguousarray(planes.T).view(np.int64).reshape(3, k)


def _blocks_of(w: np.ndarray, none: np.ndarray, c: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each block, of pairs in order."""
    mixed = w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (c % _DEALT).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    block = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % BLOCKS
    order = np.argsort(block, kind="stable")
    found, first = np.unique(block[order], return_index=True)
    ends = np.append(first, len(order))
    rows = np.stack([w[order], c[order], n[order] * 2 + none[order]])
    packed = []
    for i, j in zip(ends[:-1], ends[1:]):
        some = rows[:, i:j].copy()
        some[0, 1:] -= rows[0, i : j - 1]  # differences of what is in order are small
        packed.append(_packed(some))
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.diff(ends)), pa.array(packed, pa.binary())], ["block", "k", "pairs"])


def _merged(blocked: DataFrame, kind: str) -> DataFrame:
    """``w, c, n`` of blocks of pairs that were counted in parts."""
    out = pa.int32() if kind == "int" else pa.int64()

    def put_together(held: list[np.ndarray]) -> pa.RecordBatch:
        w, c, n = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        w, none, c, n = _summed(w, (n % 2).astype(bool), c, n // 2)
        return pa.RecordBatch.from_arrays([pa.array(w, mask=none).cast(out), pa.array(c).cast(out), pa.array(n)], ["w", "c", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for part in parts:
            for block, k, packed in zip(*(part.column(i).to_pylist() for i in ("block", "k", "pairs"))):
                if block != last and size >= PAIRS:
                    yield put_together(held)
                    held, size = [], 0
                some = _unpacked(packed, k)
                some[0] = np.cumsum(some[0])
                held.append(some)
                size, last = size + k, block
        yield put_together(held)

    rows = blocked.repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(run, f"w {kind}, c {kind}, n long")


def cooccurrence(batched: DataFrame, window: int, random: bool = True) -> DataFrame:
    """Pair counts over the whole corpus, those of the context windows (see :func:`context_sets`).

    A task counts the pairs of some thousand batches and sends them as sorted lists, one for each block of the
    table of pairs, which take a few bytes a pair; a block's lists are put together in one task.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _whole_batches(parts, POSITIONS):
            idx, words = _codes(some.column("idx"))
            m = len(words) + 1
            row, context = _near(some, _codes(some.column("batch"))[0], idx, window, m)
            pair, n = np.unique(idx[row] * m + context, return_counts=True)
            center, context = np.divmod(pair, m)
            value = np.append(0, _whole(words)[0])
            yield _blocks_of(value[center], center == 0, value[context], n)

    blocked = _by_batch(batched, window, random).mapInArrow(run, _BLOCKED)
    return _merged(blocked, batched.schema["idx"].dataType.simpleString())


def extend_cooccurrence(base: DataFrame, more: DataFrame) -> DataFrame:
    """R5 on the table form: counts of two corpora add up, exactly and at any vocabulary size.

    The pairs move as sorted lists, as in :func:`cooccurrence`.
    """
    both = base.unionByName(more).select("w", "c", "n")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in parts:
            held.append(part)
            if sum(p.num_rows for p in held) >= PAIRS:
                yield listed(held)
                held = []
        if held:
            yield listed(held)

    def listed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(held)
        w, none, c, n = _summed(*_whole(rows.column("w")), _whole(rows.column("c"))[0], _whole(rows.column("n"))[0])
        return _blocks_of(w, none, c, n)

    return _merged(both.mapInArrow(run, _BLOCKED), both.schema["w"].dataType.simpleString())


def ppmi(co: DataFrame) -> DataFrame:
    """``pmi = ln(n * T / (n_w * n_c))`` and its positive part (Levy & Goldberg 2014)."""
    # The marginals have a row a word.  Staged, they are counted before the pair table moves,
    # and broadcast if they are few enough.
    nw = cut_lineage(co.groupBy("w").agg(F.sum("n").alias("n_w")), "marginal")
    nc = cut_lineage(co.groupBy("c").agg(F.sum("n").alias("n_c")), "marginal")
    few = lambda t: F.broadcast(t) if may_broadcast(t.sparkSession, t.count()) else t
    total = nw.agg(F.sum("n_w")).scalar()
    pmi = F.log(F.col("n").cast("double") * total / (F.col("n_w").cast("double") * F.col("n_c")))
    return co.join(few(nw), "w").join(few(nc), "c").select("w", "c", "n", pmi.alias("pmi"), F.greatest(pmi, F.lit(0.0)).alias("ppmi"))
