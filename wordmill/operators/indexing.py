"""Distributed dense numbering in a total order (two-level prefix sum).

A bare ``row_number().over(Window.orderBy(...))`` moves every row into one
task.  Here rows are first grouped into *buckets* whose order agrees with the
total order (e.g. consecutive ranges of ``row_id``).  Bucket sizes are counted
(one small row per bucket), turned into running offsets, and each row's number
is ``offset(bucket) + row_number() within its bucket``.  The within-bucket
window runs in parallel over many buckets; only the per-bucket table - one row
per bucket - is ordered globally.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.session import cut_lineage

# Rows of the ordered key per bucket: bounds the within-bucket sort.
DEFAULT_KEYS_PER_BUCKET = 4096


def bucket_width(df: DataFrame, key: str, keys_per_bucket: int = DEFAULT_KEYS_PER_BUCKET) -> int:
    """Width of a ``key`` range per bucket.

    Small inputs get at least ``4 x default parallelism`` buckets so the window
    stage still fans out; large ones get ``keys_per_bucket`` keys per bucket.
    One cheap aggregate over a single column.
    """
    row = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if row is None or row["lo"] is None:
        return 1
    span = int(row["hi"]) - int(row["lo"]) + 1
    fan_out = 4 * df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(keys_per_bucket, math.ceil(span / fan_out)))


def sequential_index(
    df: DataFrame,
    bucket_cols: list[Column],
    order_cols: list[str],
    name: str = "idx",
    group_cols: list[str] | None = None,
) -> DataFrame:
    """Add ``name``: 0-based position of each row in the order ``order_cols``.

    ``bucket_cols`` must be non-decreasing along ``order_cols`` (for example
    ``file_no`` and ``row_id div width`` when the order starts with
    ``file_no, row_id``).  ``order_cols`` must be a total order (no ties), so
    the result does not depend on partitioning or retries.  With
    ``group_cols`` numbering restarts at 0 in every group.
    """
    groups = list(group_cols or [])
    names = [f"_b{i}" for i in range(len(bucket_cols))]
    with_b = df.select("*", *[c.alias(n) for c, n in zip(bucket_cols, names)])
    counts = with_b.groupBy(*groups, *names).agg(F.count(F.lit(1)).alias("_n"))
    offsets = bucket_offsets(counts, groups, names)
    within = Window.partitionBy(*groups, *names).orderBy(*order_cols)
    return (
        with_b.join(offsets, groups + names)
        .withColumn(name, (F.col("_off") + F.row_number().over(within) - 1).cast("long"))
        .drop(*names, "_off")
    )


# Buckets per super-bucket when the bucket table itself is summed.
SUPER_BUCKET = 4096


def bucket_offsets(counts: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """Exclusive running sum of ``_n`` over buckets ``names`` (per group), in two levels.

    The bucket table has one row per bucket - small next to the data, but at
    very large scale still millions of rows - so it is summed like the data:
    super-bucket totals (``SUPER_BUCKET`` buckets each) get a running sum over
    a table thousands of times smaller, and each super-bucket's buckets get
    their running sum in parallel.  No single task orders more than one
    super-bucket or the super-bucket table.
    """
    *prefix, last = names
    sup = counts.withColumn("_s", F.expr(f"`{last}` div {SUPER_BUCKET}"))
    sup_totals = sup.groupBy(*groups, *prefix, "_s").agg(F.sum("_n").alias("_sn"))
    sup_run = Window.partitionBy(*groups).orderBy(*prefix, "_s").rowsBetween(Window.unboundedPreceding, 0)
    sup_off = sup_totals.select(*groups, *prefix, "_s", (F.sum("_sn").over(sup_run) - F.col("_sn")).alias("_soff"))
    run = Window.partitionBy(*groups, *prefix, "_s").orderBy(last).rowsBetween(Window.unboundedPreceding, 0)
    inner = sup.select(*groups, *names, "_s", "_n", (F.sum("_n").over(run) - F.col("_n")).alias("_ioff"))
    return inner.join(sup_off, groups + prefix + ["_s"]).select(
        *groups, *names, (F.col("_soff") + F.col("_ioff")).alias("_off")
    )


# monotonically_increasing_id() = partition id << 33 | record number in the partition.
_LOCAL_BITS = 33


#: Numbers that rise by one from row to row are written as their differences.
_RISING = {"parquet.writer.version": "PARQUET_2_0"}


def range_index(df: DataFrame, order_cols: list[str], name: str, keep: list[str] | None = None) -> DataFrame:
    """Add ``name``: 0-based position in the total order ``order_cols``, skew-proof.

    Rows are range-partitioned on the order (Spark samples the key
    distribution, so even one hot row - a conversation holding a third of all
    tokens - is split over many tasks because the order is total) and sorted
    inside each partition; a row's local number comes from
    ``monotonically_increasing_id``.  That pass is written once under the
    checkpoint dir, so a retry never re-numbers.  Offsets are a running sum
    over the per-partition counts: one row per shuffle partition, a table
    whose size is bounded by the partition count, not by the data, which is
    what makes its broadcast safe.  AQE may coalesce adjacent range
    partitions; coalescing keeps them in order.  ``keep`` names the columns that go on
    (by default all).
    """
    kept = df.columns if keep is None else keep
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    local = cut_lineage(
        ranged.select(
            *kept,
            F.shiftright(mid, _LOCAL_BITS).alias("_p"),
            (mid - F.shiftleft(F.shiftright(mid, _LOCAL_BITS), _LOCAL_BITS)).alias("_l"),
        ),
        "ranged", **_RISING,
    )
    counts = local.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select("_p", (F.sum("_n").over(run) - F.col("_n")).alias("_off"))
    return local.join(F.broadcast(offsets), "_p").select(
        *kept, (F.col("_off") + F.col("_l")).cast("long").alias(name)
    )


def ordered_index(
    df: DataFrame,
    order_cols: list[str],
    name: str,
    file_col: str | None = "file_no",
    row_col: str = "row_id",
    group_cols: list[str] | None = None,
    keys_per_bucket: int = DEFAULT_KEYS_PER_BUCKET,
    stage: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Number rows in the order ``[file_col,] row_col, ...`` (see :func:`sequential_index`).

    Without ``group_cols`` (tokens: many rows per ``row_col``) numbering is
    :func:`range_index`, bounded per task even when one row holds a large share
    of the data.  With ``group_cols`` (one row per ``row_col`` and group, as in
    row batches) buckets are ranges of ``row_col`` of at most ``keys_per_bucket``
    rows; the input is then materialised once unless the caller did (``stage=False``).
    """
    if not group_cols:
        return range_index(df, order_cols, name, keep)
    staged = cut_lineage(df, "ordered") if stage else df
    width = bucket_width(staged, row_col, keys_per_bucket)
    # Integer division: exact for any long key (a double quotient is not).
    buckets = ([F.col(file_col)] if file_col else []) + [F.expr(f"`{row_col}` div {width}")]
    return sequential_index(staged, buckets, order_cols, name, group_cols)
