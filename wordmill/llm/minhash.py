"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

A text is the multiset of its runs of five words (split at ASCII white space, case
folded); its weight at a run is the run's count.  Two texts are linked when the
weighted Jaccard similarity, sum of minima over sum of maxima, is 0.8 or more, and
classes are the connected components of links.

DartMinHash (Christiani 2020): every unit of weight of every element is a region in
which darts fall as a Poisson process along an axis of ranks, drawn by hashing the
element, so equal elements get equal darts in every text.  A dart carries a
coordinate and a rank; each coordinate of the signature keeps its earliest dart.
Only ranks below ``t / total weight`` are drawn, about ``t = k ln k + 4k`` darts for
any text, and a text with a coordinate still empty draws twice as far.

Defined results: null and empty texts, and texts of white space, have no runs and
stay alone; a text of one to four words has one run, all its words; equal word
sequences are one class whatever their white space and case; rows repeating a
``doc_id`` are one document (if their texts differ, links of either count); a null
``doc_id`` gets no row.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.components import components
from wordmill.llm.links import FINE_BITS, Verify, bits_apart, classes, most_apart
from wordmill.llm.stage import Stages
from wordmill.llm.text import U64, Hasher, grams, mix, slices, split_words

SHINGLE = 5
THRESHOLD = 0.8
#: 40 bands of 6: a pair at 0.8 shares no bucket with probability (1 - 0.8^6)^40 = 5e-6.
BANDS, ROWS = 40, 6
#: Times as many hubs a bucket from the third round on: sketches decide nearly all their pairs, so rounds are what costs.
FANS = 64
#: Texts signed at once: some two thousand darts each.
SIGNED_ROWS = 128


def dart_signatures(elem: np.ndarray, weight: np.ndarray, doc: np.ndarray, docs: int, k: int) -> np.ndarray:
    """``docs x k`` signatures of weighted sets: element hashes, positive weights, owner of each.

    ``doc`` ascends.  A text without elements gets zeros.
    """
    out = np.zeros((docs, k), dtype=U64)
    total = np.bincount(doc, weights=weight, minlength=docs)
    todo = np.flatnonzero(total > 0)
    darts = k * math.log(k) + 4 * k
    while len(todo):
        live = np.zeros(docs, dtype=bool)
        live[todo] = True
        pick = live[doc]
        full = _throw(elem[pick], weight[pick], doc[pick], darts / np.maximum(total, 1e-300), out, k)
        todo = todo[~full[todo]]
        darts *= 2
    return out


def _throw(elem: np.ndarray, weight: np.ndarray, doc: np.ndarray, reach: np.ndarray, out: np.ndarray, k: int) -> np.ndarray:
    """Write the earliest darts below ``reach[doc]``; True for texts whose coordinates are all hit."""
    # regions: unit strips of weight (the last may be partial), times unit intervals of rank
    strips = np.ceil(weight).astype(np.int64)
    e = np.repeat(np.arange(len(elem)), strips)
    strip = np.arange(len(e)) - np.repeat(np.cumsum(strips) - strips, strips)
    cells = np.ceil(reach[doc[e]]).astype(np.int64)
    r = np.repeat(np.arange(len(e)), cells)
    cell = np.arange(len(r)) - np.repeat(np.cumsum(cells) - cells, cells)
    e = e[r]
    region = mix(elem[e] + mix(strip[r].astype(U64) * U64(0x632BE59BD9B4E019) + cell.astype(U64)))
    part = np.minimum(1.0, weight[e] - strip[r])
    owner, limit = doc[e], reach[doc[e]] - cell
    at = np.zeros(len(region))
    best = np.full(out.shape[0] * k, np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = 0
    edge = np.minimum(1.0, limit)
    while len(region):
        step += 1
        gap = mix(region + U64(2 * step))
        at = at - np.log(((gap >> U64(11)).astype(np.float64) + 1.0) * 2.0**-53)
        on = at < edge
        region, at, owner, cell, part, edge = (x[on] for x in (region, at, owner, cell, part, edge))
        dart = mix(region + U64(2 * step + 1))
        inside = (dart >> U64(40)).astype(np.float64) * 2.0**-24 < part
        slot = owner[inside] * k + ((dart[inside] & U64(0xFFFFFFFF)) % U64(k)).astype(np.int64)
        rank = cell[inside] + at[inside]
        np.minimum.at(best, slot, rank)
        found.append((slot, rank, dart[inside]))
    flat = out.reshape(-1)
    for slot, rank, dart in found:
        win = rank == best[slot]
        flat[slot[win]] = dart[win]
    return np.isfinite(best).reshape(out.shape).all(axis=1)


def weighted_runs(h: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run hash, count, text) of the distinct runs of each text, texts ascending."""
    g, doc = grams(h, first, size)
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return g[at], np.diff(np.append(at, len(g))).astype(np.float64), doc[at]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of ``rows`` coordinates, with the band's number mixed in."""
    key = np.repeat(mix(np.arange(1, bands + 1, dtype=U64))[None, :], len(sig), axis=0)
    parts = sig.reshape(len(sig), bands, rows)
    for r in range(rows):
        key = mix(key * U64(0x100000001B3) + parts[:, :, r])
    return key


def sketches(sig: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, 64 to a word."""
    bits = np.zeros((len(sig), -(-sig.shape[1] // 64) * 64), dtype=np.uint8)
    bits[:, : sig.shape[1]] = mix(sig) & U64(1)
    return np.packbits(bits, axis=1).view(U64)


def _lists(keep: np.ndarray, rows: np.ndarray) -> pa.ListArray:
    """A list column: the next of ``rows`` where ``keep``, else an empty list."""
    offsets = np.concatenate([[0], np.cumsum(keep * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64)))


def _signed(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text", rows=SIGNED_ROWS):
            w = split_words(batch.column("text"), lower=True)
            h = hasher.words(w.data, w.start, w.end)
            n = w.n
            place = mix(np.arange(len(h), dtype=U64) - w.first[:-1].astype(U64)[w.doc])
            sums = np.zeros((2, len(h) + 1), dtype=U64)
            np.cumsum(mix(h ^ place), dtype=U64, out=sums[0, 1:])
            np.cumsum(mix(h + place * U64(0x100000001B3)), dtype=U64, out=sums[1, 1:])
            k1, k2 = (s[w.first[1:]] - s[w.first[:-1]] for s in sums)
            g, weight, doc = weighted_runs(h, w.first)
            signatures = dart_signatures(g, weight, doc, len(n), bands * rows)
            keep = n > 0
            keys = band_keys(signatures, bands, rows)[keep]
            bits = sketches(signatures)[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)),
                    pa.array(n.astype(np.int64)),
                    _lists(keep, keys),
                    _lists(keep, bits),
                ],
                ["doc_id", "k1", "k2", "n", "bands", "sketch"],
            )

    return run


SIGNED = "doc_id long, k1 long, k2 long, n long, bands array<long>, sketch array<long>"


def similarity(ga: np.ndarray, wa: np.ndarray, da: np.ndarray, gb, wb, db, pairs: int) -> np.ndarray:
    """Weighted Jaccard of each pair's two sets, given as (element, weight, pair)."""
    salt = mix(np.arange(1, pairs + 1, dtype=U64))
    _, ia, ib = np.intersect1d(mix(ga ^ salt[da]), mix(gb ^ salt[db]), assume_unique=True, return_indices=True)
    low = np.bincount(da[ia], weights=np.minimum(wa[ia], wb[ib]), minlength=pairs)
    total = np.bincount(da, weights=wa, minlength=pairs) + np.bincount(db, weights=wb, minlength=pairs)
    return low / np.maximum(total - low, 1e-300)


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text_a"):
            sides = []
            for col in ("text_a", "text_b"):
                w = split_words(batch.column(col), lower=True)
                sides += weighted_runs(hasher.words(w.data, w.start, w.end), w.first)
            near = similarity(*sides, batch.num_rows) >= threshold - 1e-12
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _verified_links(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, threshold: float, k: int) -> DataFrame:
    """Pairs of ``(a, b)`` whose texts reach ``threshold``.

    First one bit of each coordinate is compared: a pair at the threshold agrees on
    ``(1 + threshold) / 2`` of them, so pairs six standard deviations below (one in a
    billion true ones) are left out before any text moves.
    """
    sa = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
    sb = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
    close = pairs.join(sa, "a").join(sb, "b").where(bits_apart("sketch_a", "sketch_b") <= most_apart(k, threshold)).select("a", "b").distinct()
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return close.join(right, "b").join(left, "a").mapInArrow(_verified(threshold), "a long, b long").distinct()


def _elements(size: int, counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), lower=True)
            g, weight, doc = weighted_runs(hasher.words(w.data, w.start, w.end), w.first, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(doc)), pa.array(g.view(np.int64)), pa.array(weight if counted else np.ones(len(g)))],
                ["id", "element", "weight"],
            )

    return run


def lone_weight(texts: DataFrame, ids: DataFrame, size: int, counted: bool) -> DataFrame:
    """``(id, alone)``: the weight of a text's runs of ``size`` words that no other text of ``ids`` holds."""
    some = texts.join(ids, "id", "left_semi").select("id", "text")
    runs = some.mapInArrow(_elements(size, counted), "id long, element long, weight double")
    held = runs.groupBy("element").agg(F.min("id").alias("id"), F.max("id").alias("other"), F.max("weight").alias("weight"))
    return held.where("id = other").groupBy("id").agg(F.sum("weight").alias("alone"))


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in slices(batches, "text", rows=SIGNED_ROWS // 8):
        w = split_words(batch.column("text"), lower=True)
        runs = weighted_runs(hasher.words(w.data, w.start, w.end), w.first)
        bits = sketches(dart_signatures(*runs, batch.num_rows, FINE_BITS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), _lists(np.ones(batch.num_rows, dtype=bool), bits)], ["id", "fine"]
        )


def fine_sketches(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, fine)``: one bit of each of ``FINE_BITS`` coordinates."""
    # some fifty thousand darts a text: small tables are much work
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = texts.join(ids, "id", "left_semi").select("id", "text").repartition(tasks, "id")
    return some.mapInArrow(_fine, "id long, fine array<long>").dropDuplicates(["id"])


def near_duplicates(
    docs: DataFrame,
    stages: Stages,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``(doc_id, class_id)`` for every distinct ``doc_id`` of ``docs(doc_id, text)``; the id is the class's least."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.where("doc_id is not null")
    signed = stages.cut(docs.mapInArrow(_signed(bands, rows), SIGNED), "signed", narrow=False)
    worded = signed.where("n > 0")
    # equal word sequences become one node, named by their least id
    reps = worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    member = stages.cut(worded.join(reps, ["k1", "k2"]).select("doc_id", "rep").distinct(), "member")
    # by the id as well: the rows of a text's copies do not meet in one task
    first = worded.join(reps.withColumnRenamed("rep", "doc_id"), ["k1", "k2", "doc_id"], "left_semi")
    nodes = stages.cut(first.select("doc_id", "n", "bands", "sketch"), "nodes", narrow=False)
    runs = F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)).alias("size")
    buckets = nodes.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), runs)

    def prepare(ids: DataFrame) -> tuple[Verify, Verify, Verify]:
        drawn = nodes.select(F.col("doc_id").alias("id"), "sketch")
        sketches = stages.cut(drawn.join(ids, "id"), "sketches")
        texts = stages.cut(docs.join(ids, docs.doc_id == ids.id, "left_semi"), "texts", narrow=False)
        verify = lambda pairs: _verified_links(pairs, sketches, texts, threshold, bands * rows)
        named = texts.withColumnRenamed("doc_id", "id")
        return verify, lambda some: lone_weight(named, some, SHINGLE, True), lambda some: fine_sketches(named, some)

    roots, links = classes(buckets, prepare, stages, threshold, FANS)
    # a doc_id with several texts belongs to several nodes: tie those too
    ties = member.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b")
    if not ties.isEmpty():
        more = member.join(ties.select("doc_id", "b"), "doc_id").select(F.col("rep").alias("a"), "b")
        roots = stages.cut(components(links.unionByName(more), stages), "roots")
    rooted = member.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    rooted = rooted.groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("class_id"))
    alone = signed.where("n = 0").select("doc_id").distinct().join(member.select("doc_id"), "doc_id", "left_anti")
    return rooted.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; all its columns.

    Rows that repeat a ``doc_id`` count as one; rows without an id are kept.
    """
    kept = near_duplicates(docs, stages, **params).where("doc_id = class_id").select("doc_id")
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))
