"""Repeated passages by paragraph MinHash banding, exact Jaccard and components.

A paragraph is a content-defined run of words: texts are cut before a word when the
hash of the pair (previous word, word) is the only least one within ``RADIUS`` pairs
on either side.  Cuts depend on nearby words only, so a passage that stands inside
different lines of different documents is cut alike; a passage of over 50 words holds
about four cuts.  Paragraphs of ``SHINGLE`` words or more are compared.

Equal paragraphs (case folded) collapse first, with map-side aggregation.  Each
distinct one of ``MIN_WORDS`` words or more gets MinHash values of its runs of five words
in ``BANDS`` bands of ``ROWS``: a pair at Jaccard 0.8 meets with probability
1 - (1 - 0.8^2)^4 = 0.98, at 0.9 0.999.  Paragraphs that meet are compared exactly, hub by
hub (see ``links``), and linked ones form components.  Shorter paragraphs, of which one
changed word leaves under 0.8, link if equal; changes in them are bridged, see below.

A paragraph alone may be a common line.  An occurrence counts as part of a passage if
the ``CONTEXT`` words before it, or those after it, are those of another occurrence in
its component too (more words beside a short paragraph), so at least ``MIN_WORDS + CONTEXT``
words in a row repeat (fewer only where a text begins or ends), and if its component lies in
two documents or more.

The first such occurrence of a component (least ``doc_id``, then text, then start) stays.
All others are removed, and word by word as far to both sides (up to ``REACH`` words a side)
as they are like an earlier occurrence that shares their context: equal words, and single changed
ones where ``threshold`` of all and the ``AGAIN`` outer ones are equal.  So what is removed is left
standing at an earlier place.  Neighbouring spans become one, also over a gap, if they follow
the same earlier document and the gap, in the one or the other, is at most ``1 - threshold`` of
the whole: then the whole span is within that share of word edits.  Whole spans of
``MIN_SPAN`` words or more are reported.

Defined results: null and empty texts have no paragraphs; a text without a cut is one
paragraph; repeats within one document only are left alone; rows that repeat a ``doc_id`` and text
give their occurrences once; different texts under one ``doc_id`` have spans of their own; a null
``doc_id`` sorts first.  Words to the sides are compared by 32 bits of their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.links import Verify, classes
from wordmill.llm.minhash import lone_weight, similarity, weighted_runs
from wordmill.llm.stage import OWN, Stages
from wordmill.llm.text import U64, Hasher, Words, grams, mix, powers, slices, split_words

RADIUS = 5
MIN_WORDS = 12
CONTEXT = 10
REACH = 32
MIN_SPAN = MIN_WORDS + CONTEXT
AGAIN = 4
SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 4, 2


def cuts(h: np.ndarray, first: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Words before which a text is cut (text starts included), ascending."""
    pair = np.full(len(h) + 2 * radius, np.iinfo(np.uint64).max, dtype=U64)
    inner = pair[radius : radius + len(h)]
    inner[1:] = mix(h[:-1] * U64(0x100000001B3) + h[1:])
    starts = first[:-1][np.diff(first) > 0]
    inner[starts] = np.iinfo(np.uint64).max  # no pair crosses texts
    if not len(h):
        return starts
    near = sliding_window_view(pair, 2 * radius + 1)
    # pairs of neighbouring texts must not count: a text's edge ends the neighbourhood
    least = near.min(axis=1)
    once = (near == inner[:, None]).sum(axis=1) == 1
    cut = (inner == least) & once & (inner != np.iinfo(np.uint64).max)
    doc = np.searchsorted(first, np.arange(len(h)), side="right") - 1
    edge = np.minimum(np.arange(len(h)) - first[doc], first[doc + 1] - 1 - np.arange(len(h)))
    close = np.flatnonzero((edge < radius) & (inner != np.iinfo(np.uint64).max))
    for i in close[inner[close] == _least_inside(pair, close, doc, first, radius)]:
        lo, hi = max(first[doc[i]] + 1, i - radius), min(first[doc[i] + 1], i + radius + 1)
        cut[i] = np.count_nonzero(inner[lo:hi] == inner[i]) == 1
    return np.union1d(np.flatnonzero(cut), starts)


def _least_inside(pair: np.ndarray, at: np.ndarray, doc: np.ndarray, first: np.ndarray, radius: int) -> np.ndarray:
    """Least pair within ``radius`` of each of ``at``, of its own text."""
    place = at[:, None] + np.arange(-radius, radius + 1)
    own = (place >= first[doc[at]][:, None]) & (place < first[doc[at] + 1][:, None])
    return np.where(own, pair[place + radius], np.iinfo(np.uint64).max).min(axis=1)


def _paragraphs(w: Words, h: np.ndarray, hasher: Hasher, radius: int, least: int = SHINGLE):
    """(start, end, text, hash) of the paragraphs of a slice."""
    at = cuts(h, w.first, radius)
    end = np.append(at[1:], len(h)) if len(at) else at
    long = end - at >= least
    at, end = at[long], end[long]
    doc = np.searchsorted(w.first, at, side="right") - 1
    return at, end, doc, run_hash(h, at, end, hasher)


def run_hash(h: np.ndarray, at: np.ndarray, end: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Hash of the words ``at`` to ``end`` of each run, the same wherever they stand."""
    up, down = hasher.up, hasher.down
    if len(h) >= len(up):  # one text longer than the tables
        up, down = powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, dtype=U64)
    np.cumsum(h * up[: len(h)], dtype=U64, out=sums[1:])
    return mix((sums[end] - sums[at]) * down[at] + (end - at).astype(U64))


def min_hashes(g: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """``n x k`` least hashes of the elements ``g`` of each owner (ascending, none empty)."""
    lead = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    out = np.empty((n, k), dtype=U64)
    for j in range(k):
        out[:, j] = np.minimum.reduceat(mix(g + mix(np.array([j + 1], dtype=U64))), lead) if n else 0
    return out


def _units(radius: int, min_words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), lower=True)
            h = hasher.words(w.data, w.start, w.end)
            at, end, doc, key = _paragraphs(w, h, hasher, radius)
            n = end - at
            side = np.maximum(CONTEXT, min_words + CONTEXT - n)
            before = np.maximum(at - side, w.first[doc])
            after = np.minimum(end + side, w.first[doc + 1])
            long = np.flatnonzero(n >= min_words)
            m = n[long]
            word = np.repeat(at[long] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            g, owner = grams(h[word], np.concatenate([[0], np.cumsum(m)]), SHINGLE)
            order = np.lexsort((g, owner))
            new = np.ones(len(g), dtype=bool)
            new[1:] = (g[order][1:] != g[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            runs = np.bincount(owner[order][new], minlength=len(long))
            low = min_hashes(g, owner, len(long), bands * rows)
            rank = np.full(len(at), -1)
            rank[long] = np.arange(len(long))
            rank = pa.array(rank, mask=rank < 0)  # short paragraphs have no bands
            keys = []
            for b in range(bands):
                band = np.full(len(long), b + 1, dtype=U64)
                for r in range(rows):
                    band = mix(band * U64(0x100000001B3) + low[:, b * rows + r])
                keys.append(pa.array(band.view(np.int64)).take(rank))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(doc)) for c in ("doc_id", "text_key")],
                    pa.array((at - w.first[doc]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(runs.astype(np.int32)).take(rank),
                    pa.array(key.view(np.int64)),
                    *[pa.array(run_hash(h, a, b, hasher).view(np.int64)) for a, b in ((before, at), (end, after))],
                    *keys,
                ],
                [*PLACE[:4], "n_runs", "h", "before", "after", *[f"b{b}" for b in range(bands)]],
            )

    return run


def _texts(radius: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), lower=True)
            h = hasher.words(w.data, w.start, w.end)
            at, end, _, key = _paragraphs(w, h, hasher, radius, min_words)  # only these are in bands
            key, some = np.unique(key, return_index=True)
            data = w.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array([data[w.start[a] : w.end[e - 1]].decode("utf-8", "replace") for a, e in zip(at[some], end[some])], pa.string()),
                ],
                ["h", "text"],
            )

    return run


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text_a"):
            sides = []
            for col in ("text_a", "text_b"):
                w = split_words(batch.column(col))
                g, _, owner = weighted_runs(hasher.words(w.data, w.start, w.end), w.first, SHINGLE)
                sides += [g, np.ones(len(g)), owner]
            near = similarity(*sides, batch.num_rows) >= threshold - 1e-12
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _beside(reach: int):
    """Words beside the points listed for each text: on from the point, or back from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), lower=True)
            h = (hasher.words(w.data, w.start, w.end) >> U64(32)).astype(np.uint32).view(np.int32)
            points = batch.column("points")
            doc = np.repeat(np.arange(batch.num_rows), points.value_lengths().to_numpy(zero_copy_only=False))
            flat = points.flatten()
            side = flat.field("side").to_numpy()
            at = flat.field("point").to_numpy() + w.first[doc]
            n = np.minimum(reach, np.where(side == 1, w.first[doc + 1] - at, at - w.first[doc]))
            offsets = np.concatenate([[0], np.cumsum(n)])
            nth = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
            word = np.where(np.repeat(side == 1, n), np.repeat(at, n) + nth, np.repeat(at, n) - 1 - nth)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(doc)) for c in ("doc_id", "text_key")],
                    *[flat.field(c) for c in ("point", "side")],
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(h[word])),
                ],
                ["doc_id", "text_key", "point", "side", "words"],
            )

    return run


PLACE = ["doc_id", "text_key", "start_word", "n_words"]


def _like_words(a: str, b: str, threshold: float) -> Column:
    """Most words from the start of two arrays that are alike: ``threshold`` of them equal in place, the last ``AGAIN`` too.

    Words equal from the start on count however few they are.
    """
    equal = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    zero = F.struct(*[F.lit(0).alias(c) for c in ("n", "equal", "run", "best")])

    def step(s: Column, same: Column) -> Column:
        n, some, run = s.n + 1, s.equal + same.cast("int"), F.when(same, s.run + 1).otherwise(0)
        good = same & ((run >= AGAIN) | (run == n)) & (some >= F.lit(threshold) * n)
        return F.struct(n.alias("n"), some.alias("equal"), run.alias("run"), F.when(good, n).otherwise(s.best).alias("best"))

    return F.coalesce(F.aggregate(equal, zero, step, lambda s: s.best), F.lit(-1))


def _contexts(seen: DataFrame) -> DataFrame:
    """Words beside a component's occurrences that more than one has, with the first and the last of these."""
    context = lambda side, col: F.struct(F.lit(side).alias("side"), F.col(col).alias("ctx"))
    sides = seen.select("root", F.struct(*PLACE).alias("place"), F.explode(F.array(context(0, "before"), context(1, "after"))).alias("c"))
    shared = sides.groupBy("root", "c.side", "c.ctx").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    return shared.where(F.col("least") != F.col("most"))


def _passages(seen: DataFrame, contexts: DataFrame) -> DataFrame:
    """Occurrences in a shared context, of components in two documents or more; the first of each stays."""
    left = contexts.where("side = 0").select("root", F.col("ctx").alias("before"), F.lit(True).alias("has_before"))
    right = contexts.where("side = 1").select("root", F.col("ctx").alias("after"), F.lit(True).alias("has_after"))
    passage = seen.join(left, ["root", "before"], "left").join(right, ["root", "after"], "left")
    passage = passage.where("has_before or has_after").drop("has_before", "has_after")
    doc, place = F.coalesce("doc_id", F.lit(-(2**63))), F.struct(*PLACE)
    lead = passage.groupBy("root").agg(F.min(doc).alias("lo"), F.max(doc).alias("hi"), F.min(place).alias("lead"))
    return passage.join(lead.where("lo < hi").drop("lo", "hi"), "root").withColumn("removed", place != F.col("lead"))


def _ends(passage: DataFrame) -> DataFrame:
    """First and last paragraph of every stretch of neighbours: ``start`` is the stretch's, ``side`` 0 the first."""
    order = Window.partitionBy("doc_id", "text_key").orderBy("start_word")
    stop = F.col("start_word") + F.col("n_words")
    same = lambda step: F.coalesce(step("removed").over(order) == F.col("removed"), F.lit(False))
    rows = passage.withColumns(
        {
            "begins": ~(same(F.lag) & (F.lag(stop).over(order) == F.col("start_word"))),
            "finishes": ~(same(F.lead) & (F.lead("start_word").over(order) == stop)),
        }
    )
    rows = rows.withColumn("start", F.last(F.when(F.col("begins"), F.col("start_word")), ignorenulls=True).over(order))
    sides = F.array_compact(F.array(F.when(F.col("begins"), 0), F.when(F.col("finishes"), 1)))
    return rows.select("*", F.explode(sides).alias("side")).drop("begins", "finishes")


def _asked(ends: DataFrame, contexts: DataFrame) -> DataFrame:
    """Each end with ``other``, the occurrence of like context whose words beside it are to be compared.

    An occurrence that goes is compared with an earlier one only, one that stays with any.  The context on the
    end's own side is asked first.
    """
    me = F.struct(*PLACE)
    other = F.when(F.col("least") < me, F.col("least")).when(~F.col("removed") & (F.col("most") > me), F.col("most"))
    rows = ends
    for name, side in (("near", F.col("side")), ("far", 1 - F.col("side"))):
        rows = rows.withColumns({"_side": side, "_ctx": F.when(side == 0, F.col("before")).otherwise(F.col("after"))})
        known = contexts.select("root", F.col("side").alias("_side"), F.col("ctx").alias("_ctx"), "least", "most")
        rows = rows.join(known, ["root", "_side", "_ctx"], "left").withColumn(name, other).drop("_side", "_ctx", "least", "most")
    point = lambda at: F.when(F.col("side") == 0, F.col(f"{at}start_word")).otherwise(F.col(f"{at}start_word") + F.col(f"{at}n_words"))
    rows = rows.withColumn("other", F.coalesce("near", "far"))
    rows = rows.withColumn("compared", F.col("other").isNotNull()).withColumn("other", F.coalesce("other", "lead"))
    return rows.select(
        "doc_id", "text_key", "removed", "start", "side", point("").alias("point"), "compared",
        F.col("other.doc_id").alias("from_doc"), F.col("other.text_key").alias("from_text"), point("other.").alias("from_point"),
    )


def _extended(asked: DataFrame, beside: DataFrame, threshold: float) -> DataFrame:
    """Stretches with the words added at both ends; ``lo`` and ``hi`` tell the place followed and how far off it is."""
    mine = beside.select("doc_id", "text_key", "point", "side", F.col("words").alias("words"))
    theirs = beside.select(*[F.col(c).alias(f"their_{c}") for c in ("doc_id", "text_key", "point", "side", "words")])
    own = [asked[c].eqNullSafe(mine[c]) for c in ("doc_id", "text_key", "point", "side")]
    rows = asked.where("compared").join(mine, own).select(*[asked[c] for c in asked.columns], mine["words"])
    followed = rows.from_doc.eqNullSafe(F.col("their_doc_id")) & (rows.from_text == F.col("their_text_key"))
    followed &= (rows.from_point == F.col("their_point")) & (rows.side == F.col("their_side"))
    rows = rows.join(theirs, followed).withColumn("n", _like_words("words", "their_words", threshold))
    rows = rows.select(*asked.columns, "n").unionByName(asked.where("not compared").withColumn("n", F.lit(0)))
    follows = F.struct("point", "n", "from_doc", "from_text", (F.col("point") - F.col("from_point")).alias("shift"))
    whole = rows.groupBy("doc_id", "text_key", "removed", "start").agg(
        F.min(F.when(F.col("side") == 0, follows)).alias("lo"), F.min(F.when(F.col("side") == 1, follows)).alias("hi")
    )
    return whole.withColumns({"start": F.col("lo.point") - F.col("lo.n"), "stop": F.col("hi.point") + F.col("hi.n")})


def _joined(spans: DataFrame, threshold: float, min_span: int) -> DataFrame:
    """Spans of a text that overlap, touch or are bridged become one; those of ``min_span`` words or more."""
    text = ["doc_id", "text_key", "removed"]
    order = Window.partitionBy(*text).orderBy("start", "stop")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    near = spans.withColumns(
        {"last": F.max("stop").over(so_far), "was": F.lag(F.struct("start", "stop", "hi")).over(order)}
    )
    gap = F.col("start") - F.col("last")
    # words in the gap of the document followed: its gap differs by the change of the shift
    theirs = gap - F.col("lo.shift") + F.col("was.hi.shift")
    matched = F.col("was.stop") - F.col("was.start") + F.col("stop") - F.col("start")
    bridged = (
        F.col("was.hi.from_doc").eqNullSafe(F.col("lo.from_doc"))
        & F.col("was.hi.from_text").eqNullSafe(F.col("lo.from_text"))
        & (theirs >= 0)
        & (matched >= threshold * (matched + F.greatest(gap, theirs)))
    )
    begins = F.when(F.col("last").isNull() | ((gap > 0) & ~bridged), 1).otherwise(0)
    whole = near.withColumn("begins", begins).withColumn("span", F.sum("begins").over(order))
    follows = F.struct("start", F.col("lo.from_doc").alias("doc"), (F.col("start") - F.col("lo.shift")).alias("at"))
    whole = whole.groupBy(*text, "span").agg(
        F.min("start").alias("start_word"), F.max("stop").alias("stop"), F.min(follows).alias("first")
    )
    n_words = F.col("stop") - F.col("start_word")
    return whole.where(n_words >= min_span).select(
        "doc_id",
        "text_key",
        "start_word",
        n_words.alias("n_words"),
        F.col("first.doc").alias("first_doc"),
        F.col("first.at").alias("first_start"),
        "removed",
    )


def spans_of_texts(
    docs: DataFrame,
    stages: Stages,
    radius: int = RADIUS,
    min_words: int = MIN_WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: float = THRESHOLD,
    reach: int = REACH,
    min_span: int = MIN_SPAN,
) -> DataFrame:
    """As ``repeated_paragraphs``, with ``text_key`` (``xxhash64`` of the text)."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    names = [f"b{b}" for b in range(bands)]
    schema = "doc_id long, text_key long, start_word int, n_words int, n_runs int, h long, before long, after long, " + ", ".join(f"{b} long" for b in names)
    units = stages.cut(docs.mapInArrow(_units(radius, min_words, bands, rows), schema), "paragraphs")
    distinct = units.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("n_runs").cast("long").alias("size"), *[F.min(b).alias(b) for b in names]
    )
    # a short paragraph takes part if it is found again; a long one also if it is like another
    distinct = stages.cut(distinct.where("n > 1 or size is not null"), "distinct")
    buckets = distinct.where("size is not null").select(F.explode(F.array(*names)).alias("key"), F.col("h").alias("id"), "size")

    def prepare(ids: DataFrame) -> tuple[Verify, Verify, None]:
        found = docs.select("text").mapInArrow(_texts(radius, min_words), "h long, text string")
        texts = stages.cut(found.join(ids, found.h == ids.id).select("id", "text").dropDuplicates(["id"]), "texts", narrow=False)
        left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        near = lambda pairs: pairs.join(right, "b").join(left, "a").mapInArrow(_similar(threshold), "a long, b long").distinct()
        return near, lambda some: lone_weight(texts, some, SHINGLE, False), None

    roots, _ = classes(buckets, prepare, stages, threshold)
    linked = roots.select(F.col("id").alias("h"), "root").unionByName(
        roots.select(F.col("root").alias("h"), "root").distinct()
    )
    several = distinct.where("n > 1").select("h").join(linked, "h", "left_anti")
    repeated = linked.unionByName(several.select("h", F.col("h").alias("root")))
    seen = units.select(*PLACE, "before", "after", "h").join(repeated, "h").drop("h").distinct()
    seen = stages.cut(seen, "repeats")
    stages.drop(units, distinct)
    contexts = stages.cut(_contexts(seen), "contexts")
    asked = stages.cut(_asked(_ends(_passages(seen, contexts)), contexts), "asked")
    stages.drop(seen, contexts)
    some = asked.where("compared")
    theirs = some.select(F.col("from_doc").alias("id"), F.col("from_text").alias("key"), F.col("from_point").alias("point"), "side")
    points = some.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "point", "side").unionByName(theirs)
    points = points.groupBy("id", "key").agg(F.collect_set(F.struct("point", "side")).alias("points"))
    points = stages.cut(points, "points", narrow=False)
    own = docs.doc_id.eqNullSafe(points.id) & (docs.text_key == points.key)
    schema = "doc_id long, text_key long, point int, side int, words array<int>"
    beside = docs.join(points, own).select("doc_id", "text_key", "text", "points").mapInArrow(_beside(reach), schema)
    # rows that repeat an id and a text give theirs once
    beside = stages.cut(beside.dropDuplicates(["doc_id", "text_key", "point", "side"]), "beside", narrow=False)
    return _joined(_extended(asked, beside, threshold), threshold, min_span)


def repeated_paragraphs(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """Every span of a repeated passage: ``doc_id, start_word, n_words, first_doc, first_start, removed``.

    ``start_word`` counts white-space words from 0; ``first_doc, first_start`` name the place of
    an earlier occurrence (for one that stays: of another).  Documents without a repeated passage
    have no row.
    """
    return spans_of_texts(docs, stages, **params).drop("text_key")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(OWN + "spans").to_pylist()
        texts = []
        for d, text in enumerate(batch.column("text").to_pylist()):
            if text is not None and spans[d]:
                w = split_words(pa.array([text]))
                data, parts, done = text.encode(), [], 0
                for s in sorted(spans[d], key=lambda x: x["start_word"]):
                    last = s["start_word"] + s["n_words"]
                    stop = int(w.start[last]) if last < len(w.start) else int(w.end[-1])
                    parts.append(data[done : int(w.start[s["start_word"]])])
                    done = stop
                text = b"".join([*parts, data[done:]]).decode()
            texts.append(text)
        cols = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names if n != OWN + "spans"]
        yield pa.RecordBatch.from_arrays(cols, [n for n in batch.schema.names if n != OWN + "spans"])


def drop_repeats(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """``docs``, same columns, with every repeated passage but its first occurrence cut from ``text``.

    A text goes on from the next word; a document may become empty.
    """
    spans = spans_of_texts(docs, stages, **params).where("removed")
    spans = spans.groupBy(F.col("doc_id").alias(OWN + "id"), F.col("text_key").alias(OWN + "key")).agg(
        F.collect_set(F.struct("start_word", "n_words")).alias(OWN + "spans")
    )
    own = F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "id")) & (F.xxhash64(F.col("text").cast("string")) == F.col(OWN + "key"))
    joined = docs.join(spans, own, "left").drop(OWN + "id", OWN + "key")
    return joined.mapInArrow(_without, docs.schema)
