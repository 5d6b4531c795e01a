"""Benchmark passages in documents by CGK embedding and bit-sampling LSH, with exact edit verification.

Texts are words (case folded, punctuation dropped).  A document is contaminated by an
item when some run of its words is within ``edits`` word edits (0.2 of the item's
words) of the whole item.

The CGK random walk (Chakraborty, Goldenberg & Koucky 2016) reads a string with a
pointer that moves on by a hashed bit of the step and the symbol under it; strings at
small edit distance give outputs at small Hamming distance.  Windows of an item's
size class and the items, cut to that size, are embedded by the same walks; a walk's
key is the symbols at ``BITS`` sampled steps, and windows that share a key with an
item are compared with it exactly.  The number of walks is set so that pairs at the
full allowed distance share a key with probability ``RECALL``, measured on simulated
edits.

By the q-gram lemma a window within ``e`` edits of an item holds all but ``2 e`` of
its word pairs; windows with fewer pairs known from the items are not embedded.  This
leaves out no window that could match.

Items are worked through in blocks of ``WORDS_PER_PASS`` words, so what tasks are
sent is bounded however large the benchmark is; every block meets all documents.

Defined results: null and empty texts match nothing; items under ``MIN_WORDS`` words
are not searched, as they would match by chance; items of equal words match alike;
repeated rows give one result; a null ``doc_id`` is reported as null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import OWN, Stages
from wordmill.llm.text import U64, Hasher, mix, slices, split_words

MIN_WORDS = 8
EDITS = 0.2
BITS = 2
RECALL = 0.99
MAX_WALKS = 512
WORDS_PER_PASS = 500_000
#: Longest item of a size class over its shortest.
CLASS_RATIO = 1.25
#: Windows embedded at once.
CHUNK = 1 << 14
_FILTER_BITS = 22


def allowed(m: int, edits: float = EDITS) -> int:
    return int(edits * m + 1e-9)


class Walks:
    """CGK walks over strings of ``size`` symbols and the sampled steps of each."""

    def __init__(self, size: int, walks: int, bits: int, seed: int = 0):
        rng = np.random.default_rng(1_000_003 * seed + size)
        self.size, self.walks, self.bits = size, walks, bits
        self.steps = 2 * size
        self.odd = rng.integers(0, 1 << 63, (MAX_WALKS, self.steps), dtype=np.int64).view(U64)[:walks] * U64(2) + U64(1)
        self.at = np.sort(np.argsort(rng.random((MAX_WALKS, self.steps)), axis=1)[:walks, :bits], axis=1)

    def keys(self, strings: np.ndarray, walk: int) -> np.ndarray:
        """Key of each row (``size`` symbols, then a pad column) under one walk."""
        n = len(strings)
        row = np.arange(n) * strings.shape[1]
        flat = strings.reshape(-1)
        place = np.zeros(n, dtype=np.int64)
        key = np.full(n, walk, dtype=U64)
        taken = 0
        last = int(self.at[walk, -1])
        for t in range(last + 1):
            symbol = flat[row + place]
            while taken < self.bits and self.at[walk, taken] == t:
                key = mix(key * U64(0x100000001B3) + symbol)
                taken += 1
            place += ((symbol * self.odd[walk, t]) >> U64(63)).astype(np.int64)
            np.minimum(place, self.size, out=place)
        return key


def edited(strings: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """Each row after ``edits`` random substitutions, insertions and deletions, cut or padded back."""
    out = np.zeros_like(strings)
    for r, row in enumerate(strings):
        x = row[:-1].tolist()
        for _ in range(edits):
            kind, i = rng.integers(3), int(rng.integers(len(x)))
            new = int(rng.integers(1 << 62))
            x[i : i + (kind != 1)] = [new] if kind < 2 else []
        x = (x + rng.integers(1 << 62, size=len(row)).tolist())[: len(row) - 1]
        out[r, :-1] = x
    return out


def walks_needed(size: int, edits: int, bits: int, recall: float, trials: int = 200) -> int:
    """Least number of walks under which ``recall`` of pairs at the full distance share a key."""
    if edits == 0:
        return 1
    rng = np.random.default_rng(size)
    strings = np.zeros((trials, size + 1), dtype=U64)
    strings[:, :-1] = rng.integers(1, 5000, (trials, size)).astype(U64)
    other = edited(strings, edits, rng)
    walks = Walks(size, MAX_WALKS, bits)
    met = np.zeros(trials, dtype=bool)
    for w in range(MAX_WALKS):
        met |= walks.keys(strings, w) == walks.keys(other, w)
        if met.mean() >= recall:
            return w + 1
    return MAX_WALKS


@dataclass
class SizeClass:
    """Items of similar size: what tasks need to find windows that may match them."""

    size: int  # words of the shortest; windows have this size
    pairs: int  # least known word pairs in a window that may match
    walks: Walks
    items: list[int]
    keys: list[np.ndarray]  # by walk: sorted keys
    owner: list[np.ndarray]  # and the place in ``items`` of each


def size_classes(items: list[np.ndarray], edits: float, bits: int, recall: float) -> list[SizeClass]:
    order = sorted(range(len(items)), key=lambda i: (len(items[i]), i))
    out, k = [], 0
    while k < len(order):
        size = len(items[order[k]])
        own = [i for i in order[k:] if len(items[i]) <= size * CLASS_RATIO]
        k += len(own)
        most = allowed(len(items[own[-1]]), edits)
        walks = Walks(size, walks_needed(size, most, bits, recall), bits)
        strings = np.zeros((len(own), size + 1), dtype=U64)
        for r, i in enumerate(own):
            strings[r, :size] = items[i][:size]
        keys, owner = [], []
        for w in range(walks.walks):
            key = walks.keys(strings, w)
            by = np.argsort(key, kind="stable")
            keys.append(key[by])
            owner.append(by)
        out.append(SizeClass(size, max(0, size - 1 - 2 * most), walks, own, keys, owner))
    return out


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * U64(0x100000001B3) + h[1:]) if len(h) > 1 else np.zeros(0, dtype=U64)


def pair_filter(items: list[np.ndarray]) -> np.ndarray:
    """Bits set for the word pairs of the items; a stray bit only lets more windows through."""
    bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
    for h in items:
        bits[(pair_hashes(h) >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return bits


def candidates(h: np.ndarray, classes: list[SizeClass], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (start word, item) whose keys meet, for the words ``h`` of a slice of texts."""
    # windows start in a text and may run past its end (verification cuts them there), so pad the last
    h = np.concatenate([h, np.zeros(max(c.size for c in classes), dtype=U64)])
    seen = known[(pair_hashes(h) >> U64(64 - _FILTER_BITS)).astype(np.int64)]
    total = np.concatenate([[0], np.cumsum(seen)])
    starts, items = [], []
    for c in classes:
        last = len(h) - c.size
        some = np.flatnonzero(total[c.size - 1 : c.size + last] - total[: last + 1] >= c.pairs)
        own = np.array(c.items)
        for lo in range(0, len(some), CHUNK):
            p = some[lo : lo + CHUNK]
            strings = np.zeros((len(p), c.size + 1), dtype=U64)
            strings[:, : c.size] = h[p[:, None] + np.arange(c.size)]
            for w in range(c.walks.walks):
                key = c.walks.keys(strings, w)
                a, b = np.searchsorted(c.keys[w], key), np.searchsorted(c.keys[w], key, side="right")
                hit = np.flatnonzero(b > a)
                n = (b - a)[hit]
                at = np.repeat(a[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                starts.append(np.repeat(p[hit], n))
                items.append(own[c.owner[w][at]])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(items)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def closest_runs(items: list[np.ndarray], texts: list[np.ndarray], anywhere: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each item to a run of its text, and the run's end.

    With ``anywhere`` a run may start at any word, else at the first.  Ties go to the earliest end.
    """
    n = len(items)
    width = max(len(t) for t in texts)
    height = max(len(x) for x in items)
    a = np.zeros((n, height), dtype=U64)
    b = np.zeros((n, width), dtype=U64)
    for r in range(n):
        a[r, : len(items[r])] = items[r]
        b[r, : len(texts[r])] = texts[r]
    m, w = np.array([len(x) for x in items]), np.array([len(t) for t in texts])
    col = np.arange(width + 1, dtype=np.int32)
    cost = np.repeat((col * (not anywhere))[None, :], n, axis=0)
    best, end = np.full(n, 1 << 30), np.zeros(n, dtype=np.int64)
    for i in range(1, height + 1):
        new = np.empty_like(cost)
        new[:, 0] = i
        np.minimum(cost[:, 1:] + 1, cost[:, :-1] + (a[:, i - 1 : i] != b), out=new[:, 1:])
        cost = np.minimum.accumulate(new - col, axis=1) + col
        done = np.flatnonzero(m == i)
        if len(done):
            row = np.where(col[None, :] <= w[done, None], cost[done], 1 << 30)
            end[done] = row.argmin(axis=1)
            best[done] = row[np.arange(len(done)), end[done]]
    return best, end


#: Regions compared at once.
REGIONS = 1 << 10


def _verified(h: np.ndarray, first: np.ndarray, start: np.ndarray, item: np.ndarray, items: list[np.ndarray], most: np.ndarray):
    """Closest run of each (text, item) among candidates: {(text, item): (distance, start, words)}."""
    size = np.array([len(x) for x in items])
    doc = np.searchsorted(first, start, side="right") - 1
    order = np.lexsort((start, item, doc))
    start, item, doc = start[order], item[order], doc[order]
    # candidates of a pair that lie within an item's length share a region
    new = np.ones(len(start), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > size[item[1:]])
    lead = np.flatnonzero(new)
    tail = np.append(lead[1:], len(start)) - 1
    lo, it, d = start[lead], item[lead], doc[lead]
    hi = np.minimum(first[d + 1], start[tail] + size[it] + most[it])
    by = np.argsort(hi - lo, kind="stable")
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k in range(0, len(by), REGIONS):
        own = by[k : k + REGIONS]
        far, end = closest_runs([items[i] for i in it[own]], [h[x:y] for x, y in zip(lo[own], hi[own])])
        near = np.flatnonzero(far <= most[it[own]])
        if not len(near):
            continue
        own, far, end = own[near], far[near], end[near]
        # the run's start: the closest prefix of the reversed region before its end
        back = [h[x : x + e][::-1][: size[i] + most[i]] for x, e, i in zip(lo[own], end, it[own])]
        _, words = closest_runs([items[i][::-1] for i in it[own]], back, anywhere=False)
        for r, f, e, n in zip(own, far, end, words):
            at = (int(f), int(lo[r] + e - n - first[d[r]]), int(n))
            pair = (int(d[r]), int(it[r]))
            found[pair] = min(found.get(pair, at), at)
    return found


def _searched(items: list[np.ndarray], classes: list[SizeClass], known: np.ndarray, edits: float):
    size = np.array([len(x) for x in items])
    most = np.array([allowed(m, edits) for m in size])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"), lower=True, marks=True)
            h = hasher.words(w.data, w.start, w.end)
            start, item = candidates(h, classes, known)
            start, item = start[start < len(h)], item[start < len(h)]
            found = _verified(h, w.first, start, item, items, most) if len(start) else {}
            if found:
                rows = sorted(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([d for d, _ in rows])),
                        batch.column("text_key").take(pa.array([d for d, _ in rows])),
                        pa.array([i for _, i in rows], pa.int64()),
                        *[pa.array([found[r][k] for r in rows], pa.int64()) for k in range(3)],
                    ],
                    ["doc_id", "text_key", "item", "distance", "start_word", "n_words"],
                )

    return run


def item_words(text: pa.Array) -> list[np.ndarray]:
    w = split_words(text, lower=True, marks=True)
    h = Hasher().words(w.data, w.start, w.end)
    return [h[a:b] for a, b in zip(w.first[:-1], w.first[1:])]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    stages: Stages,
    edits: float = EDITS,
    min_words: int = MIN_WORDS,
    bits: int = BITS,
    recall: float = RECALL,
    words_per_pass: int = WORDS_PER_PASS,
) -> DataFrame:
    """``(doc_id, text_key, item_id, distance, start_word, n_words)``: the closest run of each matching pair.

    ``start_word`` counts from 0 in the document's words; ``text_key`` is ``xxhash64(text)``.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where("text is not null").distinct()
    # an upper bound of the words: every other character
    total = asked.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    passes = max(1, math.ceil(total / words_per_pass))
    if passes > 1:
        asked = stages.cut(
            asked.repartitionByRange(passes, "item_id", "text").withColumn("pass", F.spark_partition_id()), "items"
        )
    out = []
    schema = "doc_id long, text_key long, item long, distance long, start_word long, n_words long"
    for k in range(passes):
        rows = (asked.where(F.col("pass") == k) if passes > 1 else asked).select("item_id", "text").toArrow()
        by_words: dict[bytes, tuple[np.ndarray, list[int | None]]] = {}
        for ident, h in zip(rows["item_id"].to_pylist(), item_words(rows["text"].combine_chunks() if len(rows) else pa.array([], pa.string()))):
            if len(h) >= min_words:
                by_words.setdefault(h.tobytes(), (h, []))[1].append(ident)
        if not by_words:
            continue
        items = [h for h, _ in by_words.values()]
        names = spark.createDataFrame(
            [(i, x) for i, (_, ids) in enumerate(by_words.values()) for x in ids], "item long, item_id long"
        )
        search = _searched(items, size_classes(items, edits, bits, recall), pair_filter(items), edits)
        found = docs.mapInArrow(search, schema).join(F.broadcast(names), "item").drop("item")
        out.append(stages.cut(found.distinct(), "contaminated"))
    if not out:
        return spark.createDataFrame([], "doc_id long, text_key long, item_id long, distance long, start_word long, n_words long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select("doc_id", "text_key", "item_id", "distance", "start_word", "n_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, stages: Stages, **params) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    hit = contaminated(docs, benchmark, stages, **params).select(
        F.col("doc_id").alias(OWN + "id"), F.col("text_key").alias(OWN + "key")
    ).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "id")) & (F.xxhash64("text") == F.col(OWN + "key"))
    return docs.join(hit, same, "left_anti")
