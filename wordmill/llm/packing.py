"""Packing of tokenised documents into as few sequences of bounded length as can be.

Documents become pieces: the ids of a text and an end mark, cut into pieces of the
capacity if they are longer.  What fits with what depends on lengths alone, so the
plan is made on the histogram of lengths, at most ``capacity`` numbers whatever the
corpus, and in multiples of sets, not piece by piece:

1. *Dominance reduction* (Martello and Toth).  For each length ``j``, longest first, all
   sets that fit beside it are compared.  If at most one other piece fits, ``j`` and the
   longest partner dominate every alternative.  So do ``j`` and a partner that fills the
   sequence exactly, and, where at most two others fit, a single partner at least as long
   as the best pair, or the best pair if it holds the longest partner and no pair lies
   between its two.  Such a set is in some best packing, so it is fixed for good, as often
   as its lengths last, and the instance shrinks; this is repeated until nothing is fixed.
2. *Best fit* of the rest, longest first: each piece goes where the least room is left.

The plan says for every length which of its pieces, by their number within the length, go
to which sequence and where.  Pieces are numbered within their length by range
partitioning on (length, row), so a length that a third of all pieces have is split over
tasks, and take their place by one look-up in the plan, in the task that holds them.

Ids come from the tokenizer in texts' parts: a blank before a printable ASCII or Latin
character always begins a new pre-token, letters and digits always end one before an ASCII
mark, and a line end between two printable characters is one, so a text cut there has the
same ids.  Cuts are found in the bytes, parts are numbered by Arrow, and those not met
before are encoded as one text, so no part is a Python object.  Parts and their ids stay in
the Python worker (at most ``CACHE_BYTES`` and those of ``SLICE_BYTES`` of text or one text;
all are dropped when full).

Bounds: the driver holds ``capacity`` counts and a plan of a few rows a length; a task
holds that plan and one text's ids.

Defined results: null and empty texts are one end mark; equal rows are pieces of their
own; a null ``doc_id`` stays null; an empty table gives no rows; other columns of a piece
table are passed on, a column named as a result (``sequence_id``, ``offset``) is replaced.
Which of several pieces of one length goes where follows the order of rows and is
arbitrary, the number of sequences is not.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import OWN, Stages
from wordmill.llm.text import buffers, slices
from wordmill.operators.indexing import range_index

CAPACITY = 2048
#: Id that ends a document.
END = 0
VOCABULARY = "byte_bpe_50k.json"
#: Parts and their ids that a worker keeps, in bytes, and what one needs besides its text and ids.
CACHE_BYTES = 48 << 20
PART_BYTES = 24
#: Text bytes cut and encoded at once.
SLICE_BYTES = 4 << 20

# Where a text may be cut without changing its ids, whatever stands on either side: a blank begins
# a pre-token if a printable ASCII character or a Latin letter follows (first bytes here),
_BEGINS = np.zeros(256, dtype=bool)
_BEGINS[0x21:0x7F] = _BEGINS[0xC3:0xC9] = True
#: letters and digits (of Latin-1, second bytes of U+00C0 to U+00FF) end one
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: before these marks (all of ASCII but ``|``, which a special token holds),
_MARKS = np.zeros(256, dtype=bool)
_MARKS[0x21:0x7F] = ~_ENDS[0x21:0x7F]
_MARKS[ord("|")] = False
#: and a single line end between two printable characters is one, such as that of this prefix.
_AFTER_LINE = " a\n"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cuts(at: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where parts begin in ``data``, texts that begin at ``at[:-1]``; every text that is not empty begins one."""
    begins = np.zeros(len(data), dtype=bool)
    left, right = data[:-1], data[1:]
    follows = _BEGINS[right]
    np.logical_and(left == 0x20, follows, out=begins[:-1])
    ends = _ENDS[data]
    ends[1:] |= _LATIN[right] & (left == 0xC3)
    begins[1:] |= ends[:-1] & _MARKS[right]
    line = np.flatnonzero(left == 0x0A)
    line = line[(line > 0) & follows[line]]
    line = line[ends[line - 1] | _BEGINS[data[line - 1]]]
    begins[line] = begins[line + 1] = True
    # what follows the last byte of a text is another text
    last = at[1:] - 1
    last = last[last >= 0]
    begins[last[(data[last] == 0x20) | (data[last] == 0x0A)]] = False
    begins[at[:-1][np.diff(at) > 0]] = True
    return np.flatnonzero(begins)


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers."""

    def __init__(self, path: str, most: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        # a piece of a byte-level vocabulary is written with one character a byte; special tokens are as they are
        added = self.tokenizer.get_added_tokens_decoder()
        pieces = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.size = np.array([len(p.encode() if i in added else p) for i, p in enumerate(pieces)], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())  # parts met
        self.ids = np.zeros(0, "<u4")  # ids of all of them
        self.first, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # where a part's ids begin and how many they are

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _joined(self, parts: pa.Array, prefix: str, drop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of parts encoded as one text, each after ``prefix``, where a part's ids begin, how many), without the first ``drop``."""
        if prefix:
            parts = pc.binary_join_element_wise(pa.scalar(prefix, pa.large_string()), parts, pa.scalar("", pa.large_string()))
        at, data = buffers(parts)
        ids = self._encoded(data.tobytes().decode())
        ends = np.searchsorted(np.cumsum(self.size[ids]), at[1:]) + 1
        first = np.concatenate([[0], ends[:-1]]) + drop
        return ids, first, ends - first

    def _learn(self, known: pa.Array) -> None:
        """Add parts to those met; ``known`` are those met, then those to add."""
        words = known.slice(len(self.words))
        at, data = buffers(words)
        begins = data[at[:-1]]
        # where a part is one byte the byte looked at is that of another part
        blank = (begins == 0x20) & (np.diff(at) > 1) & _BEGINS[data[np.minimum(at[:-1] + 1, len(data) - 1)]]
        line = _BEGINS[begins]
        first, n = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        done, total = [self.ids], len(self.ids)

        def add(which: np.ndarray, ids: np.ndarray, start, many) -> None:
            nonlocal total
            first[which], n[which] = total + start, many
            done.append(ids)
            total += len(ids)

        for which, prefix, drop in ((blank, "", 0), (line, _AFTER_LINE, 2)):
            if which.any():
                add(which, *self._joined(words.filter(pa.array(which)), prefix, drop))
        for i in np.flatnonzero(~(blank | line)).tolist():
            ids = self._encoded(words[i].as_py())
            add(i, ids, 0, len(ids))
        firsts, many = np.concatenate([self.first, first]), np.concatenate([self.n, n])
        self.words, self.ids, self.first, self.n = known, np.concatenate(done), firsts, many

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the end of the last)."""
        at, data = buffers(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(at), np.int64)
        starts = cuts(at, data)
        held = [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        parts = pa.Array.from_buffers(pa.large_string(), len(starts), held)
        # the parts met come first, so their numbers stay as they are
        coded = pa.chunked_array([self.words, parts]).dictionary_encode().chunks[-1]
        known, which = coded.dictionary, coded.indices.to_numpy()
        if len(known) > len(self.words):
            self._learn(known)
        size = self.n[which]
        done = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.first[which] - done[:-1], size) + np.arange(done[-1])]
        if self.words.nbytes + self.ids.nbytes + PART_BYTES * len(self.words) > self.most:
            self._forget()
        return ids, done[np.searchsorted(starts, at)]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """The worker's encoder: a worker runs one task at a time and is used for many."""
    return Encoder(path)


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all but the first are of the capacity."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        mark = np.array([end], dtype="<u4").tobytes()
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, at = encoder.encode(batch.column("text"))
            rows = []
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), at, at[1:]):
                own = ids[lo:hi].tobytes() + mark
                for k, (start, n) in enumerate(cut_lengths(len(own) // 4, capacity)):
                    rows.append((doc, k, start, n, own[4 * start : 4 * (start + n)]))
            if rows:
                yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of ``docs(doc_id, text)``; ``ids`` are little-endian 32-bit numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _pieces(path or vocabulary_path(), capacity, end), "doc_id long, piece int, start long, length long, ids binary"
    )


Set = tuple[tuple[int, int], ...]  # (length, how many of it), in the order of their places


class Histogram:
    """Pieces still to be packed, by length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.n = dict(counts)
        self.lengths = sorted(w for w, n in counts.items() if n)

    def take(self, w: int, n: int) -> None:
        self.n[w] -= n
        if not self.n[w]:
            self.lengths.remove(w)

    def beside(self, w: int, j: int) -> int:
        """How many pieces of length ``w`` there are besides one of length ``j``."""
        return self.n[w] - (w == j)

    def most(self, room: int, j: int) -> int:
        """How many pieces, the shortest ones, fit in ``room``; 3 stands for 3 or more."""
        k = 0
        for w in self.lengths:
            n = min(self.beside(w, j), room // w, 3 - k)
            k, room = k + n, room - n * w
            if k == 3 or room < w:
                break
        return k

    def longest(self, room: int, j: int) -> int:
        """Longest length that fits in ``room``, or 0."""
        i = bisect_right(self.lengths, room) - 1
        while i >= 0 and not self.beside(self.lengths[i], j):
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def best_pair(self, room: int, j: int) -> tuple[int, int]:
        """Two lengths, longer first, of the largest sum up to ``room``; of equal sums that with the longest piece."""
        best, lo, hi = (0, 0), 0, bisect_right(self.lengths, room) - 1
        while lo <= hi:
            b, a = self.lengths[lo], self.lengths[hi]
            if a + b > room or not self.beside(a, j):
                hi -= 1
                continue
            if a + b > sum(best) and self.beside(b, j) > (lo == hi):
                best = (a, b)
            lo += 1
        return best

    def between(self, b: int, a: int, j: int) -> list[int]:
        """The two shortest pieces, or fewer, of lengths strictly between ``b`` and ``a``."""
        out: list[int] = []
        for w in self.lengths[bisect_right(self.lengths, b) : bisect_left(self.lengths, a)]:
            out += [w] * min(2 - len(out), self.beside(w, j))
            if len(out) == 2:
                break
        return out


def dominating(left: Histogram, j: int) -> tuple[int, ...] | None:
    """Partners of a piece of length ``j`` that dominate every other set beside it, or None."""
    room = left.capacity - j
    most, one = left.most(room, j), left.longest(room, j)
    if most == 0:
        return ()
    if most == 1 or one == room:
        return (one,)
    if most == 2:
        a, b = left.best_pair(room, j)
        if one >= a + b:
            return (one,)
        if a == one:
            # a pair that (a, b) does not cover piece by piece lies strictly between b and a
            inner = left.between(b, a, j)
            if len(inner) < 2 or sum(inner) > room:
                return (a, b)
    return None


def reduce_by_dominance(left: Histogram) -> list[tuple[Set, int]]:
    """Sets that some best packing holds and how often each; they are taken out of ``left``.

    A set stays dominating while its lengths last, as taking pieces out only takes away alternatives.
    """
    fixed: list[tuple[Set, int]] = []
    before = -1
    while before != len(fixed):
        before = len(fixed)
        for j in reversed(left.lengths[:]):
            while left.n[j] and (partners := dominating(left, j)) is not None:
                parts = Counter((j, *partners))
                times = min(left.n[w] // k for w, k in parts.items())
                for w, k in parts.items():
                    left.take(w, k * times)
                fixed.append((tuple(parts.items()), times))
    return fixed


def best_fit(left: Histogram) -> list[tuple[Set, int]]:
    """Best fit of what is left, longest first, a run of equal pieces into equal sequences at a time."""
    # open sequences by room: sets that leave it and how many sequences hold each
    open_: list[list[tuple[Set, int]]] = [[] for _ in range(left.capacity + 1)]
    for w in reversed(left.lengths):
        n = left.n[w]
        for room in range(w, left.capacity + 1):
            if not open_[room]:
                continue
            each = room // w
            classes, open_[room] = open_[room], []
            while classes and n:
                held, times = classes.pop()
                whole = min(times, n // each)
                if whole:
                    open_[room - each * w].append((held + ((w, each),), whole))
                n -= whole * each
                if whole < times:
                    if n and n < each:
                        open_[room - n * w].append((held + ((w, n),), 1))
                        whole, n = whole + 1, 0
                    if whole < times:
                        classes.append((held, times - whole))
            open_[room] += classes
            if not n:
                break
        if n:
            each = left.capacity // w
            if n // each:
                open_[left.capacity - each * w].append((((w, each),), n // each))
            if n % each:
                open_[left.capacity - (n % each) * w].append((((w, n % each),), 1))
    return [c for classes in open_ for c in classes]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Set, int]]:
    """Sets of lengths and how many sequences hold each, for ``counts`` pieces of each length."""
    left = Histogram(counts, capacity)
    return reduce_by_dominance(left) + best_fit(left)


def _slots(sets: list[tuple[Set, int]]) -> np.ndarray:
    """Rows (length, first number, sequence, pieces a sequence, place), by length and first number."""
    rows, used, sequence = [], {}, 0
    for held, times in sets:
        place = 0
        for w, each in held:
            rows.append((w, used.get(w, 0), sequence, each, place))
            used[w] = used.get(w, 0) + times * each
            place += w * each
        sequence += times
    out = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _place(slots: np.ndarray, before: dict[int, int], numbered: str, kept: list[str]):
    """Tasks' side of the look-up: a piece's number over all lengths -> sequence and place."""
    lengths = np.array(sorted(before), dtype=np.int64)
    offset = np.array([before[w] for w in sorted(before)], dtype=np.int64)
    # numbers within a length, put one length after another, are one increasing row of starts
    starts = slots[:, 1] + offset[np.searchsorted(lengths, slots[:, 0])] if len(slots) else slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(numbered).to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, number, side="right") - 1
            row, i = slots[at], number - starts[at]
            columns = [batch.column(c) for c in kept]
            sequence, place = row[:, 2] + i // row[:, 3], row[:, 4] + i % row[:, 3] * row[:, 0]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(place)], [*kept, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, stages: Stages, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; its ``length`` is from 1 to ``capacity``."""
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row, number = OWN + "row", OWN + "number"
    rows = stages.cut(pieces.select(*kept, F.monotonically_increasing_id().alias(row)), "pieces", narrow=False)
    fits = F.col("length").between(1, capacity)
    if rows.where(~F.coalesce(fits, F.lit(False))).limit(1).count():
        raise ValueError(f"a piece's length is not from 1 to {capacity}")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for w in sorted(counts):
        before[w], total = total, total + counts[w]
    slots = _slots(plan(counts, capacity))
    numbered = range_index(rows, ["length", row], number)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*kept).schema), "sequence_id long", "offset long"])
    return numbered.drop(row).mapInArrow(_place(slots, before, number, kept), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces with their ``ids``: each sequence's whole row of ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
