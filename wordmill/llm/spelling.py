"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's frequency vector counts its letters by group: the ``OWN_GROUPS`` most frequent
letters are groups of their own, the others share ``SHARED_GROUPS``.  The trie's levels are
the counts of successive groups.  Two words that differ by one inserted, deleted or replaced
code point differ in their vectors by at most one surplus and one deficit, so a depth-first
search that may spend one of each on its way down meets every near word; words at the leaves
are verified letter by letter (common beginning and end).

The trie is cut into subtrees, so that no task holds the vocabulary.  Level by level, nodes of
more than ``most`` words are opened (at most ``words / most`` a level, so ``MAX_OPEN`` a level at
any size: what tasks are sent is bounded); a node below an open one is a group.  A word lies in
the group of its own path and asks, through the same search over the open nodes, the groups
that a budget of one surplus and one deficit reaches.  Of two groups the one with the deeper
node (ties: the larger key) is asked by the other's words: a word asks few deep nodes, while a
shallow one would be asked by all words of a heavy neighbour.  A leaf of the whole vector with
more than ``most`` words is split once more by halves: near words share the first half or the
last half of the shorter length.

A word's form is its near word of the largest count, if that is ``ratio`` times its own or more;
counts grow along forms, so following them ends, one join a step, for the words not yet at their end.

Bounds: a task holds a group (``most`` words and those that ask it) and at most ``CELLS`` letters
of the pairs it compares, or one pair; links are counted by a group-by with map-side partial counts.

Defined results: words are distinct non-null strings of one code point or more, ``n`` a count of
one or more; rows with a null word or of empty ones are left out, repeated words are added up;
ties of count go to the smallest word in code-point order; a word without near words has ``n_near``
0, no form and is its own root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import Stages
from wordmill.llm.text import U64, mix, slices

RUNS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of so many runs one loses a letter.
TYPO_EVERY = 97
MIN_CHARS, MIN_COUNT = 5, 3
RATIO = 2

OWN_GROUPS, SHARED_GROUPS = 12, 4
GROUPS = OWN_GROUPS + SHARED_GROUPS
#: Words of a subtree that one task searches, unless there are more than ``MAX_OPEN`` times as many words.
MOST, MAX_OPEN = 1 << 14, 4096
#: Letters of pairs that are compared at once.
CELLS = 1 << 21
#: Words that search a group's trie at once.
ASKING = 1 << 16

_SHIFT = 32


def word_counts(
    docs: DataFrame, typo_every: int = TYPO_EVERY, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n``: runs of letters of ``docs(doc_id, text)``, one in ``typo_every`` with a letter left out.

    Only A-Z are lower-cased.  Which run loses which letter follows from the CRC-32 of ``doc_id:run``.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("d"), F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0))).alias("run"))
    # a run of ASCII letters alone is lower-cased as a whole, which is faster
    ascii_only = F.octet_length("run") == F.char_length("run")
    low = runs.select("d", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    h = F.crc32(F.concat(F.coalesce("d", F.lit("")), F.lit(":"), F.col("run")))
    keyed = low.select("run", h.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    words = keyed.select(F.when(F.col("h") % typo_every == 0, shorter).otherwise(F.col("run")).alias("word"))
    long_enough = words.where(F.char_length("word") >= min_chars)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, offset of each word, one more than words)."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32), offsets


def vectors(codes: np.ndarray, offsets: np.ndarray, letters: list[int]) -> np.ndarray:
    """Letter-group counts of each word; ``letters`` are the code points with a group of their own."""
    own = np.array(sorted(letters), dtype=np.uint32)
    group_of = np.array([letters.index(c) for c in own], dtype=np.int64)
    group = OWN_GROUPS + (codes % SHARED_GROUPS).astype(np.int64)
    if len(own):
        at = np.minimum(np.searchsorted(own, codes), len(own) - 1)
        group = np.where(own[at] == codes, group_of[at], group)
    n = len(offsets) - 1
    word = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(word * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS)


class Level:
    """Children of one level's nodes: sorted ``node << 32 | count`` -> node of the next level."""

    def __init__(self, keys: np.ndarray, first: int = 0):
        self.keys, self.first = keys, first

    def find(self, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(children, which of them exist)."""
        if not len(self.keys):
            return np.zeros(len(node), np.int64), np.zeros(len(node), bool)
        key = (node << _SHIFT) | np.maximum(count, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.first + at, (self.keys[at] == key) & (count >= 0)


class Trie:
    """A trie over the vectors of some words; leaf ``k`` holds ``order[start[k]:start[k + 1]]``."""

    def __init__(self, table: np.ndarray):
        self.order = np.lexsort(table.T[::-1])
        rows = table[self.order]
        node = np.zeros(len(rows), dtype=np.int64)
        new = np.zeros(len(rows), dtype=bool)
        new[:1] = True
        self.levels = []
        for g in range(table.shape[1]):
            new[1:] |= rows[1:, g] != rows[:-1, g]
            lead = np.flatnonzero(new)
            self.levels.append(Level((node[lead] << _SHIFT) | rows[lead, g]))
            node = np.cumsum(new) - 1
        self.start = np.append(np.flatnonzero(new), len(rows))


def search(levels: list[Level], table: np.ndarray, leave: bool = False) -> Iterator[tuple]:
    """Depth-first search for all rows of ``table`` with a budget of one surplus and one deficit.

    Yields ``(level, rows, nodes, counts, plain)``.  At the last level the nodes are leaves and
    ``counts`` is None.  With ``leave`` also each step out of the trie: the parents and the counts
    of children that are not there.  ``plain``: nothing was spent.
    """
    start = np.zeros(len(table), dtype=np.int64)
    stack = [(0, np.arange(len(table)), start, 1, 1)]
    while stack:
        g, rows, node, surplus, deficit = stack.pop()
        if g == len(levels):
            yield g, rows, node, None, surplus + deficit == 2
            continue
        for step in (0, *([1] if surplus else []), *([-1] if deficit else [])):
            count = table[rows, g] + step
            child, found = levels[g].find(node, count)
            s, d = surplus - (step > 0), deficit - (step < 0)
            if leave:
                out = ~found & (count >= 0)
                if out.any():
                    yield g, rows[out], node[out], count[out], s + d == 2
            if found.any():
                stack.append((g + 1, rows[found], child[found], s, d))


def _gathered(codes: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Words as rows of ``width`` code points, aligned left or right; 0 where a word has none."""
    col = np.arange(width)
    if right:
        col = col - (width - size)[:, None]
        inside = col >= 0
    else:
        inside = col < size[:, None]
    at = np.where(inside, start[:, None] + col, 0)
    return np.where(inside, codes[at], 0)


def one_edit(codes: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which pairs of different words are one edit apart, length of the common beginning of each)."""
    size = np.diff(offsets)
    near, begin = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=np.int64)
    longest = np.maximum(size[a], size[b])
    order = np.argsort(longest, kind="stable")
    i = 0
    while i < len(order):
        # as many pairs as fit in CELLS at the width of the last of them
        j = i + max(1, CELLS // max(1, int(longest[order[i]])))
        while j - i > 1 and (j - i) * int(longest[order[min(j, len(order)) - 1]]) > CELLS:
            j = i + (j - i) // 2
        own = order[i:j]
        width = max(1, int(longest[own[-1]]))
        x, y = a[own], b[own]
        least = np.minimum(size[x], size[y])
        common = []
        for right in (False, True):
            same = _gathered(codes, offsets[x], size[x], width, right) == _gathered(codes, offsets[y], size[y], width, right)
            if right:
                same = same[:, ::-1]
            common.append(np.minimum(np.where(same.all(axis=1), width, same.argmin(axis=1)), least))
        near[own] = (abs(size[x] - size[y]) <= 1) & (common[0] + common[1] >= longest[own] - 1)
        begin[own] = common[0]
        i = j
    return near, begin


def links_of_group(
    codes: np.ndarray, offsets: np.ndarray, table: np.ndarray, own: np.ndarray, shorter: int, side: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of a group's own words, and of those that ask it with its own words.

    ``shorter`` and ``side`` say which half the words of a split leaf share (0, 0: any).
    Each pair of a group is given once, and of a split leaf in one of its groups only.
    """
    held = np.flatnonzero(own)
    trie = Trie(table[held])
    size = np.diff(offsets)
    order = np.lexsort(table.T[::-1])  # neighbours look in the same places
    for lo in range(0, len(table), ASKING):
        asking = order[lo : lo + ASKING]
        for _, rows, leaf, _, _ in search(trie.levels, table[asking]):
            first, n = trie.start[leaf], trie.start[leaf + 1] - trie.start[leaf]
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                done = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, done + (1 << 18), side="right")))
                a = asking[np.repeat(rows[i:j], n[i:j])]
                within = np.arange(len(a)) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j])
                b = held[trie.order[np.repeat(first[i:j], n[i:j]) + within]]
                take = ~own[a] | (a < b)
                if shorter:
                    take &= np.minimum(size[a], size[b]) == shorter
                a, b = a[take], b[take]
                near, begin = one_edit(codes, offsets, a, b)
                if shorter:
                    near &= (begin >= shorter // 2) == (side == 0)
                yield a[near], b[near]
                i = j


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "word"):
        letter, n = np.unique(code_points(batch.column("word"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(letter.astype(np.int64)), pa.array(n)], ["letter", "n"])


def _next_level(letters: list[int], levels: list[Level]):
    """Words by child of each open node of the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word"):
            table = vectors(*code_points(batch.column("word")), letters)
            node, live = np.zeros(len(table), np.int64), np.ones(len(table), bool)
            for g, level in enumerate(levels):
                child, found = level.find(node, table[:, g])
                node, live = child, live & found
            key, n = np.unique((node[live] << _SHIFT) | table[live, len(levels)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return run


def _open_nodes(words: DataFrame, letters: list[int], n_words: int, most: int) -> list[Level]:
    """Levels of the open nodes, top down; the last one, if all ``GROUPS`` are there, holds leaves to be split."""
    levels: list[Level] = []
    first, total = 1, n_words
    while len(levels) < GROUPS and total > most:
        counts = words.mapInArrow(_next_level(letters, levels), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        keys = np.array(sorted(r["key"] for r in counts.where(F.col("n") > most).collect()), dtype=np.int64)
        levels.append(Level(keys, first))
        first += len(keys)
        if not len(keys):
            break
        total = most + 1
    return levels


def _halves(codes: np.ndarray, start: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(shorter length, side, hash) of each half by which a word can meet a near one."""
    for shorter in (size, size - 1):
        if shorter:
            half = shorter // 2
            for side, part in ((0, codes[start : start + half]), (1, codes[start + size - (shorter - half) : start + size])):
                power = np.cumprod(np.full(len(part) + 1, 0x9E3779B97F4A7C15, dtype=U64), dtype=U64)
                h = np.sum((part.astype(U64) + U64(1)) * power[1:], dtype=U64)[None] + U64(2 * shorter + side)
                yield shorter, side, int(mix(h).view(np.int64)[0])


def _dealt(letters: list[int], levels: list[Level]):
    """Rows ``(key, part, shorter, side, own, word, n)``: each word for its own group and those it asks."""
    split = len(levels) == GROUPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", rows=1 << 12):
            codes, offsets = code_points(batch.column("word"))
            size = np.diff(offsets)
            table = vectors(codes, offsets, letters)
            home, deep = np.zeros(len(table), dtype=np.int64), np.zeros(len(table), dtype=np.int64)
            found = []  # rows, keys, plain, in a leaf to be split
            for g, rows, node, count, plain in search(levels, table, leave=True):
                key = (node << _SHIFT) | count if count is not None else -node  # a leaf to be split has its node's own key
                if plain:
                    home[rows], deep[rows] = key, g
                found.append((rows, key, np.full(len(rows), g), np.full(len(rows), count is None)))
            rows, keys, depth, leaf = (np.concatenate(x) for x in zip(*found))
            own = keys == home[rows]
            # a word asks groups that lie deeper than its own, or as deep and later
            take = own | (depth > deep[rows]) | ((depth == deep[rows]) & (keys > home[rows]))
            rows, keys, own, leaf = rows[take], keys[take], own[take], leaf[take] & split
            out = [(rows[~leaf], keys[~leaf], own[~leaf], *(np.zeros(int((~leaf).sum()), np.int64) for _ in range(3)))]
            for r, k, o in zip(rows[leaf], keys[leaf], own[leaf]):
                parts = list(_halves(codes, int(offsets[r]), int(size[r])))
                shorter, side, h = (np.array(x, dtype=np.int64) for x in zip(*parts))
                out.append((np.full(len(h), r), np.full(len(h), k), np.full(len(h), o), h, shorter, side))
            rows, keys, own, part, shorter, side = (np.concatenate(x) for x in zip(*out))
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(part), pa.array(shorter), pa.array(side), pa.array(own.astype(bool)), batch.column("word").take(at), batch.column("n").take(at)],
                ["key", "part", "shorter", "side", "own", "word", "n"],
            )

    return run


def _linked(letters: list[int]):
    def run(group: pa.Table) -> pa.Table:
        words = group.column("word").combine_chunks()
        n = group.column("n").to_numpy()
        own = group.column("own").to_numpy().astype(bool)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if own.any():
            codes, offsets = code_points(words)
            shorter, side = int(group.column("shorter")[0].as_py()), int(group.column("side")[0].as_py())
            for x, y in links_of_group(codes, offsets, vectors(codes, offsets, letters), own, shorter, side):
                a.append(x)
                b.append(y)
        one, two = np.concatenate(a), np.concatenate(b)
        left, right = pa.array(np.concatenate([one, two])), np.concatenate([two, one])
        return pa.table({"word": words.take(left), "near": words.take(pa.array(right)), "near_n": pa.array(n[right])})

    return run


def near_words(words: DataFrame, stages: Stages, most: int | None = None) -> DataFrame:
    """``word, near, near_n``, both ways, for every two of the stage table ``words(word, n)`` that are one edit apart."""
    n_words = stages.rows(words)
    most = most or max(MOST, -(-n_words // MAX_OPEN))
    counts = words.mapInArrow(_letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    letters = [r["letter"] for r in counts.orderBy(F.desc("n"), "letter").limit(OWN_GROUPS).collect()]
    levels = _open_nodes(words, letters, n_words, most)
    dealt = words.mapInArrow(
        _dealt(letters, levels), "key long, part long, shorter long, side long, own boolean, word string, n long"
    )
    return dealt.groupBy("key", "part", "shorter", "side").applyInArrow(_linked(letters), "word string, near string, near_n long")


def roots(forms: DataFrame, stages: Stages) -> DataFrame:
    """``word, root`` of every row of ``forms(word, form)``: the last of its forms."""
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    live = stages.cut(forms.select("word", F.col("form").alias("at")), "forms")
    ended = None
    while stages.rows(live):
        moved = live.join(step, "at", "left").select("word", F.col("at").alias("root"), "next")
        moved = stages.cut(moved, "forms")
        done = moved.where("next IS NULL").select("word", "root")
        ended = done if ended is None else ended.unionByName(done)
        stages.drop(live)
        live = stages.cut(moved.where("next IS NOT NULL").select("word", F.col("next").alias("at")), "forms")
    return ended if ended is not None else forms.select("word", F.col("form").alias("root"))


def spelling_variants(words: DataFrame, stages: Stages, ratio: float = RATIO, most: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words(word, n)``."""
    counted = words.where(F.char_length("word") > 0).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = stages.cut(counted.repartition(tasks), "words", narrow=False)  # a small table is searched by many tasks too
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = near_words(counted, stages, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    more = -F.col("best.less") >= F.col("n") * ratio
    linked = counted.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(more, F.col("best.near")).alias("form"), F.when(more, -F.col("best.less")).cast("long").alias("form_n"),
    )
    linked = stages.cut(linked, "linked")
    ends = roots(linked.where("form IS NOT NULL").select("word", "form"), stages)
    return linked.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ORACLE = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, k, length(run) AS size, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(4 * length(hx)), lambda i:
             (CAST('0x' || substr(hx, 2 * (i // 8) + 1, 2) AS BIGINT) >> (i % 8)) & 1)),
           lambda c, b: CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS h
  FROM (SELECT run, k, hex(encode(doc_id || ':' || run)) AS hx FROM runs)
), words AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
  FROM near JOIN words o ON other = o.word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON w.word = b.word
), walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk ON f.word = walk.word JOIN forms e ON walk.at = e.word WHERE e.form IS NULL
"""
