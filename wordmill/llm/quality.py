"""Quality rules: base rules plus robust multivariate outliers of text statistics.

Every document gets a vector of transformed statistics.  For each language and
source a minimum-covariance-determinant estimate (Rousseeuw & Van Driessen 1999) of
location and scatter is found by concentration steps over all of its documents:
distances under the current estimate, their ``h``-quantile, then mean and covariance
of the closest share.  A document far from its group's estimate is rejected.

The steps are group-bys of moments (one small row a group); no group is gathered,
so a source may hold any share of the rows.

Defined results: null and empty texts have no words and fail the base rule; null
language or source is a group value of its own; a group with fewer than
``min_group`` documents is pooled with the other small ones of its language, and if
that pool is small too, of all languages; a pool still too small rejects nothing.
Repeated rows are judged each on its own; other columns pass through the filter
unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import OWN, Stages
from wordmill.llm.text import U64, Hasher, mix, slices, split_words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Transformed statistics with the least spread each is held to (its floor): a
#: statistic that is constant in a group would otherwise reject any other value.
FEATURES = {
    "log_word_length": 0.05,
    "root_symbols": 0.1,
    "root_upper": 0.05,
    "root_marks": 0.2,
    "log_distinct": 0.03,
    "root_dup_lines": 0.3,
    "root_repeats": 0.3,
}
#: Share of a group that an estimate fits: (n + p + 1) / 2 of n rows in the limit, which
#: junk under nearly half of a group cannot move.
SHARE = 0.5
STEPS = 4
MIN_GROUP = 50
#: A document is an outlier beyond the squared distance that one in a million would pass.
TAIL = 1e-6

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b"!?@^_~`=+{}[]\\/\"")] = True
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _per_text(flags: np.ndarray, texts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[texts[1:]] - total[texts[:-1]]


def repeated_words(h: np.ndarray, first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``size`` words found twice or more in it."""
    docs = len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    at = np.flatnonzero(first[1:][doc] - np.arange(len(h)) >= size)
    g = np.zeros(len(at), dtype=U64)
    for k in range(size):
        g = g * U64(0x100000001B3) + h[at + k]
    g = mix(g)
    order = np.lexsort((g, doc[at]))
    g, at = g[order], at[order]
    same = (g[1:] == g[:-1]) & (doc[at][1:] == doc[at][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(h) + size + 1, dtype=np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + size, -1)
    return np.bincount(doc, weights=np.cumsum(edge)[: len(h)] > 0, minlength=docs).astype(np.int64)


def line_counts(data: np.ndarray, texts: np.ndarray, start: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those equal to an earlier one) of each text; lines end at a line feed."""
    docs = len(texts) - 1
    feeds = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([texts[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts[1:], feeds]), kind="stable")
    words = np.searchsorted(start, ends) - np.searchsorted(start, begin)
    owner = np.repeat(np.arange(docs), 1 + _per_text(data == 0x0A, texts))
    take = words > 0
    begin, ends, owner = begin[take], ends[take], owner[take]
    h = hasher.words(data, begin, ends)
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner, minlength=docs), np.bincount(owner[order][1:][same], minlength=docs)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_marks"]


def _counted(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"))
            h = hasher.words(w.data, w.start, w.end)
            docs = len(w.n)
            lines, dups = line_counts(w.data, w.texts, w.start, hasher)
            order = np.lexsort((h, w.doc))
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
            counts = [
                w.n,
                _per_text(((w.data & 0xC0) != 0x80) & ~_WHITE[w.data], w.texts),
                _per_text(_SYMBOL[w.data], w.texts),
                dups,
                repeated_words(h, w.first),
                lines,
                np.bincount(w.doc[order][new], minlength=docs),
                _per_text((w.data >= 0x41) & (w.data <= 0x5A), w.texts),
                _per_text(_MARKS[w.data], w.texts),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keys] + [pa.array(x.astype(np.int64)) for x in counts], keys + COUNTS
            )

    return run


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, text_key`` and the counts of every row."""
    keys = ["doc_id", "lang", "source", "text_key"]
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id long, lang string, source string, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)
    return named.mapInArrow(_counted(keys), schema)


def _vectors(stats: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return stats.withColumns(
        {
            "log_word_length": F.log(chars / n),
            "root_symbols": F.sqrt(F.col("n_symbols") / n),
            "root_upper": F.sqrt(F.col("n_upper") / chars),
            "root_marks": F.sqrt(F.col("n_marks") / n),
            "log_distinct": F.log(F.greatest(F.col("n_distinct"), F.lit(1))) / F.log(F.greatest(n, F.lit(2.0))),
            "root_dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
            "root_repeats": F.sqrt(F.col("n_repeat_words") / n),
        }
    )


def _grouped(rows: DataFrame, min_group: int) -> DataFrame:
    """Adds the estimate's group ``g_lang, g_source``: a small one is pooled, see the module's text."""
    pool = F.lit("\u0000pooled")
    rows = rows.withColumns(
        {"g_lang": F.coalesce("lang", F.lit("\u0000null")), "g_source": F.coalesce("source", F.lit("\u0000null"))}
    )
    size = rows.groupBy("g_lang", "g_source").agg(F.count(F.lit(1)).alias("n"))
    size = size.withColumn("to_source", F.when(F.col("n") >= min_group, F.col("g_source")).otherwise(pool))
    by_lang = size.groupBy(F.col("g_lang").alias("l"), F.col("to_source").alias("s")).agg(F.sum("n").alias("m"))
    size = size.join(by_lang, (size.g_lang == by_lang.l) & (size.to_source == by_lang.s))
    size = size.select(
        "g_lang",
        "g_source",
        F.when(F.col("m") >= min_group, F.col("g_lang")).otherwise(pool).alias("to_lang"),
        "to_source",
    )
    joined = rows.join(size, ["g_lang", "g_source"]).drop("g_lang", "g_source")
    return joined.withColumnsRenamed({"to_lang": "g_lang", "to_source": "g_source"})


def _solved(features: list[str], floors: list[float], share: float):
    """Moments of a group's closest share (or medians) -> mean and inverse scatter, one row a group."""
    p = len(features)
    fixed = np.diag(np.square(floors))
    inside = chi2_quantile(share, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                m = np.array(row["mean"])
                if row["second"] is None:  # first step: medians and absolute deviations
                    scatter = np.diag(np.square(1.4826 * np.array(row["spread"])))
                else:
                    second = np.zeros((p, p))
                    second[np.triu_indices(p)] = row["second"]
                    second = second + np.triu(second, 1).T
                    scatter = second - np.outer(m, m)
                    scatter *= max(1.0, row["cut"] / inside)
                out.append(
                    {
                        "g_lang": row["g_lang"],
                        "g_source": row["g_source"],
                        "mean": m.tolist(),
                        "inverse": np.linalg.inv(scatter + fixed).ravel().tolist(),
                        "n": row["n"],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_MODEL))

    return run


_MODEL = [
    ("g_lang", pa.string()),
    ("g_source", pa.string()),
    ("mean", pa.list_(pa.float64())),
    ("inverse", pa.list_(pa.float64())),
    ("n", pa.int64()),
]
MODEL = "g_lang string, g_source string, mean array<double>, inverse array<double>, n long"


def chi2_quantile(q: float, p: int) -> float:
    """Quantile of the chi-square law with ``p`` degrees (Wilson & Hilferty)."""
    lo, hi = -9.0, 9.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 0.5 * (1 + math.erf(mid / math.sqrt(2))) < q else (lo, mid)
    return p * (1 - 2 / (9 * p) + lo * math.sqrt(2 / (9 * p))) ** 3


def _distance(features: list[str]) -> Column:
    p = len(features)
    diff = [F.col(f) - F.col("mean")[i] for i, f in enumerate(features)]
    terms = [
        diff[i] * diff[j] * F.col("inverse")[i * p + j] * (1.0 if i == j else 2.0) for i in range(p) for j in range(i, p)
    ]
    return reduce(lambda a, b: a + b, terms)


def outlier_model(rows: DataFrame, stages: Stages, floors: dict[str, float], share: float, steps: int) -> DataFrame:
    """MCD estimate of each group of ``rows(g_lang, g_source, *features)``: one row a group."""
    features = list(floors)
    groups = ["g_lang", "g_source"]
    solve = _solved(features, list(floors.values()), share)

    med = rows.groupBy(*groups).agg(*[F.percentile_approx(f, 0.5).alias(f"m_{f}") for f in features])
    off = rows.join(med, groups).groupBy(*groups).agg(
        F.array(*[F.first(f"m_{f}") for f in features]).alias("mean"),
        F.array(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5) for f in features]).alias("spread"),
        F.count(F.lit(1)).alias("n"),
    )
    null = F.lit(None)
    start = off.withColumns({"second": null.cast("array<double>"), "cut": null.cast("double")})
    model = stages.cut(start.mapInArrow(solve, MODEL), "outlier-model")
    second = [F.avg(F.col(a) * F.col(b)) for i, a in enumerate(features) for b in features[i:]]
    for _ in range(steps):
        placed = rows.join(model.drop("n"), groups).withColumn("d2", _distance(features))
        cut = stages.cut(placed.groupBy(*groups).agg(F.percentile_approx("d2", share).alias("cut")), "outlier-cut")
        moments = (
            placed.join(cut, groups)
            .where("d2 <= cut")
            .groupBy(*groups)
            .agg(
                F.array(*[F.avg(f) for f in features]).alias("mean"),
                F.array(*second).alias("second"),
                F.count(F.lit(1)).alias("n"),
            )
            .withColumn("spread", null.cast("array<double>"))
        )
        moments = stages.cut(moments, "outlier-moments")
        model = stages.cut(moments.withColumn("cut", F.lit(0.0)).mapInArrow(solve, MODEL), "outlier-model")
    # the closest share is tighter than its group: scale it so that the share's quantile is the chi-square one
    placed = rows.join(model.drop("n"), groups).withColumn("d2", _distance(features))
    scale = placed.groupBy(*groups).agg(F.percentile_approx("d2", share).alias("cut"), F.count(F.lit(1)).alias("n"))
    return stages.cut(moments.drop("n").join(scale, groups).mapInArrow(solve, MODEL), "outlier-model")


def quality(
    docs: DataFrame,
    stages: Stages,
    floors: dict[str, float] = FEATURES,
    share: float = SHARE,
    steps: int = STEPS,
    min_group: int = MIN_GROUP,
    tail: float = TAIL,
) -> DataFrame:
    """Counts and verdict of every row: ``base_failed``, ``distance`` (null if not judged) and ``kept``."""
    cutoff = chi2_quantile(1 - tail, len(floors))
    stats = stages.cut(statistics(docs), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = stats.withColumn("base_failed", failed)
    rows = stages.cut(_grouped(_vectors(judged.where("not base_failed")), min_group), "vectors")
    model = outlier_model(rows, stages, floors, share, steps)
    far = rows.join(model.withColumnRenamed("n", "group_n"), ["g_lang", "g_source"]).withColumn(
        "distance", F.when(F.col("group_n") >= min_group, _distance(list(floors)))
    )
    passed = far.select(*judged.columns, "distance", (F.coalesce("distance", F.lit(0.0)) <= cutoff).alias("kept"))
    return passed.unionByName(
        judged.where("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    )


def keep_good(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns."""
    kept = quality(docs, stages, **params).where("kept").select(
        F.col("doc_id").alias(OWN + "id"), F.col("text_key").alias(OWN + "key"), F.col("lang").alias(OWN + "lang"), F.col("source").alias(OWN + "source")
    )
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "id"))
        & (F.xxhash64("text") == F.col(OWN + "key"))
        & F.col("lang").cast("string").eqNullSafe(F.col(OWN + "lang"))
        & F.col("source").cast("string").eqNullSafe(F.col(OWN + "source"))
    )
    return docs.join(kept, same, "left_semi")
