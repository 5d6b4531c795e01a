"""Cross-site boilerplate lines by HyperLogLog sketches of distinct sites, DataFrame functions only.

Texts are cut at line feeds.  Each line hash gets one sketch of the sites
(``source``) that carry it; sketches merge by aggregation, map side first, so a line
in every document costs one small sketch a task.  A line whose estimate lies clear of
the threshold is decided by the sketch; one near it gets its exact distinct count.
A line on ``min_sites`` sites or more is boilerplate: its first occurrence (least
``doc_id``, then line number) stays, all others are removed.

Defined results: a null text stays null and has no lines; lines without a word
(only white space) are never counted nor removed; null sources are no site; rows
that repeat a ``doc_id`` and text share their lines' positions, so both keep a first
occurrence; a null ``doc_id`` sorts first.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.stage import OWN, Stages

MIN_SITES = 10
#: Log2 of the sketch's registers: standard error 1.6 %.
REGISTERS = 12
#: Estimates within this share of the threshold are counted exactly: six standard errors.
NEAR = 0.1

_WORD = "[^ \\t\\n\\x0B\\f\\r]"


def _lines(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("source").cast("string").alias("site"),
        F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("pos", "line"),
    )
    return rows.where(F.col("line").rlike(_WORD)).select("doc_id", "text_key", "site", "pos", F.xxhash64("line").alias("h"))


def boilerplate(docs: DataFrame, stages: Stages, min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """``(h, doc_id, pos)``: hash of each boilerplate line and where it occurs first."""
    lines = _lines(docs)
    spread = lines.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS))).alias("sites"),
        F.min(F.struct("doc_id", "pos")).alias("at"),
    )
    low, high = min(min_sites - 1, int(min_sites * (1 - near))), max(min_sites + 1, int(min_sites * (1 + near)) + 1)
    spread = stages.cut(spread.where(F.col("sites") >= low), "line-spread")
    exact = (
        lines.join(spread.where(F.col("sites") < high).select("h"), "h")
        .where("site is not null")
        .select("h", "site")
        .distinct()
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_sites)
    )
    passed = spread.where(F.col("sites") >= high).select("h").unionByName(exact.select("h"))
    return spread.join(passed, "h").select("h", "at.doc_id", "at.pos")


def _without(text: Column, gone: Column) -> Column:
    parts = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))


def line_dedup(docs: DataFrame, stages: Stages, min_sites: int = MIN_SITES, near: float = NEAR) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and ``n_lines``, ``n_removed`` (long).

    ``n_lines`` counts the lines with a word before the cut.  All other columns stay.
    """
    first = stages.cut(boilerplate(docs, stages, min_sites, near), "boilerplate")
    lines = _lines(docs)
    f = first.select("h", F.col("doc_id").alias("f_id"), F.col("pos").alias("f_pos"))
    cut = lines.join(f, "h").where(~(F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("pos") == F.col("f_pos"))))
    cut = cut.groupBy(F.col("doc_id").alias(OWN + "id"), F.col("text_key").alias(OWN + "key")).agg(
        F.collect_set("pos").alias(OWN + "gone")
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(OWN + "id")) & (F.xxhash64("text") == F.col(OWN + "key"))
    text = F.col("text").cast("string")
    n = F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WORD)))
    joined = docs.join(cut, same, "left")
    return joined.select(
        *[(_without(text, F.col(OWN + "gone")) if c == "text" else F.col(c)).alias(c) for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.greatest(F.size(F.coalesce(OWN + "gone", F.array())), F.lit(0)).cast("long").alias("n_removed"),
    )


def drop_boilerplate(docs: DataFrame, stages: Stages, **params) -> DataFrame:
    """``docs`` without boilerplate lines, same columns; a document left without any word goes.

    ``n_chars`` follows the new text.  A document without words beforehand stays.
    """
    names = docs.columns
    plain = [c for c in names if c.startswith("n_lines") or c.startswith("n_removed")]
    work = docs.withColumnsRenamed({c: OWN + c for c in plain})
    done = line_dedup(work, stages, **params).where((F.col("n_removed") == 0) | F.col("text").rlike(_WORD))
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.drop("n_lines", "n_removed").withColumnsRenamed({OWN + c: c for c in plain}).select(*names)


ORACLE = """
WITH l AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')),
b AS (
  SELECT line, min(struct_pack(d := doc_id, p := pos)) AS at
  FROM w GROUP BY line HAVING count(DISTINCT source) >= 10),
gone AS (SELECT w.doc_id, w.pos FROM w JOIN b USING (line) WHERE NOT (w.doc_id = b.at.d AND w.pos = b.at.p)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS text,
         count(gone.pos) AS n_removed
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN n USING (doc_id)
"""
