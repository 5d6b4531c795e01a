"""CSV files as records, read in splits: quoted cells may hold line ends, no file is one task's.

A line end is a record's end unless it stands in quotes, and whether it does depends on all
lines before it in its file.  Each line is a function of two states, *outside* and *inside*
quotes: it says how the line ends for either way it may begin.  These functions compose, so
the state at each line is a prefix scan in two levels: over the lines of each split, then over
the splits of each file (one row a split).  Lines are grouped to records inside their split;
only a record that crosses splits (at most two parts a split) is put together afterwards.

A quote opens a cell only at the cell's beginning, so ``5" disc`` is text; inside, two quotes
are one.  Lines end with LF or CRLF (the CR of a record's end is dropped, those in quotes stay).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.session import cut_lineage

LINE = ["_file", "_start", "_line"]
QUOTE = '"'


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _start, _line, value``: lines with their file, their split's offset and their order in it."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )


_OUT, _IN, _CLOSED = 0, 1, 2


def ends_inside(value: Column, begins_inside: bool, sep: str = ",") -> Column:
    """Whether a line that begins outside (or inside) quotes ends inside."""
    parts = F.split(value, QUOTE, -1)  # a quote stands before every part but the first
    first = F.element_at(parts, 1)
    # state * 2 + whether a quote here would be at a cell's beginning
    start = F.lit(2 * _IN) if begins_inside else F.when((first == "") | first.endswith(sep), 2 * _OUT + 1).otherwise(2 * _OUT)

    def step(acc: Column, part: Column) -> Column:
        state, opens = F.floor(acc / 2), acc % 2 == 1
        quoted = F.when(state == _OUT, F.when(opens, _IN).otherwise(_OUT)).when(state == _IN, _CLOSED).otherwise(_IN)
        after = F.when((quoted == _CLOSED) & (part != ""), _OUT).otherwise(quoted)
        return (after * 2 + part.endswith(sep).cast("int")).cast("int")

    end = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start.cast("int"), step)
    scanned = F.floor(end / 2) == _IN
    return F.when(F.contains(value, F.lit(QUOTE)), scanned).otherwise(F.lit(begins_inside))


def _scanned(df: DataFrame, group: list[str], order: list[str], ends: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Adds the state before each row, for a group that begins outside and for one that begins inside.

    ``ends`` are the states after a row for either state before it.  A row that ends the same
    way for both sets the state; one that turns it counts towards a parity since then.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    to_here, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    out, inside = (F.col(c) for c in ends)
    turns = (out & ~inside).cast("long")
    counted = df.withColumn("_turns", F.sum(turns).over(to_here))
    setting = F.when(out == inside, F.struct(out.alias("to"), F.col("_turns").alias("turns")))
    known = counted.withColumn("_set", F.last(setting, ignorenulls=True).over(before))
    passed = F.col("_turns") - turns
    odd_since_set = (passed - F.col("_set.turns")) % 2 == 1
    columns = {
        name: F.when(F.col("_set").isNotNull(), F.col("_set.to") != odd_since_set).otherwise(F.lit(h) != (passed % 2 == 1))
        for h, name in zip((False, True), names)
    }
    return known.withColumns(columns).drop("_turns", "_set")


def _blank(value: Column) -> Column:
    return F.trim(F.replace(value, F.lit("\r"), F.lit(""))) == ""


def splits(text: DataFrame, sep: str = ",") -> DataFrame:
    """One row a split: ``_file, _start, inside`` (how it begins), ``n`` records that begin in it, ``open`` (its
    last one goes on), ``base`` (records of the file before it), ``owner, owner_no`` (the record its first lines
    go on with)."""
    told = text.select(*LINE, ends_inside(F.col("value"), False, sep).alias("e0"), ends_inside(F.col("value"), True, sep).alias("e1"), _blank(F.col("value")).alias("blank"))
    state = _scanned(told, ["_file", "_start"], ["_line"], ("e0", "e1"), ("s0", "s1"))
    both = {}
    for h in ("0", "1"):
        after = F.when(F.col(f"s{h}"), F.col("e1")).otherwise(F.col("e0"))
        both[f"n{h}"] = F.sum((~F.col(f"s{h}") & ~F.col("blank")).cast("long"))
        both[f"end{h}"] = F.max_by(after, "_line")
    each = state.groupBy("_file", "_start").agg(*[c.alias(k) for k, c in both.items()])
    each = _scanned(each, ["_file"], ["_start"], ("end0", "end1"), ("inside", "_unused"))
    each = each.select(
        "_file", "_start", "inside",
        F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0")).alias("n"),
        F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0")).alias("open"),
    )
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    has = F.when(F.col("n") > 0, F.struct(F.col("_start").alias("start"), F.col("n").alias("no")))
    return each.withColumns(
        {"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "_owner": F.last(has, ignorenulls=True).over(before)}
    ).select("*", F.col("_owner.start").alias("owner"), F.col("_owner.no").alias("owner_no")).drop("_owner")


def records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``row_id, record``: each record of the files under ``path`` but their headers, without blank lines.

    ``row_id`` counts from 0, file after file by name.
    """
    text = lines(spark, path)
    table = cut_lineage(splits(text, sep), "splits")
    rows = table.groupBy("_file").agg(F.greatest(F.sum("n") - 1, F.lit(0)).alias("rows"))  # one row a file
    earlier = F.sum("rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    table = table.join(rows.select("_file", F.coalesce(earlier, F.lit(0)).alias("first")), "_file")
    # the header is the file's record 1, its first row the record 2
    table = table.withColumn("base", F.col("base") + F.col("first") - 2)
    told = text.select("*", ends_inside(F.col("value"), False, sep).alias("e0"), ends_inside(F.col("value"), True, sep).alias("e1"))
    state = _scanned(told, ["_file", "_start"], ["_line"], ("e0", "e1"), ("s0", "s1"))
    state = state.join(table, ["_file", "_start"])
    state = state.withColumn("in", F.when(F.col("inside"), F.col("s1")).otherwise(F.col("s0")))
    state = state.where(F.col("in") | ~_blank(F.col("value")))
    order = Window.partitionBy("_file", "_start").orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = state.withColumn("rec", F.sum((~F.col("in")).cast("long")).over(order))
    whole = numbered.groupBy("_file", "_start", "rec").agg(
        _joined("_line", "value").alias("record"),
        *[F.first(c).alias(c) for c in ("n", "open", "base", "first", "owner", "owner_no")],
    )
    whole = cut_lineage(whole, "records")
    row_id = (F.col("base") + F.col("rec")).alias("row_id")
    crosses = (F.col("rec") == 0) | ((F.col("rec") == F.col("n")) & F.col("open"))
    inner = whole.where(~crosses).select(row_id, "first", "record")
    # the parts of a record that crosses splits: its beginning, and the first lines of the splits it reaches
    own = F.col("rec") > 0
    parts = whole.where(crosses).select(
        "_file", "_start", "first", "record",
        F.when(own, F.col("_start")).otherwise(F.col("owner")).alias("at"),
        F.when(own, F.col("rec")).otherwise(F.col("owner_no")).alias("rec"),
        F.when(own, F.col("base")).alias("base"),
    )
    across = parts.groupBy("_file", "at", "rec").agg(
        _joined("_start", "record").alias("record"), F.max("base").alias("base"), F.max("first").alias("first")
    )
    found = inner.unionByName(across.select(row_id, "first", "record"))
    return found.where(F.col("row_id") >= F.col("first")).select("row_id", F.regexp_replace("record", "\r$", "").alias("record"))


def _joined(place: str, text: str) -> Column:
    """A group's texts in order of their places, with the line ends between them."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), F.col(text).alias("text"))))
    return F.array_join(F.transform(rows, lambda r: r["text"]), "\n")


def parsed(df: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """``row_id`` and the cells of each record as strings, missing ones null."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    cells = F.from_csv("record", schema, {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"})
    return df.select("row_id", cells.alias("c")).select("row_id", *[F.col(f"c.c{i}").alias(c) for i, c in enumerate(columns)])
