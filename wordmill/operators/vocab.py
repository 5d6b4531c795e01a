"""Token tables, vocabulary build, encode/decode.

The exploded token table has the key ``(file_no, row_id, col_no, sub, pos)``,
which is the reference's reading order: file, row, column, turn, position.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.constants import DEFAULT_STOPWORDS
from wordmill.functions.text import mark_punctuation, pipe_to_space, segment_regex
from wordmill.operators.indexing import ordered_index, sequential_index
from wordmill.operators.joins import join_words
from wordmill.operators.segment import positioned_tokens

KEY = ["file_no", "row_id", "col_no", "sub", "pos"]

#: Column of a cell's packed key, where it was computed before its tokens were split off.
CELL = "_cell"


def stopword_frame(spark: SparkSession, words: Iterable[str] = DEFAULT_STOPWORDS) -> DataFrame:
    """D3/U4: a de-duplicated one-column table ``word`` (whitespace-stripped lines)."""
    rows = sorted({w.strip() for w in words})
    return spark.createDataFrame([(w,) for w in rows], "word string")


def to_cells(df: DataFrame, text_columns: list[str], special_columns: list[str], file_no: int | str = 0) -> DataFrame:
    """Wide Q&A rows -> long cells, keeping only the wanted columns that exist.

    ``df`` needs a ``row_id`` column (file order).  ``file_no`` is a literal or
    a column name.  Column numbers follow the given order, text columns first.
    """
    present_text = [c for c in text_columns if c in df.columns]
    present_special = [c for c in special_columns if c in df.columns]
    fno = F.lit(file_no) if isinstance(file_no, int) else F.col(file_no)
    structs = [
        F.struct(F.lit(i).alias("col_no"), F.col(c).cast("string").alias("text"), F.lit(c in present_special).alias("special"))
        for i, c in enumerate(present_text + present_special)
    ]
    if not structs:
        raise ValueError("none of the wanted columns is present")
    return df.select(fno.cast("int").alias("file_no"), F.col("row_id").cast("long"), F.inline(F.array(*structs))).select(
        "file_no", "row_id", F.col("col_no").cast("int"), F.lit(0).cast("long").alias("sub"), "text", "special"
    )


def text_tokens(cells: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """tokens of the text cells (F1 -> F2 -> segment), null cells skipped.

    With a ``dictionary(word, freq)`` the cells are segmented by it, else into letter/digit runs.
    """
    key = ["file_no", "row_id", "col_no", "sub", *([CELL] if CELL in cells.columns else [])]
    texts = cells.where(~F.col("special") & F.col("text").isNotNull())
    text = pipe_to_space(mark_punctuation(F.col("text")))
    if dictionary is not None:
        return positioned_tokens(texts, key, text, dictionary)
    return texts.select(*key, F.posexplode(segment_regex(text)).alias("pos", "token")).select(
        *key, F.col("pos").cast("long").alias("pos"), "token"
    )


def special_tokens(cells: DataFrame) -> DataFrame:
    """A2: a whole special cell is one token (no lower-casing or segmentation)."""
    return cells.where(F.col("special") & F.col("text").isNotNull()).select(
        "file_no", "row_id", "col_no", "sub", *([CELL] if CELL in cells.columns else []),
        F.lit(0).cast("long").alias("pos"), F.col("text").alias("token"),
    )


def vocab_tokens(cells: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """A1 + A2 input: text tokens and special cells together."""
    keyed = cells.withColumn(CELL, short_cell_key(cells))
    return text_tokens(keyed, dictionary).unionByName(special_tokens(keyed))


def word_count(tokens: DataFrame) -> DataFrame:
    """A1: occurrences per token (partial + final hash aggregation)."""
    return tokens.groupBy(F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("freq"))


def drop_stopword_tokens(tokens: DataFrame, stopwords: DataFrame, token_col: str = "token") -> DataFrame:
    """J3/P4 exploded form: anti join; AQE broadcasts the stopwords when their measured size is small."""
    return tokens.join(stopwords.select(F.col("word").alias(token_col)), token_col, "left_anti")


#: What orders tokens within a file.
PLACE = KEY[1:]

# Bits of each part of the place in a file.  They add up to 126, so a place fits a decimal of
# 38 digits: any row id, 64 columns, 2^25 turns, and any position in a Spark string.
PLACE_BITS = {"row_id": 64, "col_no": 6, "sub": 25, "pos": 31}
_WIDE = "decimal(38,0)"
#: Least value of a part: row ids may be negative.
_LEAST = {"row_id": -(1 << 63)}


def _wide(n: int) -> Column:
    return F.lit(str(n)).cast(_WIDE)


def pack_key() -> Column:
    """``(row_id, col_no, sub, pos)`` as one number that orders like the tuple.

    A minimum over it is a hash aggregate, which a minimum over a struct is not.  A part
    out of its range fails the query instead of wrapping round.
    """
    return (cell_key() + _part("pos")).cast(_WIDE)


def _part(k: str) -> Column:
    value = F.col(k).cast(_WIDE)
    if k in _LEAST:
        return (value - _wide(_LEAST[k])).cast(_WIDE)
    return F.when((F.col(k) >= 0) & (F.col(k) < F.lit(1 << PLACE_BITS[k])), value).otherwise(
        F.raise_error(F.lit(f"{k} is out of the range of the reading-order key")).cast(_WIDE)
    )


def cell_key() -> Column:
    """The packed key of a cell's position 0: all but the last addition, once a cell."""
    out = _part(PLACE[0])
    for k in PLACE[1:]:
        out = (out * _wide(1 << PLACE_BITS[k])).cast(_WIDE)
        if k != "pos":
            out = out + _part(k)
    return out.cast(_WIDE)


#: Bits of a long that a packed key may fill.
_SHORT = 63


def short_cell_key(cells: DataFrame) -> Column:
    """:func:`cell_key` as a long that orders alike, where the cells' own ranges leave room; else :func:`cell_key`.

    One aggregate over the cells tells the ranges.  A cell has fewer positions than its text
    has bytes, so a token's key is this plus its position.  Sums of longs and their minimum cost
    a token a fraction of what decimals do.
    """
    text = cells.where(F.col("text").isNotNull())
    ends = [e for k in PLACE[:-1] for e in (F.min(k).alias(f"{k}_lo"), F.max(k).alias(f"{k}_hi"))]
    gaps = [F.max(F.col(k).isNull()).alias(f"{k}_gap") for k in PLACE[1:-1]]
    seen = text.agg(*ends, *gaps, F.max(F.octet_length("text")).alias("pos_hi")).first()
    if any(seen[f"{k}_hi"] is None or seen[f"{k}_gap"] or seen[f"{k}_lo"] < 0 or seen[f"{k}_hi"] >> PLACE_BITS[k] for k in PLACE[1:-1]):
        return cell_key()  # which fails for what is out of its range
    if seen["row_id_hi"] is None:
        return F.lit(None).cast("long")
    lo = {k: seen[f"{k}_lo"] if k in _LEAST else 0 for k in PLACE[:-1]}
    bits = {**{k: (seen[f"{k}_hi"] - lo[k]).bit_length() for k in PLACE[:-1]}, "pos": seen["pos_hi"].bit_length()}
    if sum(bits.values()) > _SHORT:
        return cell_key()
    out = F.lit(0).cast("long")
    for k in PLACE[:-1]:
        out = F.shiftleft(out, bits[k]) + (F.col(k).cast("long") - F.lit(lo[k]).cast("long"))
    return F.shiftleft(out, bits["pos"])


def unpack_key(name: str) -> list[Column]:
    """Inverse of :func:`pack_key` on column ``name``."""
    parts, rest = [], F.col(name)
    for k in reversed(PLACE):
        top = _wide(1 << PLACE_BITS[k])
        part = rest % top
        parts.append((part + _wide(_LEAST.get(k, 0))).cast("int" if k == "col_no" else "long").alias(k))
        rest = ((rest - part) / top).cast(_WIDE)
    return list(reversed(parts))


def build_vocab(
    tokens: DataFrame,
    stopwords: DataFrame,
    drop_lt_freq: int | None = None,
    compact: bool = False,
) -> DataFrame:
    """A3: ``word, idx, freq``.

    idx = rank of first appearance (W1) after stopwords and the tab token are
    removed, assigned **before** the rare-word cut (P6), so idx has gaps unless
    ``compact``.  The first appearance is the ``min`` of the packed place in each file,
    then the place in the first of the files: two hash aggregates, the second over a row
    for each word and file, so any number of files.  Numbering never runs in one task.
    """
    if CELL not in tokens.columns:
        place = pack_key()
    elif tokens.schema[CELL].dataType.simpleString() == "bigint":
        place = F.col(CELL) + F.col("pos")
    else:
        place = (F.col(CELL) + F.col("pos").cast(_WIDE)).cast(_WIDE)
    in_file = tokens.groupBy(F.col("token").alias("word"), "file_no").agg(F.count(F.lit(1)).alias("freq"), F.min(place).alias("place"))
    first = in_file.groupBy("word").agg(
        F.sum("freq").alias("freq"), F.min("file_no").alias("file_no"), F.min_by("place", "file_no").alias("place")
    )
    first = drop_stopword_tokens(first.where(F.col("word") != "\t"), stopwords, "word")
    ranked = ordered_index(first.select("word", "freq", "file_no", "place"), ["file_no", "place"], "idx")
    vocab = ranked.select("word", "idx", "freq")
    if drop_lt_freq is not None:
        vocab = vocab.where(F.col("freq") >= drop_lt_freq)
    if compact:
        width_v = 1 << 16
        vocab = sequential_index(vocab, [F.expr(f"idx div {width_v}")], ["idx"], "cidx").select(
            "word", F.col("cidx").alias("idx"), "freq"
        )
    return vocab


def encode(tokens: DataFrame, vocab: DataFrame, stopwords: DataFrame | None = None) -> DataFrame:
    """Token -> idx; stopwords and out-of-vocabulary tokens removed, key kept.

    The vocabulary join is left to the planner, hot words apart: see :func:`join_words`.
    """
    if stopwords is not None:
        tokens = drop_stopword_tokens(tokens, stopwords)
    words = vocab.select(F.col("word").alias("token"), "idx", *_freq(vocab))
    return join_words(tokens, words, "token", KEY).select(*KEY, "idx")


def decode(encoded: DataFrame, vocab: DataFrame) -> DataFrame:
    """Idx -> word."""
    return join_words(encoded, vocab.select("idx", "word", *_freq(vocab)), "idx", KEY).select(*KEY, "word")


def _freq(vocab: DataFrame) -> list[str]:
    return ["freq"] if "freq" in vocab.columns else []
