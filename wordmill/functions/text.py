"""Column expressions for text normalisation (all JVM-side, codegen friendly).

Every function takes and returns a ``Column`` so it composes inside one
``select`` and stays within whole-stage codegen; none needs Python at runtime.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.constants import (
    CLEAN_WHITESPACE,
    PUNCTUATION_TAGS,
    RUN_PATTERN,
    TOKEN_PATTERN,
    TURN_SEPARATOR,
    clean_pattern,
)

# Python's str.strip() set: everything ``\s`` matches.
_EDGE_WS = "".join(map(chr, CLEAN_WHITESPACE))

# The cleaning regex.  Java tries a class's characters one after the other, so letters and digits,
# with which nothing that is deleted begins, are told first.
_CLEAN = f"(?![0-9A-Za-z])(?:{clean_pattern()})"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mark_punctuation(col: Column | str) -> Column:
    """lower-case, then replace the twelve marks by upper-case tags."""
    out = F.lower(_c(col))
    for mark, tag in PUNCTUATION_TAGS:
        out = F.replace(out, F.lit(mark), F.lit(tag))
    return out


def pipe_to_space(col: Column | str) -> Column:
    """the dialogue turn separator becomes a space."""
    return F.replace(_c(col), F.lit(TURN_SEPARATOR), F.lit(" "))


def clean_sentence(col: Column | str, gap: str = "") -> Column:
    """delete punctuation/whitespace runs and the six literals in one pass.

    A null cell cleans to ``''``.  With ``gap=" "`` a blank is left where
    something was deleted, for languages that write blanks between words.
    """
    return F.regexp_replace(F.coalesce(_c(col), F.lit("")), F.lit(_CLEAN), F.lit(gap))


def segment_regex(col: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """F4/R1 regex mode: ordered array of maximal letter/digit runs (and whole punctuation tags)."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(0))


def drop_stopwords_array(tokens: Column | str, stopwords: Iterable[str]) -> Column:
    """P4 (array form): remove members of a small, fixed stopword set.

    Order and duplicates are kept (``array_except`` would de-duplicate).
    For a large stopword table use the exploded form with an anti join.
    """
    sw = list(dict.fromkeys(stopwords))
    return F.filter(_c(tokens), lambda t: ~t.isin(sw)) if sw else _c(tokens)


def sentence_proc(col: Column | str, stopwords: Iterable[str], mode: str = "joined") -> Column:
    """clean, segment, drop stopwords, join by one space (no lower-casing).

    ``joined`` deletes blanks too, as the original does for a language that writes
    none, and takes letter/digit runs.  ``spaced`` leaves a gap: words of languages
    that write blanks.  Segmentation by a dictionary is a job over a table, see
    :func:`plans.corpus.process_table`.
    """
    tokens = segment_regex(clean_sentence(col, gap_of(mode)), RUN_PATTERN)
    return F.array_join(drop_stopwords_array(tokens, stopwords), " ")


def gap_of(mode: str) -> str:
    """What cleaning leaves where it deletes something."""
    if mode not in ("joined", "spaced"):
        raise ValueError("mode is spaced or joined")
    return " " if mode == "spaced" else ""


def token_count(col: Column | str) -> Column:
    """F8: number of single spaces plus one."""
    c = _c(col)
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("long")


def strip_ws(col: Column | str) -> Column:
    """strip leading/trailing whitespace the way Python's ``str.strip()`` does."""
    return F.btrim(_c(col), F.lit(_EDGE_WS))


def split_single_space(col: Column | str) -> Column:
    """split on one space, keeping empty tokens (``'a  b'`` -> ``a, '', b``)."""
    return F.split(_c(col), " ", -1)


def merge_columns(cols: Iterable[Column | str], sep: str = " ") -> Column:
    """Join columns with a separator, blanks kept (null counts as ``''``)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c), F.lit("")) for c in cols])
