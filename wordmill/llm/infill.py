"""Fill-in-the-middle over a piece table.

A slice's texts lie in one immutable buffer, the sentinels in another.  A document is a
row of descriptors ``(buffer, start, length)``: at first one over its whole text; cutting
splits a descriptor at two code points into prefix, middle and suffix; an arrangement
permutes the three and puts a sentinel's descriptor before each.  No text is copied until
an output is written, and digests are fed descriptor by descriptor.  Restoring reads an
output: its sentinels are found, the parts between them are descriptors over the output,
and the inverse permutation puts them back.

A document's cuts and form follow from its id alone (four numbers from the SHA-256 of the
seed and the id), so every retry gives the same output.  A text that holds a sentinel stays
plain, so an output's first sentinels are always its own: no sentinel begins with the end of
another, and cutting cannot make one.

Texts are worked on in slices of a megabyte or one text; nothing is shuffled.

Defined results: null and empty texts are empty and plain; a null ``doc_id`` counts as the
empty string in the seed; equal rows get equal outputs; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.text import buffers, slices

SEED = "1"
#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred documents, how many are cut, and of a hundred cut ones, how many begin with the suffix.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20

PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: Which part stands at each place.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Which sentinel stands before a part.
MARKS = {PREFIX: 0, SUFFIX: 1, MIDDLE: 2}

TEXT, MARK = 0, 1


@dataclass
class Pieces:
    """One document as descriptors over immutable buffers."""

    buffers: tuple[memoryview, memoryview]  # texts, sentinels
    parts: list[tuple[int, int, int]]  # (buffer, start, length), in bytes

    def cut(self, *at: int) -> Pieces:
        """Split at byte offsets of the whole, in order; empty parts stay."""
        out: list[tuple[int, int, int]] = []
        rest, done = list(self.parts), 0
        for offset in at:
            while done + rest[0][2] < offset:
                done += rest[0][2]
                out.append(rest.pop(0))
            buffer, start, length = rest.pop(0)
            out.append((buffer, start, offset - done))
            rest.insert(0, (buffer, start + offset - done, length - offset + done))
            done = offset
        return Pieces(self.buffers, out + rest)

    def arranged(self, order: tuple[int, ...]) -> Pieces:
        return Pieces(self.buffers, [self.parts[k] for k in order])

    def marked(self, order: tuple[int, ...], marks: list[tuple[int, int]]) -> Pieces:
        """A sentinel's descriptor before each part; ``order`` says which part stands where."""
        out = []
        for part, piece in zip(order, self.parts):
            out += [(MARK, *marks[MARKS[part]]), piece]
        return Pieces(self.buffers, out)

    def views(self) -> Iterator[memoryview]:
        for buffer, start, length in self.parts:
            yield self.buffers[buffer][start : start + length]

    def text(self) -> bytes:
        return b"".join(self.views())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(int(k) for k in np.argsort(order))


def numbers(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _marks(sentinels: tuple[str, ...]) -> tuple[bytes, list[tuple[int, int]]]:
    data, spans = b"", []
    for s in sentinels:
        spans.append((len(data), len(s.encode())))
        data += s.encode()
    return data, spans


def _holds(data: np.ndarray, texts: np.ndarray, mark: bytes) -> np.ndarray:
    """Which texts hold ``mark``."""
    n = len(data) - len(mark) + 1
    out = np.zeros(len(texts) - 1, dtype=bool)
    if n <= 0:
        return out
    same = np.ones(n, dtype=bool)
    for k, b in enumerate(mark):
        same &= data[k : n + k] == b
    at = np.flatnonzero(same)
    doc = np.searchsorted(texts, at, side="right") - 1
    out[doc[at + len(mark) <= texts[doc + 1]]] = True
    return out


def _infill(seed: str, sentinels: tuple[str, ...], cut_share: int, suffix_first: int):
    fields = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark_data, marks = _marks(sentinels)
        for batch in slices(batches, "text"):
            texts, data = buffers(batch.column("text"))
            begins = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of code points
            first = np.searchsorted(begins, texts)
            plain = np.zeros(len(texts) - 1, dtype=bool)
            for s in sentinels:
                plain |= _holds(data, texts, s.encode())
            both = (memoryview(np.ascontiguousarray(data)).cast("B"), memoryview(mark_data))
            out: list[list] = [[] for _ in fields]
            for d, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                lo, size = int(texts[d]), int(texts[d + 1] - texts[d])
                n = int(first[d + 1] - first[d])
                pieces = Pieces(both, [(TEXT, lo, size)])
                h1, h2, h3, h4 = numbers(doc_id, seed)
                form, prefix, middle = "plain", None, None
                if n and not plain[d] and h3 % 100 < cut_share:
                    form = "spm" if h4 % 100 < suffix_first else "psm"
                    ends = sorted((h1 % (n + 1), h2 % (n + 1)))
                    prefix, middle = ends[0], ends[1] - ends[0]
                    at = [int(begins[first[d] + k]) - lo if k < n else size for k in ends]
                    order = ORDERS[form]
                    pieces = pieces.cut(*at).arranged(order).marked(order, marks)
                row = (doc_id, n, form, prefix, middle, pieces.text(), pieces.sha256())
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            arrays[5] = arrays[5].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, fields)

    return run


def fill_in_middle(
    docs: DataFrame,
    seed: str = SEED,
    sentinels: tuple[str, ...] = SENTINELS,
    cut_share: int = CUT_SHARE,
    suffix_first: int = SUFFIX_FIRST_SHARE,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output, output_sha256`` of ``docs(doc_id, text)``.

    ``sentinels`` are those before prefix, suffix and middle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _infill(seed, sentinels, cut_share, suffix_first),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string",
    )


def parsed(output: memoryview | bytes, form: str, sentinels: tuple[str, ...] = SENTINELS) -> Pieces:
    """An output's own text as descriptors over the output."""
    raw = bytes(output)
    whole = Pieces((memoryview(raw), memoryview(b"")), [(TEXT, 0, len(raw))])
    if form == "plain":
        return whole
    order = ORDERS[form]
    ends, at = [], 0
    for part in order:
        mark = sentinels[MARKS[part]].encode()
        found = raw.find(mark, at)
        if found < 0 or not ends and found:
            raise ValueError(f"not an output of form {form}")
        at = found + len(mark)
        ends += [found, at]
    pieces = whole.cut(*ends).parts[2::2]  # what stands between the sentinels
    return Pieces(whole.buffers, pieces).arranged(inverse(order))


def _restored(sentinels: tuple[str, ...], kept: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            outputs = batch.column("output").cast(pa.large_binary()).to_pylist()
            pieces = [parsed(o or b"", f, sentinels) for o, f in zip(outputs, batch.column("form").to_pylist())]
            arrays = [*[batch.column(c) for c in kept], pa.array([p.sha256() for p in pieces], pa.string())]
            if texts:
                arrays.append(pa.array([p.text() for p in pieces], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "restored_sha256", *(["restored"] if texts else [])])

    return run


def restore(formatted: DataFrame, sentinels: tuple[str, ...] = SENTINELS, texts: bool = True) -> DataFrame:
    """``formatted`` without ``output`` but with ``restored_sha256`` and, with ``texts``, ``restored``, the text itself.

    Only ``output`` and ``form`` are used to rebuild a text.
    """
    kept = [c for c in formatted.columns if c not in ("output", "restored", "restored_sha256")]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in formatted.select(*kept).schema]
    return formatted.select(*kept, "output").mapInArrow(
        _restored(sentinels, kept, texts), ", ".join([*fields, "restored_sha256 string", *(["restored string"] if texts else [])])
    )


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || doc_id) AS h
  FROM documents
), u AS (
  SELECT doc_id, text, n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), v AS (
  SELECT doc_id, text, n, form,
         substr(text, 1, least(c1, c2)) AS prefix,
         substr(text, least(c1, c2) + 1, abs(c1 - c2)) AS middle,
         substr(text, greatest(c1, c2) + 1) AS suffix
  FROM u
)
SELECT doc_id, n, form,
       CASE WHEN form = 'plain' THEN NULL ELSE length(prefix) END AS prefix_chars,
       CASE WHEN form = 'plain' THEN NULL ELSE length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM v
"""
