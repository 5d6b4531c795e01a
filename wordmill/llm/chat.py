"""Chat formatting with a black-box template, located turn by turn.

The renderer is any function from a list of ``(role, text)`` turns to a string.  It is
called on successive prefixes of a conversation: what an output adds to the one before
is the new turn's span, and an output that does not begin with the one before shows
that the template rewrites history.  The text within an assistant turn is located by
rendering the same prefix with a mark in its place.  Nothing is assumed about how
the template builds its output.

The supplied template marks every turn and escapes its control strings inside texts
with a backslash code, so the formatted string reads back to the same turns.

Long conversations: prefixes are rendered whole up to ``FULL`` turns.  A renderer that
declares ``window = n`` (what a turn adds depends on the ``n`` turns before it only;
the supplied one declares 0) is then rendered on that window alone, which keeps the
work in proportion to the turns.  The declaration is checked against whole prefixes on
the first ``FULL`` turns of every conversation, at each later turn whose number is a
power of two and at the last; where it fails there, the conversation is rendered by
whole prefixes throughout.  A rewrite that is undone before the next such turn is missed.

Conversations are streamed from sorted partitions, one at a time.  Defined results:
null texts and roles are empty; turns are ordered by ``turn`` (null first), then role
and text, and repeated rows are turns of their own; rows with a null ``conv_id`` are
one conversation; roles other than system, user and assistant get a mark with their
name; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Renderer = Callable[[Turns], str]

#: Control strings of the supplied template, in the order of their escape codes.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
#: Turns whose whole prefixes are rendered even if the renderer declares a window.
FULL = 32
#: Stands for a text while its place is looked for; private-use characters.
MARK = "\ue000\ue001"

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted([*CONTROLS, "\\"], key=len, reverse=True)))
_CODE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Control strings and backslashes as a backslash and a code."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else "\\" + "abcdefgh"[CONTROLS.index(m[0])], text)


def unescape(text: str) -> str:
    return _CODE.sub(lambda m: "\\" if m[1] == "\\" else CONTROLS["abcdefgh".index(m[1])], text)


def render(turns: Turns) -> str:
    """The supplied template."""
    out = []
    for role, text in turns:
        body = escape(text)
        if role == "system":
            out.append(f"<<SYS>> {body} <</SYS>>\n")
        elif role == "user":
            out.append(f"<s>[INST] {body} [/INST]\n")
        elif role == "assistant":
            out.append(f"{body} </s>\n")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE] {body} </s>\n")
    return "".join(out)


render.window = 0

_TURN = re.compile(
    r"<<SYS>> (?P<system>.*?) <</SYS>>\n|<s>\[INST\] (?P<user>.*?) \[/INST\]\n"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*?) </s>\n|(?P<assistant>.*?) </s>\n",
    re.S,
)


def read_back(formatted: str) -> Turns:
    """The turns of a string made by the supplied template."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["other"])))
        else:
            turns.append(next((r, unescape(m[r])) for r in ("system", "user", "assistant") if m[r] is not None))
        at = m.end()
    return turns


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving (slices compare at memory speed)."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo + (hi > lo and a[lo] == b[lo])


class Located:
    """A conversation's formatted string, spans of its turns and of its learned texts."""

    def __init__(self, turns: Turns, renderer: Renderer, learn: str = "assistant", full: int = FULL):
        if not self._locate(turns, renderer, learn, full, getattr(renderer, "window", None)):
            # it does not keep to its window here: whole prefixes tell which turns it rewrites
            self._locate(turns, renderer, learn, full, None)

    def _locate(self, turns: Turns, renderer: Renderer, learn: str, full: int, window: int | None) -> bool:
        """False if, beyond ``full`` turns, what the windows gave is not the whole prefix's rendering."""
        self.spans: list[tuple[int, int]] = []
        self.loss: list[tuple[int, int]] = []
        self.rewritten: list[int] = []  # turns whose rendering changes what stood before
        parts, whole, length = [], "", 0
        for k, turn in enumerate(turns):
            if window is not None and k >= full:
                near = turns[k - window : k]
                before, after = renderer(near), renderer([*near, turn])
                keep = _common(before, after)
                if keep < len(before):
                    raise ValueError("the renderer rewrites turns beyond its declared window")
                offset = length - keep
            else:
                before, after = whole, renderer(turns[: k + 1])
                keep, offset = _common(before, after), 0
                if keep < len(before):
                    self.rewritten.append(k)
                    parts, length = [before[:keep]], keep
                elif window is not None:
                    near = turns[max(0, k - window) : k]
                    if renderer([*near, turn])[len(renderer(near)) :] != after[keep:]:
                        raise ValueError("the renderer depends on turns before its declared window")
                whole = after
            parts.append(after[keep:])
            length += len(after) - keep
            self.spans.append((offset + keep, offset + len(after)))
            if turn[0] == learn:
                prefix = turns[k - window : k] if window is not None and k >= full else turns[:k]
                marked = renderer([*prefix, (turn[0], MARK)])
                at = marked.find(MARK, keep)
                if at < 0:
                    at, end = keep, len(after)  # the template hides or changes the text: learn all it added
                else:
                    end = len(after) - (len(marked) - at - len(MARK))
                self.loss.append((offset + at, offset + end))
            if window is not None and k >= full and (k + 1 == len(turns) or not k & (k + 1)):
                parts = ["".join(parts)]
                if parts[0] != renderer(turns[: k + 1]):
                    return False
        self.formatted = "".join(parts)
        if self.rewritten:
            # spans before a rewrite may have moved: only those of the last output's stable part are kept
            self.spans = [(min(a, length), min(b, length)) for a, b in self.spans]
        return True


FORMATTED = (
    "conv_id long, n_turns long, formatted string, spans array<struct<start:long,end:long>>, "
    "loss array<struct<start:long,end:long>>, rewritten array<int>"
)

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _formatted(renderer: Renderer, learn: str):
    def finished(conv: int | None, turns: Turns) -> pa.RecordBatch:
        x = Located(turns, renderer, learn)
        struct = lambda spans: [{"start": a, "end": b} for a, b in spans]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([conv], pa.int64()),
                pa.array([len(turns)], pa.int64()),
                pa.array([x.formatted], pa.string()),
                pa.array([struct(x.spans)], _SPANS),
                pa.array([struct(x.loss)], _SPANS),
                pa.array([x.rewritten], pa.list_(pa.int32())),
            ],
            ["conv_id", "n_turns", "formatted", "spans", "loss", "rewritten"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, begun = None, [], False
        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if begun and c != conv:
                    yield finished(conv, turns)
                    turns = []
                conv, begun = c, True
                turns.append((role or "", text or ""))
        if begun:
            yield finished(conv, turns)

    return run


def format_chats(conversations: DataFrame, renderer: Renderer = render, learn: str = "assistant") -> DataFrame:
    """One row a conversation: the formatted string, each turn's span and the spans to learn from."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_formatted(renderer, learn), FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewrites long"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = row["formatted"]
            turns, learned = hashlib.sha256(), hashlib.sha256()
            n = chars = 0
            for role, body in read_back(text):
                turns.update(f"{role}\n{body}\n".encode())
                n += 1
            for span in row["loss"]:
                body = unescape(text[span["start"] : span["end"]])
                learned.update(body.encode())
                chars += len(body)
            rows.append((row["conv_id"], n, turns.hexdigest(), chars, learned.hexdigest(), len(text), len(row["rewritten"])))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in DIGEST.split(", ")]
            )


def digests(formatted: DataFrame) -> DataFrame:
    """Turns and learned text of each formatted conversation, read back from its string."""
    return formatted.mapInArrow(_digested, DIGEST)


def _oracle() -> str:
    body = "replace(text, '\\', '\\\\')"
    for code, control in zip("abcdefgh", CONTROLS):
        body = f"replace({body}, '{control}', '\\{code}')"
    role = body.replace("replace(text", "replace(role")
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, CASE role WHEN 'system' THEN '<<SYS>> ' || {body} || ' <</SYS>>' || chr(10)
                      WHEN 'user' THEN '<s>[INST] ' || {body} || ' [/INST]' || chr(10)
                      WHEN 'assistant' THEN {body} || ' </s>' || chr(10)
                      ELSE '[ROLE]' || {role} || '[/ROLE] ' || {body} || ' </s>' || chr(10) END AS said
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         string_agg(said, '' ORDER BY turn, role, text) AS formatted
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       length(formatted) AS formatted_chars, 0::BIGINT AS n_rewrites
FROM g"""


ORACLE = _oracle()
