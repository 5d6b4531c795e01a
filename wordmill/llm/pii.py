"""Personal data: base patterns plus a character-level bidirectional LSTM with a CRF.

The base patterns (see ``BASE``) are found in whole texts.  Each kind's characters form
a class, and a match lies inside one run of its class, so only runs with the needed
characters are matched; this finds what a search of the whole text finds.

The model labels characters begin/inside for four kinds.  It is trained here in numpy,
from labelled spans: a bounded sample of ``SAMPLE_DOCS`` documents (those of least
``doc_id``) gives contexts, in which generated items and look-alikes are set, and the
generator knows their spans.  It finds forms the patterns miss: a phone number without
a plus, or one that a pattern drops because another number follows.

Texts are decoded in windows of ``WINDOW`` characters that overlap by half, wherever a
digit or an at sign is near.  Each character takes its label from the window in whose
middle half it lies, and spans are put together over the whole text.  A model span, or the
numbers side by side in it, is added if its kind's check holds (Luhn, digits, parts) and no base span overlaps it.

Defined results: null and empty texts have no spans; repeated rows each get theirs;
other columns are not read.  Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.text import buffers, slices

KINDS = ["email", "ip", "card", "phone"]

#: Fixed patterns of the base, on bytes; all their characters are ASCII.
BASE = {
    "email": re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(rb"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]"),
}
_ALNUM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Characters of each kind, and (character class, least number) that a match must hold.
RUNS = {
    "email": (_ALNUM + b"._%+-@", [(b"@", 1)]),
    "ip": (b"0123456789.", [(b".", 3)]),
    "card": (b"0123456789 -", [(b"0123456789", 13)]),
    "phone": (b"0123456789 ().-+", [(b"+", 1), (b"0123456789", 9)]),
}

WINDOW = 64
HIDDEN = 20
EMBED = 12
#: Training contexts: the start of this many documents, at most this long.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 2000
STEPS = 260
BATCH = 64
RATE = 0.02
SEED = 7
#: Windows decoded at once.
DECODE = 512


def digits(x: bytes) -> bytes:
    return bytes(b for b in x if 48 <= b <= 57)


def luhn(x: bytes) -> bool:
    total = 0
    for k, b in enumerate(reversed(digits(x))):
        d = (b - 48) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind: str, x: bytes) -> bool:
    """The check of a base match."""
    if kind == "ip":
        return all(len(p := part.lstrip(b"0")) <= 3 and int(p or b"0") <= 255 for part in x.split(b"."))
    n = len(digits(x))
    if kind == "card":
        return 13 <= n <= 19 and luhn(x)
    return 9 <= n <= 15 if kind == "phone" else True


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_IN = {k: _table(c) for k, (c, _) in RUNS.items()}
_NEED = {k: [(_table(c), n) for c, n in need] for k, (_, need) in RUNS.items()}


_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(rb"[0-9]+(?:\.[0-9]+)*")


def _emails(raw: bytes, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern in a run: it stands around an at sign, so each is looked at once, from there."""
    done = lo
    at = raw.find(b"@", lo, hi)
    while at >= 0:
        after = raw.find(b"@", at + 1, hi)
        # no at sign between: all before this one, back to the last match or at sign, is the user's name
        if at > done and (m := _DOMAIN.match(raw, at + 1, after if after >= 0 else hi)):
            yield done, m.end()
            done = m.end()
        else:
            done = at + 1
        at = after


def _ips(raw: bytes, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Matches of the ip pattern in a run: every four numbers of a chain of numbers with single dots between."""
    for m in _NUMBERS.finditer(raw, lo, hi):
        at, parts = m.start(), m[0].split(b".")
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            yield at, end
            at = end + 1


def matches(kind: str, raw: bytes, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a kind's pattern, none over another, in a run of its characters, in time that follows its length."""
    if kind == "email":
        return _emails(raw, lo, hi)
    if kind == "ip":
        return _ips(raw, lo, hi)
    return (m.span() for m in BASE[kind].finditer(raw, lo, hi))


def base_spans(data: np.ndarray, texts: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes, of all texts of a slice; starts ascend within a kind."""
    out = []
    raw = data.tobytes()
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[texts] = True
    for k, kind in enumerate(KINDS):
        needs = [(table[data], n) for table, n in _NEED[kind]]
        if not all(flag.any() for flag, _ in needs):
            continue
        inside = _IN[kind][data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
        for flag, n in needs:
            total = np.concatenate([[0], np.cumsum(flag)])
            some = total[b] - total[a] >= n
            a, b = a[some], b[some]
        for lo, hi in zip(a.tolist(), b.tolist()):
            out += [(k, x, y) for x, y in matches(kind, raw, lo, hi) if holds(kind, raw[x:y])]
    return out


# -- the model ---------------------------------------------------------------------

_OWN = "0@.-+() :,;/_%=\"'#&*[]{}|<>!?\n"
PAD, DIGIT, LOWER, UPPER, WIDE, REST = range(6)
CLASSES = 6 + len(_OWN)


def _classes() -> np.ndarray:
    out = np.full(256, REST, dtype=np.int64)
    out[ord("a") : ord("z") + 1] = LOWER
    out[ord("A") : ord("Z") + 1] = UPPER
    out[128:] = WIDE
    for k, c in enumerate(_OWN):
        out[ord(c)] = 6 + k
    out[ord("0") : ord("9") + 1] = DIGIT
    return out


#: Class of a character by its first byte in UTF-8.
CLASS = _classes()
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


class Tagger:
    """Bidirectional LSTM emissions and CRF transitions; all arrays in ``p``."""

    def __init__(self, p: dict[str, np.ndarray] | None = None, seed: int = SEED):
        rng = np.random.default_rng(seed)
        if p is None:
            size = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
            p = {"embed": rng.normal(0, 0.5, (CLASSES, EMBED))}
            for d in "fb":
                p |= {f"x{d}": size(EMBED, 4 * HIDDEN), f"h{d}": size(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN)}
                p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # forget gates start open
            p |= {"out": size(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        n, steps, _ = x.shape
        p, hid = self.p, HIDDEN
        pre = x @ p[f"x{d}"] + p[f"c{d}"]
        h = c = np.zeros((n, hid), dtype=np.float32)
        out, kept = np.empty((n, steps, hid), dtype=np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ p[f"h{d}"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * hid]))
            g = np.tanh(z[:, 3 * hid :])
            i, f, o = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :]
            last, prior = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            kept.append((t, i, f, o, g, last, prior, tc))
        return out, kept

    def emissions(self, classes: np.ndarray) -> np.ndarray:
        x = self.p["embed"][classes]
        both = np.concatenate([self._lstm(x, "f")[0], self._lstm(x, "b")[0]], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def decode(self, classes: np.ndarray) -> np.ndarray:
        """Best tags of each window (Viterbi)."""
        e, move = self.emissions(classes), self.p["move"]
        n, steps, _ = e.shape
        score = e[:, 0] + self.p["first"]
        back = np.empty((n, steps, TAGS), dtype=np.int8)
        for t in range(1, steps):
            total = score[:, :, None] + move[None]
            back[:, t] = total.argmax(axis=1)
            score = total.max(axis=1) + e[:, t]
        tags = np.empty((n, steps), dtype=np.int8)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags

    def loss(self, classes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags, and its gradients."""
        p = self.p
        n, steps = classes.shape
        x = p["embed"][classes]
        (hf, kf), (hb, kb) = self._lstm(x, "f"), self._lstm(x, "b")
        both = np.concatenate([hf, hb], axis=2)
        e = both @ p["out"] + p["bias"]
        top = lambda a, axis: np.log(np.exp(a - (m := a.max(axis=axis, keepdims=True))).sum(axis=axis)) + m.squeeze(axis)
        alpha = np.empty_like(e)
        beta = np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + p["first"]
        for t in range(1, steps):
            alpha[:, t] = top(alpha[:, t - 1, :, None] + p["move"], 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = top(p["move"][None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = top(alpha[:, -1], 1)
        row = np.arange(n)
        gold = e[row[:, None], np.arange(steps), tags].sum(axis=1) + p["first"][tags[:, 0]] + p["move"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
        de = np.exp(alpha + beta - z[:, None, None])
        g = {"first": de[:, 0].sum(axis=0)}
        pairs = np.exp(alpha[:, :-1, :, None] + p["move"] + (e + beta)[:, 1:, None, :] - z[:, None, None, None])
        g["move"] = pairs.sum(axis=(0, 1))
        np.subtract.at(g["move"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        np.subtract.at(g["first"], tags[:, 0], 1)
        de[row[:, None], np.arange(steps), tags] -= 1
        g["out"] = both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        g["bias"] = de.sum(axis=(0, 1))
        dh = de @ p["out"].T
        dx = np.zeros_like(x)
        for d, kept, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            dpre = np.empty((n, steps, 4 * HIDDEN), dtype=np.float32)
            gh = np.zeros_like(p[f"h{d}"])
            next_h = next_c = np.zeros((n, HIDDEN), dtype=np.float32)
            for t, i, f, o, c, last, prior, tc in reversed(kept):
                h = part[:, t] + next_h
                dc = next_c + h * o * (1 - tc * tc)
                dz = np.concatenate([dc * c * i * (1 - i), dc * last * f * (1 - f), h * tc * o * (1 - o), dc * i * (1 - c * c)], axis=1)
                dpre[:, t] = dz
                gh += prior.T @ dz
                next_h, next_c = dz @ p[f"h{d}"].T, dc * f
            g[f"h{d}"], g[f"c{d}"] = gh, dpre.sum(axis=(0, 1))
            g[f"x{d}"] = x.reshape(-1, EMBED).T @ dpre.reshape(-1, 4 * HIDDEN)
            dx += dpre @ p[f"x{d}"].T
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], classes.ravel(), dx.reshape(-1, EMBED))
        return float((z - gold).mean()), {k: v / n for k, v in g.items()}

    def fit(self, classes: np.ndarray, tags: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> None:
        """Adam, with a rate that falls to a twentieth."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(classes), batch)
            _, g = self.loss(classes[pick], tags[pick])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step = rate * (1 - 0.95 * t / steps)
            for k, v in g.items():
                v = v * min(1.0, 5.0 / max(size, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                self.p[k] -= (step * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def _luhn_number(rng: np.random.Generator, n: int) -> str:
    body = "".join(str(d) for d in rng.integers(0, 10, n - 1))
    return next(body + str(d) for d in range(10) if luhn((body + str(d)).encode()))


def _item(rng: np.random.Generator, kind: str) -> str:
    """A generated item of ``kind``."""
    name = lambda lo, hi: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(lo, hi)))
    num = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    if kind == "email":
        user = name(2, 9) + str(rng.choice(["", ".", "_", "-", "+"])) + (num(int(rng.integers(1, 4))) if rng.random() < 0.5 else name(1, 6))
        return f"{user}@{name(3, 8)}{num(1) if rng.random() < 0.4 else ''}.{rng.choice(['example.com', 'com', 'org', 'example.net', 'co.uk', 'de'])}"
    if kind == "ip":
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "card":
        x, sep = _luhn_number(rng, int(rng.choice([16, 16, 16, 15, 14]))), str(rng.choice(["", "", " ", "-"]))
        return sep.join(x[i : i + 4] for i in range(0, len(x), 4)) if sep else x
    a, b, c = num(3), num(3), num(4)
    forms = ["+1 ({}) {}-{}", "+1 ({}) {}-{}", "({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "+1 {} {} {}", "+49 {} {}{}", "{} {} {}"]
    return str(rng.choice(forms)).format(a, b, c)


def _lookalike(rng: np.random.Generator) -> str:
    """Something with digits that is no personal data."""
    num = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    hexed = lambda n: "".join("0123456789abcdef"[d] for d in rng.integers(0, 16, n))
    return [
        lambda: str(rng.integers(1900, 2030)),
        lambda: f"{rng.integers(1990, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}",
        lambda: f'token = "{hexed(40)}"',
        lambda: f"password={hexed(18)}",
        lambda: f"{rng.integers(1, 9)}.{rng.integers(0, 20)}",
        lambda: f"{rng.integers(1, 9)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}",
        lambda: f"${num(2)},{num(3)}.{num(2)}",
        lambda: num(int(rng.integers(1, 8))),
        lambda: f"{rng.integers(1, 24):02d}:{rng.integers(0, 60):02d}",
        lambda: f"@{'abcdefg'[: rng.integers(2, 7)]}",
        lambda: f"version {rng.integers(1, 9)}.{rng.integers(0, 9)}",
    ][int(rng.integers(11))]()


def labelled(contexts: list[str], n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``n`` windows of character classes and tags: items and look-alikes set in contexts."""
    rng = np.random.default_rng(seed)
    classes, tags = np.zeros((n, WINDOW), dtype=np.int64), np.zeros((n, WINDOW), dtype=np.int64)
    for r in range(n):
        text, marks = "", []
        while len(text) < 2 * WINDOW:
            around = contexts[int(rng.integers(len(contexts)))] if contexts else "text "
            a = int(rng.integers(0, max(1, len(around) - 60)))
            text += around[a : a + int(rng.integers(1, 40))]
            if text and rng.random() < 0.85 and text[-1].isalnum():
                text += " "
            if rng.random() < 0.7:
                k = int(rng.integers(len(KINDS)))
                item = _item(rng, KINDS[k])
                marks += [0] * (len(text) - len(marks)) + [1 + 2 * k] + [2 + 2 * k] * (len(item) - 1)
                text += item + str(rng.choice([" ", " ", " ", ". ", ", ", "\n"]))
            else:
                text += _lookalike(rng) + " "
        marks += [0] * (len(text) - len(marks))
        a = int(rng.integers(0, WINDOW))
        if rng.random() < 0.1:  # a text's end
            text, marks = text[: a + int(rng.integers(20, WINDOW))], marks
        own = [CLASS[c.encode()[0]] for c in text[a : a + WINDOW]]
        classes[r, : len(own)], tags[r, : len(own)] = own, marks[a : a + len(own)]
        # a window may begin inside an item: its first character is then inside, as it stands
    return classes, tags


def contexts_of(docs: DataFrame, most: int = SAMPLE_DOCS) -> list[str]:
    """Passages without digits or at signs of at most ``most`` documents, those of least id."""
    rows = docs.where("doc_id is not null and text is not null")
    # ids first: a task then sends its few least ids, not their texts
    ids = [r["doc_id"] for r in rows.select("doc_id").distinct().orderBy("doc_id").limit(most).collect()]
    some = rows.where(F.col("doc_id").isin(ids)).select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    out = []
    for row in some.orderBy("doc_id", "text").limit(most).collect():
        out += [x for x in re.split(r"\S*[0-9@]\S*", row["text"]) if len(x) >= 40]
    return out


def train(contexts: list[str], windows: int = 3000, steps: int = STEPS, seed: int = SEED) -> Tagger:
    tagger = Tagger(seed=seed)
    tagger.fit(*labelled(contexts, windows, seed), steps=steps, seed=seed)
    return tagger


# -- decoding ----------------------------------------------------------------------


def model_tags(tagger: Tagger, lead: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A tag for each character of a slice; ``lead`` are first bytes, texts own ``first[d]:first[d+1]``.

    Windows start every half window of a text; only those near a digit or an at sign are decoded.
    """
    half = WINDOW // 2
    near = ((lead >= 48) & (lead <= 57)) | (lead == 64)
    out = np.zeros(len(lead), dtype=np.int8)
    at = np.flatnonzero(near)
    if not len(at):
        return out
    doc = np.searchsorted(first, at, side="right") - 1
    # each anchor asks for the windows over it and its surroundings
    asked = []
    for shift in (-half // 2, 0, half // 2):
        place = np.clip(at + shift, first[doc], first[doc + 1] - 1) - first[doc]
        for back in (0, 1):
            k = place // half - back
            ok = k >= 0
            asked.append(np.stack([doc[ok], k[ok]], axis=1))
    windows = np.unique(np.concatenate(asked), axis=0)
    start = first[windows[:, 0]] + windows[:, 1] * half
    stop = first[windows[:, 0] + 1]
    # a window labels its middle half, and from its text's start if it is the first
    lo = np.where(windows[:, 1] == 0, start, start + half // 2)
    hi = np.minimum(start + half + half // 2, stop)
    hi = np.where(start + WINDOW >= stop, stop, hi)  # the last windows label to the end
    for a in range(0, len(windows), DECODE):
        s, e = start[a : a + DECODE], stop[a : a + DECODE]
        place = s[:, None] + np.arange(WINDOW)
        inside = place < e[:, None]
        tags = tagger.decode(np.where(inside, CLASS[lead[np.minimum(place, len(lead) - 1)]], PAD))
        own = (place >= lo[a : a + DECODE, None]) & (place < hi[a : a + DECODE, None])
        out[place[own]] = tags[own]
    return out


def model_spans(tags: np.ndarray, first: np.ndarray, lead: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) in characters; begins only split where the kind goes on after a gap or anew."""
    kind = (tags.astype(np.int64) + 1) // 2  # 0 outside, else kind + 1
    begin = (kind > 0) & (tags % 2 == 1)
    edge = np.zeros(len(tags) + 1, dtype=bool)
    edge[first] = True
    change = np.ones(len(tags), dtype=bool)
    change[1:] = (kind[1:] != kind[:-1]) | edge[1:-1] | (begin[1:] & (lead[:-1] == 32))
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(tags))
    own = kind[starts] > 0
    return list(zip((kind[starts[own]] - 1).tolist(), starts[own].tolist(), ends[own].tolist()))


def _accepted(kind: int, x: bytes) -> bool:
    name = KINDS[kind]
    if name == "email":
        return BASE["email"].fullmatch(x) is not None
    if name == "ip":
        return BASE["ip"].fullmatch(x) is not None and holds("ip", x)
    return re.fullmatch(rb"[+(]?[0-9][0-9 ().-]*[0-9]", x) is not None and holds(name, x)


_GROUP = re.compile(rb"[+(]?[0-9][0-9().-]*")
#: Digit groups that one item may have.
GROUPS = 8


def items(kind: int, x: bytes) -> list[tuple[int, int]]:
    """What a model span of ``kind`` holds: itself, or the items that stand side by side in it, from the left.

    The tagger sees two numbers with a blank between as one span; each of them is tested.  Of
    several at one place a card is the longest (its check tells), a phone number the shortest.
    """
    if _accepted(kind, x):
        return [(0, len(x))]
    if KINDS[kind] not in ("card", "phone"):
        return []
    groups = [m.span() for m in _GROUP.finditer(x)]
    out, i = [], 0
    while i < len(groups):
        ends = range(i + 1, min(i + GROUPS, len(groups)) + 1)
        for j in reversed(ends) if KINDS[kind] == "card" else ends:
            lo, hi = groups[i][0], groups[j - 1][1]
            hi = lo + len(x[lo:hi].rstrip(b"().-"))
            if hi - lo < len(x) and _accepted(kind, x[lo:hi]):
                out.append((lo, hi))
                i = j
                break
        else:
            i += 1
    return out


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long"


def _found(weights: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(weights)
        for batch in slices(batches, "text"):
            texts, data = buffers(batch.column("text"))
            head = (data & 0xC0) != 0x80
            char = np.concatenate([[0], np.cumsum(head)])  # byte offset -> character
            first = char[texts]
            place = np.append(np.flatnonzero(head), len(data))  # character -> byte offset
            base = base_spans(data, texts)
            taken = np.zeros(len(data) + 1, dtype=bool)
            rows: list[list[tuple[int, int, int, bool]]] = [[] for _ in range(batch.num_rows)]
            for k, a, b in base:
                taken[a:b] = True
                d = int(np.searchsorted(texts, a, side="right")) - 1
                rows[d].append((k, int(char[a] - first[d]), int(char[b] - first[d]), True))
            lead = data[place[:-1]]
            tags = model_tags(tagger, lead, first)
            raw = data.tobytes()
            for k, a, b in model_spans(tags, first, lead):
                lo, hi = int(place[a]), int(place[b])
                while lo < hi and raw[lo] in b" .,;:-\n":
                    lo += 1
                while hi > lo and raw[hi - 1] in b" .,;:-(+\n":
                    hi -= 1
                beside = (lo and raw[lo - 1 : lo].isalnum()) or raw[hi : hi + 1].isalnum()
                for x, y in items(k, raw[lo:hi]) if hi > lo and not beside else []:
                    x, y = lo + x, lo + y
                    if not taken[x:y].any():
                        d = int(np.searchsorted(texts, x, side="right")) - 1
                        rows[d].append((k, int(char[x] - first[d]), int(char[y] - first[d]), False))
                        taken[x:y] = True
            told = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in sorted(spans))
            own = [[x for x in spans if x[3]] for spans in rows]
            counts = [[sum(x[0] == k for x in spans) for spans in own] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(told(x).encode()).hexdigest() for x in own], pa.string()),
                    pa.array([told(x) for x in rows], pa.string()),
                    pa.array([len(x) - len(y) for x, y in zip(rows, own)], pa.int64()),
                ],
                [x.split()[0] for x in RESULT.split(", ")],
            )

    return run


def personal_data(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Counts of base spans, their digest, and all spans (``kind:start:end``) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tagger = tagger or train(contexts_of(rows))
    return rows.mapInArrow(_found(tagger.p), RESULT)
