"""Token counts under a unigram vocabulary by dynamic programming over a trie of words.

A text's white-space words, each with the vocabulary's word-start mark before it, are
segmented into pieces so that the sum of piece scores is largest (Viterbi); the count
of a text is the sum over its words.  Distinct words are put in a trie; the best score
and count of a prefix depend on the prefix alone, so they are computed once for each
trie node, level by level, and a word's count is stored where it ends.

The vocabulary is a public one, read from a file; its pieces come ranked by frequency,
and a piece of rank ``r`` scores ``-ln(r + 1)`` (Zipf's law).  A byte that no piece
covers is a byte token, which scores ``BYTE_SCORE`` below the last piece.  Ties go to
the longer last piece.

Words and counts stay in the task that meets them: no shuffle, and a task keeps at most
``CACHE_WORDS`` counts, dropping them all when full, so memory is bounded and results
do not depend on it.  What tasks are sent is the vocabulary, of fixed size.

Defined results: null and empty texts and texts of white space have 0 words and 0
tokens; words over ``LONG`` bytes or with a NUL are segmented one by one by the same
rule; repeated rows each get their count; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.text import U64, Hasher, mix, slices, split_words

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_START = "▁".encode()
BYTE_SCORE = 10.0
#: Longest word, in bytes, that goes into the trie.
LONG = 64
CACHE_WORDS = 1 << 20
#: Words put into one trie.
TRIE_WORDS = 1 << 15

_BASE = U64(0x9E3779B97F4A7C15)


def load_pieces(path: str = VOCABULARY) -> dict[bytes, float]:
    """Piece -> score of a sentence-piece model's ordinary pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i).encode(): -math.log(rank + 2) for rank, i in enumerate(plain)}


class Vocabulary:
    """Pieces as sorted hashes, by which a trie level looks up all its substrings at once."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = pieces
        self.byte = min(pieces.values()) - BYTE_SCORE
        self.lengths = sorted({len(p) for p in pieces})
        keys = np.array([self.hash(p) for p in pieces], dtype=U64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(list(pieces.values()))[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(mix(self.keys) >> U64(44)).astype(np.int64)] = True

    @staticmethod
    def hash(piece: bytes) -> int:
        out = 0
        for b in piece:
            out = (out * int(_BASE) + b + 1) % (1 << 64)
        return out

    def score(self, keys: np.ndarray) -> np.ndarray:
        """Scores of pieces by hash; minus infinity where there is none."""
        out = np.full(len(keys), -np.inf)
        some = np.flatnonzero(self.maybe[(mix(keys) >> U64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        hit = self.keys[at] == keys[some]
        out[some[hit]] = self.scores[at[hit]]
        return out


def viterbi(word: bytes, vocabulary: Vocabulary) -> int:
    """Tokens of the best segmentation of one word."""
    best, count = [0.0], [0]
    longest = vocabulary.lengths[-1]
    for d in range(1, len(word) + 1):
        score, n = best[d - 1] + vocabulary.byte, count[d - 1] + 1
        for size in range(1, min(longest, d) + 1):
            s = vocabulary.pieces.get(word[d - size : d])
            if s is not None and best[d - size] + s >= score:
                score, n = best[d - size] + s, count[d - size] + 1
        best.append(score)
        count.append(n)
    return count[-1]


def trie_counts(words: np.ndarray, size: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each of ``words`` (rows of bytes, zero-padded, sorted, distinct)."""
    n, width = words.shape
    node = [np.zeros(n, dtype=np.int64)]  # trie node of each word at each depth
    best, count = [np.zeros(1)], [np.zeros(1, dtype=np.int64)]
    hashes = np.zeros((width + 1, n), dtype=U64)
    power = np.full(width + 1, _BASE, dtype=U64)
    power[0] = 1
    power = np.cumprod(power, dtype=U64)
    differs = np.zeros(n, dtype=bool)
    differs[0] = True
    out = np.zeros(n, dtype=np.int64)
    for d in range(1, width + 1):
        differs[1:] |= words[1:, d - 1] != words[:-1, d - 1]
        hashes[d] = hashes[d - 1] * _BASE + words[:, d - 1] + U64(1)
        lead = np.flatnonzero(differs)  # the first word below each node
        node.append(np.cumsum(differs) - 1)
        deep = np.flatnonzero(size[lead] >= d)
        own = lead[deep]
        value = np.full(len(lead), -np.inf)
        tokens = np.zeros(len(lead), dtype=np.int64)
        back = node[d - 1][own]
        high, few = best[d - 1][back] + vocabulary.byte, count[d - 1][back] + 1
        for m in vocabulary.lengths:
            if m > d:
                break
            score = vocabulary.score(hashes[d][own] - hashes[d - m][own] * power[m])
            back = node[d - m][own]
            total = best[d - m][back] + score
            better = total >= high
            better &= np.isfinite(score)
            high = np.where(better, total, high)
            few = np.where(better, count[d - m][back] + 1, few)
        value[deep], tokens[deep] = high, few
        best.append(value)
        count.append(tokens)
        ends = np.flatnonzero(size == d)
        out[ends] = tokens[node[d][ends]]
    return out


class Counter:
    """Token counts of words by hash, kept for a task."""

    def __init__(self, vocabulary: Vocabulary, most: int = CACHE_WORDS):
        self.vocabulary, self.most = vocabulary, most
        self.keys, self.counts = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)

    def count(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each word; ``h`` are the words' hashes."""
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        counts = np.zeros(len(keys), dtype=np.int64)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            counts[new] = self._counted(data, start[first[new]], end[first[new]])
            if len(self.keys) + len(new) > self.most:
                self.keys, self.counts = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys, self.counts = merged[order], np.concatenate([self.counts, counts[new]])[order]
        return counts[back]

    def _counted(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), dtype=np.int64)
        size = end - start
        nul = np.concatenate([[0], np.cumsum(data == 0)])
        short = (size <= LONG) & (nul[end] == nul[start])
        for i in np.flatnonzero(~short):
            out[i] = viterbi(WORD_START + data[start[i] : end[i]].tobytes(), self.vocabulary)
        some = np.flatnonzero(short)
        for lo in range(0, len(some), TRIE_WORDS):
            own = some[lo : lo + TRIE_WORDS]
            width = int(size[own].max())
            col = np.arange(width)
            rows = np.where(col < size[own, None], data[np.minimum(start[own, None] + col, len(data) - 1)], 0).astype(np.uint8)
            order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
            mark = np.repeat(np.frombuffer(WORD_START, np.uint8)[None, :], len(own), axis=0)
            words = np.concatenate([mark, rows[order]], axis=1)
            out[own[order]] = trie_counts(words, size[own[order]] + len(WORD_START), self.vocabulary)
        return out


def _tokens(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counter = Hasher(), Counter(vocabulary)
        for batch in slices(batches, "text"):
            w = split_words(batch.column("text"))
            h = hasher.words(w.data, w.start, w.end)
            tokens = counter.count(h, w.data, w.start, w.end)
            total = np.concatenate([[0], np.cumsum(tokens)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(w.n.astype(np.int64)),
                    pa.array(total[w.first[1:]] - total[w.first[:-1]]),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, pieces: dict[bytes, float] | None = None, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row of ``docs(doc_id, text)``."""
    vocabulary = Vocabulary(load_pieces(path) if pieces is None else pieces)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tokens(vocabulary), "doc_id long, n_words long, n_tokens long")
