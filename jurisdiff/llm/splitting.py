"""Oversized documents cut into pieces under a token limit, at natural boundaries.

The fewest pieces that can do are planned with equal-length targets; each
target moves to the strongest boundary near it, and if the limit fails for any
piece, one more piece is planned. Documents are independent: nothing shuffles.

All cuts at boundaries fall between units that the tokenizer keeps apart, so a
piece has as many tokens as it has in the whole document, which is encoded
once. Pieces with a cut where there is no boundary are encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.llm.tokens import DEFAULT_TOKENIZER, clean, count, encoding, token_bytes

LIMIT = 512
OVERLAP = 32
#: How far a cut may move from its target, as a share of the limit.
REACH = 0.2

# Strongest first. A cut falls before the blanks, or between a mark and the letter behind it.
_BOUNDARIES = (
    re.compile(r"(?<=\S)(?=[^\S\n]*\n[^\S\n]*\n)"),  # a blank line
    re.compile(r"(?<=\S)(?=[^\S\n]*\n)"),  # a line end
    re.compile(r"(?<=[.!?…])(?=\s)|(?<=[.!?…][\"'”’»)\]])(?=\s)|(?<=[。！？｡])(?=[^\W_]|\s)|(?<=[。！？][」』）])(?=[^\W_]|\s)"),  # a sentence
    re.compile(r"(?<=[,;:])(?=\s)|(?<=[、，；：])(?=[^\W_]|\s)"),  # a clause
    re.compile(r"(?<=\S)(?=\s)"),  # a word
)
STRENGTHS = ("blank line", "line", "sentence", "clause", "word", "none")


class _Document:
    """A text with its tokens: token number of each place where one begins, and back."""

    def __init__(self, text: str, path: str):
        self.text, self.path = text, path
        ids = np.array(encoding(path).encode_ordinary(text), dtype=np.int64)
        self.n = len(ids)
        ends = np.cumsum(token_bytes(path)[ids]) if self.n else np.zeros(0, np.int64)
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        chars = np.cumsum((data & 0xC0) != 0x80)
        whole = np.ones(self.n, bool)  # does the token end where a character ends?
        if self.n:
            whole[:-1] = (data[ends[:-1]] & 0xC0) != 0x80
        self.char = np.r_[0, chars[ends - 1]] if self.n else np.zeros(1, np.int64)
        self.whole = np.r_[True, whole]

    def token(self, char: int) -> int | None:
        """The number of tokens before a place, or None inside a token."""
        k = int(np.searchsorted(self.char, char))
        while k <= self.n and self.char[k] == char:
            if self.whole[k]:
                return k
            k += 1
        return None

    def near(self, target: int, lo: int, hi: int) -> tuple[int, int] | None:
        """(token, strength) of the strongest boundary in lo..hi, the nearest to the target of these."""
        a, b = int(self.char[lo]), int(self.char[hi])
        at = int(self.char[target])
        for strength, pattern in enumerate(_BOUNDARIES):
            best = None
            for m in pattern.finditer(self.text, max(a - 2, 0), min(b + 2, len(self.text))):
                c = m.start()
                if a <= c <= b and (best is None or abs(c - at) < abs(best[0] - at)):
                    k = self.token(c)
                    if k is not None and lo <= k <= hi:
                        best = (c, k)
            if best:
                return best[1], strength
        return None

    def hard(self, k: int, lo: int) -> int:
        """The last token end at or before k that ends a character."""
        while k > lo and not self.whole[k]:
            k -= 1
        return k

    def after(self, k: int) -> int:
        """The first token end behind k that ends a character."""
        k += 1
        while k < self.n and not self.whole[k]:
            k += 1
        return k

    def start(self, end: int, overlap: int, lo: int) -> tuple[int, bool]:
        """(token where a piece begins whose predecessor ends at end, is it a boundary): at least the overlap back, to a word's beginning if one is near."""
        if not overlap:
            return end, True
        k = max(end - overlap, lo)
        floor = max(k - max(overlap // 2, 8), lo)
        a, c = int(self.char[floor]), int(self.char[k])
        best = None
        for m in _BOUNDARIES[-1].finditer(self.text, max(a - 1, 0), min(c + 2, len(self.text))):
            if a <= m.start() <= c and self.token(m.start()) is not None:
                best = m.start()
        for m in _BOUNDARIES[2].finditer(self.text, max(a - 2, 0), min(c + 2, len(self.text))):
            if a <= m.start() <= c and self.token(m.start()) is not None:
                best = max(best or 0, m.start())
        if best is not None:
            return self.token(best), True
        return self.hard(k, lo), False


def split(text: str, limit: int, overlap: int, path: str) -> list[tuple[int, int, int, int]]:
    """(start, end, tokens, strength of the boundary at the end) of each piece, in code points; one piece if the text fits.

    The pieces cover the text; neighbours share at least ``overlap`` tokens
    (fewer only where the first of the two is shorter). No piece has more than
    ``limit`` tokens, unless one character alone has.
    """
    if not 0 <= overlap * 2 < limit:
        raise ValueError("the overlap must be less than half of the limit")
    doc = _Document(text, path)
    if doc.n <= limit:
        return [(0, len(text), doc.n, len(STRENGTHS) - 1)]
    k = -(-(doc.n - overlap) // (limit - overlap))
    while True:
        pieces = _plan(doc, k, limit, overlap)
        if pieces is not None:
            return pieces
        k += 1 + k // 32


def _plan(doc: _Document, k: int, limit: int, overlap: int) -> list[tuple[int, int, int, int]] | None:
    """k pieces, or None if any is over the limit. With as many pieces as half limits fit, a piece is cut shorter instead."""
    reach = max(1, int(limit * REACH))
    patient = k * (limit - overlap) < 2 * doc.n
    out = []
    start, clean_start, end = 0, True, 0
    j = 0
    while True:
        j += 1
        room = min(start + limit, doc.n)
        least = doc.after(end)  # a piece reaches beyond the one before
        target = max(min(max(overlap + round(j * (doc.n - overlap) / k), least), room), least)
        if doc.n - start <= limit and (j >= k or target + reach >= doc.n):
            end, strength = doc.n, len(STRENGTHS) - 1
        elif j >= k and patient:
            return None
        else:
            lo = max(target - reach, least)
            hit = doc.near(target, lo, max(lo, min(target + reach, room)))
            if hit and hit[0] < doc.n:
                end, strength = hit
            else:
                end, strength = doc.hard(target, least), len(STRENGTHS) - 1
        whole = clean_start and (strength < len(STRENGTHS) - 1 or end == doc.n)
        a, b = int(doc.char[start]), int(doc.char[end])
        tokens = end - start if whole else count(doc.text[a:b], doc.path)
        while tokens > limit:
            if patient:
                return None
            if end <= least or b - a <= 1:
                break
            end = doc.hard(max(end - max(1, tokens - limit), least), least)
            b, strength = int(doc.char[end]), len(STRENGTHS) - 1
            tokens = count(doc.text[a:b], doc.path)
        out.append((a, b, tokens, strength))
        if end >= doc.n:
            return out
        nxt, clean_start = doc.start(end, overlap, doc.after(start))
        if overlap == 0:
            clean_start = strength < len(STRENGTHS) - 1
        start = nxt


def split_documents(df: DataFrame, doc_id: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Pieces of the documents above the limit: doc_id, piece_no (from 0), start, end (code points), n_tokens, boundary, piece.

    Documents within the limit, null and empty ones give no rows; repeated
    documents each give theirs. ``boundary`` names what the piece ends at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for d, s in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                if not isinstance(s, str) or len(s) * 4 <= limit:  # a token has a byte at least
                    continue
                s = clean(s)
                pieces = split(s, limit, overlap, tokenizer)
                if len(pieces) > 1:
                    out += [(d, i, a, b, n, STRENGTHS[k], s[a:b]) for i, (a, b, n, k) in enumerate(pieces)]
            yield pd.DataFrame(out, columns=["doc_id", "piece_no", "start", "end", "n_tokens", "boundary", "piece"])

    kind = df.select(doc_id).schema[0].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, f"doc_id {kind}, piece_no int, start int, end int, n_tokens int, boundary string, piece string")
