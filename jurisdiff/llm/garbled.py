"""Text decoded with the wrong character encoding: find it, restore it.

Adjacent character pairs are scored by their mutual information over the whole
corpus. Pairs the corpus doesn't bear out weigh against a text; maximum-scoring
segments of those weights are its improbable runs. Only inside such runs are
inverse mappings tried (encode with the wrong reader, decode with the right
one), and one is taken if the run becomes probable by it. Characters that only
a failed decoding leaves behind mark a run as damaged even if nothing restores
it.

The pair table sent to the executors holds pairs of at least ``PAIR_SHARE`` of
all pairs, so it has at most 1 / PAIR_SHARE rows however large the corpus is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.session import materialize

PAIR_SHARE = 2e-6
#: Pairs counted fewer than this share of all pairs have their information discounted towards none.
SHRINK_SHARE = 2e-5
#: Pairs of less information than this weigh for, others against an improbable run.
TAU = 0.5
MIN_RUN_WEIGHT = 8.0
MIN_GAIN = 2.0
#: A restored run scores more than this.
MIN_PROBABLE = -0.5
#: The same for runs of rare characters, and the gain of short runs.
MIN_GAIN_RARE, MIN_PROBABLE_RARE, MIN_GAIN_SHORT = 2.5, -1.5, 3.0
UNSEEN = -4.0

#: Left by a failed decoding only: C1 controls but the next-line mark, private use, the replacement character.
RESIDUE = re.compile("[\x80-\x84\x86-\x9f-�]")
_HALF_KANA = re.compile("[｡-ﾟ]")
_NON_ASCII = re.compile(r"[^\x00-\x7f]")

# Single-byte readers: byte -> the characters it was read as.
_READERS = {"western": ("cp1252", "latin-1"), "mac": ("mac_roman",), "cyrillic": ("cp1251",)}
# (wrong reader, right reader), in the order they are tried.
MAPPINGS = (
    ("western", "utf-8"), ("mac", "utf-8"), ("cyrillic", "utf-8"), ("cp932", "utf-8"), ("gb18030", "utf-8"),
    ("western", "cp932"), ("cp932", "euc_jp"), ("gb18030", "cp932"), ("western", "euc_jp"), ("mac", "cp932"), ("gb18030", "euc_jp"),
)


@lru_cache(None)
def _byte_of(reader: str) -> dict[str, int]:
    """Character -> byte of a single-byte reader; bytes the code page leaves free are read as C1 controls."""
    m: dict[str, int] = {}
    for code in reversed(_READERS[reader]):
        for b in range(128, 256):
            try:
                m[bytes([b]).decode(code)] = b
            except UnicodeDecodeError:
                m.setdefault(chr(b), b)
    return m


@lru_cache(None)
def _utf8_as(reader: str) -> re.Pattern:
    """Lead byte and continuation bytes of UTF-8 as a single-byte reader shows them."""
    inv: dict[int, str] = {}
    for c, b in _byte_of(reader).items():
        inv[b] = inv.get(b, "") + c
    cls = lambda lo, hi: "[" + re.escape("".join(inv.get(b, "") for b in range(lo, hi + 1))) + "]"
    # Lead bytes of both lengths come first, in one class, which is searched for by table.
    return re.compile(f"{cls(0xC2, 0xEF)}(?:(?<={cls(0xC2, 0xDF)}){cls(0x80, 0xBF)}|(?<={cls(0xE0, 0xEF)}){cls(0x80, 0xBF)}{{2}})")


def trusted(s: str) -> bool:
    """Is the text free of the plain marks of a wrong decoding, so that it may speak for the corpus?"""
    if s.isascii():
        return True
    if RESIDUE.search(s) or _HALF_KANA.search(s) or _utf8_as("western").search(s):
        return False
    return all(len(_utf8_as(r).findall(s)) < 2 for r in ("mac", "cyrillic"))


def code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters with a zero before, between and after the strings; the place of each string's first."""
    joined = "\0" + "\0".join(strings) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    lens = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    return cp, np.r_[1, 1 + np.cumsum(lens + 1)[:-1]] if len(strings) else np.zeros(0, np.int64)


def pair_counts(texts: DataFrame) -> DataFrame:
    """pair (two code points in one number), n: adjacent pairs over all trusted texts, ends of text as 0. texts: one string column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            strings = [s for s in pdf.iloc[:, 0].tolist() if isinstance(s, str) and s and trusted(s)]
            cp, _ = code_points(strings)
            pair, n = np.unique(cp[:-1] << 21 | cp[1:], return_counts=True)
            yield pd.DataFrame({"pair": pair, "n": n})

    return texts.mapInPandas(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


class PairModel:
    """Discounted mutual information of adjacent characters."""

    def __init__(self, pair: np.ndarray, n: np.ndarray, total: int):
        order = np.argsort(pair)
        self.pair, n = np.asarray(pair, dtype=np.int64)[order], np.asarray(n, dtype=np.float64)[order]
        a, b = self.pair >> 21, self.pair & 0x1FFFFF
        size = int(max(a.max(initial=0), b.max(initial=0))) + 1
        self.left, self.right = np.bincount(a, n, size), np.bincount(b, n, size)
        k = max(1.0, SHRINK_SHARE * total)
        pmi = np.log(n * max(total, 1) / np.maximum(self.left[a] * self.right[b], 1))
        low = np.minimum(self.left[a], self.right[b])
        discount = n / (n + k) * low / (low + k)
        self.value = np.where(pmi > 0, pmi * discount, pmi) - 2.0 * k / (n + k)
        self._known: dict[str, float] | None = None

    @classmethod
    def fit(cls, texts: DataFrame) -> "PairModel":
        counts = materialize(pair_counts(texts), "pairs")
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        kept = counts.where(F.col("n") >= math.floor(PAIR_SHARE * total)).toPandas()  # at most 1 / PAIR_SHARE rows
        return cls(kept["pair"].to_numpy(np.int64), kept["n"].to_numpy(np.int64), int(total))

    def of(self, cp: np.ndarray) -> np.ndarray:
        """Score of each adjacent pair."""
        key = cp[:-1] << 21 | cp[1:]
        if not len(self.pair):
            return np.full(len(key), UNSEEN)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.value[at], UNSEEN)

    def text(self, s: str) -> float:
        """Mean score of the pairs inside s."""
        if len(s) < 2:
            return UNSEEN
        if self._known is None:
            self._known = {chr(p >> 21) + chr(p & 0x1FFFFF): v for p, v in zip(self.pair.tolist(), self.value.tolist())}
        known = self._known.get
        return sum(known(a + b, UNSEEN) for a, b in zip(s, s[1:])) / (len(s) - 1)


def maximal_segments(w: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, weight) of a sequence, in linear time (Ruzzo and Tompa)."""
    out: list[list[float]] = []  # start, end, sum before, sum after
    total = 0.0
    for i, x in enumerate(w):
        before, total = total, total + x
        if x <= 0:
            continue
        cur = [i, i + 1, before, total]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= cur[2]:
                j -= 1
            if j < 0 or out[j][3] >= cur[3]:
                out.append(cur)
                break
            cur = [out[j][0], cur[1], out[j][2], cur[3]]
            del out[j:]
    return [(int(a), int(b), hi - lo) for a, b, lo, hi in out]


def _to_bytes(s: str, reader: str) -> list[bytes | None]:
    """The byte or bytes behind each character; None if the reader can't have shown it."""
    if reader in _READERS:
        m = _byte_of(reader)
        return [bytes([ord(c)]) if c < "\x80" else bytes([m[c]]) if c in m else None for c in s]
    out: list[bytes | None] = []
    for c in s:
        try:
            out.append(c.encode(reader))
        except UnicodeEncodeError:
            out.append(bytes([ord(c)]) if "\x80" <= c <= "\xff" else None)
    return out


# Runs of well-formed bytes of each right encoding. UTF-8 never hides ASCII, so its runs hold none and stay short.
_FORMED = {
    "utf-8": re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+"),
    "utf-8 in pairs": re.compile(rb"(?:(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})[\x30-\x7e]?)+"),  # two-byte readers swallow an ASCII letter
    "cp932": re.compile(rb"(?:[\x00-\x7f\xa1-\xdf]|[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc])+"),
    "euc_jp": re.compile(rb"(?:[\x00-\x7f]|[\xa1-\xfe]{2}|\x8e[\xa1-\xdf]|\x8f[\xa1-\xfe]{2})+"),
}


def _decoded_prefix(data: bytes, right: str) -> str:
    """The longest part of data from its start that decodes without loss."""
    try:
        text = data.decode(right)
    except UnicodeDecodeError as e:
        text = data[: e.start].decode(right)
    bad = None if right == "utf-8" else RESIDUE.search(text)
    return text[: bad.start()] if bad else text


def _stretches(s: str, lo: int, hi: int, reader: str, right: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, decoded) for each longest stretch of s[lo:hi] that the mapping turns back without loss and that changes by it."""
    parts = _to_bytes(s[lo:hi], reader)
    i, n = 0, hi - lo
    while i < n:
        if parts[i] is None:
            i += 1
            continue
        j = i
        while j < n and parts[j] is not None:
            j += 1
        owner = [k for k in range(i, j) for _ in parts[k]]
        data = b"".join(parts[i:j])
        for m in _FORMED["utf-8 in pairs" if right == "utf-8" and reader not in _READERS else right].finditer(data):
            a = m.start()
            while a < m.end():
                if a and owner[a] == owner[a - 1]:  # inside a character
                    a += 1
                    continue
                text = _decoded_prefix(data[a : m.end()], right)
                b = a + len(text.encode(right))
                while text and b < len(data) and owner[b] == owner[b - 1]:  # back to a whole character
                    text = text[:-1]
                    b = a + len(text.encode(right))
                if text:
                    x, y = lo + owner[a], lo + owner[b - 1] + 1
                    if text != s[x:y]:
                        yield x, y, text
                a = max(b, a + 1)
        i = j


def _core(s: str, x: int, y: int, decoded: str) -> tuple[int, int, str]:
    """The stretch without the ASCII at its ends, which no mapping changes."""
    while x < y and decoded and s[x] == decoded[0] and s[x] < "\x80":
        x, decoded = x + 1, decoded[1:]
    while x < y and decoded and s[y - 1] == decoded[-1] and s[y - 1] < "\x80":
        y, decoded = y - 1, decoded[:-1]
    return x, y, decoded


_WESTERN = "[" + re.escape("".join(_byte_of("western"))) + "]"
_WESTERN_RUN = re.compile(f"{_WESTERN}{{3}}|{_WESTERN}.{_WESTERN}")
_IDEOGRAPHS = re.compile("[\u3100-\u9fff]{2}")

# Neighbours of a run that are themselves parts of a damaged character as a rule.
_ENDS = set("".join(_byte_of("western"))) - set("ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ’“”–—")


def _again(decoded: str, reader: str) -> str:
    """Text that went through the same misreading twice is turned back a second time."""
    if reader not in _READERS or not _utf8_as(reader).search(decoded):
        return decoded
    m = _byte_of(reader)
    try:
        data = bytes(ord(c) if c < "\x80" else m[c] for c in decoded)
        return data.decode("utf-8")
    except KeyError:
        return decoded
    except UnicodeDecodeError as e:  # a byte a character, so the place in the bytes is the place in the text
        return data[: e.start].decode("utf-8") + decoded[e.start :]


def _shows(s: str, reader: str, right: str) -> bool:
    """Cheap test: can s hold text of the right encoding as the wrong reader shows it?"""
    if reader in _READERS:
        return bool((_utf8_as(reader) if right == "utf-8" else _WESTERN_RUN).search(s))
    if right == "euc_jp" and reader == "cp932":
        return bool(_HALF_KANA.search(s))
    if reader == "cp932":
        return bool(_HALF_KANA.search(s) or _IDEOGRAPHS.search(s))
    return bool(_IDEOGRAPHS.search(s)) or right == "utf-8"


def _convincing(gain: float, new: float, right: str, length: int) -> bool:
    """Does a mapping make a run probable? UTF-8 proves itself by its form as well; in other encodings a short run has to gain more."""
    if right == "utf-8":
        return gain >= MIN_GAIN and new > MIN_PROBABLE or gain >= MIN_GAIN_RARE and new > MIN_PROBABLE_RARE
    return gain >= MIN_GAIN and new > MIN_PROBABLE if length >= 3 else gain >= MIN_GAIN_SHORT and new > 0


def restore(s: str, model: PairModel) -> tuple[str, list[tuple[int, int]], bool]:
    """(text with every restorable run restored, the damaged runs of s, is any of them left unrestored).

    A run is taken to be damaged if one mapping makes it probable; further runs
    of the text that the same mapping improves go with it.
    """
    cp = np.r_[0, np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64), 0]
    score = model.of(cp)  # score[i]: the pair of characters i - 1 and i
    segs = [(max(0, a - 1), min(len(s), b), w) for a, b, w in maximal_segments((TAU - score).tolist()) if w >= MIN_RUN_WEIGHT]
    merged: list[list[int]] = []
    for a, b, _ in segs:
        if not _NON_ASCII.search(s[a:b]):
            continue
        a, b = max(0, a - 4), min(len(s), b + 4)
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    edits: list[tuple[int, int, str]] = []
    best: list[tuple[float, int, int, str]] = []
    for reader, right in MAPPINGS:
        found: list[tuple[float, float, int, int, str]] = []
        for a, b in merged:
            if not _shows(s[a:b], reader, right):
                continue
            for x, y, decoded in _stretches(s, a, b, reader, right):
                x, y, decoded = _core(s, x, y, _again(decoded, reader) if right == "utf-8" else decoded)
                if not decoded or len(RESIDUE.findall(decoded)) > len(decoded) // 4:
                    continue
                pre, post = s[x - 1 : x] if x else "\0", s[y : y + 1] or "\0"
                pre = "" if RESIDUE.match(pre) or pre in _ENDS else pre
                post = "" if RESIDUE.match(post) or post in _ENDS else post
                if len(pre + decoded + post) < 2:
                    continue
                new = model.text(pre + decoded + post)
                found.append((new - model.text(pre + s[x:y] + post), new, x, y, decoded))
        if any(_convincing(gain, new, right, len(d)) for gain, new, _, _, d in found):
            best += [(gain * (y - x), x, y, decoded) for gain, new, x, y, decoded in found if gain > 0]
    best.sort(key=lambda t: -t[0])
    for _, x, y, decoded in best:
        if all(y <= p or q <= x for p, q, _ in edits):
            edits.append((x, y, decoded))
    edits.sort()
    spans = [(x, y) for x, y, _ in edits]
    left = [(m.start(), m.end()) for m in RESIDUE.finditer(s) if not any(x <= m.start() < y for x, y in spans)]
    out, at = [], 0
    for x, y, decoded in edits:
        out += [s[at:x], decoded]
        at = y
    return "".join([*out, s[at:]]), sorted(spans + left), bool(left)


def suspects(strings: list[str], model: PairModel) -> np.ndarray:
    """Of all strings at once: can the text hold an improbable run with characters beyond ASCII?"""
    if not strings:
        return np.zeros(0, bool)
    cp, at = code_points(strings)
    s = model.of(cp)
    beyond = (cp[:-1] > 127) | (cp[1:] > 127)
    weight = np.where(beyond, np.maximum(TAU - s, 0), 0)
    return np.add.reduceat(weight, at - 1) >= MIN_RUN_WEIGHT


def find_garbled(df: DataFrame, key: str, fields: dict[str, str], model: PairModel) -> DataFrame:
    """One row per damaged text: key, field, garbled, restored (runs beyond repair stay as they are), whole (all of it restored).

    fields: name -> column expression. Null and empty texts, and rows without
    damage, give none; repeated rows each give theirs.
    """
    names = list(fields)
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most 1 / PAIR_SHARE pairs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            out = []
            keys = pdf["key"].tolist()
            for i, name in enumerate(names):
                texts = [s if isinstance(s, str) else "" for s in pdf[f"f{i}"].tolist()]
                hit = suspects(texts, m)
                for k in np.flatnonzero(hit):
                    s = texts[k]
                    if s.isascii():
                        continue
                    fixed, spans, left = restore(s, m)
                    if spans:
                        out.append((keys[k], name, s, fixed, not left))
            yield pd.DataFrame(out, columns=["key", "field", "garbled", "restored", "whole"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(F.col(key).alias("key"), *[F.expr(x).alias(f"f{i}") for i, x in enumerate(fields.values())]).mapInPandas(run, f"key {kind}, field string, garbled string, restored string, whole boolean")
