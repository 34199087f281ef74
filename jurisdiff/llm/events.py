"""Reading labels and titles of events as bags of words of one language.

A row tells its event twice, in a label and in a title, which may be written in
another language and another order. Both fields are cut into units: words, and
runs of Han and Katakana where there are no blanks; Hiragana only connects. How
often a unit of the titles and a word of the labels stand in one row, counted
over all rows, tells three things without any form of wording being given:

- what a unit means: the words that most rows with it hold, and much more often
  than other rows do;
- which words and units tell nothing, because they go with no unit of the other
  field: connecting words and decoration;
- which rare words are slips: they go with a unit that means a similar word.

An event is then the bag of the words its label tells, in which unknown words
are settled by the row's own title, or the words its title means.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.llm.garbled import RESIDUE, PairModel, restore, suspects, trusted
from jurisdiff.llm.lookalike import canonical
from jurisdiff.session import materialize

#: A word or unit is judged from this many rows on.
MIN_ROWS = 3
#: Meanings are sent to the executors for units of at least this share of the rows; rarer ones stand for themselves.
MIN_SHARE = 1e-4
#: A unit means the words that this share of its rows hold,
MIN_CHANCE = 0.5
#: and that are so many times more frequent there than in all rows.
MIN_LIFT = 1.5
#: Rows whose pairs are counted at once. Of such a part only pairs of half the chance asked for are passed on: what holds over all rows holds in some part.
PART_ROWS = 50_000

# The reference number of a document, with the word before it.
_NUMBER = re.compile(r"[(\[]?\s*\b([a-z]{2,6})\.?\s*(\d{1,7})\s*[/\-–]\s*(\d{2})(?!\d)\s*[)\]]?")
_UNIT = re.compile("[ァ-ヺー㐀-鿿々〆]+|[^\\W_々-ヿ㐀-鿿]+")
#: Latin letters with marks -> the letter; kana keep theirs, which make other syllables.
_PLAIN_LATIN = {c: b[0] for c in range(0xC0, 0x250) if (b := unicodedata.normalize("NFD", chr(c))) and len(b) > 1} | {0xF8: "o", 0x142: "l", 0x111: "d", 0x131: "i"}
_MARKED_LATIN = re.compile(f"[{''.join(map(chr, _PLAIN_LATIN))}]")


def _plain(m: re.Match) -> str:
    return _PLAIN_LATIN[ord(m[0])]


def folded(s: str | None) -> str:
    """The text as compared: canonical form without letter case and accents of Latin letters; null is empty."""
    if not s:
        return ""
    s = canonical(s).casefold()
    return s if s.isascii() else _MARKED_LATIN.sub(_plain, s)  # most texts have none, and a search is much faster than a look at every character


def split_number(s: str) -> tuple[str, str]:
    """(text without its reference number, number as digits/year or empty). The last number counts."""
    found = None
    if "/" not in s and "-" not in s and "–" not in s:
        return s, ""
    for found in _NUMBER.finditer(s):
        pass
    if found is None:
        return s, ""
    return (s[: found.start()].rstrip() + " " + s[found.end() :].lstrip()).strip(), f"{int(found[2])}/{found[3]}"


def units_of(text: str) -> tuple[list[str], str]:
    """(units of a folded text in their order, its reference number)."""
    text, number = split_number(text)
    return _UNIT.findall(text), number


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment), most + 1 if greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, prev = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            cur.append(d)
        if min(cur) > most:
            return most + 1
        before, prev = prev, cur
    return prev[-1]


def _similar(a: str, b: str) -> bool:
    """Can a be b with a slip or two of the pen?"""
    most = 2 if min(len(a), len(b)) > 5 else 1
    return edits(a, b, most) <= most


def _products(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of each row in two flat lists, given how many entries a row has in each."""
    first_b = np.cumsum(sizes_b) - sizes_b
    per_a = np.repeat(sizes_b, sizes_a)
    a = np.repeat(np.arange(sizes_a.sum()), per_a)
    start = np.cumsum(per_a) - per_a
    b = np.arange(per_a.sum()) - np.repeat(start, per_a) + np.repeat(np.repeat(first_b, sizes_a), per_a)
    return a, b


def _part_counts(rows: list[tuple[list[str], list[str]]]) -> pd.DataFrame:
    """unit, word, n of one part: alone (the other empty) and in pairs that are frequent enough for one of the two."""
    units: dict[str, int] = {}
    words: dict[str, int] = {}
    uu = [units.setdefault(x, len(units)) for u, _ in rows for x in u]
    ww = [words.setdefault(x, len(words)) for _, w in rows for x in w]
    un, wn = np.array([*units, ""], dtype=object), np.array([*words, ""], dtype=object)
    ua, wa = np.array(uu, np.int64), np.array(ww, np.int64)
    n_u, n_w = np.bincount(ua, minlength=len(units)), np.bincount(wa, minlength=len(words))
    a, b = _products(np.array([len(u) for u, _ in rows]), np.array([len(w) for _, w in rows]))
    pair, n = np.unique(ua[a] << 32 | wa[b], return_counts=True)
    pu, pw = pair >> 32, pair & 0xFFFFFFFF
    kept = n >= MIN_CHANCE / 2 * np.minimum(n_u[pu], n_w[pw])
    return pd.DataFrame({
        "unit": np.concatenate([un[:-1], np.full(len(words), ""), un[pu[kept]]]), "word": np.concatenate([np.full(len(units), ""), wn[:-1], wn[pw[kept]]]), "n": np.concatenate([n_u, n_w, n[kept]]),
    })


def count_pairs(df: DataFrame) -> DataFrame:
    """unit, word, n over the rows with both fields, the title not plainly garbled; an empty word or unit: the rows of the other alone, both empty: all rows. df: label, title."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[list[str], list[str]]] = []

        def part() -> pd.DataFrame:
            out = pd.concat([_part_counts(rows), pd.DataFrame([("", "", len(rows))], columns=["unit", "word", "n"])])
            rows.clear()
            return out

        for pdf in batches:
            for label, title in zip(pdf["label"].tolist(), pdf["title"].tolist()):
                if trusted(title):
                    u, w = set(units_of(folded(title))[0]), set(units_of(folded(label))[0])
                    if u and w:
                        rows.append((sorted(u), sorted(w)))
            if len(rows) >= PART_ROWS:
                yield part()
        if rows:
            yield part()

    both = df.where("label is not null and title is not null").select("label", "title")
    return both.mapInPandas(run, "unit string, word string, n bigint").groupBy("unit", "word").agg(F.sum("n").alias("n"))


def learn_lexicon(df: DataFrame) -> "Lexicon":
    """Meanings of units, idle words and slips, from counts over all rows. df: label, title.

    Counts of further rows can be added to those of earlier ones; events that
    were read before stay valid, as they are made of words, not of numbers.
    """
    counts = materialize(count_pairs(df), "unit-pairs")
    rows = counts.where("unit = '' and word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(MIN_ROWS, rows * MIN_SHARE)
    alone = lambda mine, other: counts.where(f"{other} = '' and {mine} <> ''").select(mine, F.col("n").alias(f"n_{mine}"))
    # What is judged here and sent to the executors is bounded: a row has so many units, and each is in at least MIN_SHARE of the rows.
    units, words = alone("unit", "word").where(F.col("n_unit") >= least), alone("word", "unit").where(F.col("n_word") >= least)
    pairs = counts.where("unit <> '' and word <> ''").where(F.col("n") >= MIN_ROWS)
    known = pairs.join(alone("unit", "word"), "unit").join(alone("word", "unit"), "word").where((F.col("n_unit") >= least) | (F.col("n_word") >= least))
    known = known.where(F.col("n") * F.lit(rows) >= F.lit(MIN_LIFT) * F.col("n_unit") * F.col("n_word"))
    sure = F.col("n") - F.sqrt("n")  # less the chance error of a count
    strong = known.select("unit", "word", (sure >= MIN_CHANCE * F.col("n_unit")).alias("means"), (sure >= MIN_CHANCE * F.col("n_word")).alias("points")).where("means or points")
    return Lexicon(
        [tuple(r) for r in strong.orderBy("unit", "word").collect()],
        {r["unit"] for r in units.select("unit").collect()}, {r["word"] for r in words.select("word").collect()},
    )


class Lexicon:
    """What units mean, which words are slips of which, and which tell nothing."""

    def __init__(self, pairs: list[tuple[str, str, bool, bool]], units: set[str], words: set[str]):
        """pairs: unit, word, does the unit mean the word, does the word point to the unit; units and words: those frequent enough to be judged."""
        self.means: dict[str, list[str]] = {}
        for u, w, means, _ in pairs:
            if means:
                self.means.setdefault(u, []).append(w)
        for u in [u for u in self.means if u in words]:  # a word of both fields means itself or, if it doesn't, nothing
            if u in self.means[u]:
                self.means[u] = [u]
            else:
                del self.means[u]
        self.content = {w for ws in self.means.values() for w in ws}
        told = {w for _, w, _, points in pairs if points}
        self.slips: dict[str, str] = {}
        for u, w, means, points in pairs:
            if points and not means and w not in self.content:
                near = {c for c in self.means.get(u, ()) if _similar(w, c)}
                if len(near) == 1:
                    self.slips[w] = near.pop()
        self.idle = {w for w in words if w not in self.content and w not in told} | {u for u in units if u not in self.means and u not in self.content}
        self._near: dict[str, list[str]] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_near": None}

    def _corrected(self, word: str) -> str:
        """The one content word an unknown word can be a slip of; itself if there is none or more."""
        if word in self.slips:
            return self.slips[word]
        if len(word) < 5 or not word.isascii():
            return word
        if self._near is None:  # content words by what is left without one letter: words one slip apart share such a rest
            self._near = {}
            for c in self.content:
                if len(c) >= 4 and c.isascii():
                    for rest in {c, *(c[:k] + c[k + 1 :] for k in range(len(c)))}:
                        self._near.setdefault(rest, []).append(c)
        rests = {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}
        near = {c for rest in rests for c in self._near.get(rest, ()) if edits(word, c, 1) <= 1}
        if not near and len(word) > 6:
            twice = {r[:k] + r[k + 1 :] for r in rests for k in range(len(r))}
            near = {c for rest in twice | rests for c in self._near.get(rest, ()) if edits(word, c, 2) <= 2}
        return near.pop() if len(near) == 1 else word

    def _cut(self, run: str) -> list[str] | None:
        """A run of units without a connecting word between them, as the longest known units one after another."""
        out = []
        while run:
            n = next((n for n in range(len(run), 0, -1) if run[:n] in self.means or run[:n] in self.idle), 0)
            if not n:
                return None
            out.append(run[:n])
            run = run[n:]
        return out

    def _meant(self, unit: str) -> list[str]:
        if unit in self.means:
            return self.means[unit]
        if unit in self.idle or RESIDUE.search(unit):
            return []
        if unit >= "　" and (parts := self._cut(unit)) is not None:
            return [w for p in parts for w in self.means.get(p, ())]
        if unit in self.content:
            return [unit]
        return [self._corrected(unit)]

    def of_title(self, units: list[str]) -> list[str]:
        """The words a title means, as a bag: words of several units that mean the same count once a kind of unit."""
        out: list[str] = []
        for u in units:
            meant = self._meant(u)
            # Parts of one meaning (as a word with a connecting syllable inside) stand side by side.
            if out[len(out) - len(meant) :] != meant or len(meant) == 1 and meant[0] == u:
                out += meant
        return out

    def of_label(self, words: list[str], title: list[str] | None) -> list[str]:
        """The words a label tells: idle ones left out, unknown ones settled by the title's words or, if these don't know them, by all content words."""
        told = [w for w in words if w not in self.idle]
        if all(w in self.content for w in told):
            return told
        spare = [t for t in title or () if t not in told]
        out, unknown = [], []
        for w in told:
            if w in self.content:
                out.append(w)
            elif near := [t for t in spare if _similar(w, t)]:
                out.append(near[0])
                spare.remove(near[0])
            else:
                unknown.append(w)
        if title and not spare and out:  # the title tells no more: what is left decorates
            return out
        return out + [self._corrected(w) for w in unknown]

    def unsettled(self, words: list[str]) -> bool:
        """Does a label need its title: has it an unknown word, or none that tells anything?"""
        told = [w for w in words if w not in self.idle]
        return not told or any(w not in self.content for w in told)


def as_bag(words: list[str]) -> list[str]:
    """The words sorted, repeated ones told apart by their number."""
    seen: dict[str, int] = {}
    out = []
    for w in words:
        n = seen[w] = seen.get(w, 0) + 1
        out.append(w if n == 1 else f"{w}#{n}")
    return sorted(out)


def read_events(df: DataFrame, keep: list[str], lexicon: Lexicon, model: PairModel) -> DataFrame:
    """The kept columns, number (empty: none) and words of each row's event. df: label, title.

    The title, restored if it was garbled, is read only where the label leaves
    something open. A row with neither text has no words.
    """
    shared = df.sparkSession.sparkContext.broadcast((lexicon, model))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, m = shared.value
        for pdf in batches:
            labels = [units_of(folded(s)) if isinstance(s, str) and s else ([], "") for s in pdf["label"].tolist()]
            titles = pdf["title"].tolist()
            todo = [k for k, (words, _) in enumerate(labels) if x.unsettled(words) and isinstance(titles[k], str) and titles[k]]
            texts = [titles[k] for k in todo]
            second: dict[int, tuple[list[str], str]] = {}
            for k, s, hit in zip(todo, texts, suspects(texts, m)):
                units, number = units_of(folded(restore(s, m)[0] if hit and not s.isascii() else s))
                second[k] = x.of_title(units), number
            bags, numbers = [], []
            for k, (words, number) in enumerate(labels):
                title, other = second.get(k, (None, ""))
                told = x.of_label(words, title) if words else []
                bags.append(as_bag(told or title or []))
                numbers.append(number or other)
            out = pdf[keep].copy()
            out["number"] = pd.Series(numbers, index=out.index, dtype=object)
            out["words"] = pd.Series(bags, index=out.index, dtype=object)
            yield out

    return df.select(*keep, *[c for c in ("label", "title") if c not in keep]).mapInPandas(run, kinds + ", number string, words array<string>")
