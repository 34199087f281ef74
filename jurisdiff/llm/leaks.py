"""Passages of evaluation items inside corpus documents: a positional inverted index.

Documents are cut into terms: words, and for text written without blanks every
character with its two successors. The index covers every term of the corpus
and is made without a shuffle, segment by segment: a segment is an inverted
index of some documents, with a sorted dictionary of their terms and, for each,
the list of its postings (document, position) in that order. The list of a
frequent term is so spread over all segments, and any later set of items is
looked up in the same index.

A search looks up the items' terms. Of every window of an item of the shortest
passage's length, the rarest terms by their document frequency over the whole
corpus are its anchors, however frequent they are: a passage may stand in any
share of the documents. The anchors' lists name the documents to look at. There
the lists of the item's other terms are intersected, shifted by their offset in
the item: positions on one diagonal are an exact phrase, and a chain over
neighbouring diagonals is a passage with slips or short insertions.
"""

from __future__ import annotations

import math
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.llm.lookalike import canonical
from jurisdiff.session import materialize

MIN_WORDS = 16
MIN_CHARS = 45
#: Anchors per window of the shortest passage: so many slips may hit a window before none is left.
ANCHORS = 4
#: Insertions and gaps up to this many terms keep a passage together.
MAX_GAP = 12
#: Share of what the terms inside a passage tell that must be met, and inside one of twice the shortest length; the rest may be slips.
MIN_TELLING = 0.8
MIN_TELLING_LONG = 0.6
#: The information of a term counts in this power: names and numbers decide, not ordinary words.
TELL_POWER = 3
#: A term that more than this share of the items hold (at least two of them) says nothing about which of them leaked.
SHARED_ITEMS = 0.05
#: Postings a segment holds at least, unless its task has no more documents.
SEGMENT_POSTINGS = 1 << 20
#: Characters of documents cut into terms at once, unless a single one has more.
CHUNK_CHARS = 1 << 18
#: How the index is stored: a segment a row group, as a reader, like the writer, holds a row group in memory; by size alone a writer of Parquet looks every 100 rows only.
#: Without statistics and dictionaries: the writer would keep the least and the greatest list of postings of every row group until its file ends.
ONE_BY_ONE = {"parquet.block.row.count.limit": "1", "parquet.column.statistics.enabled": "false", "parquet.enable.dictionary": "false"}
#: Characters of items searched at once, which bounds what is sent to every executor.
BLOCK_CHARS = 8_000_000

# Han, Kana and other letters written without blanks.
_DENSE = "぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿가-힣々〆"
_TERM = re.compile(f"([{_DENSE}]+)|[^\\W_{_DENSE}]+")
# Layout and markup that can stand inside a passage. Each pattern begins with what is searched for by table.
_HYPHEN = re.compile(r"[-‐‑­](?<=[^\W\d_].)\s*\n[\s>|]*(?=[^\W\d_])")
_QUOTED = re.compile(r"\n[ \t]*[>|]+")
_TAGS = re.compile(r"<[/!a-zA-Z][^<>]{0,200}>")
_MARKS = re.compile(r"\*\**|__+|~~|``*")


def plain(text: str) -> str:
    """The text without layout, markup and case, in canonical characters."""
    if "\n" in text:
        text = _QUOTED.sub("\n", _HYPHEN.sub("", text) if "-" in text or "‐" in text or "­" in text else text)
    if "<" in text:
        text = _TAGS.sub(" ", text)
    if "*" in text or "_" in text or "`" in text or "~~" in text:
        text = _MARKS.sub("", text)
    return (text if text.isascii() else canonical(text)).lower()


def terms_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """(terms, their positions, offset in the plain text of each position).

    A word takes one position, and so does every character of a text without
    blanks; its term is the character with its two successors, punctuation
    left aside, so the last two before a word have none.
    """
    text = plain(text)
    terms: list[str] = []
    at: list[int] = []
    offsets: list[int] = []
    dense: list[str] = []

    def flush() -> None:
        run = "".join(dense)
        dense.clear()
        first = len(offsets) - len(run)
        terms.extend(run[i : i + 3] for i in range(len(run) - 2))
        at.extend(range(first, len(offsets) - 2))

    for m in _TERM.finditer(text):
        if m[1]:
            dense.append(m[1])
            offsets.extend(range(m.start(), m.end()))
        else:
            if dense:
                flush()
            terms.append(m[0])
            at.append(len(offsets))
            offsets.append(m.start())
    if dense:
        flush()
    return terms, at, offsets


class Numbers(dict):
    """Numbers of terms: a new one gets the next. A term of a text without blanks stands as the codes of its three characters, 21 bits each."""

    def __missing__(self, term: str | int) -> int:
        n = self[term] = len(self)
        return n

    def names(self) -> list[str]:
        """The terms as texts, by their numbers."""
        return [t if isinstance(t, str) else chr(t >> 42) + chr(t >> 21 & 0x1FFFFF) + chr(t & 0x1FFFFF) for t in self]


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Of every character: 1 part of a word, 2 written without blanks, 0 neither."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    kinds = np.frombuffer(bytes(map(str.isalnum, every)), np.uint8).copy()
    kinds[np.frombuffer("".join(re.findall(f"[{_DENSE}]+", every)).encode("utf-32-le", "surrogatepass"), np.uint32)] = 2
    return kinds


def chunk_terms(texts: list[str], number: Numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which text, number of the term, its position) of each term of some texts, and how many positions each text has; terms_of for many at once.

    Words come first, then terms of texts without blanks, each kind in reading order.
    """
    clean = [plain(t) for t in texts]
    codes = np.frombuffer("\n".join(clean).encode("utf-32-le"), np.uint32)
    kinds = _kinds()[codes]
    in_word = kinds == 1
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    places = np.flatnonzero(begins | (kinds == 2))
    ends = np.cumsum([len(t) + 1 for t in clean])
    first = np.searchsorted(places, np.r_[0, ends[:-1]])
    lengths = np.diff(first, append=len(places))
    of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    at = (np.arange(len(places)) - np.repeat(first, lengths)).astype(np.int32)
    dense = kinds[places] == 2
    words = np.where(in_word, codes, 32).astype(np.uint32).tobytes().decode("utf-32-le").split()
    numbers = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    if not dense.any():
        return of, numbers, at, lengths
    k = np.flatnonzero(dense[:-2] & dense[1:-1] & dense[2:] & (of[:-2] == of[2:]))
    c = codes[places].astype(np.int64)
    grams = (c[k] << 42 | c[k + 1] << 21 | c[k + 2]).tolist()
    order = np.r_[np.flatnonzero(~dense), k]
    return of[order], np.r_[numbers, np.fromiter(map(number.__getitem__, grams), np.int32, len(grams))], at[order], lengths


def numbered_terms(text: str, number: dict[str, int]) -> tuple[list[int], list[int], int]:
    """(numbers of the terms of a text, their positions, how many positions it has); terms_of in numbers, new terms get the next ones."""
    own = Numbers()
    _, terms, at, lengths = chunk_terms([text], own)
    names, order = own.names(), np.argsort(at, kind="stable")
    return [number.setdefault(names[t], len(number)) for t in terms[order].tolist()], at[order].tolist(), int(lengths[0])


class Items:
    """The evaluation items as sequences of term numbers. There are as many as the evaluation set has, which is held out and small."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.number: dict[str, int] = {}
        self.items: list[dict] = []
        for item_id, text in rows:
            terms, at, offsets = terms_of(text)
            if not terms:
                continue
            seq = [-1] * len(offsets)
            for t, p in zip(terms, at):
                seq[p] = self.number.setdefault(t, len(self.number))
            dense = sum(len(t) == 3 and bool(re.match(f"[{_DENSE}]", t)) for t in terms) * 2 > len(terms)
            self.items.append({"id": item_id, "seq": seq, "offsets": [*offsets, offsets[-1] + 1], "dense": dense})
        self.anchors: dict[int, list[tuple[int, int]]] = {}

    def choose_anchors(self, df: dict[int, int], documents: int) -> None:
        """Per window of the shortest passage its rarest terms, however frequent, of those that few items hold; of all, if it has none of these.

        What a term tells is its information: the logarithm of how many times
        fewer documents hold it than there are. So a passage in a third of all
        documents still has terms that tell more than others.
        """
        holders: dict[int, set[int]] = defaultdict(set)
        wording: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for k, item in enumerate(self.items):
            seq = item["seq"]
            item["size"] = size = min(len(seq), MIN_CHARS * 2 // 3 if item["dense"] else MIN_WORDS)
            for t in seq:
                holders[t].add(k)
            for a in range(len(seq) - size + 1):
                wording[tuple(seq[a : a + size])].add(k)
        few = max(2, int(len(self.items) * SHARED_ITEMS))
        chosen: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for k, item in enumerate(self.items):
            seq, size = item["seq"], item["size"]
            item["own"] = set()
            for a in range(len(seq) - size + 1):
                if len(wording[tuple(seq[a : a + size])]) > few:
                    continue
                item["own"].add(a)
                window = sorted((df.get(seq[p], 0), p) for p in range(a, a + size) if seq[p] >= 0)
                telling = [(n, p) for n, p in window if len(holders[seq[p]]) <= few]
                for _, p in (telling or window)[:ANCHORS]:
                    chosen[seq[p]].add((k, p))
            item["tells"] = [math.log(1 + documents / (1 + df.get(t, 0))) ** TELL_POWER if t >= 0 and len(holders[t]) <= few else 0.0 for t in seq]
        self.anchors = {t: sorted(v) for t, v in chosen.items()}


def _extend(doc: list[int], seq: list[int], d: int, i: int, step: int, dense: bool) -> list[tuple[int, int]]:
    """Matched (document, item) positions from (d, i) on in one direction, each the nearest continuation of the one before.

    Misses cost more than matches gain, so chance matches beyond the passage are cut.
    """
    out = []
    reach = MAX_GAP + 1
    ends, ended = (len(doc), len(seq)) if step > 0 else (-1, -1)
    best = keep = score = 0
    while d + step != ends and i + step != ended:
        k, j = 1, 0
        if doc[d + step] != seq[i + step]:
            ahead = seq[i + 1 : i + 1 + reach] if step > 0 else seq[max(0, i - reach) : i][::-1]
            there = doc[d + 1 : d + 1 + reach] if step > 0 else doc[max(0, d - reach) : d][::-1]
            met = set(there).intersection(ahead)
            if not met:
                break
            least = 2 * reach
            for n, t in enumerate(ahead, 1):
                if n >= least:
                    break
                if t in met and (m := there.index(t)) + n < least:
                    least, k, j = m + n, n, m
        d, i = d + step * (j + 1), i + step * k
        out.append((d, i))
        score += 1 - (1.2 if dense else 3.0) * (k - 1)
        if score >= best:
            best, keep = score, len(out)
        elif score < best - (24 if dense else 12):
            break
    return out[:keep]


def _holds_exact(path: list[tuple[int, int]], item: dict) -> bool:
    """Does the path hold, without a slip, wording of the shortest passage's length (or the whole item) that few items share?"""
    seq, offsets, dense = item["seq"], item["offsets"], item["dense"]
    least = MIN_CHARS if dense else MIN_WORDS
    d0, i0 = d1, i1 = path[0]
    for d, i in [*path[1:], (-1, -1)]:
        if i >= 0 and d - d1 == i - i1 and all(t < 0 for t in seq[i1 + 1 : i]):
            d1, i1 = d, i
            continue
        end = min(i1 + 2, len(seq) - 1) if dense and seq[i1] >= 0 else i1  # the last term's own characters
        length = offsets[end + 1] - offsets[i0] if dense else end - i0 + 1
        if (length >= least or i0 == 0 and end == len(seq) - 1) and any(a in item["own"] for a in range(i0, end - item["size"] + 2)):
            return True
        d0, i0 = d1, i1 = d, i
    return False


def passages(terms: list[int], positions: list[int], items: Items) -> list[tuple[int, int]]:
    """(item, length of the longest passage that counts, in the item's own measure) for each item of which the document holds one."""
    doc = [-2] * (max(positions, default=-1) + 1)  # -2: a term of no item
    for p, t in zip(positions, terms):
        doc[p] = t
    seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, t in zip(positions, terms):
        for k, i in items.anchors.get(t, ()):
            seeds[k].append((p, i))
    found = []
    for k, pairs in seeds.items():
        item = items.items[k]
        seq, dense = item["seq"], item["dense"]
        best = 0
        done: list[tuple[int, int, int]] = []
        for d, i in pairs:
            if any(lo <= d <= hi and abs((d - i) - diag) <= 4 * MAX_GAP for lo, hi, diag in done):
                continue
            path = [*reversed(_extend(doc, seq, d, i, -1, dense)), (d, i), *_extend(doc, seq, d, i, 1, dense)]
            done.append((path[0][0], path[-1][0], d - i))
            lo, hi = path[0][1], path[-1][1] + (2 if dense and seq[path[-1][1]] >= 0 else 0)
            hi = min(hi, len(seq) - 1)
            length = item["offsets"][hi + 1] - item["offsets"][lo] if dense else hi - lo + 1
            if length > best and _counts(path, lo, hi, length, item):
                best = length
        if best:
            found.append((item["id"], best))
    return found


def _counts(path: list[tuple[int, int]], lo: int, hi: int, length: int, item: dict) -> bool:
    """Is a chain over the positions lo to hi of the item a passage: long enough, or the whole item, and exact or with the terms that tell the item from others?"""
    least = MIN_CHARS if item["dense"] else MIN_WORDS
    if length < least and (lo > 0 or hi < len(item["seq"]) - 1):
        return False
    met = {j for _, j in path}
    tells = item["tells"]
    whole = sum(tells[lo : hi + 1])
    share = sum(tells[j] for j in met) / whole if whole else 0.0
    return share >= MIN_TELLING or length >= 2 * least and share >= MIN_TELLING_LONG or _holds_exact(path, item)


SEGMENT = pa.schema([("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("holders", pa.list_(pa.int32())), ("starts", pa.binary()), ("docs", pa.binary()), ("positions", pa.binary())])
_SEGMENT_SQL = "doc_ids array<bigint>, terms array<string>, holders array<int>, starts binary, docs binary, positions binary"


def _segment(ids: list[int], docs: np.ndarray, terms: np.ndarray, positions: np.ndarray, number: Numbers) -> pa.RecordBatch:
    """The inverted index of some documents, given as their terms, each term's in reading order; docs and starts are coded as differences."""
    names = np.array(number.names(), dtype=object)
    order = np.argsort(names)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    by_term = rank[terms] << 32 | np.arange(len(terms))  # a plain sort of these numbers is several times faster than a stable one by term
    by_term.sort()
    of = by_term >> 32
    by_term &= 0xFFFFFFFF
    docs, positions = docs[by_term], positions[by_term]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])  # every numbered term occurs
    new_doc = np.r_[True, (docs[1:] != docs[:-1]) | (of[1:] != of[:-1])]
    holders = np.add.reduceat(new_doc, starts, dtype=np.int32)
    steps = np.diff(docs, prepend=np.int32(0)).astype(np.int32)
    one = [pa.array([ids], pa.list_(pa.int64())), pa.array([names[order]], pa.list_(pa.string())), pa.array([holders], pa.list_(pa.int32()))]
    return pa.RecordBatch.from_arrays([*one, *[pa.array([x.tobytes()], pa.binary()) for x in (starts.astype(np.int32), steps, positions)]], schema=SEGMENT)


def build_index(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The positional inverted index of a corpus, a segment a row. Null and empty texts, and texts without a term, are in none."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        chunk: list[tuple[int, str]] = []
        number = Numbers()
        held = chars = 0

        def cut() -> None:
            """Add the documents of the chunk to the segment."""
            nonlocal held, chars
            of, terms, at, _ = chunk_terms([s for _, s in chunk], number)
            has = np.bincount(of, minlength=len(chunk)) > 0
            parts.append(((np.cumsum(has) - 1 + len(ids)).astype(np.int32)[of], terms, at))
            ids.extend(d for (d, _), h in zip(chunk, has.tolist()) if h)
            held += len(terms)
            chars = 0
            chunk.clear()

        def done() -> pa.RecordBatch:
            nonlocal held, number
            row = _segment(ids, *(np.concatenate(x) for x in zip(*parts)), number)
            ids.clear()
            parts.clear()
            number, held = Numbers(), 0
            return row

        for batch in batches:
            for d, s in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = s.as_py()
                if d is None or not s:
                    continue
                chunk.append((d, s))
                chars += len(s)
                if chars >= CHUNK_CHARS:
                    cut()
                    if held >= SEGMENT_POSTINGS:
                        yield done()
        if chunk:
            cut()
        if held:
            yield done()

    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return docs.mapInArrow(segments, _SEGMENT_SQL)


def _looked_up(terms: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the wanted terms a segment holds, their places in its dictionary)."""
    at = pc.index_in(wanted, value_set=terms)
    there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return there, at.take(pa.array(there)).to_numpy(zero_copy_only=False).astype(np.int64)


def _candidates(seg: dict, wanted: pa.Array, anchors: frozenset[int]) -> Iterator[tuple[int, list[int], list[int]]]:
    """(doc_id, numbers of the wanted terms in it, their positions) of each document of a segment that an anchor's list names."""
    there, at = _looked_up(seg["terms"].values, wanted)
    if not len(there):
        return
    starts = np.frombuffer(seg["starts"].as_py(), np.int32)
    docs = np.cumsum(np.frombuffer(seg["docs"].as_py(), np.int32))
    positions = np.frombuffer(seg["positions"].as_py(), np.int32)
    ends = np.r_[starts[1:], len(docs)]
    named = np.zeros(len(seg["doc_ids"].values), bool)
    for t, k in zip(there.tolist(), at.tolist()):
        if t in anchors:
            named[docs[starts[k] : ends[k]]] = True
    if not named.any():
        return
    lists = []
    for t, k in zip(there.tolist(), at.tolist()):
        of = docs[starts[k] : ends[k]]
        keep = named[of]
        lists.append((of[keep], positions[starts[k] : ends[k]][keep], np.full(int(keep.sum()), t, np.int32)))
    d, p, t = (np.concatenate(x) for x in zip(*lists))
    order = np.lexsort((p, d))
    d, p, t = d[order], p[order], t[order]
    cuts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    ids = seg["doc_ids"].values
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(d)]):
        yield ids[int(d[a])].as_py(), t[a:b].tolist(), p[a:b].tolist()


def search_index(index: DataFrame, documents: int, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """doc_id, item_id, length: every document of the index with an item of which it holds a passage.

    documents: how many the index is of. Items are searched in blocks of about
    BLOCK_CHARS characters, so what is sent to an executor doesn't grow with
    the evaluation set; shares of items are those of a block.
    """
    texts = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    chars = texts.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = chars // BLOCK_CHARS + 1
    found = None
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).orderBy("i").collect()
        held = Items([(r["i"], r["t"]) for r in rows])
        part = _search_block(index, documents, held)
        found = part if found is None else found.unionByName(part)
    return found


def _search_block(index: DataFrame, documents: int, held: Items) -> DataFrame:
    spark = index.sparkSession
    names = spark.sparkContext.broadcast(list(held.number))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(names.value, pa.string())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, holders in zip(batch.column(0), batch.column(1)):
                there, at = _looked_up(terms.values, wanted)
                total[there] += holders.values.to_numpy()[at]
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["t", "n"])

    freq = index.select("terms", "holders").mapInArrow(frequencies, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))  # as many rows as the items have terms
    held.choose_anchors({r["t"]: r["n"] for r in freq.collect()}, documents)
    shared = spark.sparkContext.broadcast((held, frozenset(held.anchors)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchors = shared.value
        wanted = pa.array(names.value, pa.string())
        for batch in batches:
            for k in range(batch.num_rows):
                seg = {c: batch.column(c)[k] for c in SEGMENT.names}
                out = [(d, i, n) for d, terms, at in _candidates(seg, wanted, anchors) for i, n in passages(terms, at, block)]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["doc_id", "item_id", "length"])

    return index.mapInArrow(search, "doc_id bigint, item_id bigint, length bigint")


def find_leaks(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """doc_id, item_id, length: every document with an item of which it holds a passage.

    length is in words, or in characters for items written without blanks.
    Null and empty texts hold nothing; repeated documents each count. An empty
    corpus or evaluation set gives no rows.
    """
    index = materialize(build_index(documents, doc_id, text), "index", ONE_BY_ONE)
    counted = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0))).first()[0]
    return search_index(index, counted, items, item_id, item_text)
