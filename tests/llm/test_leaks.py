"""Leaked passages: planted with noise, in parts, and things that only look like leaks."""

import random

import pyarrow.parquet as pq
import pytest

from jurisdiff.llm import leaks as L
from jurisdiff.session import materialize

rnd = random.Random(11)
_NAMES = ["".join(rnd.choice(["ba", "ko", "ri", "ste", "lu", "mo", "na", "tir"]) for _ in range(4)) for _ in range(400)]
_KANA = ["".join(rnd.choice("アカサタナハマヤラワミムメモリルレロ") for _ in range(5)) for _ in range(200)]
EN = [" ".join(f"the court of {rnd.choice(_NAMES)} billed {rnd.randrange(100, 9999)} broadcasts, and the appeal moved to {rnd.choice(_NAMES)}." for _ in range(4)) for _ in range(20)]
JA = ["".join(f"{rnd.choice(_KANA)}の許可審判所が第{rnd.randrange(100, 9999)}号様式が撤回された後で事業者{rnd.randrange(10, 999)}社に過料を科した。" for _ in range(3)) for _ in range(10)]
ITEMS = [(i, f"Read the passage and answer. {t}") for i, t in enumerate(EN)] + [(100 + i, t) for i, t in enumerate(JA)] + [(200, None), (201, ""), (202, "…"), (203, "Zorbalia quemmed trundlemarks"), (204, "仝蟇丼爻驫ヾ")]
FILL = "A local authority recorded a register of serious incidents by way of exception. The court reviewed the appeal. "


def words(t, a, b):
    return " ".join(t.split()[a:b])


DOCS = {
    1: (FILL + EN[0] + FILL, {0}), 2: (FILL + words(EN[1], 10, 32) + FILL, {1}), 3: (words(EN[2], 10, 22), set()), 4: ((FILL + EN[3]).upper().replace(",", "").replace(".", ""), {3}),
    5: (FILL + EN[4].replace("billed", "bilked", 1).replace("moved", "movd", 1), {4}), 6: (words(EN[5], 0, 20) + " (see note 4) " + words(EN[5], 20, 40), {5}), 7: (EN[6].replace("court", "<b>court</b>").replace(" the ", " **the** "), {6}),
    8: ("\n> ".join(words(EN[7], k, k + 6) for k in range(0, 48, 6)), {7}), 9: ("Read the passage and answer. " + FILL, set()), 10: (EN[8].replace("e", "е").replace(" ", "　"), {8}), 11: (EN[9].replace("billed", "bil-\nled"), {9}),
    12: (JA[0], {100}), 13: ("作業部会は" + JA[1][10:70] + "。", {101}), 14: (JA[2][10:35], set()), 15: ("\n> ".join(JA[3][k : k + 17] for k in range(0, len(JA[3]), 17)), {103}), 16: (EN[10] + FILL + JA[4], {10, 104}), 17: (None, set()), 18: ("", set()), 19: (FILL * 2000 + EN[11], {11}), 20: (EN[0], {0}), 21: (FILL + "Zorbalia quemmed trundlemarks. " + FILL, {203}), 22: ("作業部会は仝蟇丼爻驫を公表", set()),
}


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, (t, _) in DOCS.items()] + [(1000 + i, FILL * 3, None, None) for i in range(300)], "doc_id bigint, text string, terms string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r.length for r in L.find_leaks(docs, "doc_id", "text", items, "item_id", "text").collect()}


@pytest.mark.parametrize("doc", sorted(DOCS))
def test_planted(found, doc):
    assert {i for d, i in found if d == doc} == DOCS[doc][1]


def test_nothing_else(found):
    assert all(d < 1000 for d, _ in found) and found[20, 0] >= 50 and 22 <= found[2, 1] <= 26


def test_fast_path_equals_the_plain_one():
    for t, _ in DOCS.values():
        if t:
            terms, at, offsets = L.terms_of(t)
            number = {}
            got, places, length = L.numbered_terms(t, number)
            names = list(number)
            assert [names[k] for k in got] == terms and places == at and length == len(offsets)


def test_texts_cut_together_equal_each_alone():
    """Also where a word or a run without blanks ends one text and begins the next; empty texts and such without a term between."""
    texts = [t or "" for t, _ in DOCS.values()] + ["許可", "審判所", "word", "Word two", "…", "ab\u3000仝蟇", "丼a爻。驫ヾ亜", "İstanbul STRASSE ß_x ４２", ""]
    number = L.Numbers()
    of, terms, at, lengths = L.chunk_terms(texts, number)
    names = number.names()
    for k, t in enumerate(texts):
        plain_terms, plain_at, offsets = L.terms_of(t)
        assert sorted(zip(at[of == k].tolist(), [names[x] for x in terms[of == k]])) == sorted(zip(plain_at, plain_terms)) and lengths[k] == len(offsets)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame(ITEMS[:3], "item_id bigint, text string")
    some = spark.createDataFrame([(1, EN[0])], "doc_id bigint, text string")
    assert L.find_leaks(docs, "doc_id", "text", items, "item_id", "text").count() == 0
    assert L.find_leaks(some, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0


def test_passage_in_a_third_of_the_documents(spark):
    docs = [(i, FILL + words(EN[1], 10, 32) + FILL if i % 3 == 0 else FILL + "作業部会は" + JA[1][10:70] + "。" if i % 3 == 1 else FILL * 2) for i in range(300)]
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(ITEMS, "item_id bigint, text string"), "item_id", "text").collect()}
    assert got == {(i, 1) for i in range(0, 300, 3)} | {(i, 101) for i in range(1, 300, 3)}


def test_passage_with_one_anchor(spark):
    """Exact passages with a single term that few items hold, found by that alone."""
    names = sorted(set(_NAMES))[:120]
    common = [f"the court of appeal heard that every authority had kept its own register in {a} while the office sent all notices by post to {b}" for a, b in zip(names[:60], names[60:])]
    docs = [(i, FILL + words(common[i], 4, 22) + ". " + FILL) for i in range(60)] + [(100 + i, FILL + words(common[i], 10, 22) + ". " + FILL) for i in range(60)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(common)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {(i, i) for i in range(60)}


def test_exact_passage_beside_a_longer_chain_with_other_names(spark):
    """Every chain is judged by itself: the item's wording about other names is longer, and isn't a passage."""
    other = [words(EN[i], 0, 6) + " " + words(EN[i + 5], 6, 52) for i in range(5)]
    docs = [(i, FILL + other[i] + FILL * 3 + words(EN[i], 10, 28) + ". " + FILL) for i in range(5)] + [(10 + i, FILL + other[i] + FILL) for i in range(5)]
    items = spark.createDataFrame([(i, EN[i]) for i in range(5)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {(i, i) for i in range(5)}


def test_a_segment_a_row_group(spark, monkeypatch):
    """Whoever writes or reads the index holds a row group in memory, so each is one segment, however many a task makes."""
    kept = []
    monkeypatch.setattr(L, "materialize", lambda *a: kept.append(materialize(*a)) or kept[-1])
    docs = spark.createDataFrame([(i, FILL * 2000 + EN[i % 20]) for i in range(70)], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(EN)], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in L.find_leaks(docs, "doc_id", "text", items, "item_id", "text").collect()} == {(i, i % 20) for i in range(70)}
    held = [pq.read_metadata(f.removeprefix("file://")) for f in kept[0].inputFiles()]
    assert sum(m.num_rows for m in held) >= 2 and all(m.num_row_groups == m.num_rows for m in held)
    assert not any(m.row_group(g).column(c).is_stats_set for m in held for g in range(m.num_row_groups) for c in range(m.num_columns))  # a writer keeps these until its file ends
