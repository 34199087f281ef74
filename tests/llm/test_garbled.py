"""Garbled text: what is found, what is restored, what is left alone."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jurisdiff.llm import garbled as G

CLEAN = [
    "Le comité recueille un résumé accessible après la fin du trimestre.", "L’autorité de contrôle a reporté le barème des amendes à titre expérimental.", "Die Aufsicht ergänzt die Schwellenwerte für hohe Risiken bei jeder Änderung.", "La autoridad aplazó el registro de incidentes en 48 días.",
    "所管省は次回の見直しまでに平易な概要を求めている。", "小規模事業者は例外として高リスク用途の基準を却下した。", "監督当局は追加費用なしで学習データの出所を収集し始めた。", "A local authority recorded a register of serious incidents by way of exception.", "COMISSÃO DE PADRÕES REJECTS “SAMPLING” BILL – PORT CRANES", "A câmara reviu as sanções e a lista de isenções.", "KI-Büro adopts “logging” order – court notes",
]


def read_as(s, right, wrong):
    data = s.encode(right)
    if wrong == "cp1252":
        return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in data)
    return data.decode(wrong, "replace")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, s, None, "clash") for i, s in enumerate(CLEAN * 30)], "k bigint, s string, key string, field string")


@pytest.fixture(scope="module")
def model(texts):
    return G.PairModel.fit(texts.select("s"))


def test_clean_texts_are_left_alone(model):
    for s in CLEAN:
        assert G.restore(s, model) == (s, [], False)


@pytest.mark.parametrize("right, wrong", [("utf-8", "latin-1"), ("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("cp932", "cp1252")])
def test_restored_whole(model, right, wrong):
    for s in CLEAN:
        if s.isascii() or right == "cp932" and not s.startswith(("所", "小", "監")) or wrong == "cp1251" and "И" in read_as(s, right, "cp1251"):
            continue
        bad = read_as(s, right, wrong)
        if "�" not in bad:
            assert G.restore(bad, model)[0] == s


def test_twice_and_in_part(model):
    s = CLEAN[1]
    assert G.restore(read_as(read_as(s, "utf-8", "cp1252"), "utf-8", "cp1252"), model)[0] == s
    ja = CLEAN[5]
    half = ja[:8] + read_as(ja[8:], "utf-8", "latin-1")
    fixed, spans, left = G.restore(half, model)
    assert fixed == ja and spans[0][0] >= 8 and not left


@pytest.mark.parametrize("right, wrong", [("cp932", "utf-8"), ("latin-1", "utf-8"), ("utf-8", "cp932"), ("euc_jp", "cp932"), ("utf-8", "gb18030")])
def test_found_though_not_restorable(model, right, wrong):
    s = CLEAN[5] if right in ("cp932", "euc_jp") else CLEAN[1] if right == "latin-1" else CLEAN[4]
    bad = s.encode(right, "replace").decode(wrong, "replace")
    assert bad != s and G.restore(bad, model)[1]


def test_operator(spark, texts, model):
    bad = read_as(CLEAN[5], "utf-8", "latin-1")
    rows = [(1, bad, bad, None, None), (2, None, "", None, None), (3, CLEAN[0], None, None, None), (1, bad, "x" * 300_000 + bad, None, None)]
    df = spark.createDataFrame(rows, "k bigint, a string, b string, key string, field string")
    got = G.find_garbled(df, "k", {"a": "a", "b": "upper(b)"}, model).collect()
    assert sorted((r.key, r.field) for r in got if r.field == "a") == [(1, "a"), (1, "a")]
    assert all(r.restored == CLEAN[5] and r.whole for r in got if r.field == "a")
    assert G.find_garbled(df.limit(0), "k", {"a": "a"}, model).count() == 0


def test_empty_corpus(spark):
    m = G.PairModel.fit(spark.createDataFrame([], "s string"))
    assert G.restore("résumé", m) == ("résumé", [], False) and G.restore("a�b", m)[1] and list(G.suspects([], m)) == []


def test_segments():
    w = [1, -2, 3, -1, 2, -9, 4]
    assert [(a, b, s) for a, b, s in G.maximal_segments(w)] == [(0, 1, 1), (2, 5, 4), (6, 7, 4)]
    assert G.maximal_segments([]) == [] and G.maximal_segments([-1, 0]) == []


def test_pair_table_is_bounded(spark):
    counts = G.pair_counts(spark.createDataFrame([("abab",), ("",), (None,), ("ab",)], "s string")).collect()
    assert {(chr(r.pair >> 21), chr(r.pair & 0x1FFFFF)): r.n for r in counts}[("a", "b")] == 3
    assert F is not None and 1 / G.PAIR_SHARE <= 1_000_000


@pytest.mark.parametrize("reader", ["western", "mac", "cyrillic"])
def test_marks_of_a_wrong_decoding_begin_with_one_class(reader):
    """Lead bytes are searched for by table, and all that two alternatives would find is found."""
    inv = {}
    for c, b in G._byte_of(reader).items():
        inv[b] = inv.get(b, "") + c
    lead2, lead3, rest = (re.escape("".join(inv.get(b, "") for b in range(lo, hi + 1))) for lo, hi in ((0xC2, 0xDF), (0xE0, 0xEF), (0x80, 0xBF)))
    plain = re.compile(f"[{lead2}][{rest}]|[{lead3}][{rest}]{{2}}")
    assert f"[{rest}]|[" not in G._utf8_as(reader).pattern  # no branch at the start
    letters = "".join(inv.values()) + "ab "
    pick = random.Random(5)
    for _ in range(3000):
        s = "".join(pick.choice(letters) for _ in range(30))
        assert G._utf8_as(reader).findall(s) == plain.findall(s)
