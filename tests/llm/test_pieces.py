"""Pieces and containers: limits, cover, overlap, bounds."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jurisdiff.llm import packing as P
from jurisdiff.llm import splitting as S
from jurisdiff.llm.tokens import DEFAULT_TOKENIZER, clean, count

EN, JA = "The lead ministry must document the risk file, and it does. ", "所管省は次回の見直しまでに平易な概要を求めている。"


def check(text, limit, overlap):
    text = clean(text)
    pieces = S.split(text, limit, overlap, DEFAULT_TOKENIZER)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, n, _), nxt in zip(pieces, [*pieces[1:], None]):
        assert n == count(text[a:b], DEFAULT_TOKENIZER)
        assert n <= limit or b - a == 1
        if nxt:
            assert a < nxt[0] <= b < nxt[1]
    return pieces


@pytest.mark.parametrize("text", [EN * 200, JA * 120, "\n\n".join([EN * 3] * 40), "x" * 30_000, "".join(chr(0x4E00 + i % 5000) for i in range(4000)), "🙂👩‍👩‍👧‍👦" * 500, " " * 9000, EN * 30 + "y" * 5000 + JA * 30, "a\r\n\r\nb " * 900])
def test_pieces(text):
    for limit, overlap in ((128, 16), (64, 0), (512, 32)):
        check(text, limit, overlap)


def test_cuts_at_boundaries_and_few_pieces():
    text = "\n\n".join([EN * 3] * 40)
    pieces = check(text, 256, 0)
    n = count(text, DEFAULT_TOKENIZER)
    assert all(text[b:].lstrip(" ").startswith("\n\n") for _, b, _, _ in pieces[:-1]) and len(pieces) <= -(-n // 256) + 2
    assert S.split("short", 64, 8, DEFAULT_TOKENIZER) == [(0, 5, count("short", DEFAULT_TOKENIZER), len(S.STRENGTHS) - 1)]
    with pytest.raises(ValueError):
        S.split(EN, 10, 5, DEFAULT_TOKENIZER)


def test_overlap_is_kept():
    pieces = check(EN * 200, 128, 16)
    assert all(count((EN * 200)[n[0] : p[1]], DEFAULT_TOKENIZER) >= 16 for p, n in zip(pieces, pieces[1:]))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab .,\n。、あ漢é🙂'\t　-1")), min_size=50, max_size=600), st.sampled_from([(16, 0), (16, 4), (24, 7)]))
def test_any_text(text, lo):
    check(text, *lo)


def test_split_operator(spark):
    df = spark.createDataFrame([(1, EN * 100, "x"), (2, None, None), (3, "", None), (4, "short", None), (1, EN * 100, "x")], "id bigint, text string, piece string")
    got = S.split_documents(df, "id", "text", 128, 16).collect()
    assert {r.doc_id for r in got} == {1} and len(got) % 2 == 0
    assert all(r.piece == (EN * 100)[r.start : r.end] and r.n_tokens <= 128 for r in got)
    assert S.split_documents(df.limit(0), "id", "text").count() == 0


def test_bounds_and_best_fit():
    rnd = np.random.default_rng(0)
    for _ in range(300):
        s = rnd.integers(1, 101, rnd.integers(1, 60))
        bins = P.best_fit_decreasing(s, 100)
        assert np.bincount(bins, s).max() <= 100 and P.lower_bound(s, 100) <= bins.max() + 1
    assert P.lower_bound(np.array([51] * 7), 100) == 7 and P.lower_bound(np.array([34] * 9), 100) == 5 and P.lower_bound(np.array([], int), 100) == 0


def packed(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, container string, pid int")
    return P.pack_documents(df, **kw).toPandas()


def test_packing(spark):
    rnd = random.Random(4)
    sizes = [rnd.choice([0, 1, 40, 99, 100, 101, 250, 400, 7]) if rnd.random() < 0.3 else rnd.randrange(1, 100) for _ in range(500)]
    rows = [(i, n, "x", 1) for i, n in enumerate(sizes)] + [(None, None, None, None), (3, 50, "x", 1), (3, 50, "x", 1)]
    got = packed(spark, rows, capacity=100, items_a_partition=60)
    fill = got.groupby("container").tokens.sum()
    assert fill.max() <= 100 and (got.container.map(fill) == got.fill).all()
    assert got.tokens.sum() == sum(sizes) + 100
    parts = got[got.doc_id.notna() & (got.doc_id != 3)].groupby("doc_id").agg(n=("part", "size"), t=("tokens", "sum"))
    assert all(parts.loc[i, "t"] == n and parts.loc[i, "n"] == max(1, -(-n // 100)) for i, n in enumerate(sizes) if i != 3)
    assert len(fill) <= -(-got.tokens.sum() // 100) * 1.05 + 2


def test_packing_small(spark):
    assert len(packed(spark, [])) == 0
    assert len(packed(spark, [(1, 0, None, None)])) == 1
    got = packed(spark, [(i, 50, None, None) for i in range(10)], capacity=100, items_a_partition=3)
    assert got.container.nunique() == 5


def test_sizes(spark):
    df = spark.createDataFrame([(1, EN), (2, None), (3, "")], "id bigint, text string")
    assert {r.doc_id: r.tokens for r in P.token_sizes(df, "id", "text").collect()} == {1: count(EN, DEFAULT_TOKENIZER), 2: 0, 3: 0}


def test_bounds_of_a_packing(spark):
    import random

    from jurisdiff.llm.packing import lower_bound, pack_documents, packing_bounds

    rnd = random.Random(4)
    sizes = [rnd.randrange(0, 250) for _ in range(400)]
    packed = pack_documents(spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, tokens bigint"), 100, 50)
    r = packing_bounds(packed, 100).first()
    parts = [x.tokens for x in packed.where("tokens > 0").collect()]
    assert r.parts == len(parts) and r.containers == packed.where("tokens > 0").select("container").distinct().count()
    assert r.bound == lower_bound(np.array(parts), 100) and r.gap == r.containers - r.bound >= 0
    assert tuple(packing_bounds(packed.limit(0), 100).first()) == (0, 0, 0, 0)
