"""Canonical form, and pairs of texts that look alike, against brute force."""

import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from jurisdiff.llm.lookalike import alike_classes, alike_pairs, canonical


def test_same_look():
    for a, b in (("Ｓｅｎａｔｅ", "Senate"), ("Sen​ate", "Senate"), ("a b", "a b"), ("a 　b", "a b"), ("café", "café"), ("Ѕеnаtе", "Senate"), ("ﬁlter", "filter"), ("ｶﾞｲﾄﾞ", "ガイド"), ("口グ", "ログ"), ("モデル⼒ード", "モデルカード"), ("ӓ", "ä"), (" a ", "a"), ("‮a", "a"), ("e‍́", "é"), ("（Ａ）", "(A)"), ("承認ヘ", "承認へ"), ("ガ", "ガ")):
        assert canonical(a) == canonical(b), (a, b)


def test_another_look():
    for a, b in (("Senate", "senate"), ("résumé", "resume"), ("a b", "ab"), ("①", "1"), ("x²", "x2"), ("“a”", '"a"'), ("カ", "ガ"), ("電力", "電カ夕")):
        assert canonical(a) != canonical(b), (a, b)
    assert canonical("") == "" and canonical("​ 　") == ""


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aéеｅＡカ口力ヘへり ー二゙̧́​ 　\U0001d400한ﾞｶ")), max_size=9))
def test_idempotent(s):
    assert canonical(canonical(s)) == canonical(s)


def test_pairs_against_brute_force(spark):
    rnd = random.Random(2)
    forms = ["Senate", "Ｓenate", "Sen​ate", "senate", "ログ", "口グ", None, "", "​"]
    rows = [(rnd.choice(["x", "y"]), rnd.choice(["eu", "eu", "eu", "wr", None]), i, rnd.choice(forms), "clash", 1) for i in range(300)]
    groups = defaultdict(list)
    for f, g, k, t, *_ in rows:
        if g is not None and t is not None:
            groups[f, g, canonical(t)].append((k, t))
    want = {(key[0], a, b) for key, v in groups.items() for a, s in v for b, t in v if a < b and s != t}
    df = spark.createDataFrame(rows, "field string, grp string, row_key bigint, text string, form string, salt int")
    got = [tuple(r) for r in alike_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert alike_pairs(df.limit(0)).count() == 0 == alike_classes(df.limit(0)).count()
    classes = {}
    for (f, *_), v in groups.items():
        if len({t for _, t in v}) > 1:
            classes |= {(f, k): (min(v)[0], len({t for _, t in v}), len(v)) for k, _ in v}
    assert {(r.field, r.row_key): (r.class_key, r.forms, r.members) for r in alike_classes(df).collect()} == classes


def test_hot_text_is_salted(spark, monkeypatch):
    import jurisdiff.llm.lookalike as L

    monkeypatch.setattr(L, "ROWS_A_TASK", 7)
    rows = [("x", "eu", i, "Senate" if i % 10 else "Ｓenate") for i in range(60)]
    got = {tuple(r)[1:] for r in alike_pairs(spark.createDataFrame(rows, "field string, grp string, row_key bigint, text string")).collect()}
    assert got == {(min(a, b), max(a, b)) for a in range(0, 60, 10) for b in range(60) if b % 10}


def test_letters_of_many_scripts_and_styles():
    for s in ("ꓢenate", "Ꮪenate", "𝖲𝖾𝗇𝖺𝗍𝖾", "𝐒𝐞𝐧𝐚𝐭𝐞", "Տenate"):
        assert canonical(s) == "Senate", s
    assert canonical("ӏⲟɡ") == "log" and canonical("ꓮꓲ") == "AI" == canonical("ᎪI")


def test_long_texts_take_linear_time():
    import time

    t = time.perf_counter()
    for n in (20_000, 200_000):
        assert canonical("二" * n + "ア") == "ニ" * n + "ア" and canonical("ア" + "へり" * n)
    assert time.perf_counter() - t < 5
