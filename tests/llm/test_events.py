"""Reading events, and finding repeats by the pivot table, against plain grouping and a batch-by-batch run."""

import random

import pytest
from pyspark.sql import functions as F

from jurisdiff.llm import events as E
from jurisdiff.llm import pivots as P
from jurisdiff.llm.garbled import PairModel
from jurisdiff.session import materialize

BODIES, ACTS = ["Euralia Senate", "Česká dozorčí Domio"], [("adopts", "採択"), ("repeals", "廃止"), ("consults on", "意見募集")]
INS, SUB = [("order", "命令"), ("code of conduct", "行動規範"), ("treaty", "協定")], [("logging", "ログ保存"), ("fees", "手数料"), ("age limits", "年齢制限")]
SYS, SEC = [("chatbots", "チャットボット"), ("court notes", "法廷記録"), ("port cranes", "港湾クレーン")], [("ports", "港湾"), ("sports", "競技"), ("courts", "裁判所")]


def event(rnd):
    return rnd.choice(BODIES), rnd.choice(ACTS), rnd.choice(INS), rnd.choice(SUB), rnd.choice(SYS), rnd.choice(SEC), rnd.choice(["", "", " (No. 12/26)", " (Case 345/25)"])


def label(e):
    b, a, i, s, y, c, n = e
    return f"{b} {a[0]} {i[0]} on {s[0]} of {y[0]} in {c[0]}{n}"


def titles(e):
    b, a, i, s, y, c, n = e
    n = n.strip().replace("(", "（").replace(")", "）")
    return [f"{b}が{a[1]}した{c[1]}向け{i[1]} — {y[1]}と{s[1]}{n}", f"【{c[1]}】{b}：{y[1]}・{s[1]}についての{i[1]}、{a[1]}へ{n}", f"{y[1]}の{s[1]}を巡り{b}が{i[1]}を{a[1]}、対象は{c[1]}{n}", f"{b}、{c[1]}分野の{y[1]}に関する{s[1]}の{i[1]}を{a[1]}{n}"]


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    rows, truth = [], {}
    for k in range(600):
        e = event(rnd)
        c = rnd.choice(["eu", "eu", "dm"])
        lab, tit = label(e), rnd.choice(titles(e))
        if rnd.random() < 0.2:
            lab = rnd.choice([None, "", lab.upper(), lab.replace("e", "е"), f"[translated] {lab}", lab.replace(" on ", " on the ", 1)])
        elif rnd.random() < 0.1:
            tit = rnd.choice([None, "", tit + "【速報】"])
        elif "cranes" not in lab and rnd.random() < 0.05:
            lab = f"[Cranes] {lab}"  # decorated with a word that elsewhere tells something
        rows.append((k, k // 100, c, lab, tit, "clash", 1))
        truth[k] = (c, e)
    return spark.createDataFrame(rows, "row_key bigint, batch_no int, country string, label string, title string, slots string, point int"), truth


def points_of(df, lexicon, model):
    return materialize(P.event_points(E.read_events(df, ["row_key", "batch_no", "country"], lexicon, model)), "points")


@pytest.fixture(scope="module")
def points(corpus):
    df, truth = corpus
    return points_of(df, E.learn_lexicon(df), PairModel.fit(df.select("title"))), truth


def want(truth):
    first, out = {}, set()
    for k, e in sorted(truth.items()):
        if e in first and k >= 100:
            out.add((first[e], k))
        first.setdefault(e, k)
    return out


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_repeats(points):
    pts, truth = points
    assert rows(P.repeated_in_batches(pts)) == want(truth)


def test_a_shuffled_batch_gives_the_same(points, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_POINTS", 0)
    assert rows(P.repeated_in_batches(points[0])) == want(points[1])


def test_the_metric_decides(points, monkeypatch):
    """Some repeats are known only by their distance: points that differ in a word."""
    pts, truth = points
    monkeypatch.setattr(P, "between", lambda a, b: F.when(a == b, 0).otherwise(9))
    fewer = rows(P.repeated_in_batches(pts))
    assert fewer < want(truth)


def test_other_connecting_words(spark, corpus):
    df, truth = corpus
    swap = F.regexp_replace(F.regexp_replace(F.regexp_replace("label", " on ", " regarding "), " of ", " for "), " in ", " across ")
    other = df.withColumn("label", F.when(F.col("row_key") % 2 == 0, swap).otherwise(F.col("label")))
    assert rows(P.repeated_in_batches(points_of(other, E.learn_lexicon(other), PairModel.fit(df.select("title"))))) == want(truth)


def test_batches_against_history_stored_with_an_older_lexicon(corpus):
    """Points are made of words: a table stored with the lexicon of batch 0 serves batches read with that of all rows."""
    df, truth = corpus
    model = PairModel.fit(df.select("title"))
    first = df.where("batch_no = 0")
    history = P.pivot_table(points_of(first, E.learn_lexicon(first), model)).drop("batch_no")
    later = points_of(df.where("batch_no > 0"), E.learn_lexicon(df), model)
    got = set()
    for b in range(1, 6):
        batch = later.where(F.col("batch_no") == b)
        found = materialize(P.match_batch(P.pivot_table(batch).drop("batch_no"), history), "found")
        got |= rows(batch.join(found.select("point", "near_key"), "point").where("near_key < row_key").select("near_key", "row_key"))
        history = materialize(history.unionByName(found.where("is_new").select(*history.columns)), "history")
    assert len(got ^ want(truth)) <= 0.02 * len(want(truth))


def test_the_triangle_inequality(points):
    t = P.pivot_table(points[0])
    a, b = t.alias("a"), t.orderBy("point").limit(5).alias("b")
    gap = F.array_max(F.zip_with("a.d", "b.d", lambda x, y: F.abs(x - y)))
    pairs = a.join(b, F.col("a.country") == F.col("b.country")).select(P.between(F.col("a.words"), F.col("b.words")).alias("d"), gap.alias("gap"), F.size(F.array_intersect("a.ranges", "b.ranges")).alias("shared"), (F.col("a.number") == F.col("b.number")).alias("near")).collect()
    assert pairs and all(r.d >= r.gap for r in pairs) and all(r.shared for r in pairs if r.d <= P.RADIUS and r.near)
    assert any(r.d > r.gap for r in pairs) and not all(r.shared for r in pairs)


def test_slips_and_unknown_words():
    pairs = [(en, en, True, True) for b in BODIES for en in E.units_of(E.folded(b))[0]]
    pairs += [(ja, w, True, True) for v in (ACTS, INS, SUB, SYS, SEC) for en, ja in v for w in en.split() if w not in ("on", "of")]
    x = E.Lexicon(sorted(set(pairs)), {"対象", "巡", "関"}, {"on", "of", "in", "the"})
    label = lambda s, t=None: (E.as_bag(x.of_label(E.units_of(E.folded(s))[0], t and x.of_title(E.units_of(E.folded(t))[0]))), E.units_of(E.folded(s))[1])
    title = lambda s: (E.as_bag(x.of_title(E.units_of(E.folded(s))[0])), E.units_of(E.folded(s))[1])
    base = label("Euralia Senate adopts treaty on logging of court notes in sports (No. 7/26)")
    assert label("Court notes in sports: Euralia Senate adopts treaty on logging (No. 7/26)") == base
    assert label("euralia sneate adopts traety on loging of court notes in sports No 0007-26") == base
    assert title("【競技】Euralia Senate：法廷記録・ログ保存についての協定、採択へ（No. 7/26）") == base == title("法廷記録ログ保存を巡りEuralia Senateが協定を採択、対象は競技（No. 7/26）")
    assert label("URGENT Euralia Senate adopts treaty on logging of court notes in sports (No. 7/26)", "Euralia Senateが採択した競技協定 — 法廷記録とログ保存") == base
    assert label("Euralia Senate adopts treaty on logging of court notes in ports (No. 7/26)") != base
    assert label("Euralia Senate adopts treaty on logging of court notes in sports (No. 8/26)")[1] != base[1]
    assert label("") == ([], "") and label("no such words") == (["no", "such", "words"], "") and E.as_bag(["a", "b", "a"]) == ["a", "a#2", "b"]
    assert E.edits("abcd", "abdc", 2) == 1 and E.edits("a", "abcd", 2) == 3 and E.edits("", "", 1) == 0


def test_empty_and_null(spark):
    df = spark.createDataFrame([], "row_key bigint, batch_no int, country string, label string, title string")
    x, model = E.learn_lexicon(df), PairModel.fit(df.select("title"))
    assert P.repeated_in_batches(points_of(df, x, model)).count() == 0
    some = [(1, 0, "eu", None, None), (2, 1, "eu", "", None), (3, 1, None, "x", "x"), (4, 0, "eu", "three odd words", None), (5, 1, "eu", "three odd words now", None), (6, 1, "eu", "other", "x" * 100_000), (7, 2, "eu", "three odd word", None), (8, None, "eu", "late words", None), (9, 3, "eu", "words late", None)]
    assert rows(P.repeated_in_batches(points_of(spark.createDataFrame(some, df.schema), x, model))) == {(4, 5), (8, 9)}


def test_marks_of_latin_letters_are_searched_for():
    """By one class of characters; every character comes out as by the table."""
    every = [chr(c) for c in range(0x80, 0x3000)]
    assert {c for c in every if E._MARKED_LATIN.search(c)} == {c for c in every if ord(c) in E._PLAIN_LATIN}
    for c in every:
        s = E.canonical(f"a{c}b").casefold()
        assert E.folded(f"a{c}b") == s.translate(E._PLAIN_LATIN)
