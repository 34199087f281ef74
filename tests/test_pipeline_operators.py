"""Known answers for gates, dedupe, identifiers, merges, state, links, URLs and dates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from jurisdiff.functions import text as X
from jurisdiff.operators import dedupe, gates, incremental, links, merge, validate
from jurisdiff.operators.ranking import rank_within
from jurisdiff.sources import catalog
from jurisdiff.streaming.incremental import StateTable, run_feeds, run_pages


def one(spark, column, *values, schema="string"):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} {schema}" for n in names)).select(column(*[F.col(n) for n in names])).first()[0]


def test_gate_reasons(spark):
    long = "  The AI act applies. " * 40
    rows = [("https://news.google.com/x", long, "google-news-source"), ("https://a.NEWS.google.com/x", long, "google-news-source"), ("https://example.gov/a", "AI act", "body-too-short"), ("https://example.gov/a", None, "body-too-short"),
            ("https://example.gov/a", "Rolls of paper were bought once more. " * 30, "no-ai-reg-keyword"), (None, long, None), ("not a url", long, None), ("https://e.gov", "Please enable JavaScript. " + long, "blocked-or-js-only-page"),
            ("https://e.gov", long + "function () {" * 19, None), ("https://e.gov", long + "function () {" * 20, "blocked-or-js-only-page"), ("https://e.gov", "　" * 700 + "AI", "body-too-short")]
    got = gates.mechanical_gate(spark.createDataFrame([(i, u, t) for i, (u, t, _) in enumerate(rows)], "i int, url string, text string")).orderBy("i").collect()
    assert [r.reason for r in got] == [r[2] for r in rows]


def test_publication_gate(spark):
    dates = [("2026-01-01", "stale-publication-date"), ("2026-03-19", "stale-publication-date"), ("2026-03-20", None), ("2026-12-31", None), (None, "missing-publication-date"), ("", "missing-publication-date"), ("2026-3-20", "missing-publication-date"), ("2026-13-45", None), ("0000-00-00", None)]
    got = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(dates)], "i int, d string").select("i", gates.publication_reason(F.col("d"), "2026-06-17").alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [d[1] for d in dates]
    assert one(spark, X.rolled_date, "2026-13-45") == dt.date(2027, 2, 14)


def test_event_dedupe(spark):
    schema = "seq int, countries array<string>, country_hint string, priority string, label string"
    rows = [(1, ["eu"], None, "low", "l"), (2, ["eu"], None, "high", "l"), (3, ["us", "us"], None, "high", "l"), (4, [], "jp", None, "m"), (5, None, "", "high", "m"), (6, ["eu"], None, "high", ""), (7, ["eu"], None, "high", "l"), (8, ["br"], None, "low", "old")]
    kept, drops = dedupe.dedupe_events(spark.createDataFrame(rows, schema), spark.createDataFrame([("br", "old")], "cc string, label string"))
    assert sorted((r.seq, r.cc, r.out_seq) for r in kept.collect()) == [(2, "eu", 1), (3, "us", 3), (4, "jp", 4)]
    assert sorted((r.seq, r.reason) for r in drops.collect()) == [(1, "duplicate-event-lower-priority"), (3, "duplicate-event-lower-priority"), (7, "duplicate-event-lower-priority"), (8, "duplicate-existing-event")]


def test_identifiers(spark):
    new = spark.createDataFrame([(1, "2026-06-10", "us"), (2, "2026-06-10", "us"), (3, "2026-06-11", "us"), (4, "2026-06-12", "eu"), (5, None, "eu")], "s int, d string, c string")
    old = spark.createDataFrame([("2026-06-10-us-001",), ("2026-06-12-eu-999",), ("odd",), (None,)], "id string")
    got = {r.s: r.id for r in merge.allocate_ids(new, old, "d", "c", "s").collect()}
    assert got == {1: "2026-06-10-us-002", 2: "2026-06-10-us-003", 3: "2026-06-11-us-001", 4: "2026-06-12-eu-1000", 5: None}


def test_places_in_groups_of_any_size(spark):
    rnd = random.Random(6)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", None]), i, "clash") for i in rnd.sample(range(900), 900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(r.k, r.i): r.place for r in rank_within(spark.createDataFrame(rows, "k string, i int, _x string"), ["k"], [F.desc("i")], "place").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k in ("hot", "a", None):
        assert [got[k, i] for i in sorted((i for q, i, _ in rows if q == k), reverse=True)] == list(range(1, sum(q == k for q, *_ in rows) + 1))
    assert rank_within(spark.createDataFrame([], "k string, i int"), ["k"], ["i"]).count() == 0


def test_guarded_values(spark):
    current = spark.createDataFrame([("a", "draft"), ("b", "odd"), ("c", "enacted")], "k string, status string")
    patches = spark.createDataFrame([("a", 1, "enacted"), ("a", 2, "proposed"), ("a", 3, "enacted"), ("a", 4, ""), ("b", 1, "proposed"), ("c", 1, None), ("c", 2, "odd")], "k string, s int, status string")
    after, back = merge.guarded_values(patches, current, "k", "status", "s")
    assert {tuple(r) for r in after.collect()} == {("a", "enacted"), ("b", "proposed"), ("c", "enacted")}
    assert {tuple(r) for r in back.collect()} == {("a", 2, "proposed"), ("c", 2, "odd")}


def test_timeline_touch_overlay(spark):
    tl = spark.createDataFrame([("eu", "2026-01-01", "x")], "c string, d string, e string")
    p = spark.createDataFrame([("eu", "2026-01-01", "x", 1), ("eu", "2026-01-02", "x", 2), ("eu", "2026-01-02", "x", 3), ("eu", "soon", "y", 4)], "c string, d string, e string, s int")
    assert [r.s for r in merge.merge_timeline(p, tl, ["c"], "d", "e", "s").collect()] == [2]
    t = merge.touch(spark.createDataFrame([(1, "a", "a"), (2, None, "a"), (3, "z", "a")], "k int, last_checked string, last_changed string"), "m", F.col("k") == 1)
    assert [tuple(r) for r in t.orderBy("k").collect()] == [(1, "m", "m"), (2, None, "a"), (3, "z", "a")]
    base, over = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "o"), (3, "o")], "k int, v string")
    assert sorted(map(tuple, merge.overlay(base, over, "k").collect())) == [(1, "b"), (2, "o"), (3, "o")]
    assert sorted(map(tuple, merge.insert_absent(base, over, "k").collect())) == [(1, "b"), (2, "b"), (3, "o")]


def ts(h):
    return dt.datetime(2024, 1, 10, h)


def test_feed_and_page_steps(spark):
    items = spark.createDataFrame([("a", ts(1), 1), ("a", ts(2), 2), ("a", None, 3), ("b", ts(5), 4), ("b", dt.datetime(2024, 1, 1), 5)], "feed string, published timestamp, i int")
    marks = spark.createDataFrame([("a", ts(1)), ("c", ts(9))], "feed string, last_seen timestamp")
    fresh, late, after = incremental.feed_step(items, marks, "2024-01-11")
    assert sorted(r.i for r in fresh.collect()) == [2, 4] and sorted(r.i for r in late.collect()) == [1, 3, 5]
    assert {tuple(r) for r in after.collect()} == {("a", ts(2)), ("b", ts(5)), ("c", ts(9))}
    pages = spark.createDataFrame([("p", "x"), ("q", "y"), ("r", None)], "url string, text string")
    changed, hashes = incremental.page_step(pages, spark.createDataFrame([], "url string, hash string"))
    assert changed.count() == 0 and {r.url: r.hash[:8] for r in hashes.collect()}["r"] == "e3b0c442"
    changed, after = incremental.page_step(spark.createDataFrame([("p", "x2"), ("q", "y")], "url string, text string"), hashes)
    assert [r.url for r in changed.collect()] == ["p"] and after.count() == 3


def test_streams_give_what_batches_give(spark, tmp_path):
    landed = tmp_path / "in"
    rows = [("a", ts(1), 1), ("a", ts(2), 2), ("b", ts(5), 4)]
    spark.createDataFrame(rows, "feed string, published timestamp, i int").coalesce(1).write.parquet(str(landed))
    out: list[int] = []
    state = StateTable(spark, str(tmp_path / "marks"), catalog.MARKS)
    go = lambda: run_feeds(spark.readStream.schema("feed string, published timestamp, i int").parquet(str(landed)), state, "2024-01-11", lambda df, n: out.extend(r.i for r in df.collect()), str(tmp_path / "cp"))
    go()
    assert sorted(out) == [1, 2, 4]
    spark.createDataFrame([("a", ts(2), 5), ("a", ts(3), 6)], "feed string, published timestamp, i int").coalesce(1).write.mode("append").parquet(str(landed))
    go()
    assert sorted(out) == [1, 2, 4, 6]
    pages, seen = tmp_path / "pages", []
    hashes = StateTable(spark, str(tmp_path / "hashes"), catalog.HASHES)
    for text in ("x", "x", "z"):
        spark.createDataFrame([("p", text)], "url string, text string").coalesce(1).write.mode("append").parquet(str(pages))
        run_pages(spark.readStream.schema("url string, text string").parquet(str(pages)), hashes, lambda df, n: seen.extend(r.text for r in df.collect()), str(tmp_path / "cp2"))
    assert seen == ["z"]


def test_dated_links(spark):
    far = "x" * 450
    html = f"""<a href="/a#f">Rule of 2026-08-01</a>{far}<a href="b?utm_source=x&y=1">no date</a>{far}<a href="/c"></a>{far}
    <a href='https://H.example:443/d' aria-label='Notice'> </a> <div>Jul 22, 2026</div>{far}<a href="/a">again 3 May 2025</a>{far}<a href="/e">E</a><i>01/02/2026</i>"""
    got = links.dated_links(html, "https://site.example/x/y.html")
    assert [(t, u) for _, t, u in got] == [("Rule of 2026-08-01", "https://site.example/a"), ("Notice", "https://h.example/d"), ("E", "https://site.example/e")]
    many = "".join(f'<a href="/{i}">2026-01-01</a>' for i in range(30))
    assert len(links.dated_links(many, "https://s.example/")) == 20
    blanks = "".join(f'<a href="/{i}">D{i}</a>{d}{far}' for i, d in enumerate(("2026年\u30008月\u30001日", "2026.\u00a08.\n1", "Jul\u00a022, 2026", "2026 8 1")))
    assert [t for _, t, _ in links.dated_links(blanks, "https://s.example/")] == ["D0", "D1", "D2"]
    md = "[A](/a 'x') [B](/b) 2026年8月1日 ![i](/p.png) [j](javascript:x) [C](http://[bad)"
    assert [u for *_, u in links.dated_links(md, "https://s.example/", True)] == ["https://s.example/b"]
    pages = spark.createDataFrame([("https://s.example/", many, False), ("https://t.example/", None, False), ("https://u.example/", "plain", True)], "url string, text string, via_reader boolean")
    found = links.extract_dated_links(pages)
    assert found.count() == 20 and sorted(r.body for r in links.pages_for_review(pages, found).collect()) == ["https://t.example/", "https://u.example/"]


def test_text_functions(spark):
    assert one(spark, X.strip_html, "<style>a{}</style>A<b>b</b> <SCRIPT>x<y</SCRIPT>　c&amp;\n<!-- d -->") == "A b c&amp;"
    assert one(spark, X.event_label, "ＡＢ①　https://x.y/z カード・#1!") == "ab1 カード 1"
    assert one(spark, X.event_label, None) == "" and len(one(spark, X.event_label, "ab " * 99)) == 120
    assert one(spark, X.normalize_url, "HTTP://Ex.AM:80?utm_source=a&b=1&utm_campaign=c#f") == "http://ex.am/?b=1"
    assert one(spark, X.normalize_url, "no url") == "no url"
    for href, want in (("//o.x/a", "https://o.x/a"), ("/r", "https://h.x/r"), ("r", "https://h.x/d/r"), ("?q", "https://h.x/d/p?q"), ("mailto:a", "mailto:a")):
        assert one(spark, X.resolve_url, href, "https://h.x/d/p?z#y") == want
    assert one(spark, lambda c: X.news_search_url(c, "p", "s"), "AI 規制 ~'()!*") == "pAI%20%E8%A6%8F%E5%88%B6%20~'()!*s"
    assert one(spark, X.charset_name, None, '<meta charset="Shift_JIS">') == "shift_jis" and one(spark, X.charset_name, "text/html; charset=EUC-JP", "") == "euc-jp" and one(spark, X.charset_name, None, None) == "utf-8"
    assert one(spark, X.strip_reader_preamble, "Title: x\n2026-01-01\n\nMarkdown Content:\n2026年 8月1日 10:00\n body ") == " body "
    assert one(spark, lambda c: X.content_hash(c), "")[:8] == "e3b0c442"


def test_validation(spark):
    schema = "id string, date string, country string, axis string, change_type string, title string, summary struct<what:string,who:string,when_impact:string>, so_what string, impact struct<diff_changed:boolean,diff_note:string>, sources array<string>, country_anchor string, publication_date string, effective_date string, deadline_date string, canonical_event string"
    good = ("2026-01-01-eu-001", "2026-01-01", "eu", "general", "other", "t", ("a", "b", "c"), "s", (True, None), ["https://x.y"], "/c", None, None, "2026-13-45", None)
    bad = ("x", None, "EU", "odd", "odd", "t" * 121, ("a", None, "c" * 121), "", (None, None), [], None, "1", None, None, "")
    got = validate.violations(spark.createDataFrame([good, bad], schema), "id", validate.update_rules()).collect()
    assert {(r.path, r.rule) for r in got} == {("id", "pattern"), ("date", "required"), ("country", "pattern"), ("axis", "enum"), ("change_type", "enum"), ("title", "maxLength"), ("summary.who", "required"), ("summary.when_impact", "maxLength"), ("so_what", "minLength"), ("impact.diff_changed", "required"), ("sources", "minItems"), ("country_anchor", "required"), ("publication_date", "pattern"), ("canonical_event", "minLength")}
    raw = spark.createDataFrame([(1, '{"a": {"b": 1, "x": 2}, "y": [{"q": 1}]}'), (2, "no"), (3, None)], "k int, p string")
    assert sorted(r.path for r in validate.unknown_properties(raw, "k", "p", {"": {"a"}, "a": {"b"}}).collect()) == ["a.x", "y"]
    assert [r.valid for r in validate.meta_is_valid(spark.createDataFrame([("t", "ok"), (None, "ok"), ("t", "odd"), ("t", None)], "last_sweep string, status string")).collect()] == [True, False, False, False]


def test_catalog(spark, tmp_path):
    (tmp_path / "updates").mkdir()
    (tmp_path / "updates" / "2026-01.json").write_text('[{"id": "a", "date": "2026-01-02", "summary": {"what": "w"}}, {"id": "b", "date": "2026-01-03"}]', "utf-8")
    (tmp_path / "updates" / "2026-02.json").write_text("broken", "utf-8")
    (tmp_path / "meta.json").write_text('{"last_sweep": "t", "status": "ok"}', "utf-8")
    (tmp_path / "countries.json").write_text('{"countries": [{"code": "eu", "lat": 1.5, "official_sources": [{"url": "u", "type": "rss"}], "news_queries": ["q r"]}, {"code": "jp"}]}', "utf-8")
    (tmp_path / "regulations").mkdir()
    (tmp_path / "regulations" / "jp.json").write_text('{"jurisdiction": "jp", "status": "draft", "axes": {"penalties": {"summary": "s"}}}', "utf-8")
    c = catalog.Catalog(spark, str(tmp_path), str(tmp_path / "dry"))
    assert [r.id for r in c.updates().collect()] == ["b", "a"] and c.json("meta").first().status == "ok" and c.json("hashes").count() == 0
    assert [r.code for r in c.regulations(complete=False).collect()] == ["jp"] and c.regulation("eu").count() == 0
    with pytest.raises(FileNotFoundError, match="eu"):
        c.regulations()
    assert [tuple(r)[2:6] for r in catalog.enumerate_sources(c.countries()).collect()] == [("official_sources", 0, 0, "u"), ("news_queries", 2, 0, "q r")]
    base = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    base.write.parquet(str(tmp_path / "tbl"))
    assert c.read("tbl", "k").count() == 2
    c.write(spark.createDataFrame([(2, "o")], "k int, v string"), "tbl")
    assert sorted(map(tuple, c.read("tbl", "k").collect())) == [(1, "b"), (2, "o")]
    assert c.write(base, "parts", partition="v").endswith("dry/parts")


def test_feeds_and_decoding(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><link>l</link><pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate></item><item><link>m</link></item></channel></rss>", "utf-8")
    got = sorted((r.title, r.link, str(r.published)) for r in catalog.feed_items(spark, str(tmp_path / "f.xml")).collect())
    assert got == [("", "m", "None"), ("A", "l", "2026-08-05 10:00:00")]
    pages = spark.createDataFrame([(bytearray("規制".encode("cp932")), "shift_jis"), (bytearray("é".encode()), "no-such"), (None, None)], "body binary, cs string")
    assert [r.text for r in catalog.decode_pages(pages, F.col("cs")).collect()] == ["規制", "é", None]
    direct = spark.createDataFrame([("a", "t", None), ("b", None, "e1"), ("c", None, "e2")], "url string, text string, error string")
    got = catalog.direct_or_reader(direct, spark.createDataFrame([("b", "r")], "url string, text string")).orderBy("url").collect()
    assert [tuple(r) for r in got] == [("a", "t", False, None), ("b", "r", True, None), ("c", None, False, "fetch-failed:e2")]


def test_retry():
    class Busy(Exception):
        status = 429

    waits, answers = [], [Busy(), Busy(), "ok"]

    def call():
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    assert catalog.with_retry(call, sleep=waits.append) == "ok" and waits == [60, 120]
    answers[:] = [ValueError(), "late"]
    assert catalog.with_retry(call, sleep=waits.append) == "late"
    answers[:] = [ValueError(), ValueError()]
    with pytest.raises(ValueError):
        catalog.with_retry(call, sleep=waits.append)


def test_state_table(spark, tmp_path, monkeypatch):
    from jurisdiff.streaming.incremental import StateTable

    monkeypatch.setattr(StateTable, "COMPACT", 3)
    t, state = StateTable(spark, str(tmp_path / "state"), "url string, hash string"), {}
    for b in range(0, 9):
        assert {tuple(r) for r in t.read(b).collect()} == set(state.items()), b
        again = dict(state)
        state |= {f"u{b % 7}": f"h{b}", f"n{b // 3}": None if b % 3 else "x"}
        for _ in range(2 if b in (2, 3) else 1):  # a batch that runs again gives the same
            t.write(spark.createDataFrame(sorted(state.items(), key=str), "url string, hash string").coalesce(1), b)
            assert {tuple(r) for r in t.read(b).collect()} == set(again.items())
    kept = sorted(p.name for p in (tmp_path / "state").iterdir())
    assert kept == ["d4", "d5", "d7", "d8", "w3", "w6"] and spark.read.parquet(str(tmp_path / "state" / "d8")).count() == 1
