"""Pages over a small catalogue."""

import json

import pytest

from jurisdiff.plans import site
from jurisdiff.plans.views import matrix, matrix_table
from jurisdiff.sources.catalog import Catalog


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("site")
    (root / "countries.json").write_text(json.dumps({"countries": [{"code": "jp", "name_ja": "日本", "flag": "J", "lat": 1.0, "lng": 2.0}, {"code": "eu", "name_ja": "EU", "flag": "E", "lat": 3.0, "lng": 4.0}]}), "utf-8")
    for d in ("regulations", "updates"):
        (root / d).mkdir()
    entry = lambda t, s: {"topic": t, "note": "n", "source": s}
    jp = {"jurisdiction": "jp", "regulation_name": "R", "status": "enacted", "approach": "soft_law", "axes": {"penalties": {"summary": "p", "sources": ["s1", "s2"]}, "timeline": [{"date": "2026-01-01", "event": "a", "source": "s2"}, {"date": "2030-01-01", "event": "b", "source": "s3"}]}, "diff_vs_eu": {"stricter": [entry("x", "s1"), entry("y", "s4")], "looser": [], "unique": [entry("z", "s4")]}, "last_checked": "2026-08-02T00:00:00Z", "last_changed": "2026-08-01T00:00:00Z"}
    eu = {"jurisdiction": "eu", "regulation_name": "B", "status": "odd", "is_baseline": True, "last_checked": "2026-08-02T00:00:00Z", "last_changed": "no"}
    (root / "regulations" / "jp.json").write_text(json.dumps(jp), "utf-8")
    (root / "regulations" / "eu.json").write_text(json.dumps(eu), "utf-8")
    (root / "updates" / "2026-08.json").write_text(json.dumps([{"id": i, "date": d, "country": c} for i, d, c in (("a", "2026-08-01", "jp"), ("b", "2026-08-03", "xx"), ("c", "2026-08-03", "eu"), ("d", "2026-07-01", "jp"))]), "utf-8")
    c = Catalog(spark, str(root))
    return c.countries(), c.json("regulations"), c.json("updates")


def test_home(tables):
    latest, markers, chips = site.home(*tables, "2026-08-05")
    assert [(r.id, r.flag) for r in latest.collect()] == [("b", None), ("c", "E"), ("a", "J")]
    assert [(r.lat, r.recent, r.size) for r in markers.collect()] == [(1.0, True, 0.1), (3.0, False, 0.05)]
    assert [(r.code, r.status, r.approach) for r in chips.collect()] == [("jp", "成立", "ソフトロー"), ("eu", "odd", None)]


def test_country_page(tables):
    page = site.country_page(*tables, "jp", "2026-08-05")
    assert [(r.no, r.summary) for r in page["axes"].collect()] == [("01", "—"), ("02", "—"), ("03", "—"), ("04", "—"), ("05", "p"), ("06", "—")]
    assert [(r.list, r.pos, r.topic) for r in page["diffs"].collect()] == [("stricter", 0, "x"), ("stricter", 1, "y"), ("unique", 0, "z")]
    assert tuple(page["sizes"].first())[1:] == (2, 0, 0, 1)
    assert [(r.date, r.is_future) for r in page["timeline"].collect()] == [("2030-01-01", True), ("2026-01-01", False)]
    assert page["sources"].first().sources == ["s1", "s2", "s3", "s4"]
    assert page["report"].first().report == "【日本のAI規制とEU AI Actの差分】2026-08-02時点\n規制名: R（状態: 成立）\n■ EUより厳しい: x、y\n■ EUより緩い: なし\n■ 規定なし: なし\n■ 独自規定: z\n出典: s1 s4"
    assert [r.id for r in page["updates"].collect()] == ["a", "d"]
    assert all(df.count() == 0 for df in site.country_page(*tables, "zz", "2026-08-05").values())
    assert site.country_page(*tables, "eu", "2026-08-05")["report"].count() == 0


def test_matrix_and_queue(spark, tables):
    m = matrix(tables[0], matrix_table(spark)).orderBy("place").collect()
    assert [(r.code, r.risk_classification, r.penalties) for r in m] == [("eu", "baseline", "baseline"), ("jp", "looser", "absent")]
    rec = spark.createDataFrame([("eu", "t", True, None), ("jp", "u", None, "x")], "country string, title string, diff_changed boolean, diff_note string")
    q = site.issues(rec, spark.createDataFrame([("eu", "draft")], "country string, status string"), spark.createDataFrame([("u" * 99, "m")], "url string, message string"))
    assert sorted((r.labels[0], len(r.title)) for r in q.collect()) == [("diff-change", 24), ("needs-review", 26), ("needs-review", 88)]
    assert json.loads(site.prompt_rows(spark.createDataFrame([(1, "t", "s" * 400, None)], "seq int, title string, snippet string, country_hint string")).first().payload)["snippet"] == "s" * 300
    assert site.bad_status(spark.createDataFrame([("t", "ok"), ("t", None)], "last_sweep string, status string")).count() == 1
