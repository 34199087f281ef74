"""Event queries fold compatibility forms; held against brute force."""

import re
import unicodedata

from jurisdiff.plans.pipeline import QUERIES

# row_key, country, change_type, canonical_event, title, batch_no, date
ROWS = [
    (1, "EU", None, "ＡＩ　Ａｃｔ　２０２６", "a", 0, "2026-09-01"), (2, "EU", "new_regulation", "ai act 2026", "b", 0, "2026-09-02"), (3, "EU", None, "AI-Act ２０２６", "c", 1, "2026-09-03"), (4, "FR", None, "ＡＩ Act 2026", "d", 1, "2026-09-03"),
    (5, "JP", None, None, "ﾃﾞｰﾀ規制①", 0, "2026-09-04"), (6, "JP", "deadline_change", "データ規制1", "e", 1, "2026-09-05"), (7, "JP", None, "", "データ 規制 1", 1, "2026-09-05"), (8, "US", None, None, "ﬁling №5", 1, "2026-09-06"), (9, "US", None, "filing No5", "f", 2, "2026-09-06"),
]


def label(s):
    s = re.sub(r"https?://\S+", " ", unicodedata.normalize("NFKC", (s or "").lower()))
    return " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in s).split())[:120]


def dedupe(rows, known=()):
    best, dropped = {}, []
    rank = lambda r: 2 if r[2] in ("new_regulation", "status_change") else 1 if r[2] in ("guideline_draft", "deadline_change") else 0
    for r in rows:
        k = r[1], label(r[3] or r[4])
        if k in known:
            dropped.append(r[0])
        elif k not in best or rank(r) > rank(best[k]):
            dropped += [best[k][0]] if k in best else []
            best[k] = r
        else:
            dropped.append(r[0])
    return {(r[0], *k) for k, r in best.items()}, set(dropped)


def test_full_and_half_width_labels_are_one_event(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "row_key bigint, country string, change_type string, canonical_event string, title string, batch_no bigint, date string")
    df.selectExpr("*", "cast(row_key as string) id").coalesce(1).write.parquet(f"{tmp_path}/updates.parquet")
    rows = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    kept, dropped = dedupe(ROWS)
    assert {(r.row_key, r.cc.upper(), r.label) for r in rows("event_dedupe")} == kept and len(kept) == 6
    assert {r.row_key for r in rows("event_dedupe_drops")} == dropped
    kept, dropped = dedupe([r for r in ROWS if r[5]], {(r[1], label(r[3] or r[4])) for r in ROWS if not r[5]})
    got = {r.row_key: r.outcome for r in rows("existing_event_antijoin")}
    assert {k for k, o in got.items() if o == "kept"} == {r[0] for r in kept} and {k for k, o in got.items() if o != "kept"} == dropped
    assert {r.row_key: r.label for r in rows("existing_titles")} == {r[0]: r[3] or label(r[4]) for r in ROWS}
