"""Queries of the ingestion pipeline over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurisdiff.functions.codes import norm_code, norm_term
from jurisdiff.functions.text import event_label, first_truthy, is_news_search, month_key, news_search_url, normalize_url, strip_html, url_host
from jurisdiff.functions.values import KEYWORDS, LIST_DAYS, MAX_PER_RUN, RECENCY_DAYS, STATUS_ORDER
from jurisdiff.operators.dedupe import dedupe_events, existing_event_keys, first_per_url, top_of_run
from jurisdiff.operators.gates import mechanical_gate, publication_reason, reason_histogram, split_by_reason
from jurisdiff.operators.incremental import feed_step, page_step, run_status
from jurisdiff.operators.merge import allocate_ids, build_updates, guarded_values, merge_timeline, overlay, touch
from jurisdiff.operators.validate import failing, snapshot_rules, update_rules, violations
from jurisdiff.plans.general import _B, _code, _term, _trim
from jurisdiff.sources.catalog import enumerate_sources, existing_titles

AS_OF = "2026-09-15"
NEWS_PREFIX, NEWS_SUFFIX = "https://news.example/rss/search?q=", "&hl=en"
NOW = "2026-01-01T00:00:00Z"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _label():
    return event_label(first_truthy(F.col("canonical_event"), F.col("title")))


def _priority():
    return F.when(F.col("change_type").isin("new_regulation", "status_change"), "high").when(F.col("change_type").isin("guideline_draft", "deadline_change"), "low")


def strip_html_q(spark, sf):
    """Text of every document without markup: length and hash."""
    d = _t(spark, sf, "documents").select("doc_id", strip_html(F.col("text")).alias("t"))
    return d.select("doc_id", F.length("t").cast("bigint").alias("n_chars"), F.sha2("t", 256).alias("digest"))


def normalize_url_q(spark, sf):
    """Addresses of documents: normal form, host, search-news host."""
    return _t(spark, sf, "documents").where("url is not null").select("doc_id", normalize_url(F.col("url")).alias("url_norm"), url_host(F.col("url")).alias("host"), is_news_search(F.col("url")).alias("is_news"))


def url_first_wins(spark, sf):
    """The update that names each source, in its normal form, first."""
    u = _t(spark, sf, "updates").select("row_key", F.posexplode(F.transform("sources", normalize_url)).alias("pos", "url"))
    kept, _ = first_per_url(u.select("row_key", "url", F.struct("row_key", "pos").alias("seq")))
    return kept.select("url", "row_key")


def mechanical_gate_q(spark, sf):
    """Reason every document is dropped for; null: none."""
    return mechanical_gate(_t(spark, sf, "documents").select("doc_id", "url", "text")).select("doc_id", "reason")


def gate_histogram(spark, sf):
    return reason_histogram(mechanical_gate_q(spark, sf))


def gate_drops(spark, sf):
    """Drops of the gate as they are logged."""
    d = mechanical_gate(_t(spark, sf, "documents").select("doc_id", "url", "text", "country"))
    return split_by_reason(d, F.col("url"), F.col("country"))[1]


def publication_gate(spark, sf):
    """Reason every update's publication date is dropped for; null: none."""
    return _t(spark, sf, "updates").select("row_key", publication_reason(F.col("publication_date"), AS_OF).alias("reason"))


def publication_histogram(spark, sf):
    return reason_histogram(publication_gate(spark, sf))


def event_labels(spark, sf):
    return _t(spark, sf, "updates").select("row_key", _label().alias("label"))


def _items(spark, sf):
    code = norm_code(F.col("country"))
    u = _t(spark, sf, "updates")
    return u.select(F.col("row_key").alias("seq"), F.when(code.isNotNull(), F.array(code)).alias("countries"), F.lit(None).cast("string").alias("country_hint"), _priority().alias("priority"), _label().alias("label"), "batch_no")


def event_dedupe(spark, sf):
    """One update per country and event label, in the order of the label's first update."""
    return dedupe_events(_items(spark, sf))[0].select(F.col("seq").alias("row_key"), "cc", "label", F.col("out_seq"))


def event_dedupe_drops(spark, sf):
    return dedupe_events(_items(spark, sf))[1].select(F.col("seq").alias("row_key"), "cc", "reason")


def existing_event_antijoin(spark, sf):
    """Batch updates whose event the last 90 days of accepted ones don't hold, and the others with their reason."""
    u = _t(spark, sf, "updates").where("batch_no = 0").withColumn("country", norm_code(F.col("country")))
    known = existing_event_keys(u, _label(), AS_OF, RECENCY_DAYS)
    kept, drops = dedupe_events(_items(spark, sf).where("batch_no >= 1"), known)
    return kept.select(F.col("seq").alias("row_key"), F.lit("kept").alias("outcome")).unionByName(drops.select(F.col("seq").alias("row_key"), F.col("reason").alias("outcome")))


def verdict_join(spark, sf):
    """Classified candidates that are relevant and no duplicates; a verdict without candidate, or the other way round, is skipped."""
    verdicts = _t(spark, sf, "documents").select(F.col("doc_id").alias("idx"), (F.col("doc_type") != "minutes").alias("relevant"), F.col("lang").isNull().alias("duplicate"), "doc_type")
    cands = _t(spark, sf, "updates").select(F.col("row_key").alias("idx"), "title", "country")
    return cands.join(verdicts.where(F.coalesce(F.col("relevant"), F.lit(False)) & ~F.coalesce(F.col("duplicate"), F.lit(False))), "idx").select("idx", "country", "doc_type")


def country_whitelist(spark, sf):
    """Countries of each update that are configured, in order and with repeats; updates with none are left out."""
    codes = _t(spark, sf, "country").select(norm_code(F.col("code")).alias("cc")).where("cc is not null").distinct()
    named = F.array(norm_code(F.col("country")), norm_code(F.regexp_extract("country_anchor", "/country/([^/]*)/", 1)))
    return _t(spark, sf, "updates").select("row_key", F.posexplode(named).alias("pos", "cc")).join(codes, "cc", "left_semi").select("row_key", "pos", "cc")


def priority_topk(spark, sf):
    """The first eight updates of a run, high priority before the others."""
    u = _t(spark, sf, "updates").select("row_key", _priority().alias("priority"))
    return top_of_run(u, "row_key", MAX_PER_RUN)[0]


def over_cap(spark, sf):
    """The updates beyond them, which the run would lose."""
    u = _t(spark, sf, "updates").select("row_key", _priority().alias("priority"))
    return top_of_run(u, "row_key", MAX_PER_RUN)[1].select("row_key", "reason")


def id_allocation(spark, sf):
    """New identifiers of the batches' updates, behind those of the history."""
    u = _t(spark, sf, "updates").withColumn("cc", norm_code(F.col("country")))
    new = u.where("batch_no >= 1 and date is not null and cc is not null")
    return allocate_ids(new.select("row_key", "date", "cc"), u.where("batch_no = 0").select("id"), "date", "cc", "row_key").select("row_key", "id")


def month_partition(spark, sf):
    """Updates per publication month, the partition they are appended to."""
    return _t(spark, sf, "updates").groupBy(month_key(F.col("publication_date")).alias("month")).agg(F.count("*").alias("n"))


def build_update(spark, sf):
    """Update rows built from extracted records, flattened."""
    u = _t(spark, sf, "updates").withColumn("cc", norm_code(F.col("country")))
    records = u.select("id", F.col("cc").alias("country"), F.col("sources")[0].alias("url"), "axis", "change_type", "title", "summary.what", "summary.who", "summary.when_impact", "detail", "so_what", "impact.diff_changed", "impact.diff_note", "canonical_event", "publication_date", "effective_date", "deadline_date")
    b = build_updates(records)
    return b.select("id", "date", "country", "axis", "change_type", "title", *[F.col(f"summary.{c}").alias(c) for c in ("what", "who", "when_impact")], "detail", "so_what", "impact.diff_changed", "impact.diff_note", "canonical_event", "publication_date", "effective_date", "deadline_date", F.col("sources")[0].alias("source"), "country_anchor", "month")


def _feeds(spark, sf):
    e = _t(spark, sf, "events").select(F.col("user_id").alias("feed"), F.col("ts").alias("published"), "event_id")
    marks = e.where("published < timestamp'2024-01-16'").groupBy("feed").agg(F.max("published").alias("last_seen"))
    return feed_step(e, marks, "2024-01-31")


def feed_high_water(spark, sf):
    """Items later than their feed's mark; feeds without one start three days back."""
    return _feeds(spark, sf)[0].select("event_id")


def feed_late_drops(spark, sf):
    return _feeds(spark, sf)[1].select("event_id")


def feed_marks(spark, sf):
    return _feeds(spark, sf)[2].select("feed", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"))


def _sweep(spark, sf, until):
    s = _t(spark, sf, "regulation_snapshots").where(F.col("snapshot_at") < F.lit(until).cast("timestamp"))
    state = F.concat_ws("|", F.coalesce(norm_term(F.col("status")), F.lit("-")), F.coalesce(norm_term(F.col("approach")), F.lit("-")), F.coalesce("regulation_name", F.lit("-")))
    return s.groupBy(F.col("regulation_id").alias("url")).agg(F.max_by(state, F.struct("snapshot_at", "snapshot_key")).alias("text"))


def page_hash_change(spark, sf):
    """Regulations whose record differs between two sweeps; those seen first are silent."""
    _, hashes = page_step(_sweep(spark, sf, "2026-03-15"), spark.createDataFrame([], "url string, hash string"))
    return page_step(_sweep(spark, sf, "2026-07-15"), hashes)[0].select("url")


def page_hashes(spark, sf):
    """The hashes after that run, of all regulations ever seen."""
    _, hashes = page_step(_sweep(spark, sf, "2026-03-15"), spark.createDataFrame([], "url string, hash string"))
    return page_step(_sweep(spark, sf, "2026-07-15"), hashes)[1]


def sources_enum(spark, sf):
    """Every source of every country, group by group."""
    return enumerate_sources(_t(spark, sf, "country")).select("code", "ord", "source_group", F.col("pos").cast("bigint").alias("pos"), "source", "type")


def news_urls(spark, sf):
    """Search-feed addresses of the news queries."""
    return _t(spark, sf, "country").select("ord", F.posexplode("news_queries").alias("pos", "q")).select("ord", F.col("pos").cast("bigint").alias("pos"), news_search_url(F.col("q"), NEWS_PREFIX, NEWS_SUFFIX).alias("url"))


def existing_titles_q(spark, sf):
    """Titles and labels of the last 60 days, as the classifier is given them."""
    return existing_titles(_t(spark, sf, "updates").withColumnRenamed("id", "uid").withColumnRenamed("row_key", "id"), AS_OF, LIST_DAYS, F.coalesce(F.nullif("canonical_event", F.lit("")), event_label(F.col("title")))).select(F.col("id").alias("row_key"), "title", "label")


def _patches(spark, sf):
    s = _t(spark, sf, "regulation_snapshots").select("regulation_id", "snapshot_key", norm_term(F.col("status")).alias("status"))
    first = s.groupBy("regulation_id").agg(F.min("snapshot_key").alias("snapshot_key"))
    current = s.join(first, ["regulation_id", "snapshot_key"], "left_semi")
    return guarded_values(s.join(first, ["regulation_id", "snapshot_key"], "left_anti"), current, "regulation_id", "status", "snapshot_key")


def status_merge(spark, sf):
    """The status of each regulation after all deliveries, which never steps back."""
    return _patches(spark, sf)[0]


def status_regress(spark, sf):
    """The deliveries that would have stepped back."""
    return _patches(spark, sf)[1]


def timeline_merge(spark, sf):
    """Entries of the batches to add to the timeline of the history."""
    u = _t(spark, sf, "updates").select(norm_code(F.col("country")).alias("cc"), F.col("effective_date").alias("day"), F.col("canonical_event").alias("event"), "row_key", "batch_no")
    return merge_timeline(u.where("batch_no >= 1"), u.where("batch_no = 0"), ["cc"], "day", "event", "row_key").select("row_key", "cc", "day")


def touch_last_checked(spark, sf):
    s = _t(spark, sf, "regulation_snapshots")
    return touch(s, NOW, F.coalesce(norm_term(F.col("status")) == "enacted", F.lit(False))).select("snapshot_key", "last_checked", "last_changed")


def overlay_read(spark, sf):
    """The batches' updates, and those of the history whose id they don't hold."""
    u = _t(spark, sf, "updates").select("row_key", "id", "batch_no")
    return overlay(u.where("batch_no = 0"), u.where("batch_no >= 1"), "id").select("row_key")


def validate_updates(spark, sf):
    """Every broken rule of every update."""
    return violations(_t(spark, sf, "updates"), "row_key", update_rules())


def validate_snapshots(spark, sf):
    return violations(_t(spark, sf, "regulation_snapshots"), "snapshot_key", snapshot_rules())


def validation_counts(spark, sf):
    """Errors per table, which gate the commit."""
    u = validate_updates(spark, sf).select(F.lit("updates").alias("src"))
    return failing(u.unionByName(validate_snapshots(spark, sf).select(F.lit("regulation_snapshots").alias("src"))), "src")


def run_status_q(spark, sf):
    """Outcome of a run in which a dropped document counts as a failure."""
    return run_status(mechanical_gate_q(spark, sf).select(F.col("reason").isNull().alias("ok")))


def json_props(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


QUERIES = {
    "strip_html": strip_html_q, "normalize_url": normalize_url_q, "url_first_wins": url_first_wins, "mechanical_gate": mechanical_gate_q, "gate_histogram": gate_histogram, "gate_drops": gate_drops,
    "publication_gate": publication_gate, "publication_histogram": publication_histogram, "event_labels": event_labels, "event_dedupe": event_dedupe, "event_dedupe_drops": event_dedupe_drops,
    "existing_event_antijoin": existing_event_antijoin, "verdict_join": verdict_join, "country_whitelist": country_whitelist, "priority_topk": priority_topk, "over_cap": over_cap, "id_allocation": id_allocation, "month_partition": month_partition,
    "build_update": build_update, "feed_high_water": feed_high_water, "feed_late_drops": feed_late_drops, "feed_marks": feed_marks, "page_hash_change": page_hash_change, "page_hashes": page_hashes, "sources_enum": sources_enum, "news_urls": news_urls,
    "existing_titles": existing_titles_q, "status_merge": status_merge, "status_regress": status_regress, "timeline_merge": timeline_merge, "touch_last_checked": touch_last_checked, "overlay_read": overlay_read,
    "validate_updates": validate_updates, "validate_snapshots": validate_snapshots, "validation_counts": validation_counts, "run_status": run_status_q, "json_props": json_props,
}

_strip = lambda c: rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '(?is)<script\b[^>]*>.*?</script>', '', 'g'), '(?is)<style\b[^>]*>.*?</style>', '', 'g'), '<[^>]+>', ' ', 'g'), '{_B}+', ' ', 'g'))"""
_FOLDS = {c: n for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]) if (n := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c)}
_list = lambda xs: "['" + "', '".join(x.replace("'", "''") for x in xs) + "']"


def _class_of(chars) -> str:
    """A regular expression's class of characters, as ranges."""
    out: list[list[int]] = []
    for c in map(ord, chars):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


#: The compatibility form in SQL, from the character data: each character by its own form, then all composed.
_nfkc = lambda c: f"nfc_normalize(case when regexp_matches({c}, '{_class_of(_FOLDS)}') then list_aggregate(list_transform(regexp_extract_all({c}, '(?s).'), lambda x: coalesce(map({_list(_FOLDS)}, {_list(_FOLDS.values())})[x], x)), 'string_agg', '') else {c} end)"
_sql_label = lambda c: rf"""substring(trim(regexp_replace(regexp_replace(regexp_replace({_nfkc(f"lower(coalesce({c}, ''))")}, 'https?://{_B.replace("[", "[^", 1)}+', ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' +', ' ', 'g')), 1, 120)"""
_normal = lambda source, key: rf"""a as (select {key}, url, regexp_replace(url, '#.*$', '') u from {source}),
b as (select {key}, url, regexp_replace(regexp_replace(regexp_replace(u, '([?&])utm_source=[^&]*', '\1', 'g'), '([?&])utm_medium=[^&]*', '\1', 'g'), '([?&])utm_campaign=[^&]*', '\1', 'g') u from a),
c as (select {key}, url, regexp_replace(regexp_replace(regexp_replace(u, '&&+', '&', 'g'), '\?&', '?', 'g'), '[?&]$', '') u from b),
d as (select {key}, url, u, lower(regexp_extract(u, '^(?i:https?)://[^/?]+')) o, regexp_replace(u, '^(?i:https?)://[^/?]+', '') rest from c),
n as (select {key}, url, case when o = '' then url else regexp_replace(regexp_replace(o, '^(http://[^/]*):80$', '\1'), '^(https://[^/]*):443$', '\1') || case when rest = '' then '/' when rest like '?%' then '/' || rest else rest end end url_norm from d)"""  # noqa: E731
_ROW_LABEL = _sql_label("coalesce(nullif(canonical_event, ''), nullif(title, ''))")
_LISTED = " or ".join(f"contains(l, lower('{k}'))" for k in KEYWORDS)
_GATE = f"""gate as (
  select doc_id, url, country, case
    when coalesce(h = 'news.google.com' or h like '%.news.google.com' or h = 'news.url.google.com', false) then 'google-news-source'
    when length({_trim("t")}) < 600 then 'body-too-short'
    when not ({_LISTED}) then 'no-ai-reg-keyword'
    when contains(l, 'enable javascript') or contains(l, 'cookie consent') or contains(l, 'accept all cookies') or len(regexp_extract_all(t, 'function\\s*\\(\\)\\s*\\{{')) >= 20 then 'blocked-or-js-only-page' end reason
  from (select doc_id, url, country, coalesce(text, '') t, lower(coalesce(text, '')) l, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) h from documents)
)"""
_ymd = lambda c: rf"coalesce(regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}$'), false)"
_roll = lambda c: f"cast(make_date(cast({c}[1:4] as bigint), 1, 1) + to_months(cast({c}[6:7] as integer) - 1) + to_days(cast({c}[9:10] as integer) - 1) as date)"
_PUB = f"""pub as (select row_key, case when not {_ymd("publication_date")} then 'missing-publication-date'
  when date '{AS_OF}' - {_roll("publication_date")} >= 90 then 'stale-publication-date' end reason from updates)"""
_HIST = "select reason, count(*) n from {0} where reason is not null group by 1 union all select 'total', count(*) from {0} where reason is not null"
_PRIO = "case when change_type in ('new_regulation', 'status_change') then 2 when change_type in ('guideline_draft', 'deadline_change') then 1 else 0 end"
_ITEMS = f"items as (select row_key, batch_no, {_code('country')} cc, {_PRIO} rank, {_ROW_LABEL} label, date from updates)"
_RANKED = "ranked as (select *, row_number() over (partition by cc, label order by rank desc, row_key) rn, min(row_key) over (partition by cc, label) out_seq from items where label <> '' and cc is not null)"
_MARKS = """e as (select user_id feed, event_id, cast(ts as timestamp) published from events), m as (select feed, max(published) last_seen from e where published < timestamp '2024-01-16' group by 1),
j as (select e.*, coalesce(m.last_seen, timestamp '2024-01-31' - interval 3 day) mark from e left join m using (feed))"""
_SWEEP = lambda d: f"""(select regulation_id url, arg_max(coalesce({_term("status")}, '-') || '|' || coalesce({_term("approach")}, '-') || '|' || coalesce(regulation_name, '-'), (snapshot_at, snapshot_key)) t
  from regulation_snapshots where snapshot_at < timestamptz '{d} 00:00:00+00' group by 1)"""  # noqa: E731
_RANK = lambda c: f"coalesce(list_position({STATUS_ORDER}, {c}), 0)"
_PATCH = f"""s as (select regulation_id, snapshot_key, {_term("status")} status, row_number() over (partition by regulation_id order by snapshot_key) rn from regulation_snapshots),
c as (select regulation_id, status as old, {_RANK("status")} old_rank from s where rn = 1),
p as (select regulation_id, snapshot_key, status, {_RANK("status")} rank from s where rn > 1 and status is not null)"""
_rule = lambda key, table, rules: "\nunion all\n".join(f"select {key}, '{p}' path, '{r}' as \"rule\" from {table} where coalesce({bad}, false)" for p, r, bad in rules)
_VU = _rule("row_key", "updates", [
    *[(c, "required", f"{c} is null") for c in ("id", "date", "country", "axis", "change_type", "title", "summary", "so_what", "impact", "sources", "country_anchor")],
    *[(f"summary.{c}", "required", f"summary is not null and summary.{c} is null") for c in ("what", "who", "when_impact")],
    ("impact.diff_changed", "required", "impact is not null and impact.diff_changed is null"),
    ("id", "pattern", r"not regexp_matches(id, '^\d{4}-\d{2}-\d{2}-[a-z]{2}-\d{3}$')"), ("country", "pattern", "not regexp_matches(country, '^[a-z]{2}$')"),
    *[(c, "pattern", rf"not regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}$')") for c in ("date", "publication_date", "effective_date", "deadline_date")],
    ("axis", "enum", "axis not in ('risk_classification', 'prohibited_uses', 'gpai_obligations', 'transparency', 'penalties', 'enforcement_body', 'timeline', 'general')"),
    ("change_type", "enum", "change_type not in ('new_regulation', 'status_change', 'guideline_draft', 'deadline_change', 'diff_change', 'other')"),
    ("title", "minLength", "length(title) < 1"), ("so_what", "minLength", "length(so_what) < 1"), ("canonical_event", "minLength", "length(canonical_event) < 1"),
    *[(c, "maxLength", f"length({c}) > 120") for c in ("title", "summary.what", "summary.who", "summary.when_impact")],
    ("sources", "minItems", "len(sources) < 1"), ("sources", "format", "len(list_filter(sources, lambda u: not regexp_matches(coalesce(u, ''), '^[A-Za-z][A-Za-z0-9+.-]*:'))) > 0"),
])
_VS = _rule("snapshot_key", "regulation_snapshots", [
    *[(c, "required", f"{c} is null") for c in ("jurisdiction", "regulation_name", "status", "approach", "last_checked", "last_changed")],
    ("jurisdiction", "pattern", "not regexp_matches(jurisdiction, '^[a-z]{2}$')"), ("regulation_name", "minLength", "length(regulation_name) < 1"),
    ("status", "enum", "status not in ('proposed', 'draft', 'consultation', 'enacted', 'in_force')"), ("approach", "enum", "approach not in ('risk_based', 'sectoral', 'soft_law')"),
    *[(c, "format", f"{c} is not null and try_cast({c} as timestamptz) is null") for c in ("last_checked", "last_changed")],
])

ORACLES = {
    "strip_html": f"select doc_id, length(t) n_chars, sha256(t) digest from (select doc_id, {_strip('text')} t from documents)",
    "normalize_url": f"""with {_normal("documents where url is not null", "doc_id")}
select doc_id, url_norm, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) host, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) in ('news.google.com', 'news.url.google.com') or lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) like '%.news.google.com' is_news from n""",
    "url_first_wins": f"""with {_normal("(select struct_pack(r := row_key, p := pos) k, url from (select row_key, unnest(sources) url, generate_subscripts(sources, 1) pos from updates))", "k")}
select url_norm url, arg_min(k.r, k) row_key from n where coalesce(url_norm, '') <> ''
  and lower(regexp_extract(url_norm, '^[A-Za-z]+://([^/?#:]+)', 1)) not in ('news.google.com', 'news.url.google.com') and lower(regexp_extract(url_norm, '^[A-Za-z]+://([^/?#:]+)', 1)) not like '%.news.google.com' group by 1""",
    "mechanical_gate": f"with {_GATE} select doc_id, reason from gate",
    "gate_histogram": f"with {_GATE} " + _HIST.format("gate"),
    "gate_drops": f"with {_GATE} select coalesce(url, '') url, reason, nullif(country, '') country from gate where reason is not null",
    "publication_gate": f"with {_PUB} select * from pub",
    "publication_histogram": f"with {_PUB} " + _HIST.format("pub"),
    "event_labels": f"select row_key, {_ROW_LABEL} label from updates",
    "event_dedupe": f"with {_ITEMS}, {_RANKED} select row_key, cc, label, out_seq from ranked where rn = 1",
    "event_dedupe_drops": f"with {_ITEMS}, {_RANKED} select row_key, cc, 'duplicate-event-lower-priority' reason from ranked where rn > 1",
    "existing_event_antijoin": f"""with {_ITEMS}, known as (select distinct cc, label from items where batch_no = 0 and label <> '' and date >= strftime(date '{AS_OF}' - 90, '%Y-%m-%d')),
n as (select i.*, k.cc is not null dup from items i left join known k on i.cc = k.cc and i.label = k.label where batch_no >= 1 and i.label <> '' and i.cc is not null),
r as (select *, row_number() over (partition by cc, label order by rank desc, row_key) rn from n where not dup)
select row_key, 'duplicate-existing-event' outcome from n where dup union all select row_key, case when rn = 1 then 'kept' else 'duplicate-event-lower-priority' end from r""",
    "verdict_join": "select u.row_key idx, u.country, d.doc_type from updates u join documents d on u.row_key = d.doc_id where d.doc_type <> 'minutes' and d.lang is not null",
    "country_whitelist": f"""with x as (select row_key, 0 pos, {_code("country")} cc from updates union all select row_key, 1, {_code("regexp_extract(country_anchor, '/country/([^/]*)/', 1)")} from updates)
select row_key, cast(pos as integer) pos, cc from x where cc in (select {_code("code")} from country)""",
    "priority_topk": """select row_key, case when change_type in ('new_regulation', 'status_change') then 'high' when change_type in ('guideline_draft', 'deadline_change') then 'low' end priority
  from updates order by case when change_type in ('new_regulation', 'status_change') then 0 else 1 end, row_key limit 8""",
    "over_cap": "select row_key, 'over-cap' reason from (select row_key, row_number() over (order by case when change_type in ('new_regulation', 'status_change') then 0 else 1 end, row_key) rn from updates) where rn > 8",
    "id_allocation": rf"""with n as (select row_key, date || '-' || {_code("country")} || '-' prefix from updates where batch_no >= 1),
used as (select regexp_extract(id, '^(.*-)(\d+)$', 1) prefix, max(try_cast(regexp_extract(id, '^(.*-)(\d+)$', 2) as bigint)) m from updates where batch_no = 0 group by 1),
k as (select row_key, n.prefix, coalesce(m, 0) + row_number() over (partition by n.prefix order by row_key) q from n left join used using (prefix) where n.prefix is not null)
select row_key, prefix || case when length(cast(q as varchar)) < 3 then lpad(cast(q as varchar), 3, '0') else cast(q as varchar) end id from k""",
    "month_partition": 'select publication_date[1:7] as "month", count(*) n from updates group by 1',
    "build_update": f"""select id, publication_date date, {_code("country")} country, axis, change_type, title[1:120] title, summary.what[1:120] what, summary.who[1:120] who, summary.when_impact[1:120] when_impact, nullif(detail, '') detail, so_what,
  coalesce(impact.diff_changed, false) diff_changed, coalesce(impact.diff_note, '') diff_note, coalesce(nullif(canonical_event, ''), title) canonical_event, publication_date, effective_date, deadline_date, sources[1] source,
  '/country/' || {_code("country")} || '/#axis-' || case when axis in ('timeline', 'general') then 'risk_classification' else axis end country_anchor, publication_date[1:7] as "month" from updates""",
    "feed_high_water": f"with {_MARKS} select event_id from j where published > mark",
    "feed_late_drops": f"with {_MARKS} select event_id from j where not coalesce(published > mark, false)",
    "feed_marks": f"with {_MARKS} select feed, strftime(max(published), '%Y-%m-%d %H:%M:%S') last_seen from e group by 1",
    "page_hash_change": f"select n.url from {_SWEEP('2026-07-15')} n join {_SWEEP('2026-03-15')} o using (url) where n.t <> o.t",
    "page_hashes": f"select url, sha256(t) hash from {_SWEEP('2026-07-15')}",
    "sources_enum": """with g as (select ord, code, 'official_sources' source_group, official_sources items from country union all select ord, code, 'watch_feeds', watch_feeds from country)
select code, ord, source_group, pos - 1 pos, x.url source, x.type as "type" from (select code, ord, source_group, unnest(items) x, generate_subscripts(items, 1) pos from g)
union all select code, ord, 'news_queries', pos - 1, q, 'news_query' from (select code, ord, unnest(news_queries) q, generate_subscripts(news_queries, 1) pos from country)""",
    "news_urls": f"""select ord, pos - 1 pos, '{NEWS_PREFIX}' || replace(replace(replace(replace(replace(url_encode(q), '%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*') || '{NEWS_SUFFIX}' url
from (select ord, unnest(news_queries) q, generate_subscripts(news_queries, 1) pos from country)""",
    "existing_titles": f"select row_key, title, coalesce(nullif(canonical_event, ''), {_sql_label('title')}) label from updates where date >= strftime(date '{AS_OF}' - 60, '%Y-%m-%d')",
    "status_merge": f"with {_PATCH}, b as (select regulation_id, arg_max(status, (rank, snapshot_key)) status, max(rank) rank from p group by 1) select c.regulation_id, case when b.rank >= old_rank then b.status else old end status from c left join b using (regulation_id)",
    "status_regress": f"""with {_PATCH}, m as (select p.*, greatest(coalesce(max(rank) over (partition by regulation_id order by snapshot_key rows between unbounded preceding and 1 preceding), 0), old_rank) met from p join c using (regulation_id))
select regulation_id, snapshot_key, status from m where rank < met""",
    "timeline_merge": f"""with u as (select row_key, batch_no, {_code("country")} cc, effective_date as "day", canonical_event as event from updates),
f as (select cc, "day", event, min(row_key) row_key from u where batch_no >= 1 and {_ymd("u.day")} and cc is not null and event is not null group by 1, 2, 3)
select row_key, cc, "day" from f where not exists (select 1 from u where u.batch_no = 0 and u.cc = f.cc and u.day = f.day and u.event = f.event)""",
    "touch_last_checked": f"select snapshot_key, case when last_checked < '{NOW}' then '{NOW}' else last_checked end last_checked, case when {_term('status')} = 'enacted' then '{NOW}' else last_changed end last_changed from regulation_snapshots",
    "overlay_read": "select row_key from updates where batch_no >= 1 or id not in (select id from updates where batch_no >= 1)",
    "validate_updates": _VU,
    "validate_snapshots": _VS,
    "validation_counts": f"select 'updates' src, count(*) errors from ({_VU}) union all select 'regulation_snapshots', count(*) from ({_VS})",
    "run_status": f"with {_GATE} select count(*) filter (where reason is null) successes, count(*) filter (where reason is not null) failures, case when count(*) filter (where reason is not null) > 0 and count(*) filter (where reason is null) = 0 then 'partial' else 'ok' end status from gate",
    "json_props": "select event_id, cast(json_extract(props, '$.k') as integer) k from events",
}
