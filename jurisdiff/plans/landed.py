"""Queries over landed pages, feeds and catalogues.

The driver's tables hold none, so each query lays its pages, feed files or
regulations out of the columns of a whole table, and its SQL says from the same
columns what must be read back.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurisdiff.functions.codes import norm_code
from jurisdiff.functions.text import article_body, charset_name, first_truthy, fragment_text, resolve_url, strip_reader_preamble
from jurisdiff.functions.values import AXES, AXIS_LABELS, DIFF_KEYS, DIFF_LABELS, EMPTY_REPORT, EMPTY_SUMMARY, STATUS_LABELS, STATUS_ORDER
from jurisdiff.operators.candidates import candidates, united
from jurisdiff.operators.dedupe import first_links
from jurisdiff.operators.incremental import run_meta
from jurisdiff.operators.links import extract_dated_links, pages_for_review
from jurisdiff.operators.merge import insert_absent, seed_regulations, with_current
from jurisdiff.operators.validate import meta_is_valid, unknown_properties
from jurisdiff.plans import site
from jurisdiff.plans.general import _code
from jurisdiff.plans.pipeline import AS_OF, NOW, _strip, _t
from jurisdiff.session import shared_dir
from jurisdiff.sources.catalog import decode_pages, direct_or_reader, feed_items, first_appearance

_SITE = "https://site.example"


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "updates").withColumn("k", F.col("row_key"))


_DATE = """case k % 6 when 0 then concat('2026-', lpad(k % 12 + 1, 2, '0'), '-', lpad(k % 28 + 1, 2, '0')) when 1 then concat('2026年　', k % 12 + 1, '月　', k % 28 + 1, '日')
  when 2 then concat('Aug ', k % 28 + 1, ', 2026') when 3 then concat(k % 28 + 1, ' Aug 2026') when 4 then concat(lpad(k % 28 + 1, 2, '0'), '/08/2026') else 'undated' end"""
_DOC = "k - case when k % 3 = 2 then 1 else 0 end"


def _pages(df: DataFrame, item: str, markdown: bool) -> DataFrame:
    """url, text, via_reader: a page for every 40 rows, with one link a row, far apart."""
    one = F.struct("k", F.expr(f"concat({item}, repeat('. ', 300))").alias("x"))
    p = df.groupBy(F.floor(F.col("k") / 40).alias("p")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda r: r["x"]), "").alias("text"))
    return p.select(F.concat(F.lit(f"{_SITE}/list/"), F.col("p").cast("string"), F.lit("/")).alias("url"), "text", F.lit(markdown).alias("via_reader"))


_ANCHOR = f"concat('<li>', {_DATE}, ' <a class=\"x\" href=\"/doc/', {_DOC}, '?utm_source=feed&a=1#top\"', if(k % 5 = 0, concat(' aria-label=\"Label ', k, '\"><img src=\"i.png\">'), concat('><b>Doc</b>  ', k)), '</a>')"
_MARKED = f"concat({_DATE}, ' ![icon](/i.png) [menu](javascript:open) [Doc ', k, '](/doc/', {_DOC}, '?utm_source=feed&a=1 \"t\")')"


def dated_links_q(spark, sf):
    """Dated links of pages: each address once, the first twenty a page."""
    return extract_dated_links(_pages(_updates(spark, sf), _ANCHOR, False))


def markdown_links(spark, sf):
    """The same of pages that came as Markdown."""
    return extract_dated_links(_pages(_updates(spark, sf), _MARKED, True))


def pages_without_links(spark, sf):
    """Work items of changed pages that have no dated link."""
    pages = _pages(_updates(spark, sf).where("k % 6 = 5 or floor(k / 40) % 2 = 0"), _ANCHOR, False)
    return pages_for_review(pages, extract_dated_links(pages)).select("title", "body", F.array_join("labels", ",").alias("labels"))


def _feed_file(spark: SparkSession, entries: DataFrame, root: str) -> str:
    """Feed files of the entries (column value), a document with the root a partition."""

    def documents(batches):
        yield pd.DataFrame({"value": [f"<{root}>"]})
        yield from batches
        yield pd.DataFrame({"value": [f"</{root}>"]})

    path = f"{shared_dir(spark)}/jurisdiff-feed-{uuid.uuid4().hex[:12]}"
    entries.mapInPandas(documents, "value string").write.text(path)
    return path


_RSS = """concat('<item><title>Doc ', k, '</title><link>https://SITE.example:443/doc/', k - k % 2, '?utm_medium=x&amp;a=1</link>',
  if(k % 10 = 0, '', concat('<pubDate>Tue, ', date_format(ingested_at, 'dd MMM yyyy HH:mm:ss'), ' GMT</pubDate>')), '<description>', repeat('word ', 100), k, '</description></item>')"""
_ATOM = """concat('<entry><title>Doc ', k, '</title><link href="https://site.example/doc/', k, '"/><updated>', date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '</updated>',
  if(k % 2 = 0, '', '<published>2026-01-02T03:04:05Z</published>'), '<summary>short</summary></entry>')"""


def _rss(spark, sf):
    return feed_items(spark, _feed_file(spark, _updates(spark, sf).selectExpr(f"{_RSS} as value"), "rss"))


def rss_items(spark, sf):
    """Entries of landed RSS files; an undated one has no time."""
    return _rss(spark, sf).select("title", "link", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"), F.length("snippet").alias("n_snippet"))


def atom_items(spark, sf):
    """Entries of landed Atom files; the time of publication, else of the last change."""
    f = feed_items(spark, _feed_file(spark, _updates(spark, sf).selectExpr(f"{_ATOM} as value"), "feed"), "entry")
    return f.select("title", "link", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"), "snippet")


def _united(spark, sf):
    links = extract_dated_links(_pages(_updates(spark, sf), _ANCHOR, False))
    number = F.regexp_extract("title", r"(\d+)$", 1).cast("bigint")
    pages = candidates(links, F.struct(F.lit(1).alias("rank"), number.alias("n")), F.lit("eu"), "scrape_hash", "official_sources")
    feeds = candidates(_rss(spark, sf), F.struct(F.lit(2).alias("rank"), number.alias("n")), F.lit(None).cast("string"), "rss", "watch_feeds", "snippet")
    news = _updates(spark, sf).where("k % 50 = 0").selectExpr("k", "concat('News ', k) as title", "concat('https://news.google.com/rss/', k) as link")
    return united([pages, feeds, candidates(news, F.struct(F.lit(3).alias("rank"), F.col("k").alias("n")), F.lit(None).cast("string"), "rss", "news_queries")])


def candidate_union(spark, sf):
    """Candidates of all sources, the first of each address."""
    return _united(spark, sf)[0].select("title", "url", F.length("snippet").alias("n_snippet"), "country_hint", "source_type", "source_group")


def candidate_counts(spark, sf):
    """Candidates found, kept and lost to search news, per group of sources."""
    return _united(spark, sf)[2]


def decoded_pages(spark, sf):
    """Pages decoded by the character set of their header, else of their head."""
    body = "concat(if(k % 3 = 2, '<meta charset=\"iso-8859-1\">', ''), 'Café ', k, ' señal')"
    p = _updates(spark, sf).selectExpr("row_key", f"encode({body}, if(k % 3 = 0, 'UTF-8', 'ISO-8859-1')) as body", "case k % 3 when 0 then 'text/html; charset=UTF-8' when 1 then 'text/html; charset=\"ISO-8859-1\"' end as header")
    return decode_pages(p, charset_name(F.col("header"), F.decode("body", "ISO-8859-1"))).select("row_key", "text")


def page_fallback(spark, sf):
    """Pages read directly or, where that failed, through a reader; where both failed the page's own error."""
    u = _updates(spark, sf).withColumn("url", F.concat(F.lit(f"{_SITE}/p/"), F.col("k").cast("string")))
    direct = u.selectExpr("url", "if(k % 4 < 2, concat('page ', k), null) as text", "if(k % 4 < 2, null, 'HTTP 403') as error")
    raw = u.where("k % 4 = 2").selectExpr("url", "concat('Title: t\\n2026-01-01\\n\\nMarkdown Content:\\n', if(k % 8 = 2, '2026年 8月1日 10:00\\n', ''), 'read ', k) as raw")
    return direct_or_reader(direct, raw.select("url", strip_reader_preamble(F.col("raw")).alias("text")))


def body_texts(spark, sf):
    """What of every document an extractor and a link's snippet are given: lengths and hashes."""
    d = _t(spark, sf, "documents").select("doc_id", article_body(F.col("text")).alias("b"), fragment_text(F.col("text")).alias("s"))
    return d.select("doc_id", F.length("b").cast("bigint").alias("n_body"), F.sha2("b", 256).alias("body"), F.sha2("s", 256).alias("snippet"))


def resolved_urls(spark, sf):
    """Links of every kind against the page they stand on."""
    href = "case k % 6 when 0 then concat('//cdn.example/', k) when 1 then concat('/r/', k) when 2 then concat('./n', k) when 3 then concat('?q=', k) when 4 then concat('#f', k) else concat('mailto:', k, '@x.example') end"
    return _updates(spark, sf).selectExpr("row_key", f"{href} as href", "concat('https://site.example/d/', k % 7, '/page?z=1#y') as base").select("row_key", resolve_url(F.col("href"), F.col("base")).alias("url"))


def page_first_links(spark, sf):
    """The first three different sources of every ten updates."""
    links = _updates(spark, sf).select(F.floor(F.col("k") / 10).alias("page"), F.posexplode("sources").alias("i", "url"), "k").withColumn("pos", F.struct("k", "i"))
    return first_links(links, "page", "url", "pos", 3).select("page", "url", F.col("k").alias("row_key"))


def axis_order(spark, sf):
    """Axes in the order in which updates first name them."""
    return first_appearance(_updates(spark, sf).where("axis is not null"), "axis", "row_key")


# Regulations out of the configured countries: fields are present, empty or missing by their place.


def _countries(spark, sf):
    c = _t(spark, sf, "country").groupBy("ord").agg(F.min("code").alias("c"), F.min("name_ja").alias("name_ja"), F.min("name_en").alias("name_en"), F.min("added_at").alias("added_at"))
    return c.select("ord", F.concat(F.lit("c"), F.col("ord").cast("string")).alias("code"), "name_ja", "name_en", F.col("c").alias("flag"), F.col("ord").cast("double").alias("lat"), F.lit(0.5).alias("lng"), "added_at")


def _regulations(spark, sf):
    axis = lambda i, a: f"if((ord + {i}) % 4 = 0, null, named_struct('summary', case (ord + {i}) % 4 when 1 then '' else concat('{a} ', ord) end, 'detail', if(ord % 2 = 0, 'd', null), 'sources', if((ord + {i}) % 4 = 3, null, array(concat('https://s.example/', ord % 3), concat('https://s.example/{a}')))))"
    line = "array(named_struct('date', concat('202', ord % 10, '-01-01'), 'event', coalesce(name_en, ''), 'source', 'https://t.example/1'), named_struct('date', '2026-12-31', 'event', 'later', 'source', if(ord % 5 = 0, null, concat('https://t.example/', ord))))"
    entry = "transform(sequence(1, ord % 3 + {0}), x -> named_struct('topic', concat('{1} ', x), 'note', 'n', 'source', concat('https://s.example/', x)))"
    lists = [f"'{k}', if((ord + {i}) % 5 = 0, null, {entry.format(i % 2 + 1, k)})" for i, k in enumerate(DIFF_KEYS)]
    state = f"element_at(array({', '.join(repr(x) for x in STATUS_ORDER)}, 'odd'), cast(ord % 6 + 1 as int))"
    return _countries(spark, sf).where("ord % 7 <> 6").selectExpr(
        "code as jurisdiction", "concat('Act ', ord) as regulation_name", f"{state} as status", "'sectoral' as approach", "ord = 0 as is_baseline",
        "named_struct(" + ", ".join(f"'{a}', {axis(i, a)}" for i, a in enumerate(AXES)) + f", 'timeline', if(ord % 6 = 0, null, {line})) as axes", f"named_struct({', '.join(lists)}) as diff_vs_eu",
        "date_format(added_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as last_checked", f"if(ord % 2 = 0, '2026-09-1{{}}T00:00:00Z', 'no') as last_changed".replace("{}", "2"),
    )


def site_axes(spark, sf):
    """Six axis rows of every regulation, a dash for an empty summary."""
    return site.axis_rows(_regulations(spark, sf)).select("jurisdiction", "no", "label", "summary", "sources")


def site_timeline(spark, sf):
    """All timeline entries with their country and what lies ahead, in the order of the page."""
    t = site.timeline_rows(_countries(spark, sf), _regulations(spark, sf), AS_OF)
    return t.select("code", "pos", "date", "event", "is_future")


def site_diffs(spark, sf):
    """The difference lists entry by entry."""
    return site.diff_rows(_regulations(spark, sf)).select("jurisdiction", "list", "pos", "topic")


def site_sizes(spark, sf):
    return site.diff_sizes(_regulations(spark, sf))


def site_sources(spark, sf):
    """Different sources of every regulation in first-seen order."""
    return site.regulation_sources(_regulations(spark, sf)).select("jurisdiction", F.array_join("sources", " ").alias("sources"))


def site_reports(spark, sf):
    """The text to copy from every country's page, word for word; the baseline has none."""
    c = _countries(spark, sf).withColumn("name_ja", first_truthy(F.col("name_ja"), F.col("code")))
    return site.copy_reports(c, _regulations(spark, sf), F.concat(F.lit("※自動要約 https://tracker.example/country/"), F.col("code"), F.lit("/")))


def site_markers(spark, sf):
    """Markers of the map: where something changed within seven days."""
    u = _updates(spark, sf).select("date", "country", F.lit("f").alias("file"), F.col("row_key").alias("pos"))
    return site.home(_countries(spark, sf), _regulations(spark, sf), u, AS_OF)[1].select("ord", "recent", "size")


def country_count(spark, sf):
    """How many jurisdictions are configured."""
    return _countries(spark, sf).agg(F.count("*").alias("countries"))


def page_paths(spark, sf):
    """Address of every country's page below the site's base."""
    return _countries(spark, sf).select("ord", site.page_path("/base/", F.concat(F.lit("/country/"), "code", F.lit("/"))).alias("path"))


def _label_text(df):
    return df.select("title", F.coalesce("body", F.lit("")).alias("body"), F.array_join("labels", ",").alias("labels"))


def work_queue(spark, sf):
    """Work a run queues: changed differences, steps back, failures."""
    u = _updates(spark, sf)
    records = u.where("batch_no >= 1").select(F.coalesce("country", F.lit("-")).alias("country"), F.coalesce("title", F.lit("")).alias("title"), "impact.diff_changed", "impact.diff_note")
    regress = u.where("k % 9 = 0").select(F.concat(F.lit("c"), F.col("k").cast("string")).alias("country"), F.lit("draft").alias("status"))
    failures = u.where("k % 11 = 0").select(F.concat(F.lit(_SITE + "/"), F.repeat(F.lit("x"), F.lit(90)), F.col("k").cast("string")).alias("url"), F.concat(F.lit("HTTP "), F.col("k").cast("string")).alias("message"))
    return _label_text(site.issues(records, regress, failures))


def untriaged_item(spark, sf):
    """The work item of a run whose classifier failed."""
    return _label_text(site.untriaged(_updates(spark, sf).where("batch_no >= 1")))


def usable_records(spark, sf):
    """Extracted records against the regulation they change: kept, unusable, or without one."""
    r = _updates(spark, sf).select("row_key", norm_code(F.col("country")).alias("cc"), (F.col("axis") != "general").alias("usable"))
    current = _t(spark, sf, "regulation_snapshots").select(norm_code(F.col("jurisdiction")).alias("cc")).where("cc is not null").distinct()
    kept, dropped = with_current(r, current, "cc")
    return kept.select("row_key", F.lit("kept").alias("outcome")).unionByName(dropped.select("row_key", F.col("reason").alias("outcome")))


def run_metas(spark, sf):
    """What three runs store: one over all documents, one without outcomes, one that broke off."""
    outcomes = _t(spark, sf, "documents").select(F.col("text").isNotNull().alias("ok"))
    runs = [("all", outcomes, False), ("none", outcomes.where("false"), False), ("crashed", outcomes, True)]
    parts = [run_meta(o, NOW, broke).select(F.lit(name).alias("run"), "last_sweep", "status") for name, o, broke in runs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def seed_insert(spark, sf):
    """The stored regulations by jurisdiction and an empty one for each configured country that has none."""
    there = _t(spark, sf, "regulation_snapshots").select(norm_code(F.col("jurisdiction")).alias("jurisdiction")).where("jurisdiction < 'm'").distinct()
    codes = _t(spark, sf, "country").select(norm_code(F.col("code")).alias("code")).where("code is not null").distinct()
    return insert_absent(there, seed_regulations(codes, NOW), "jurisdiction").select("jurisdiction", "status", "approach", "last_checked")


_FIELDS = ["jurisdiction", "regulation_name", "status", "approach", "is_baseline", "axes", "diff_vs_eu", "last_checked", "last_changed"]


def unknown_fields(spark, sf):
    """Fields of the received records that the schema doesn't know, at the top."""
    return unknown_properties(_t(spark, sf, "regulation_raw"), "raw_id", "payload", {"": set(_FIELDS)})


def meta_valid(spark, sf):
    """Is every stored run record valid: with a time and a known status?"""
    m = _t(spark, sf, "regulation_snapshots").selectExpr("snapshot_key", "last_checked as last_sweep", "element_at(array('ok', 'partial', 'failed', 'odd'), cast(snapshot_key % 4 + 1 as int)) as status")
    return meta_is_valid(m).select("snapshot_key", "valid")


def prompt_payloads(spark, sf):
    """What a classifier is shown of every update, read back from its JSON."""
    p = site.prompt_rows(_updates(spark, sf).select(F.col("row_key").alias("seq"), "title", F.col("summary.what").alias("snippet"), F.col("country").alias("country_hint")), 30)
    return p.select(F.col("seq").alias("row_key"), F.get_json_object("payload", "$.title").alias("title"), F.get_json_object("payload", "$.snippet").alias("snippet"), F.get_json_object("payload", "$.country_hint").alias("country_hint"))


QUERIES = {
    "dated_links": dated_links_q, "markdown_links": markdown_links, "pages_without_links": pages_without_links, "rss_items": rss_items, "atom_items": atom_items, "candidate_union": candidate_union, "candidate_counts": candidate_counts,
    "decoded_pages": decoded_pages, "page_fallback": page_fallback, "body_texts": body_texts, "resolved_urls": resolved_urls, "page_first_links": page_first_links, "axis_order": axis_order,
    "site_axes": site_axes, "site_timeline": site_timeline, "site_diffs": site_diffs, "site_sizes": site_sizes, "site_sources": site_sources, "site_reports": site_reports, "site_markers": site_markers, "country_count": country_count, "page_paths": page_paths,
    "work_queue": work_queue, "untriaged_item": untriaged_item, "usable_records": usable_records, "run_metas": run_metas, "seed_insert": seed_insert, "unknown_fields": unknown_fields, "meta_valid": meta_valid, "prompt_payloads": prompt_payloads,
}

_LINKS = lambda title: f"""k as (select row_key, row_key // 40 p, row_key - case when row_key % 3 = 2 then 1 else 0 end doc, {title} title from updates where row_key % 6 <> 5),
f as (select p, doc, min(row_key) row_key from k group by p, doc),
l as (select p, f.row_key, f.doc, row_number() over (partition by p order by f.row_key) - 1 pos, title from f join k using (p, doc, row_key) qualify pos < 20)"""  # noqa: E731
_HTML_LINKS = _LINKS("case when row_key % 5 = 0 then 'Label ' else 'Doc ' end || row_key")
_READ = lambda links: f"with {links} select '{_SITE}/list/' || p || '/' page, cast(pos as integer) pos, title, '{_SITE}/doc/' || doc || '?a=1' url from l"
_UNION = f"""{_HTML_LINKS}, a as (
  select 1 rank, row_key n, title, '{_SITE}/doc/' || doc || '?a=1' url, length(title) n_snippet, 'eu' country_hint, 'scrape_hash' source_type, 'official_sources' source_group from l
  union all select 2, row_key, 'Doc ' || row_key, '{_SITE}/doc/' || (row_key - row_key % 2) || '?a=1', 300, null, 'rss', 'watch_feeds' from updates
  union all select 3, row_key, 'News ' || row_key, 'https://news.google.com/rss/' || row_key, length('News ' || row_key), null, 'rss', 'news_queries' from updates where row_key % 50 = 0),
b as (select *, row_number() over (partition by url order by rank, n) rn from a)"""
_C = """c as (select ord, 'c' || ord code, coalesce(nullif(min(name_ja), ''), 'c' || ord) name, min(name_en) name_en, min(added_at) added_at from country group by ord),
r as (select * from c where ord % 7 <> 6)"""
_axes = ", ".join(f"({i}, '{a}', '{AXIS_LABELS[a]}')" for i, a in enumerate(AXES))
_lists = ", ".join(f"({i}, '{k}', '{DIFF_LABELS[k]}')" for i, k in enumerate(DIFF_KEYS))
_ENTRIES = f"""e as (select r.ord, r.code, d.i, d.k, d.label, unnest(range(1, ord % 3 + d.i % 2 + 2)) x from r, (values {_lists}) d(i, k, label) where (ord + d.i) % 5 <> 0)"""
_size = lambda i: f"case when (ord + {i}) % 5 = 0 then 0 else ord % 3 + {i % 2 + 1} end"
_topics = lambda i, k: f"case when (ord + {i}) % 5 = 0 then '{EMPTY_REPORT}' else (select string_agg('{k} ' || x, '、' order by x) from range(1, ord % 3 + {i % 2 + 2}) t(x)) end"
_state = "['" + "', '".join(STATUS_LABELS[x] for x in STATUS_ORDER) + "', 'odd'][ord % 6 + 1]"
_SEEN = f"""s as (
  select ord, code, 1000 + d.i * 10 q, 'https://s.example/' || (ord % 3) s from r, (values {_axes}) d(i, a, l) where (ord + d.i) % 4 in (1, 2)
  union all select ord, code, 1001 + d.i * 10, 'https://s.example/' || d.a from r, (values {_axes}) d(i, a, l) where (ord + d.i) % 4 in (1, 2)
  union all select ord, code, 2000, 'https://t.example/1' from r where ord % 6 <> 0
  union all select ord, code, 2001, 'https://t.example/' || ord from r where ord % 6 <> 0 and ord % 5 <> 0
  union all select ord, code, 3000 + i * 10 + x, 'https://s.example/' || x from e)"""
_first_seen = lambda where: f"(select code, string_agg(s, ' ' order by q) sources from (select code, s, min(q) q from s where {where} group by 1, 2) group by 1)"

ORACLES = {
    "dated_links": _READ(_HTML_LINKS),
    "markdown_links": _READ(_LINKS("'Doc ' || row_key")),
    "pages_without_links": f"select 'No dated links: {_SITE}/list/' || p || '/' title, '{_SITE}/list/' || p || '/' body, 'needs-review' labels from (select distinct row_key // 40 p from updates where row_key % 6 = 5) where p % 2 <> 0",
    "rss_items": "select 'Doc ' || row_key title, 'https://SITE.example:443/doc/' || (row_key - row_key % 2) || '?utm_medium=x&a=1' link, case when row_key % 10 <> 0 then strftime(ingested_at at time zone 'UTC', '%Y-%m-%d %H:%M:%S') end published, 300 n_snippet from updates",
    "atom_items": f"select 'Doc ' || row_key title, '{_SITE}/doc/' || row_key link, case when row_key % 2 = 0 then strftime(ingested_at at time zone 'UTC', '%Y-%m-%d %H:%M:%S') else '2026-01-02 03:04:05' end published, 'short' snippet from updates",
    "candidate_union": f"with {_UNION} select title, url, cast(n_snippet as integer) n_snippet, country_hint, source_type, source_group from b where rn = 1 and rank < 3",
    "candidate_counts": f"with {_UNION} select source_group, count(*) as \"found\", count(*) filter (where rn = 1 and rank < 3) kept, count(*) filter (where rn = 1 and rank = 3) news from b group by 1",
    "decoded_pages": "select row_key, case when row_key % 3 = 2 then '<meta charset=\"iso-8859-1\">' else '' end || 'Café ' || row_key || ' señal' as \"text\" from updates",
    "page_fallback": f"select '{_SITE}/p/' || row_key url, case when row_key % 4 < 2 then 'page ' || row_key when row_key % 4 = 2 then 'read ' || row_key end as \"text\", row_key % 4 = 2 via_reader, case when row_key % 4 = 3 then 'fetch-failed:HTTP 403' end as \"error\" from updates",
    "body_texts": f"select doc_id, length(t[1:20000]) n_body, sha256(t[1:20000]) body, sha256(t[1:300]) snippet from (select doc_id, {_strip('text')} t from documents)",
    "resolved_urls": """select row_key, case row_key % 6 when 0 then 'https://cdn.example/' || row_key when 1 then 'https://site.example/r/' || row_key when 2 then 'https://site.example/d/' || (row_key % 7) || '/n' || row_key
  when 3 then 'https://site.example/d/' || (row_key % 7) || '/page?q=' || row_key when 4 then 'https://site.example/d/' || (row_key % 7) || '/page#f' || row_key else 'mailto:' || row_key || '@x.example' end url from updates""",
    "page_first_links": """with l as (select row_key // 10 page, row_key, unnest(sources) url, generate_subscripts(sources, 1) i from updates), f as (select page, url, min((row_key, i)) m from l group by 1, 2)
select page, url, m[1] row_key from f qualify row_number() over (partition by page order by m) <= 3""",
    "axis_order": "select axis, min(row_key) first_pos, cast(row_number() over (order by min(row_key)) as integer) ord from updates where axis is not null group by 1",
    "site_axes": f"""with {_C} select code jurisdiction, lpad(cast(i + 1 as varchar), 2, '0') as "no", l as label, case when (ord + i) % 4 in (0, 1) then '{EMPTY_SUMMARY}' else a || ' ' || ord end summary,
  case when (ord + i) % 4 in (0, 3) then '' else 'https://s.example/' || (ord % 3) || ' https://s.example/' || a end sources from r, (values {_axes}) d(i, a, l)""",
    "site_timeline": f"""with {_C}, t as (select code, 0 pos, '202' || (ord % 10) || '-01-01' as "date", coalesce(name_en, '') as "event" from r where ord % 6 <> 0 union all select code, 1, '2026-12-31', 'later' from r where ord % 6 <> 0)
select code, cast(pos as integer) pos, "date", "event", "date" > '{AS_OF}' is_future from t""",
    "site_diffs": f"with {_C}, {_ENTRIES} select code jurisdiction, k as \"list\", cast(x - 1 as integer) pos, k || ' ' || x topic from e",
    "site_sizes": f"with {_C} select code jurisdiction, {', '.join(f'cast({_size(i)} as integer) as "{k}"' for i, k in enumerate(DIFF_KEYS))} from r",
    "site_sources": f"with {_C}, {_ENTRIES}, {_SEEN} select r.code jurisdiction, coalesce(f.sources, '') sources from r left join {_first_seen('true')} f using (code)",
    "site_reports": f"""with {_C}, {_ENTRIES}, {_SEEN} select code, '【' || name || 'のAI規制とEU AI Actの差分】' || strftime(added_at at time zone 'UTC', '%Y-%m-%d') || '時点' || chr(10) || '規制名: Act ' || ord || '（状態: ' || {_state} || '）' || chr(10)
  || {" || chr(10) || ".join(f"'■ {DIFF_LABELS[k]}: ' || {_topics(i, k)}" for i, k in enumerate(DIFF_KEYS))} || chr(10) || '出典: ' || coalesce(sources, '') || chr(10) || '※自動要約 https://tracker.example/country/' || code || '/' report
from r left join {_first_seen('q >= 3000')} f using (code) where ord <> 0""",
    "site_markers": f"with {_C} select ord, ord % 2 = 0 recent, case when ord % 2 = 0 then 0.1::double else 0.05::double end size from r",
    "country_count": "select count(distinct ord) countries from country",
    "page_paths": f"with {_C} select ord, '/base/country/' || code || '/' path from c",
    "work_queue": f"""select 'Difference changed: ' || coalesce(country, '-') || ' ' || coalesce(title, '') title, coalesce(impact.diff_note, '{EMPTY_REPORT}') body, 'diff-change' labels from updates where batch_no >= 1 and impact.diff_changed
union all select 'Status would step back: c' || row_key, 'draft', 'needs-review' from updates where row_key % 9 = 0
union all select 'Failed: ' || ('{_SITE}/' || repeat('x', 90) || row_key)[1:80], 'HTTP ' || row_key, 'needs-review' from updates where row_key % 11 = 0""",
    "untriaged_item": "select 'Classification failed' title, count(*) || ' candidates skipped' body, 'needs-review' labels from updates where batch_no >= 1",
    "usable_records": f"""select row_key, case when axis = 'general' then 'gemini-unusable' when {_code("country")} is null or {_code("country")} not in (select j from (select {_code("jurisdiction")} j from regulation_snapshots) where j is not null) then 'missing-regulation' else 'kept' end outcome from updates""",
    "run_metas": f"""select run, '{NOW}' last_sweep, case when run = 'crashed' then 'failed' when run = 'all' and bad > 0 and good = 0 then 'partial' else 'ok' end status
from (values ('all'), ('none'), ('crashed')) v(run), (select count(*) filter (where "text" is null) bad, count("text") good from documents)""",
    "seed_insert": f"""with t as (select distinct {_code("jurisdiction")} j from regulation_snapshots) select j jurisdiction, null::varchar status, null::varchar approach, null::varchar last_checked from t where j < 'm'
union all select distinct {_code("code")}, 'proposed', 'soft_law', '{NOW}' from country where {_code("code")} is not null and {_code("code")} not in (select j from t where j < 'm')""",
    "unknown_fields": f"""with p as (select raw_id, payload from regulation_raw where json_valid(payload) and json_type(case when json_valid(payload) then payload end) = 'OBJECT')
select distinct raw_id, k path from (select raw_id, unnest(json_keys(payload)) k from p) where k not in ({", ".join(repr(x) for x in _FIELDS)})""",
    "meta_valid": "select snapshot_key, last_checked is not null and snapshot_key % 4 <> 3 as \"valid\" from regulation_snapshots",
    "prompt_payloads": "select row_key, title, summary.what[1:30] snippet, country country_hint from updates",
}
