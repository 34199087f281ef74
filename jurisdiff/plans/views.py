"""Read-side queries: lists, facets, search, matrix, timeline, reports; each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jurisdiff.functions.codes import norm_code, norm_term
from jurisdiff.functions.text import first_truthy, format_minute, month_key
from jurisdiff.functions.values import AXES, AXIS_LABELS, CHANGE_TYPE_LABELS, DIFF_KEYS, EMPTY_LIST, EMPTY_REPORT, EMPTY_SUMMARY, STATUS_LABELS
from jurisdiff.operators.nested import regulation_nodes
from jurisdiff.operators.ranking import rank_within
from jurisdiff.operators.validate import exactly_one, regulation_violations
from jurisdiff.plans.general import _code, _term, flat_regulations
from jurisdiff.plans.pipeline import AS_OF, _t

BASELINE = "eu"

# Class of each cell of the comparison matrix, per jurisdiction in the order of AXES.
MATRIX_CELLS = {
    "eu": ["baseline", "baseline", "baseline", "baseline", "baseline", "baseline"],
    "jp": ["looser", "absent", "absent", "absent", "absent", "looser"],
    "us": ["unique", "absent", "looser", "looser", "looser", "absent"],
    "uk": ["looser", "absent", "looser", "unique", "absent", "looser"],
    "cn": ["looser", "unique", "stricter", "stricter", "looser", "stricter"],
    "kr": ["looser", "absent", "looser", "looser", "looser", "stricter"],
    "sg": ["looser", "absent", "unique", "looser", "absent", "looser"],
    "ca": ["absent", "absent", "looser", "unique", "absent", "absent"],
    "br": ["absent", "absent", "absent", "unique", "absent", "absent"],
    "in": ["absent", "absent", "absent", "absent", "absent", "unique"],
    "au": ["looser", "absent", "looser", "unique", "absent", "looser"],
    "tw": ["looser", "absent", "absent", "looser", "absent", "looser"],
    "kh": ["absent", "absent", "absent", "absent", "absent", "absent"],
}


def label_of(c: Column, labels: dict[str, str], default: Column | None = None) -> Column:
    """Label of a code, or the default, or the code itself."""
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), c if default is None else default)


def is_recent(c: Column, now: str, days: int = 7) -> Column:
    """Is a time less than so many days ago? One in the future is, an unreadable one isn't."""
    return F.coalesce(F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(c.try_cast("timestamp")) < days * 86_400_000_000, F.lit(False))


def search_text(title: Column, *parts: Column) -> Column:
    """What a word is looked for in: title and summary, in lower case."""
    return F.lower(reduce(lambda a, b: F.concat(a, F.lit(" "), b), [F.coalesce(c, F.lit("")) for c in (title, *parts)]))


def search_updates(df: DataFrame, countries: list[str] = [], axes: list[str] = [], types: list[str] = [], word: str = "") -> DataFrame:  # noqa: B006
    """Updates of any chosen value within a facet and of all facets; an empty facet is all. df: country, axis, change_type, title, summary."""
    for column, chosen in (("country", countries), ("axis", axes), ("change_type", types)):
        if chosen:
            df = df.where(F.col(column).isin(chosen))
    word = word.strip().lower()
    return df.where(F.contains(search_text(F.col("title"), F.col("summary.what"), F.col("summary.who"), F.col("summary.when_impact")), F.lit(word))) if word else df


def matrix_table(spark: SparkSession, cells: dict[str, list[str]] = MATRIX_CELLS) -> DataFrame:
    """code, axis, cell of the hand-kept matrix."""
    return spark.createDataFrame([(c, a, x) for c, row in cells.items() for a, x in zip(AXES, row)], "code string, axis string, cell string")


def matrix(countries: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per country, a column per axis; the baseline first, the others in configured order."""
    axes = countries.select("code", "ord", F.explode(F.array(*map(F.lit, AXES))).alias("axis"))
    grid = axes.join(cells, ["code", "axis"], "left").groupBy("code", "ord").pivot("axis", AXES).agg(F.first("cell"))
    return grid.withColumn("place", F.row_number().over(Window.orderBy(F.when(F.col("code") == BASELINE, 0).otherwise(1), "ord")))


# The text to copy from a country's page; its wording must not change.
REPORT_HEAD, REPORT_CHECKED, REPORT_NAME, REPORT_STATE, REPORT_END, REPORT_SOURCES = "のAI規制とEU AI Actの差分】", "時点", "規制名: ", "（状態: ", "）", "出典: "


def text_report(name: Column, checked: Column, regulation: Column, status: Column, topics: dict[str, Column], sources: Column, footer: Column | None = None) -> Column:
    """The plain-text report of one regulation: header, name and state, a line per list, sources, and the site's own last line if given."""
    listed = lambda c: F.when(F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0, F.array_join(c, "、")).otherwise(EMPTY_REPORT)
    lines = [F.concat(F.lit("【"), name, F.lit(REPORT_HEAD), F.substring(checked, 1, 10), F.lit(REPORT_CHECKED)), F.concat(F.lit(REPORT_NAME), regulation, F.lit(REPORT_STATE), status, F.lit(REPORT_END))]
    lines += [F.concat(F.lit(f"■ {title}: "), listed(c)) for title, c in topics.items()]
    lines += [F.concat(F.lit(REPORT_SOURCES), F.array_join(F.coalesce(sources, F.array().cast("array<string>")), " ")), *([] if footer is None else [footer])]
    return F.concat_ws("\n", *lines)


def _u(spark, sf):
    return _t(spark, sf, "updates").withColumn("country", norm_code(F.col("country")))


def latest_updates(spark, sf):
    """The three latest updates; the first is shown large."""
    top = _u(spark, sf).orderBy(F.desc("date"), "row_key").limit(3)
    return top.select("row_key", "date", (F.row_number().over(Window.orderBy(F.desc("date"), "row_key")) == 1).alias("big"))


def faceted_search(spark, sf):
    return search_updates(_u(spark, sf), ["eu", "wr", "sv"], ["penalties", "transparency", "general"], ["status_change", "new_regulation"], " No. ").select("row_key", month_key(F.col("date")).alias("month"))


def search_by_month(spark, sf):
    """Hits of a search per month, with the months that have none; those are hidden."""
    u = _u(spark, sf).withColumn("month", month_key(F.col("date")))
    hits = search_updates(u, axes=["penalties"], word="register").groupBy("month").agg(F.count("*").alias("hits"))
    months = u.select("month").distinct()
    return months.join(hits, "month", "left").select("month", F.coalesce("hits", F.lit(0)).alias("hits"), F.col("hits").isNotNull().alias("shown"))


def facet_values(spark, sf):
    """Values of each facet in the order in which they first appear in the list."""
    facets = (("month", month_key(F.col("date"))), ("axis", F.col("axis")), ("change_type", F.col("change_type")), ("country", F.col("country")))
    cells = _u(spark, sf).select("date", "row_key", F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), c.alias("value")) for f, c in facets])).alias("c"))
    # The first in the list is the one of the latest date, and of these of the smallest key.
    first = cells.groupBy("c.facet", "c.value").agg(F.max(F.struct("date", -F.col("row_key"))).alias("first"))
    return first.select("facet", "value", F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("first"))).alias("ord"))


def update_labels(spark, sf):
    """Updates with the labels of their codes; an unknown code stands for itself."""
    names = _t(spark, sf, "country").where("name_ja is not null").groupBy(norm_code(F.col("code")).alias("country")).agg(F.min("name_ja").alias("name"))
    return _u(spark, sf).join(names, "country", "left").select("row_key", label_of(F.col("axis"), AXIS_LABELS).alias("axis_label"), label_of(F.col("change_type"), CHANGE_TYPE_LABELS).alias("type_label"), F.coalesce("name", "country").alias("country_label"))


def source_counts(spark, sf):
    """Number of sources of each group per country; absent groups count 0."""
    of = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)).cast("bigint").alias(c)
    return _t(spark, sf, "country").select("ord", of("official_sources"), of("watch_feeds"), of("news_queries"))


def source_union(spark, sf):
    """Different sources of each country in first-seen order."""
    urls = lambda c: F.coalesce(F.transform(c, lambda s: s["url"]), F.array().cast("array<string>"))
    c = _t(spark, sf, "country")
    return c.select("ord", F.array_join(F.array_distinct(F.concat(urls("official_sources"), urls("watch_feeds"))), " ").alias("sources"))


def topic_join(spark, sf):
    """News queries of each country as one text, or the placeholder."""
    return _t(spark, sf, "country").select("ord", F.when(F.size(F.coalesce("news_queries", F.array().cast("array<string>"))) > 0, F.array_join("news_queries", "、")).otherwise(EMPTY_LIST).alias("topics"))


def country_report(spark, sf):
    """The plain-text report of every configured country row, over its sources."""
    urls = lambda c: F.transform(c, lambda s: s["url"])
    c = _t(spark, sf, "country")
    name = first_truthy(F.col("name_ja"), F.col("name_en"), F.col("code"))
    return c.select("ord", text_report(name, F.date_format("added_at", "yyyy-MM-dd HH:mm"), F.coalesce("name_en", F.lit("")), F.col("code"), {"official": urls("official_sources"), "news": F.col("news_queries")}, urls("watch_feeds")).alias("report"))


def timeline(spark, sf):
    """Dates of all updates as one timeline, with what lies ahead."""
    u = _u(spark, sf)
    entries = F.filter(F.array(*[F.struct(F.col(f"{k}_date").alias("day"), F.lit(k).alias("kind")) for k in ("publication", "effective", "deadline")]), lambda x: x["day"].isNotNull())
    return u.select("row_key", "country", F.explode(entries).alias("e")).select("row_key", "country", "e.day", "e.kind", (F.col("e.day") > AS_OF).alias("is_future"))


def timeline_years(spark, sf):
    return timeline(spark, sf).groupBy(F.substring("day", 1, 4).alias("year")).agg(F.count("*").alias("n"), F.count_if("is_future").alias("ahead"))


def matrix_grid(spark, sf):
    """Updates per country and axis in the layout of the matrix."""
    c = _t(spark, sf, "country").groupBy(norm_code(F.col("code")).alias("code")).agg(F.min("ord").alias("ord"))
    cells = _u(spark, sf).groupBy(F.col("country").alias("code"), "axis").agg(F.count("*").alias("cell"))
    return matrix(c, cells)


def matrix_literal(spark, sf):
    """The hand-kept matrix with its empty cells."""
    c = spark.createDataFrame([(k, i) for i, k in enumerate(MATRIX_CELLS)], "code string, ord int")
    return matrix(c, matrix_table(spark))


def axis_unpivot(spark, sf):
    """The three summary fields of every update as rows, numbered, with a dash for empty ones."""
    fields = F.array(*[F.struct(F.lit(f"{i:02d}").alias("no"), F.lit(f).alias("field"), F.coalesce(F.nullif(F.col(f"summary.{f}"), F.lit("")), F.lit(EMPTY_SUMMARY)).alias("text")) for i, f in enumerate(("what", "who", "when_impact"), 1)])
    return _t(spark, sf, "updates").select("row_key", F.explode(fields).alias("x")).select("row_key", "x.no", "x.field", "x.text")


def recent_markers(spark, sf):
    """Map markers of the countries, larger where something changed within seven days."""
    last = _u(spark, sf).groupBy(F.col("country").alias("code")).agg(F.max("ingested_at").alias("last"))
    c = _t(spark, sf, "country").select("ord", norm_code(F.col("code")).alias("code"), "lat", "lng").join(last, "code", "left")
    recent = is_recent(F.col("last"), AS_OF)
    return c.select("ord", "lat", "lng", recent.alias("recent"), F.when(recent, F.lit(0.1)).otherwise(F.lit(0.05)).alias("size"))


def status_bar(spark, sf):
    """Each regulation's last known state: label and last delivery."""
    s = _t(spark, sf, "regulation_snapshots").groupBy("regulation_id").agg(F.max_by(norm_term(F.col("status")), F.struct("snapshot_at", "snapshot_key")).alias("status"), F.max("snapshot_at").alias("at"))
    return s.select("regulation_id", label_of(F.col("status"), STATUS_LABELS).alias("label"), format_minute(F.col("at")).alias("seen"))


def snapshot_countries(spark, sf):
    """Regulations per configured country, the missing ones counted as 0."""
    n = _t(spark, sf, "regulation_snapshots").groupBy(norm_code(F.col("jurisdiction")).alias("code")).agg(F.count_distinct("regulation_id").alias("n"))
    return _t(spark, sf, "country").select(norm_code(F.col("code")).alias("code")).distinct().join(n, "code", "left").select("code", F.coalesce("n", F.lit(0)).alias("regulations"))


def month_groups(spark, sf):
    """The archive: the place of every update in the list of its month, latest first."""
    u = _u(spark, sf).select(month_key(F.col("date")).alias("month"), "date", "row_key")
    return rank_within(u, ["month"], [F.desc("date"), "row_key"], "place").select("month", "row_key", F.col("place").cast("int").alias("place"))


def _nodes(spark, sf):
    return regulation_nodes(*flat_regulations(spark, sf))


def diff_counts(spark, sf):
    """Entries of the four difference lists per record; absent lists count 0."""
    keys = [f"diff_vs_eu.{k}" for k in DIFF_KEYS]
    n = _nodes(spark, sf).groupBy("record_id").pivot("node", keys).agg(F.count(F.lit(1)))
    return _t(spark, sf, "regulation_raw").select(F.col("raw_id").alias("record_id")).join(n, "record_id", "left").select(F.col("record_id").alias("raw_id"), *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(k.removeprefix("diff_vs_eu.")) for k in keys])


def diff_long(spark, sf):
    """The entries themselves, list by list."""
    return _nodes(spark, sf).where(F.col("node").startswith("diff_vs_eu.")).select(F.col("record_id").alias("raw_id"), F.substring_index("node", ".", -1).alias("list"), "pos")


def validate_xor(spark, sf):
    """Payloads with a record, of whatever shape, that isn't either the baseline or a comparison."""
    bridge, bodies = flat_regulations(spark, sf)
    roots = bridge.where("place = ''").join(bodies.dropDuplicates(["object_id"]), "object_id")
    return exactly_one(roots, F.get_json_object("body", "$.is_baseline"), F.get_json_object("body", "$.diff_vs_eu")).select(F.col("record_id").alias("raw_id")).distinct()


def validate_regulations(spark, sf):
    """Every broken rule of the nested parts of the records as received."""
    return regulation_violations(*flat_regulations(spark, sf)).withColumnRenamed("record_id", "raw_id")


QUERIES = {
    "latest_updates": latest_updates, "faceted_search": faceted_search, "search_by_month": search_by_month, "facet_values": facet_values, "update_labels": update_labels, "source_counts": source_counts, "source_union": source_union,
    "topic_join": topic_join, "country_report": country_report, "timeline": timeline, "timeline_years": timeline_years, "matrix_grid": matrix_grid, "matrix_literal": matrix_literal, "axis_unpivot": axis_unpivot,
    "recent_markers": recent_markers, "status_bar": status_bar, "snapshot_countries": snapshot_countries, "month_groups": month_groups, "diff_counts": diff_counts, "diff_long": diff_long, "validate_xor": validate_xor, "validate_regulations": validate_regulations,
}

_U = f"u as (select * replace ({_code('country')} as country) from updates)"
_pick = lambda c, labels, default: f"case {c} " + " ".join(f"when '{k}' then '{v}'" for k, v in labels.items()) + f" else {default} end"
_HAY = "lower(coalesce(title, '') || ' ' || coalesce(summary.what, '') || ' ' || coalesce(summary.who, '') || ' ' || coalesce(summary.when_impact, ''))"
_TL = f"""tl as (select row_key, country, publication_date as "day", 'publication' kind from u union all select row_key, country, effective_date, 'effective' from u union all select row_key, country, deadline_date, 'deadline' from u)"""
_join = lambda c, sep, empty: f"case when len({c}) > 0 then array_to_string({c}, '{sep}') else '{empty}' end"
_urls = lambda c: f"list_transform({c}, lambda s: s.url)"

ORACLES = {
    "latest_updates": "select row_key, date, row_number() over (order by date desc, row_key) = 1 big from updates order by date desc, row_key limit 3",
    "faceted_search": f"""with {_U} select row_key, date[1:7] as "month" from u where country in ('eu', 'wr', 'sv') and axis in ('penalties', 'transparency', 'general') and change_type in ('status_change', 'new_regulation') and contains({_HAY}, 'no.')""",
    "search_by_month": f"""with h as (select date[1:7] m, count(*) hits from updates where axis = 'penalties' and contains({_HAY}, 'register') group by 1)
select a.m as "month", coalesce(hits, 0) hits, hits is not null shown from (select distinct date[1:7] m from updates) a left join h on a.m is not distinct from h.m""",
    "facet_values": f"""with {_U}, p as (select *, row_number() over (order by date desc, row_key) pos from u),
c as (select pos, 'month' facet, date[1:7] as "value" from p union all select pos, 'axis', axis from p union all select pos, 'change_type', change_type from p union all select pos, 'country', country from p),
f as (select facet, "value", min(pos) q from c group by 1, 2) select facet, "value", cast(row_number() over (partition by facet order by q) as integer) ord from f""",
    "update_labels": f"""with {_U}, n as (select {_code("code")} country, min(name_ja) n from country where name_ja is not null group by 1)
select row_key, {_pick("axis", AXIS_LABELS, "axis")} axis_label, {_pick("change_type", CHANGE_TYPE_LABELS, "change_type")} type_label, coalesce(n, country) country_label from u left join n using (country)""",
    "source_counts": "select ord, coalesce(len(official_sources), 0) official_sources, coalesce(len(watch_feeds), 0) watch_feeds, coalesce(len(news_queries), 0) news_queries from country",
    "source_union": f"""with l as (select row_number() over () r, ord, list_concat(coalesce({_urls("official_sources")}, []), coalesce({_urls("watch_feeds")}, [])) l from country)
select ord, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') sources from l""",
    "topic_join": f"select ord, {_join('news_queries', '、', EMPTY_LIST)} topics from country",
    "country_report": f"""select ord, '【' || coalesce(nullif(name_ja, ''), nullif(name_en, ''), code) || 'のAI規制とEU AI Actの差分】' || strftime(added_at at time zone 'UTC', '%Y-%m-%d') || '時点' || chr(10) || '規制名: ' || coalesce(name_en, '') || '（状態: ' || code || '）' || chr(10)
  || '■ official: ' || {_join(_urls("official_sources"), '、', EMPTY_REPORT)} || chr(10) || '■ news: ' || {_join("news_queries", '、', EMPTY_REPORT)} || chr(10) || '出典: ' || coalesce(array_to_string({_urls("watch_feeds")}, ' '), '') report from country""",
    "timeline": f"""with {_U}, {_TL} select row_key, country, "day", kind, "day" > '{AS_OF}' is_future from tl where "day" is not null""",
    "timeline_years": f"""with {_U}, {_TL} select "day"[1:4] as "year", count(*) n, count(*) filter (where "day" > '{AS_OF}') ahead from tl where "day" is not null group by 1""",
    "matrix_grid": f"""with {_U}, c as (select {_code("code")} code, min(ord) ord from country group by 1)
select c.code, c.ord, {", ".join(f"nullif(count(*) filter (where axis = '{a}'), 0) {a}" for a in AXES)}, cast(row_number() over (order by case when c.code = 'eu' then 0 else 1 end, c.ord) as integer) place from c left join u on u.country = c.code group by c.code, c.ord""",
    "matrix_literal": "select * from (values " + ", ".join(f"('{k}', {i}, {', '.join(repr(x) for x in v)}, {i + 1})" for i, (k, v) in enumerate(MATRIX_CELLS.items())) + f") t(code, ord, {', '.join(AXES)}, place)",
    "axis_unpivot": "\nunion all\n".join(f"select row_key, '{i:02d}' as \"no\", '{f}' field, coalesce(nullif(summary.{f}, ''), '{EMPTY_SUMMARY}') as \"text\" from updates" for i, f in enumerate(("what", "who", "when_impact"), 1)),
    "recent_markers": f"""with {_U}, l as (select country, max(ingested_at) t from u group by 1), m as (select ord, lat, lng, coalesce(epoch_us(timestamptz '{AS_OF} 00:00:00+00') - epoch_us(t) < 604800000000, false) recent from country left join l on l.country = {_code("code")})
select ord, lat, lng, recent, case when recent then 0.1::double else 0.05::double end size from m""",
    "status_bar": f"""with s as (select regulation_id, arg_max(struct_pack(v := {_term("status")}), (snapshot_at, snapshot_key)).v status, max(snapshot_at) t from regulation_snapshots group by 1)
select regulation_id, {_pick("status", STATUS_LABELS, "status")} as label, strftime(t at time zone 'UTC', '%Y-%m-%d %H:%M UTC') seen from s""",
    "snapshot_countries": f"""with n as (select {_code("jurisdiction")} code, count(distinct regulation_id) n from regulation_snapshots group by 1) select c.code, coalesce(n, 0) regulations from (select distinct {_code("code")} code from country) c left join n using (code)""",
    "month_groups": """select date[1:7] as "month", row_key, cast(row_number() over (partition by date[1:7] order by date desc, row_key) as integer) place from updates""",
    "validate_xor": """with recursive v as (
  select raw_id, case when json_valid(ltrim(payload, chr(65279))) then ltrim(payload, chr(65279))::json end j from regulation_raw
  union all
  select raw_id, unnest(case when json_type(j) = 'ARRAY' then json_extract(j, '$[*]')
    when json_type(j) = 'VARCHAR' then [case when json_valid(j ->> '$') and left(ltrim(j ->> '$'), 1) in ('{', '[') then (j ->> '$')::json end]
    when not list_has_any(list_transform(json_keys(j), lambda k: replace(lower(k), '_', '')), ['axes', 'diffvseu']) then [coalesce(json_extract(j, '$.record'), json_extract(j, '$.data'), json_extract(j, '$.regulation'), json_extract(j, '$.payload'))] end)
  from v where j is not null and json_type(j) in ('ARRAY', 'VARCHAR', 'OBJECT')
), r as (select raw_id, j from v where json_type(j) = 'OBJECT' and (list_has_any(list_transform(json_keys(j), lambda k: replace(lower(k), '_', '')), ['axes', 'diffvseu']) or coalesce(json_extract(j, '$.record'), json_extract(j, '$.data'), json_extract(j, '$.regulation'), json_extract(j, '$.payload')) is null))
select distinct raw_id from r where (coalesce(json_extract(j, '$.is_baseline'), json_extract(j, '$.isBaseline'), 'null')::varchar = 'null')
  = (coalesce(json_extract(j, '$.diff_vs_eu'), json_extract(j, '$.diffVsEu'), 'null')::varchar in ('null', '""', '[]'))""",
}
