"""The pages of the site as DataFrame functions over a catalogue's tables; ``as_of`` is always given, never the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.values import APPROACH_LABELS, AXES, AXIS_LABELS, DIFF_KEYS, DIFF_LABELS, EMPTY_REPORT, EMPTY_SUMMARY, STATUS_LABELS
from jurisdiff.operators.merge import work_items
from jurisdiff.plans.views import is_recent, label_of, text_report


def _entries(c: str, of: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast(of))


_DIFF = "array<struct<topic:string,note:string,source:string>>"
_TIMELINE = "array<struct<date:string,event:string,source:string>>"


def page_path(base: str, path: Column) -> Column:
    """A path below the site's base, which may end in a slash."""
    return F.concat(F.lit(base.rstrip("/")), path)


def axis_rows(regulations: DataFrame) -> DataFrame:
    """jurisdiction, no, axis, label, summary, detail, sources: six rows a regulation in fixed order, a dash for an empty summary."""
    rows = F.array(*[F.struct(F.lit(f"{i:02d}").alias("no"), F.lit(a).alias("axis"), F.lit(AXIS_LABELS[a]).alias("label"), F.coalesce(F.nullif(F.col(f"axes.{a}.summary"), F.lit("")), F.lit(EMPTY_SUMMARY)).alias("summary"), F.col(f"axes.{a}.detail").alias("detail"), F.coalesce(F.array_join(f"axes.{a}.sources", " "), F.lit("")).alias("sources")) for i, a in enumerate(AXES, 1)])
    return regulations.select("jurisdiction", F.explode(rows).alias("x")).select("jurisdiction", "x.*")


def timeline_rows(countries: DataFrame, regulations: DataFrame, as_of: str) -> DataFrame:
    """All timeline entries with their country, latest first (then in configured order), marked if they lie ahead."""
    r = regulations.select("jurisdiction", F.posexplode(_entries("axes.timeline", _TIMELINE)).alias("pos", "t"))
    joined = countries.join(r, F.col("code") == F.col("jurisdiction"))
    return joined.select("ord", "code", "flag", "name_ja", "pos", "t.date", "t.event", "t.source", F.coalesce(F.col("t.date") > as_of, F.lit(False)).alias("is_future")).orderBy(F.desc("date"), "ord", "pos")


def diff_rows(regulations: DataFrame) -> DataFrame:
    """jurisdiction, list, label, pos, topic, note, source of the difference lists."""
    lists = F.array(*[F.struct(F.lit(k).alias("list"), F.lit(i).alias("rank"), F.lit(DIFF_LABELS[k]).alias("label"), _entries(f"diff_vs_eu.{k}", _DIFF).alias("items")) for i, k in enumerate(DIFF_KEYS)])
    return regulations.select("jurisdiction", F.explode(lists).alias("l")).select("jurisdiction", "l.list", "l.rank", "l.label", F.posexplode("l.items").alias("pos", "d")).select("jurisdiction", "list", "rank", "label", "pos", "d.topic", "d.note", "d.source")


def diff_sizes(regulations: DataFrame) -> DataFrame:
    """Length of each list; absent lists have 0."""
    return regulations.select("jurisdiction", *[F.size(_entries(f"diff_vs_eu.{k}", _DIFF)).alias(k) for k in DIFF_KEYS])


def _diff_sources() -> Column:
    return F.flatten(F.array(*[F.transform(_entries(f"diff_vs_eu.{k}", _DIFF), lambda d: d["source"]) for k in DIFF_KEYS]))


def regulation_sources(regulations: DataFrame) -> DataFrame:
    """Different sources of a regulation in first-seen order: axes, timeline, difference lists."""
    axes = F.flatten(F.array(*[F.coalesce(F.col(f"axes.{a}.sources"), F.array().cast("array<string>")) for a in AXES]))
    entries = F.transform(_entries("axes.timeline", _TIMELINE), lambda t: t["source"])
    present = F.filter(F.concat(axes, entries, _diff_sources()), lambda s: F.coalesce(s, F.lit("")) != "")
    return regulations.select("jurisdiction", F.array_distinct(present).alias("sources"))


def copy_reports(countries: DataFrame, regulations: DataFrame, footer: Column | None = None) -> DataFrame:
    """code, report: the text to copy from a country's page; the baseline has none."""
    topics = {DIFF_LABELS[k]: F.transform(_entries(f"diff_vs_eu.{k}", _DIFF), lambda d: d["topic"]) for k in DIFF_KEYS}
    r = countries.join(regulations.where(~F.coalesce("is_baseline", F.lit(False))), F.col("code") == F.col("jurisdiction"))
    sources = F.filter(F.array_distinct(_diff_sources()), lambda s: s.isNotNull())
    return r.select("code", text_report(F.col("name_ja"), F.col("last_checked"), F.col("regulation_name"), label_of(F.col("status"), STATUS_LABELS), topics, sources, footer).alias("report"))


def home(countries: DataFrame, regulations: DataFrame, updates: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the three latest updates with their country, map markers, status chips)."""
    top = updates.orderBy(F.desc("date"), "file", "pos").limit(3)
    latest = top.join(countries.select("code", "flag", "name_ja"), F.col("country") == F.col("code"), "left").orderBy(F.desc("date"), "file", "pos")
    r = countries.join(regulations, F.col("code") == F.col("jurisdiction"))
    recent = is_recent(F.col("last_changed"), as_of)
    markers = r.select("ord", "lat", "lng", recent.alias("recent"), F.when(recent, 0.1).otherwise(0.05).alias("size")).orderBy("ord")
    chips = r.select("ord", "code", "flag", "regulation_name", label_of(F.col("status"), STATUS_LABELS).alias("status"), label_of(F.col("approach"), APPROACH_LABELS).alias("approach"), recent.alias("recent")).orderBy("ord")
    return latest, markers, chips


def country_page(countries: DataFrame, regulations: DataFrame, updates: DataFrame, code: str, as_of: str) -> dict[str, DataFrame]:
    """The parts of one jurisdiction's page; an unknown code gives empty ones."""
    c, r = countries.where(F.col("code") == code), regulations.where(F.col("jurisdiction") == code)
    return {
        "country": c, "axes": axis_rows(r), "diffs": diff_rows(r).orderBy("rank", "pos"), "sizes": diff_sizes(r), "timeline": timeline_rows(c, r, as_of),
        "sources": regulation_sources(r), "report": copy_reports(c, r), "updates": updates.where(F.col("country") == code).orderBy(F.desc("date"), "file", "pos"),
    }


def prompt_rows(candidates: DataFrame, most: int = 300) -> DataFrame:
    """seq, payload: what a classifier is shown of each candidate, as JSON."""
    return candidates.select("seq", F.to_json(F.struct(F.col("seq").alias("index"), "title", F.substring("snippet", 1, most).alias("snippet"), "country_hint")).alias("payload"))


def issues(records: DataFrame, regress: DataFrame, failures: DataFrame) -> DataFrame:
    """Queued work of a run. records: country, title, diff_changed, diff_note; regress: country, status; failures: url, message."""
    changed = work_items("diff-change", records.where(F.coalesce("diff_changed", F.lit(False))), F.concat(F.lit("Difference changed: "), "country", F.lit(" "), "title"), F.coalesce("diff_note", F.lit(EMPTY_REPORT)))
    back = work_items("needs-review", regress, F.concat(F.lit("Status would step back: "), "country"), F.col("status"))
    failed = work_items("needs-review", failures, F.concat(F.lit("Failed: "), F.substring("url", 1, 80)), F.col("message"))
    return changed.unionByName(back).unionByName(failed)


def bad_status(meta: DataFrame) -> DataFrame:
    """The run's metadata if its status isn't ok."""
    return meta.where(~F.col("status").eqNullSafe("ok"))


def untriaged(candidates: DataFrame) -> DataFrame:
    """The work item of a run whose classifier failed: how many candidates were skipped."""
    n = candidates.agg(F.count("*").alias("n"))
    return work_items("needs-review", n, F.lit("Classification failed"), F.concat(F.col("n").cast("string"), F.lit(" candidates skipped")))
