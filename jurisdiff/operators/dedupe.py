"""Duplicates by priority and order of arrival, and against what is already there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jurisdiff.functions.text import is_news_search
from jurisdiff.functions.values import MAX_PER_RUN


def priority_rank(c: Column) -> Column:
    return F.when(c == "high", 2).when(c == "low", 1).otherwise(0)


def event_keys(items: DataFrame) -> DataFrame:
    """One row per item and country. items: seq, countries, country_hint, priority, label and further columns.

    An item without countries stands under its hint; with neither, or without
    a label, it vanishes unlogged.
    """
    hint = F.when(F.coalesce(F.col("country_hint"), F.lit("")) != "", F.array("country_hint"))
    named = F.when(F.size(F.coalesce("countries", F.array().cast("array<string>"))) > 0, F.col("countries")).otherwise(hint)
    return items.where("label <> ''").select("*", F.posexplode(named).alias("pos", "cc"))


def dedupe_events(items: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(one item per country and label, drops with their reason).

    The highest priority wins, of equals the earliest. ``out_seq`` is the place
    of the key's first item, which gives the order of the result even if a
    later item won. existing: cc, label of events known already.

    The winner and the first place are aggregates with partial sums, so a key
    under which a third of all items stands costs no more than any other.
    """
    keyed = event_keys(items)
    drops = []
    if existing is not None:
        known = existing.select("cc", "label").distinct()
        drops.append(keyed.join(known, ["cc", "label"], "left_semi").withColumn("reason", F.lit("duplicate-existing-event")))
        keyed = keyed.join(known, ["cc", "label"], "left_anti")
    order = F.struct((-priority_rank(F.col("priority"))).alias("r"), "seq", "pos")
    best = keyed.groupBy("cc", "label").agg(F.min(order).alias("best"), F.min(F.struct("seq", "pos")).alias("first"))
    marked = keyed.join(best, ["cc", "label"])
    won = (F.col("best.seq") == F.col("seq")) & (F.col("best.pos") == F.col("pos"))
    kept = marked.where(won).withColumn("out_seq", F.col("first.seq")).drop("best", "first")
    lost = marked.where(~won).drop("best", "first").withColumn("reason", F.lit("duplicate-event-lower-priority"))
    for d in drops:
        lost = lost.unionByName(d)
    return kept, lost


def existing_event_keys(updates: DataFrame, label: Column, as_of: str, days: int) -> DataFrame:
    """Distinct country and label of the updates of the last ``days`` days, the cutoff included. updates: country, date."""
    cutoff = F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyy-MM-dd")
    return updates.where(F.col("date") >= cutoff).select(F.col("country").alias("cc"), label.alias("label")).where("label <> ''").distinct()


def first_per_url(candidates: DataFrame, url: str = "url", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(first candidate of each address, those of them that lead to a search-news host). Empty addresses are dropped first."""
    first = candidates.where(F.coalesce(F.col(url), F.lit("")) != "").groupBy(url).agg(F.min(seq).alias(seq))
    chosen = candidates.join(first, [url, seq], "left_semi")
    news = is_news_search(F.col(url))
    return chosen.where(~news), chosen.where(news)


def first_links(links: DataFrame, page: str, url: str, pos: str, most: int) -> DataFrame:
    """The first ``most`` different links of each page, in page order."""
    first = links.groupBy(page, url).agg(F.min(pos).alias(pos))
    w = Window.partitionBy(page).orderBy(pos)
    return links.join(first.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n"), [page, url, pos])


def top_of_run(items: DataFrame, seq: str, most: int = MAX_PER_RUN) -> tuple[DataFrame, DataFrame]:
    """(the first ``most`` items, high priority before the others, stable; the rest with reason ``over-cap``)."""
    high = F.when(F.col("priority") == "high", 0).otherwise(1)
    top = items.orderBy(high, seq).limit(most)
    rest = items.join(top.select(seq), seq, "left_anti").withColumn("reason", F.lit("over-cap"))
    return top, rest
