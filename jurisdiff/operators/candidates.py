"""Candidates of a run: items of feeds and links of pages brought to one form and united over all sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.text import normalize_url
from jurisdiff.functions.values import SNIPPET_CHARS
from jurisdiff.operators.dedupe import first_per_url


def candidates(items: DataFrame, seq: Column, hint: Column, source_type: str, source_group: str, snippet: str | None = None) -> DataFrame:
    """seq, title, url (normal form), snippet, country_hint, source_type, source_group. items: title and link or url; without a snippet the title stands for it. Null texts become ''."""
    link = "link" if "link" in items.columns else "url"
    short = F.substring(F.coalesce(F.col(snippet or "title"), F.lit("")), 1, SNIPPET_CHARS)
    return items.select(
        seq.alias("seq"), F.coalesce("title", F.lit("")).alias("title"), normalize_url(F.coalesce(F.col(link), F.lit(""))).alias("url"), short.alias("snippet"),
        hint.alias("country_hint"), F.lit(source_type).alias("source_type"), F.lit(source_group).alias("source_group"),
    )


def united(parts: list[DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the first candidate of each address in the order of seq, those that only lead to search news, counts per group). counts: source_group, found, kept, news; what is neither kept nor news was a repeat or had no address."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    kept, news = first_per_url(whole)
    of = lambda df, name: df.groupBy("source_group").agg(F.count("*").alias(name))
    counts = of(whole, "found").join(of(kept, "kept"), "source_group", "left").join(of(news, "news"), "source_group", "left").fillna(0)
    return kept, news, counts
