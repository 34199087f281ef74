"""Quality gates with reason codes: the first failing test names the reason, null passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.codes import trim_blanks
from jurisdiff.functions.text import days_between, is_news_search, is_ymd
from jurisdiff.functions.values import BLOCKED_PHRASES, KEYWORDS, MIN_BODY_CHARS, RECENCY_DAYS


def has_keyword(lower: Column, keywords: list[str] = KEYWORDS) -> Column:
    """Does a text in lower case hold any of the words, inside longer words too? Words within other words are left out of the test."""
    words = sorted({k.lower() for k in keywords if k.strip()})
    least = [w for w in words if not any(v != w and v in w for v in words)]
    return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in least]) if least else F.lit(False)


def looks_blocked(text: Column, lower: Column) -> Column:
    """Is it a page that only asks for scripts or cookies, or 20 anonymous functions?"""
    phrases = reduce(lambda a, b: a | b, [F.contains(lower, F.lit(p)) for p in BLOCKED_PHRASES])
    return phrases | (F.regexp_count(text, F.lit(r"function\s*\(\)\s*\{")) >= 20)


def mechanical_reason(url: Column, text: Column, lower: Column, min_chars: int = MIN_BODY_CHARS, keywords: list[str] = KEYWORDS) -> Column:
    """Reason an article is dropped for, tests in rising order of cost; null: it passes. lower: the text in lower case, computed once."""
    body = F.coalesce(text, F.lit(""))
    return (
        F.when(is_news_search(url), "google-news-source")
        .when(F.length(trim_blanks(body)) < min_chars, "body-too-short")
        .when(~F.coalesce(has_keyword(lower, keywords), F.lit(False)), "no-ai-reg-keyword")
        .when(F.coalesce(looks_blocked(body, lower), F.lit(False)), "blocked-or-js-only-page")
    )


def mechanical_gate(df: DataFrame, url: str = "url", text: str = "text", min_chars: int = MIN_BODY_CHARS, keywords: list[str] = KEYWORDS) -> DataFrame:
    """df with ``reason``. Null and empty texts are too short; a null address is no search-news link."""
    lowered = df.withColumn("_lower", F.lower(F.coalesce(F.col(text), F.lit(""))))
    return lowered.withColumn("reason", mechanical_reason(F.col(url), F.col(text), F.col("_lower"), min_chars, keywords)).drop("_lower")


def publication_reason(published: Column, as_of: str, days: int = RECENCY_DAYS) -> Column:
    """Reason a publication date is dropped for: not of a date's shape, or ``days`` old or older. Future dates pass."""
    return F.when(~is_ymd(published), "missing-publication-date").when(days_between(published, F.lit(as_of)) >= days, "stale-publication-date")


def split_by_reason(df: DataFrame, url: Column, country: Column, hint: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, drops as url, reason, country)."""
    kept = df.where(F.col("reason").isNull()).drop("reason")
    where = F.coalesce(F.nullif(country, F.lit("")), F.nullif(hint, F.lit("")) if hint is not None else F.lit(None))
    return kept, df.where(F.col("reason").isNotNull()).select(F.coalesce(url, F.lit("")).alias("url"), "reason", where.alias("country"))


def reason_histogram(df: DataFrame) -> DataFrame:
    """Rows per reason and in total (reason ``total``)."""
    return df.where("reason is not null").rollup("reason").agg(F.count("*").alias("n")).select(F.coalesce("reason", F.lit("total")).alias("reason"), "n")
