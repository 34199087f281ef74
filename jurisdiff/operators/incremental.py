"""Per-source high-water marks and content-hash change detection, as batch steps over state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.text import content_hash
from jurisdiff.functions.values import FIRST_RUN_DAYS


def feed_step(items: DataFrame, marks: DataFrame, as_of: str, first_run_days: int = FIRST_RUN_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new items, items discarded as late or undated, marks after the run).

    items: feed, published and further columns. marks: feed, last_seen. An item
    is new if it is dated and later than its feed's mark; a feed without one
    starts ``first_run_days`` before as_of. The new mark is the latest date
    seen, discarded items included, and never falls.
    """
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(first_run_days))
    joined = items.join(marks.select("feed", "last_seen"), "feed", "left")
    fresh = F.coalesce(F.col("published") > F.coalesce("last_seen", start), F.lit(False))
    seen = items.groupBy("feed").agg(F.max("published").alias("latest"))
    after = marks.select("feed", "last_seen").join(seen, "feed", "full_outer").select("feed", F.greatest("last_seen", "latest").alias("last_seen"))
    return joined.where(fresh).drop("last_seen"), joined.where(~fresh).drop("last_seen"), after.where("last_seen is not null")


def page_step(pages: DataFrame, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages whose content changed, hashes after the run).

    pages: url, text. hashes: url, hash. A page seen for the first time is no
    change; its hash is stored all the same, and so is a changed page's,
    whether or not anything is drawn from it later.
    """
    current = pages.withColumn("hash", content_hash(F.col("text")))
    joined = current.join(hashes.select("url", F.col("hash").alias("prev")), "url", "left")
    changed = joined.where("prev is not null and prev <> hash").drop("prev", "hash")
    now = current.groupBy("url").agg(F.max("hash").alias("hash"))
    return changed, now.unionByName(hashes.select("url", "hash").join(now, "url", "left_anti"))


def run_status(outcomes: DataFrame) -> DataFrame:
    """successes, failures and the run's status: partial if all failed and some did, else ok. outcomes: ok."""
    return outcomes.agg(F.count_if(F.col("ok")).alias("successes"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("failures")).withColumn("status", F.when((F.col("failures") > 0) & (F.col("successes") == 0), "partial").otherwise("ok"))


def run_meta(outcomes: DataFrame, now: str, crashed: bool = False) -> DataFrame:
    """last_sweep, status of a run, as stored at its end: ``failed`` if it broke off, else the status of its outcomes; one without outcomes is ok."""
    return run_status(outcomes).select(F.lit(now).alias("last_sweep"), F.when(F.lit(crashed), "failed").otherwise(F.col("status")).alias("status"))
