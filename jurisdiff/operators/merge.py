"""Building records, allocating identifiers, and merging patches into what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.text import is_ymd, truncated
from jurisdiff.functions.values import STATUS_ORDER
from jurisdiff.operators.ranking import rank_within


def allocate_ids(new: DataFrame, existing: DataFrame, date: str, country: str, seq: str) -> DataFrame:
    """new with ``id``: date-country-NNN, continuing behind the greatest number in use under that prefix.

    existing: id. Numbers of three digits are padded, longer ones not cut.
    Numbers are given in the order of seq. Rows without date or country get no id.
    """
    prefix = F.concat(F.col(date), F.lit("-"), F.col(country), F.lit("-"))
    used = existing.select(F.regexp_extract("id", r"^(.*-)(\d+)$", 1).alias("_prefix"), F.regexp_extract("id", r"^(.*-)(\d+)$", 2).try_cast("bigint").alias("n")).groupBy("_prefix").agg(F.max("n").alias("_max"))
    placed = rank_within(new.withColumn("_prefix", prefix), ["_prefix"], [seq], "_n").join(used, "_prefix", "left")
    digits = (F.coalesce("_max", F.lit(0)) + F.col("_n")).cast("string")
    return placed.withColumn("id", F.concat("_prefix", F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits))).drop("_prefix", "_max", "_n")


def country_anchor(country: Column, axis: Column) -> Column:
    """Anchor of an update: its axis, or the first axis for those that are none of the country page's."""
    return F.concat(F.lit("/country/"), country, F.lit("/#axis-"), F.when(axis.isin("timeline", "general"), "risk_classification").otherwise(axis))


def build_updates(records: DataFrame) -> DataFrame:
    """Update rows from extracted records. records: seq, id, country, url, axis, change_type, title, what, who, when_impact, detail, so_what, diff_changed, diff_note, canonical_event, publication_date, effective_date, deadline_date. A record without an event's name takes its title, uncut."""
    return records.select(
        "id", F.col("publication_date").alias("date"), "country", "axis", "change_type", truncated(F.col("title")).alias("title"),
        F.struct(*[truncated(F.col(c)).alias(c) for c in ("what", "who", "when_impact")]).alias("summary"),
        F.nullif(F.col("detail"), F.lit("")).alias("detail"), "so_what",
        F.struct(F.coalesce("diff_changed", F.lit(False)).alias("diff_changed"), F.coalesce("diff_note", F.lit("")).alias("diff_note")).alias("impact"),
        F.coalesce(F.nullif("canonical_event", F.lit("")), "title").alias("canonical_event"), "publication_date", "effective_date", "deadline_date", F.array("url").alias("sources"), country_anchor(F.col("country"), F.col("axis")).alias("country_anchor"),
        F.substring("publication_date", 1, 7).alias("month"),
    )


def status_rank(c: Column, order: list[str] = STATUS_ORDER) -> Column:
    """Place of a value in an ordered enumeration, from 1; 0 for others and null."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, order)), c), F.lit(0))


def guarded_values(patches: DataFrame, current: DataFrame, key: str, value: str, seq: str, order: list[str] = STATUS_ORDER) -> tuple[DataFrame, DataFrame]:
    """(value per key after all patches, patches that would step back).

    A patch is taken if its rank isn't below that of the value it meets, which
    is the greatest rank so far; empty patches do nothing. So the last value is
    the greatest rank of all, and steps back are those below the running
    greatest. A value outside the enumeration has the lowest rank.
    """
    p = patches.where(F.coalesce(F.col(value), F.lit("")) != "").select(key, seq, F.col(value).alias("new"), status_rank(F.col(value), order).alias("rank"))
    c = current.select(key, F.col(value).alias("old"), status_rank(F.col(value), order).alias("old_rank"))
    # Where each rank is first reached tells the running greatest; there are as many places a key as ranks.
    reached = p.groupBy(key, "rank").agg(F.min(seq).alias("at")).groupBy(key).agg(F.collect_list(F.struct("at", "rank")).alias("reached"))
    before = F.array_max(F.transform(F.filter("reached", lambda x: x["at"] < F.col(seq)), lambda x: x["rank"]))
    met = p.join(c, key).join(reached, key).withColumn("met", F.greatest(F.coalesce(before, F.lit(0)), F.col("old_rank")))
    best = p.groupBy(key).agg(F.max_by("new", F.struct("rank", F.col(seq))).alias("new"), F.max("rank").alias("rank"))
    after = c.join(best, key, "left").select(key, F.when(F.col("rank") >= F.col("old_rank"), F.col("new")).otherwise(F.col("old")).alias(value))
    return after, met.where("rank < met").select(key, seq, F.col("new").alias(value))


def merge_timeline(patches: DataFrame, timeline: DataFrame, keys: list[str], date: str, event: str, seq: str) -> DataFrame:
    """Entries to add: of a date's shape, not there yet by keys, date and event; of repeated patches the first."""
    by = [*keys, date, event]
    first = patches.where(is_ymd(F.col(date))).groupBy(*by).agg(F.min(seq).alias(seq))
    return patches.join(first, [*by, seq], "left_semi").join(timeline.select(*by).distinct(), by, "left_anti")


def touch(df: DataFrame, now: str, changed: Column) -> DataFrame:
    """``last_checked`` becomes now where it is earlier (a missing one stays missing), ``last_changed`` where the row changed."""
    return df.withColumn("last_checked", F.when(F.col("last_checked") < now, F.lit(now)).otherwise(F.col("last_checked"))).withColumn("last_changed", F.when(changed, F.lit(now)).otherwise(F.col("last_changed")))


def overlay(base: DataFrame, over: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``over``, and those of ``base`` whose key it doesn't hold."""
    return over.unionByName(base.join(over, key, "left_anti"))


def insert_absent(existing: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """existing and the seeds whose key is new."""
    return existing.unionByName(seeds.join(existing, key, "left_anti"), allowMissingColumns=True)


def with_current(records: DataFrame, current: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(usable records with the row they change, the others with their reason). records: usable (null: yes); current: one row a key.

    A record that was found unusable is dropped under the fixed reason; one
    whose row is missing fails by itself and stops no other.
    """
    joined = records.join(current.withColumn("_there", F.lit(True)), key, "left")
    reason = F.when(~F.coalesce("usable", F.lit(True)), "gemini-unusable").when(F.col("_there").isNull(), "missing-regulation")
    judged = joined.withColumn("reason", reason).drop("_there")
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def seed_regulations(codes: DataFrame, now: str) -> DataFrame:
    """jurisdiction and the flat fields of an empty regulation, proposed and soft, for each code."""
    return codes.select(F.col("code").alias("jurisdiction"), F.lit("").alias("regulation_name"), F.lit("proposed").alias("status"), F.lit("soft_law").alias("approach"), F.lit(now).alias("last_checked"), F.lit(now).alias("last_changed"))


def work_items(kind: str, rows: DataFrame, title: Column, body: Column) -> DataFrame:
    """title, body, labels of queued work; producers are united, none overwrites another's."""
    return rows.select(title.alias("title"), body.alias("body"), F.array(F.lit(kind)).alias("labels"))
