"""References to records that do not exist at the time of the reference.

References are aggregated per (field, key, month) before anything is joined;
what remains a key is a handful of rows however many references it has. Heavy
keys, of which a share of all references bounds the number, are checked against
a broadcast of their records; the others in a shuffled join. A month in which a
key is valid only part of the time is settled reference by reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.session import materialize

#: A key is heavy if it holds this share of all references; there are at most 1 / HEAVY_SHARE such keys.
HEAVY_SHARE = 0.02
#: Reference records are broadcast only if there are at most this many of them (24 bytes and the key each).
BROADCAST_ROWS = 100_000

GROUP = ["src_table", "field", "dim", "key", "month"]
_REF, _DIM = ["src_table", "field", "dim", "key", "at", "row_key"], ["dim", "key", "valid_from", "valid_to"]


def period_verdicts(refs: DataFrame, dims: DataFrame) -> DataFrame:
    """Per src_table, field, dim, key, month: n references and the verdict held, orphan or mixed.

    refs: src_table, field, dim, key, at, row_key. dims: dim, key, valid_from,
    valid_to (null: still valid, valid_from null: since ever), one or more
    periods a key, repeated and overlapping ones included. References without a
    key are none; references without a time are orphans.
    """
    refs = refs.select(*_REF).where("key is not null").withColumn("month", F.date_format("at", "yyyy-MM"))
    # Read again by every branch below, and small: it is stored, so that the references are normalised once.
    per = materialize(refs.groupBy(*GROUP).agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")), "references")
    per_key = per.groupBy("dim", "key").agg(F.sum("n").alias("kn"))
    total = per_key.agg(F.sum("kn").alias("total"))
    heavy = per_key.join(F.broadcast(total), F.col("kn") >= F.col("total") * HEAVY_SHARE).select("dim", "key", F.lit(True).alias("heavy"))  # at most 1 / HEAVY_SHARE rows
    flagged = per.join(F.broadcast(heavy), ["dim", "key"], "left")
    dims = dims.select(*_DIM).where("key is not null").distinct()
    small = dims.count() <= BROADCAST_ROWS
    heavy_dims = dims.join(F.broadcast(heavy), ["dim", "key"], "left_semi")

    def judged(part: DataFrame, against: DataFrame) -> DataFrame:
        since = F.col("valid_from").isNull()
        covers = (since | (F.col("valid_from") <= F.col("lo"))) & (F.col("valid_to").isNull() | (F.col("hi") < F.col("valid_to")))
        touches = (since | (F.col("valid_from") <= F.col("hi"))) & (F.col("valid_to").isNull() | (F.col("lo") < F.col("valid_to")))
        found = part.join(against.withColumn("there", F.lit(True)), ["dim", "key"], "left")
        return found.groupBy(*GROUP).agg(
            F.first("n").alias("n"),
            F.coalesce(F.bool_or(F.col("there") & covers), F.lit(False)).alias("covered"),
            F.coalesce(F.bool_or(F.col("there") & touches), F.lit(False)).alias("touched"),
        )

    light = judged(flagged.where("heavy is null"), dims)
    heavies = judged(flagged.where("heavy"), F.broadcast(heavy_dims) if small else heavy_dims)
    verdict = F.when(F.col("covered"), "held").when(F.col("touched"), "mixed").otherwise("orphan")
    return materialize(heavies.unionByName(light).select(*GROUP, "n", verdict.alias("verdict")), "verdicts")


def _settled(refs: DataFrame, verdicts: DataFrame, dims: DataFrame) -> DataFrame:
    """The orphan references themselves; only keys and months with orphans are joined."""
    refs = refs.select(*_REF).where("key is not null").withColumn("month", F.date_format("at", "yyyy-MM"))
    suspects = verdicts.where("verdict <> 'held'").drop("n").withColumn("month", F.coalesce("month", F.lit("")))
    hit = refs.withColumn("month", F.coalesce("month", F.lit(""))).join(suspects, GROUP)
    d = dims.select(*_DIM).distinct()
    # Orphan months match nothing and stay; in mixed months the references that hold drop out.
    live = (F.col("r.verdict") == "mixed") & (F.col("r.dim") == F.col("d.dim")) & (F.col("r.key") == F.col("d.key")) & (F.col("d.valid_from").isNull() | (F.col("d.valid_from") <= F.col("r.at"))) & (F.col("d.valid_to").isNull() | (F.col("r.at") < F.col("d.valid_to")))
    return hit.alias("r").join(d.alias("d"), live, "left_anti")


def orphan_rows(refs: DataFrame, dims: DataFrame) -> DataFrame:
    """Each orphan once: src_table, row_key, field. A field with two references is an orphan if either is."""
    return _settled(refs, period_verdicts(refs, dims), dims).select("src_table", "row_key", "field").distinct()


def orphan_counts(refs: DataFrame, dims: DataFrame) -> DataFrame:
    """Per src_table, field, dim and month: references and orphans, from the aggregates; only mixed months are read again."""
    v = period_verdicts(refs, dims)
    settled = _settled(refs, v.where("verdict = 'mixed'"), dims).groupBy("src_table", "field", "dim", "month").agg(F.count("*").alias("n"))
    whole = v.groupBy("src_table", "field", "dim", F.coalesce("month", F.lit("")).alias("month")).agg(F.sum("n").alias("references"), F.sum(F.when(F.col("verdict") == "orphan", F.col("n")).otherwise(0)).alias("n"))
    return whole.unionByName(settled, allowMissingColumns=True).groupBy("src_table", "field", "dim", "month").agg(F.coalesce(F.sum("references"), F.lit(0)).alias("references"), F.sum("n").alias("orphans"))
