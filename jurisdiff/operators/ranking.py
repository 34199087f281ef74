"""Places within groups of any size: no group has to fit one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jurisdiff.session import materialize


def rank_within(df: DataFrame, keys: list[str], order: list[Column | str], to: str = "rank") -> DataFrame:
    """df with the place of every row within its keys (from 1), by an order that leaves no ties.

    Rows are range-partitioned on keys and order, so a hot group is spread over
    as many partitions as its rows need; a row's place is its place there plus
    the rows of its group in the partitions before, of which there is one
    count a partition and group. Null keys are a group of their own.
    """
    spread = materialize(df.repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id()), "ranked")
    counts = spread.groupBy("_pid", *keys).agg(F.count("*").alias("_c"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    local = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order))).alias("l")
    b = before.alias("b")
    same = F.col("l._pid") == F.col("b._pid")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}"))
    return local.join(b, same).select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._n") + F.col("b._before")).alias(to))
