"""History of changing entity attributes by tree-reduction coalescing.

Every snapshot is a unit interval. Neighbouring intervals of one entity with an
equal payload are merged pairwise over logarithmic rounds: first inside each
range partition (vectorised, after a null-filling scan in doubling rounds), then
across partitions by a pairwise tree over one summary row a partition, which a
single task holds whatever the data (some megabytes at 100,000 partitions). The range
partitioning is on (entity, time), so one entity that holds a third of all rows
is spread over as many partitions as its rows need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jurisdiff.session import materialize


def _fill_rounds(new: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Last value not null within each entity, by log2(n) doubling rounds. new: the entity starts here."""
    v, n = v.copy(), len(v)
    seg = np.cumsum(new)
    step = 1
    while step < n:
        gap = pd.isna(v[step:]) & (seg[step:] == seg[:-step])
        if not (pd.isna(v) & ~new).any():
            break
        src = v[:-step].copy()
        v[step:][gap] = src[gap]
        step *= 2
    return v


def _merge_rounds(new: np.ndarray, vals: list[np.ndarray]) -> np.ndarray:
    """Which unit intervals begin a run after neighbouring runs of one entity and equal payload were merged pairwise.

    Round r merges blocks of 2**r intervals two by two: the last run of the left
    block takes in the first of the right one if they belong together. Each
    border between two intervals is looked at in one round, so log2(n) rounds
    cost n comparisons.
    """
    n = len(new)
    begins = np.ones(n, bool)
    size = 1
    while size < n:
        border = np.arange(size, n, 2 * size)
        apart = new[border].copy()
        for v in vals:
            apart |= v[border] != v[border - 1]
        begins[border] = apart
        size *= 2
    return begins


def _local_runs(k: int):
    names = [f"v{i}" for i in range(k)]

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        pid, ord_, last_e, last_v, first_e = TaskContext.get().partitionId(), 0, None, [None] * k, None
        for pdf in batches:
            if not len(pdf):
                continue
            e = pdf["entity"].to_numpy()
            first_e = e[0] if first_e is None else first_e
            new = np.r_[e[0] != last_e, e[1:] != e[:-1]]
            vals = []
            for i, c in enumerate(names):
                v = pdf[c].to_numpy(dtype=object).copy()
                v[pd.isna(v)] = None
                if not new[0] and v[0] is None:
                    v[0] = last_v[i]
                vals.append(_fill_rounds(new, v))
            begins = _merge_rounds(new, vals)
            begins[0] = new[0] or any(v[0] != x for v, x in zip(vals, last_v))
            last_e, last_v = e[-1], [v[-1] for v in vals]
            idx = np.flatnonzero(begins)
            if len(idx):
                out = pd.DataFrame({"pid": pid, "ord": ord_ + np.arange(len(idx)), "entity": e[idx], "start": pdf["at"].to_numpy()[idx]})
                for c, v in zip(names, vals):
                    out[c] = v[idx]
                ord_ += len(idx)
                yield out

    return runs


def _carry_tree(k: int):
    """One row a partition in, the payload carried into each partition out.

    The summaries are combined pairwise over log2(partitions) rounds (an
    inclusive scan of an associative merge); there are as many rows as
    partitions, never as entities.
    """

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pid").reset_index(drop=True)
        acc = [(r.first_e, r.last_e, tuple(None if pd.isna(getattr(r, f"l{i}")) else getattr(r, f"l{i}") for i in range(k))) for r in pdf.itertuples()]

        def merge(a, b):
            if b[0] == b[1] == a[1]:
                return (a[0], b[1], tuple(y if y is not None else x for x, y in zip(a[2], b[2])))
            return (a[0], b[1], b[2])

        step = 1
        while step < len(acc):
            acc = [merge(acc[i - step], acc[i]) if i >= step else acc[i] for i in range(len(acc))]
            step *= 2
        out = pd.DataFrame({"pid": pdf["pid"], "ce": [None] + [a[1] for a in acc[:-1]]})
        for i in range(k):
            out[f"c{i}"] = [None] + [a[2][i] for a in acc[:-1]]
        return out

    return tree


def coalesce_history(df: DataFrame, entity: str, at: str, latest_by: list[str], payload: dict[str, Column]) -> DataFrame:
    """Versions of every entity with the period each was valid.

    df: one row a snapshot delivery. Of several rows for one (entity, at) only
    the greatest by ``latest_by`` counts (nulls are least; put a unique column
    last, so that ties are settled). payload: name -> string expression; null
    means "not reported" and keeps the value before it.

    Returns entity, valid_from, valid_to (null: still valid), the payload. Rows
    without an entity or time belong to no version and are left out. Before a
    column was first reported its value is null, and the first report begins a
    new version. An empty input gives no rows; further columns are ignored.
    """
    k = len(payload)
    names = [f"v{i}" for i in range(k)]
    base = df.select(
        F.col(entity).cast("string").alias("entity"), F.col(at).cast("timestamp").alias("at"),
        F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(latest_by)]).alias("rank"),
        F.struct(*[x.cast("string").alias(n) for n, x in zip(names, payload.values())]).alias("p"),
    ).where("entity is not null and at is not null")
    units = base.groupBy("entity", "at").agg(F.max_by("p", "rank").alias("p")).select("entity", "at", *[F.col(f"p.{n}").alias(n) for n in names])
    parts = units.repartitionByRange("entity", "at").sortWithinPartitions("entity", "at")
    schema = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("ord", T.LongType()), T.StructField("entity", T.StringType()), T.StructField("start", T.TimestampType()), *[T.StructField(n, T.StringType()) for n in names]])
    runs = materialize(parts.mapInPandas(_local_runs(k), schema), "runs")

    summary = runs.groupBy("pid").agg(
        F.min_by("entity", "ord").alias("first_e"), F.max_by("entity", "ord").alias("last_e"), *[F.max_by(F.struct(n), "ord")[n].alias(f"l{i}") for i, n in enumerate(names)]
    )
    carry_schema = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("ce", T.StringType()), *[T.StructField(f"c{i}", T.StringType()) for i in range(k)]])
    carry = summary.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_carry_tree(k), carry_schema)

    # One row a partition: the broadcast grows with the number of partitions only.
    same = F.col("entity") == F.col("ce")
    filled = runs.join(F.broadcast(carry), "pid", "left").select(
        "pid", "ord", "entity", "start", "ce", *[F.coalesce(n, F.when(same, F.col(f"c{i}"))).alias(n) for i, n in enumerate(names)], *[f"c{i}" for i in range(k)]
    )
    w = Window.partitionBy("pid").orderBy("ord")
    prev_same = F.coalesce(F.lag("entity").over(w), F.col("ce")) == F.col("entity")
    is_first = F.col("ord") == 0
    changed = F.lit(False)
    for i, n in enumerate(names):
        changed = changed | ~F.col(n).eqNullSafe(F.when(is_first, F.col(f"c{i}")).otherwise(F.lag(n).over(w)))
    versions = filled.withColumn("begins", F.coalesce(~prev_same, F.lit(True)) | changed).where("begins").select("pid", "ord", "entity", "start", *names)

    heads = versions.groupBy("pid").agg(F.min_by(F.struct("entity", "start"), "ord").alias("h"))
    nexts = heads.select("pid", F.lead("h").over(Window.orderBy("pid")).alias("nh"))
    follow = F.lead(F.struct("entity", "start")).over(w)
    nxt = F.coalesce(follow, F.col("nh"))
    return versions.join(F.broadcast(nexts), "pid", "left").select(
        F.col("entity"), F.col("start").alias("valid_from"), F.when(nxt["entity"] == F.col("entity"), nxt["start"]).alias("valid_to"), *[F.col(n).alias(c) for n, c in zip(names, payload)]
    )
