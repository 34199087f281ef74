"""Deduplicating new batches against all history by a pivot-distance table.

An event is a point: the bag of its words. The distance of two points is the
number of words one has and the other hasn't, a true metric, so a word that was
lost, or added, lies within the radius, and another word in place of one lies
beyond it.

Pivot i is the point that holds every word of hash class i; the pivots are so
fixed without looking at data. What a point's words add to that distance (the
words outside the class less those inside; the rest is the same for all points)
is stored with each point of the history. The differences of two points'
distances, which is all the triangle inequality uses, are exact.

Classes are disjoint, so the differences of the counts behind all the distances
add up to no more than the distance of the points. Hence of RADIUS + 1 groups
of pivots one has equal distances for any two points within the radius: a batch
is joined with the table on the ranges (of width one) of a group's distances,
the triangle inequality on the other pivots prunes, and the metric itself
decides. Accepted points are appended; the history's texts are never read
again, and an event told a million times is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.session import Appended, materialize

#: Events at most this many words apart are the same: a word lost in damage, or one that decorates.
RADIUS = 1
#: Pivots of each of the RADIUS + 1 groups.
GROUP_PIVOTS = 8
#: A batch of no more points (about 250 bytes each) is sent to the executors; a greater one is shuffled.
BROADCAST_POINTS = 100_000
_PIVOTS = GROUP_PIVOTS * (RADIUS + 1)
_POINT = ["country", "number", "words"]


def between(a: Column, b: Column) -> Column:
    """The distance of two bags of words."""
    return F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))


def pivot_distances(classes: Column) -> Column:
    """Array of the distances to the pivots, as far as they depend on the point. classes: the hash class of each of its words."""
    inside = lambda i: F.size(F.filter(classes, lambda k: k == i))
    return F.transform(F.sequence(F.lit(0), F.lit(_PIVOTS - 1)), lambda i: F.size(classes) - 2 * inside(i))


def event_points(read: DataFrame) -> DataFrame:
    """row_key, batch_no, country, number, words and the point's identity; rows that report no event or no country are left out."""
    p = read.where(F.col("country").isNotNull() & (F.size("words") > 0)).select("row_key", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), *_POINT)
    return p.withColumn("point", F.unhex(F.md5(F.to_json(F.struct(*_POINT)))))


def pivot_table(points: DataFrame) -> DataFrame:
    """Each distinct point of a batch once: its smallest row_key, its distances to the pivots and, for each group of them, its range.

    The range is that of the counts inside the classes, which are half of the
    bag's size less the distance, with the country and number points must share.
    """
    distinct = points.groupBy("batch_no", "point").agg(F.min("row_key").alias("first_key"), *[F.first(c).alias(c) for c in _POINT])
    hashed = distinct.withColumn("classes", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(_PIVOTS)).cast("int")))
    table = hashed.withColumn("d", pivot_distances(F.col("classes"))).drop("classes")
    inside = F.transform("d", lambda x: F.size("words") - x)
    ranges = [F.xxhash64("country", "number", F.lit(g), F.slice(inside, g * GROUP_PIVOTS + 1, GROUP_PIVOTS)) for g in range(RADIUS + 1)]
    return table.withColumn("ranges", F.array(*ranges))


def nearest_first(queries: DataFrame, table: DataFrame, few: bool) -> DataFrame:
    """point, near_key, same_key: for each query point the smallest first_key of the table's points within the radius, and of those at no distance.

    Points are compared within their country and reference number only. few:
    the queries are known to be no more than BROADCAST_POINTS, so the table is
    read past them where it lies; otherwise both sides are shuffled by range.
    """
    side = lambda df, *more: df.select(*more, *_POINT, "d", F.explode("ranges").alias("range"))
    q = side(queries, "point")
    q, t = (F.broadcast(q) if few else q).alias("q"), side(table, "first_key").alias("t")
    same = (F.col("q.range") == F.col("t.range")) & (F.col("q.country") == F.col("t.country")) & (F.col("q.number") == F.col("t.number"))
    pruned = F.array_max(F.zip_with("q.d", "t.d", lambda a, b: F.abs(a - b))) <= RADIUS  # the triangle inequality on every pivot
    apart = F.when(pruned, between(F.col("q.words"), F.col("t.words")))
    near = q.join(t, same).select(F.col("q.point").alias("point"), F.col("t.first_key").alias("k"), apart.alias("apart")).where(F.col("apart") <= RADIUS)
    return near.groupBy("point").agg(F.min("k").alias("near_key"), F.min(F.when(F.col("apart") == 0, F.col("k"))).alias("same_key"))


def match_batch(batch: DataFrame, history: DataFrame | None, few: bool = False) -> DataFrame:
    """The batch's table with near_key (the first report of each event, its own rows included) and is_new (the history lacks the point).

    batch: the pivot table of the batch. history: the tables so far, which are
    joined but never rebuilt; rows of the result with is_new are to be appended.
    few: see nearest_first.
    """
    table = batch if history is None else history.unionByName(batch)
    found = batch.join(nearest_first(batch, table, few), "point")
    return found.withColumn("is_new", F.col("same_key") == F.col("first_key"))


def repeated_in_batches(points: DataFrame) -> DataFrame:
    """row_key_a, row_key_b: rows of the batches (batch_no >= 1) and the first row, of any batch, that reports their event.

    Batch by batch: each is matched with the stored table and itself, then its
    new points are appended to the table. row_key rises with arrival.
    """
    own = materialize(pivot_table(points).sortWithinPartitions("batch_no"), "batch-points")
    sizes = {r["batch_no"]: r["count"] for r in own.groupBy("batch_no").count().collect()}
    accepted = own.where("batch_no < 1")  # its points only
    table = Appended(points.sparkSession, "accepted")
    for b in sorted(b for b in sizes if b >= 1):
        since = table.read()
        history = accepted if since is None else accepted.unionByName(since.where("is_new").select(*own.columns))
        table.add(match_batch(own.where(F.col("batch_no") == b), history, sizes[b] <= BROADCAST_POINTS), b)
    rows, first = points.where("batch_no >= 1").select("row_key", "batch_no", "point"), table.read()
    if first is None:
        return rows.select(F.col("row_key").alias("row_key_a"), F.col("row_key").alias("row_key_b")).where("false")
    repeated = rows.join(first.select("batch_no", "point", "near_key"), ["batch_no", "point"]).where("near_key < row_key")
    return repeated.select(F.col("near_key").alias("row_key_a"), F.col("row_key").alias("row_key_b"))
