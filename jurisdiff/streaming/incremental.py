"""The incremental steps over streams of landed files: one micro-batch a run, state committed after the sink."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurisdiff.operators.incremental import feed_step, page_step


class StateTable:
    """A table of state by key (the first column), as a whole version and the changes of the batches since.

    A batch stores only the rows it changed; every ``COMPACT`` batches the whole
    state is written once and what came before the version before it is
    deleted. So a batch costs what it changes, and storage doesn't grow with the
    number of batches. A batch that runs again reads what was before it.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        jvm = spark.sparkContext._jvm
        self._at = lambda name="": jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        self._fs = self._at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> dict[int, bool]:
        """Finished versions: number -> is it whole?"""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at())] if self._fs.exists(self._at()) else []
        return {int(n[1:]): n[0] == "w" for n in names if self._fs.exists(self._at(f"{n}/_SUCCESS"))}

    def read(self, batch: int) -> DataFrame:
        """The state before a batch."""
        earlier = {v: whole for v, whole in self._versions().items() if v < batch}
        base = max((v for v, whole in earlier.items() if whole), default=-1)
        used = sorted(v for v in earlier if v >= base)
        if not used:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{'w' if earlier[v] else 'd'}{v}").withColumn("_v", F.lit(v)) for v in used]
        key, *rest = parts[0].columns[:-1]
        every = reduce(DataFrame.unionByName, parts)
        return every.groupBy(key).agg(F.max_by(F.struct(*rest), "_v").alias("s")).select(key, "s.*")

    def write(self, after: DataFrame, batch: int) -> None:
        """Store the state after a batch. Keys are never dropped from it."""
        whole = [v for v, w in self._versions().items() if w and v < batch]
        if not whole or batch - max(whole) >= self.COMPACT:
            after.write.mode("overwrite").parquet(f"{self.path}/w{batch}")
            for v, w in self._versions().items():
                if whole and v < max(whole):
                    self._fs.delete(self._at(f"{'w' if w else 'd'}{v}"), True)
            return
        before = self.read(batch).select(*[F.col(c).alias(f"b_{c}") for c in after.columns])
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in after.columns[1:]], F.col(after.columns[0]) == F.col(f"b_{after.columns[0]}"))
        after.join(before, same, "left_anti").write.mode("overwrite").parquet(f"{self.path}/d{batch}")


def run_feeds(items: DataFrame, marks: StateTable, as_of: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """New items of a stream go to the sink, batch by batch; the marks follow once the sink has them."""

    def step(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        fresh, _, after = feed_step(batch, marks.read(number), as_of)
        sink(fresh, number)
        marks.write(after, number)
        batch.unpersist()

    items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_pages(pages: DataFrame, hashes: StateTable, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Changed pages of a stream go to the sink; the first sight of a page is stored silently."""

    def step(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        changed, after = page_step(batch, hashes.read(number))
        sink(changed, number)
        hashes.write(after, number)
        batch.unpersist()

    pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
