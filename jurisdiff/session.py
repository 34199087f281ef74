"""Session construction and the shared working folder.

Queries that cut lineage write Parquet tables below ``spark.checkpoint.dir``.
The folder is read from the session; one is created only where the setting is
absent, which is the case on a single machine such as a test run.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_written: list[str] = []


def build_session(master: str | None = None, app: str = "jurisdiff", partitions: int | None = None) -> SparkSession:
    """A session with UTC, AQE and Arrow; executor sizing is left to the cluster."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from the session's ``spark.checkpoint.dir``."""
    global _own_dir
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    found = found or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="jurisdiff-")
    return "file://" + _own_dir


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def materialize(df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, with these options of the writer, and return a scan of it.

    Unlike a local checkpoint the table survives the loss of any executor, and
    unlike ``checkpoint()`` it is columnar, so later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/jurisdiff-{os.getpid()}-{uuid.uuid4().hex[:12]}/{tag}"
    df.write.mode("errorifexists").options(**(options or {})).option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


class Appended:
    """A table in the shared folder that grows by whole batches; a read is one scan of all of them."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.schema = spark, None
        self.path = f"{shared_dir(spark)}/jurisdiff-{os.getpid()}-{uuid.uuid4().hex[:12]}/{tag}"

    def add(self, df: DataFrame, number: int) -> None:
        """Write one batch; written again it takes the place of the first writing."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/part={number}")
        if self.schema is None:
            self.schema = df.schema
            _written.append(self.path)

    def read(self) -> DataFrame | None:
        """All batches so far; None before the first."""
        if self.schema is None:
            return None
        return self.spark.read.schema(self.schema).parquet(self.path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: an input of fewer splits than cores, so a small one, is dealt out before costly work on its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def purge(spark: SparkSession) -> int:
    """Delete every table written by :func:`materialize`; call it once results are stored."""
    n = 0
    while _written:
        fs, p = _hadoop(spark, _written.pop().rpartition("/")[0])
        n += bool(fs.delete(p, True))
    return n
