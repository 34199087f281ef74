"""Queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurisdiff.functions.codes import norm_code
from jurisdiff.llm.events import learn_lexicon, read_events
from jurisdiff.llm.garbled import PairModel, find_garbled
from jurisdiff.llm.leaks import find_leaks
from jurisdiff.llm.lookalike import alike_classes, alike_pairs
from jurisdiff.llm.packing import pack_documents, packing_bounds, token_sizes
from jurisdiff.llm.pivots import event_points, repeated_in_batches
from jurisdiff.llm.splitting import split_documents
from jurisdiff.session import materialize, spread


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/updates.parquet")


def _pair_model(u: DataFrame) -> PairModel:
    """Pairs of the distinct texts: copies of a damaged text can't make its damage probable."""
    return PairModel.fit(u.select("title").unionByName(u.select(F.col("summary.what").alias("title"))).distinct())


def garbled_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged titles and summaries of updates, with what could be restored."""
    u = _updates(spark, sf)
    return find_garbled(u, "row_key", {"title": "title", "summary.what": "summary.what"}, _pair_model(u))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """row_key, field of every text that was decoded wrongly, restorable or not."""
    return garbled_fields(spark, sf).select(F.col("key").alias("row_key"), "field").distinct()


def p3_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged texts beside their restored form; whole: nothing of the damage is left."""
    return garbled_fields(spark, sf).withColumnRenamed("key", "row_key")


def _comparable(spark: SparkSession, sf: str) -> DataFrame:
    """field, grp, row_key, text of the labels and titles; damaged titles take no part."""
    u = _updates(spark, sf)
    damaged = find_garbled(u, "row_key", {"title": "title"}, _pair_model(u)).select(F.col("key").alias("row_key"))
    of = lambda df, c: df.select(F.lit(c).alias("field"), norm_code(F.col("country")).alias("grp"), "row_key", F.col(c).alias("text"))
    return of(u, "canonical_event").unionByName(of(u.join(damaged, "row_key", "left_anti"), "title"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """field, row_key_a, row_key_b: labels or titles of one country that differ but read the same; damaged titles take no part."""
    return alike_pairs(_comparable(spark, sf))


def p4_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The same as classes: every row with the first row of its class, and how many forms and rows that has."""
    return alike_classes(_comparable(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """row_key_a, row_key_b: rows of the weekly batches and the first row that reports their event."""
    u = spread(_updates(spark, sf).select("row_key", "batch_no", norm_code(F.col("country")).alias("country"), F.col("canonical_event").alias("label"), "title"))
    read = read_events(u, ["row_key", "batch_no", "country"], learn_lexicon(u), PairModel.fit(u.select("title").distinct()))
    return repeated_in_batches(materialize(event_points(read), "points"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, item_id: documents that hold an evaluation item or a long passage of it."""
    return find_leaks(spread(_documents(spark, sf)), "doc_id", "text", spark.read.parquet(f"{sf}/eval_items.parquet"), "item_id", "text").select("doc_id", "item_id")


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, or part of an oversized one, with its container of 4,096 tokens."""
    return pack_documents(token_sizes(spread(_documents(spark, sf)), "doc_id", "text"))


def p7_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Containers of that packing, the bound no packing goes below, and the gap."""
    return packing_bounds(materialize(p7_packing(spark, sf), "packing"))


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """The pieces of at most 512 tokens of every longer document, each with 32 tokens of the one before."""
    return split_documents(spread(_documents(spark, sf)), "doc_id", "text")


QUERIES = {"p3_found": p3_found, "p3_restored": p3_restored, "p4_found": p4_found, "p4_classes": p4_classes, "p5_found": p5_found, "p7_packing": p7_packing, "p7_bounds": p7_bounds, "p8_found": p8_found, "p9_pieces": p9_pieces}
ORACLES: dict[str, str] = {}
