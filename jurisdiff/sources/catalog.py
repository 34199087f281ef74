"""Tables of a catalogue directory: explicit schemas, tolerant reads, an overlay for dry runs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jurisdiff.functions.values import DIFF_KEYS
from jurisdiff.operators.merge import overlay

_AXIS = "struct<summary:string,detail:string,sources:array<string>>"
_ENTRY = "struct<topic:string,note:string,source:string>"
COUNTRY = "ord int, code string, name_ja string, name_en string, flag string, lat double, lng double, official_sources array<struct<url:string,type:string>>, watch_feeds array<struct<url:string,type:string>>, news_queries array<string>"
REGULATION = (
    "jurisdiction string, regulation_name string, status string, approach string, is_baseline boolean, axes struct<"
    + ",".join(f"{a}:{_AXIS}" for a in ("risk_classification", "prohibited_uses", "gpai_obligations", "transparency", "penalties", "enforcement_body"))
    + ",timeline:array<struct<date:string,event:string,source:string>>>, diff_vs_eu struct<"
    + ",".join(f"{k}:array<{_ENTRY}>" for k in DIFF_KEYS)
    + ">, last_checked string, last_changed string"
)
UPDATE = "id string, date string, country string, axis string, change_type string, title string, summary struct<what:string,who:string,when_impact:string>, detail string, so_what string, impact struct<diff_changed:boolean,diff_note:string>, canonical_event string, publication_date string, effective_date string, deadline_date string, sources array<string>, country_anchor string"
META = "last_sweep string, status string"
HASHES = "url string, hash string"
MARKS = "feed string, last_seen timestamp"
SCHEMAS = {"regulations": REGULATION, "eu_baseline": REGULATION, "updates": UPDATE, "meta": META, "hashes": HASHES, "last_seen": MARKS}


class Catalog:
    """Reads of ``root``, and of ``overlay_root`` in its place where a table is there; writes go to the overlay, if there is one."""

    def __init__(self, spark: SparkSession, root: str, overlay_root: str | None = None):
        self.spark, self.root, self.overlay_root = spark, root.rstrip("/"), overlay_root and overlay_root.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def json(self, name: str, schema: str | None = None) -> DataFrame:
        """A JSON table, one record or an array of records a file, with ``file`` and, of an array, ``pos`` as place of origin.

        A missing table is empty; a file that is no JSON gives no rows.
        """
        schema = schema or SCHEMAS[name]
        at = next((f"{r}/{name}" for r in (self.overlay_root, self.root) if r and (self._exists(f"{r}/{name}") or self._exists(f"{r}/{name}.json"))), None)
        if at is None:
            return self.spark.createDataFrame([], schema).withColumns({"file": F.lit(""), "pos": F.lit(0)})
        at = at if self._exists(at) else at + ".json"
        texts = self.spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(at).select(F.input_file_name().alias("file"), F.trim("value").alias("value"))
        many = F.from_json("value", f"array<struct<{_colons(schema)}>>", {"mode": "PERMISSIVE"})
        one = F.array(F.from_json("value", schema, {"mode": "PERMISSIVE"}))
        rows = texts.select("file", F.posexplode(F.when(F.col("value").startswith("["), many).otherwise(F.when(F.col("value").startswith("{"), one))).alias("pos", "r"))
        return rows.where("r is not null").select("r.*", "file", "pos")

    def countries(self) -> DataFrame:
        """The configured jurisdictions in file order (``ord``); the configuration is small and read by the driver."""
        text = lambda path: self.spark.read.option("wholetext", True).text(path).first()[0]
        if self._exists(f"{self.root}/countries.yaml"):
            import yaml

            rows = yaml.safe_load(text(f"{self.root}/countries.yaml"))["countries"]
        else:
            rows = json.loads(text(f"{self.root}/countries.json"))["countries"]
        names = [x.split()[0] for x in COUNTRY.split(", ")]
        return self.spark.createDataFrame([tuple({"ord": i, **r}.get(n) for n in names) for i, r in enumerate(rows)], COUNTRY)

    def regulation(self, code: str) -> DataFrame:
        """The regulation of one jurisdiction."""
        return self.json("regulations").where(F.col("jurisdiction") == code)

    def regulations(self, complete: bool = True) -> DataFrame:
        """Regulations of the configured jurisdictions, in their order. complete: one that is missing is an error (the configuration is small)."""
        if complete and (lost := [r["code"] for r in self.countries().join(self.json("regulations"), F.col("code") == F.col("jurisdiction"), "left_anti").select("code").collect()]):
            raise FileNotFoundError(f"no regulation of {', '.join(sorted(lost))} in {self.root}")
        return self.countries().join(self.json("regulations"), F.col("code") == F.col("jurisdiction")).orderBy("ord")

    def updates(self) -> DataFrame:
        """All updates, latest first; of one date in the order of file and place."""
        return self.json("updates").orderBy(F.desc("date"), "file", "pos")

    def read(self, name: str, key: str | list[str]) -> DataFrame:
        """A Parquet table with the overlay's rows in place of those of their key."""
        base = self.spark.read.parquet(f"{self.root}/{name}")
        if not self.overlay_root or not self._exists(f"{self.overlay_root}/{name}"):
            return base
        return overlay(base, self.spark.read.parquet(f"{self.overlay_root}/{name}"), key)

    def write(self, df: DataFrame, name: str, mode: str = "overwrite", partition: str | None = None, fmt: str = "parquet") -> str:
        """Write a table and return its place; updates are appended to the partition of their publication month."""
        path = f"{self.overlay_root or self.root}/{name}"
        w = df.write.mode(mode)
        (w.partitionBy(partition) if partition else w).format(fmt).save(path)
        return path


def _colons(ddl: str) -> str:
    """``a int, b string`` as the inside of a struct type."""
    out, depth, start = [], 0, True
    for token in ddl:
        depth += (token == "<") - (token == ">")
        if token == "," and depth == 0:
            out.append(",")
            start = True
            continue
        if token == " " and depth == 0:
            if start and out and out[-1] == ",":
                continue
            if start:
                out.append(":")
                start = False
                continue
        out.append(token)
    return "".join(out)


def enumerate_sources(countries: DataFrame) -> DataFrame:
    """code, ord, source_group, group_rank, pos, source, type of every source: official, watched, news queries; null lists are empty."""
    empty = F.array().cast("array<struct<url:string,type:string>>")
    news = F.transform(F.coalesce("news_queries", F.array().cast("array<string>")), lambda q: F.struct(q.alias("url"), F.lit("news_query").alias("type")))
    groups = F.array(*[F.struct(F.lit(g).alias("source_group"), F.lit(i).alias("group_rank"), F.coalesce(c, empty).alias("items")) for i, (g, c) in enumerate((("official_sources", F.col("official_sources")), ("watch_feeds", F.col("watch_feeds")), ("news_queries", news)))])
    return countries.select("ord", "code", F.explode(groups).alias("g")).select("ord", "code", "g.source_group", "g.group_rank", F.posexplode("g.items").alias("pos", "s")).select("code", "ord", "source_group", "group_rank", "pos", F.col("s.url").alias("source"), F.col("s.type").alias("type"))


def feed_items(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """feed, title, link, published, snippet of the entries of landed feed files (``entry`` for Atom)."""
    schema = "title string, link string, pubDate string, description string" if row_tag == "item" else "title string, link struct<_href:string>, updated string, published string, summary string"
    raw = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path).withColumn("feed", F.input_file_name())
    if row_tag == "item":
        day = F.regexp_replace("pubDate", "^[A-Za-z]{3},? *", "")
        when = F.coalesce(F.try_to_timestamp(day, F.lit("dd MMM yyyy HH:mm:ss z")), F.try_to_timestamp(day, F.lit("dd MMM yyyy HH:mm:ss Z")), F.col("pubDate").try_cast("timestamp"))
        return raw.select("feed", F.coalesce("title", F.lit("")).alias("title"), "link", when.alias("published"), F.substring("description", 1, 300).alias("snippet"))
    return raw.select("feed", F.coalesce("title", F.lit("")).alias("title"), F.col("link._href").alias("link"), F.coalesce(F.col("published").try_cast("timestamp"), F.col("updated").try_cast("timestamp")).alias("published"), F.substring("summary", 1, 300).alias("snippet"))


def decode_pages(pages: DataFrame, charset: Column) -> DataFrame:
    """pages with ``text``: the bytes of ``body`` decoded; an unknown character set is read as UTF-8, bad bytes as replacement characters."""
    @F.pandas_udf("string")
    def decode(body: pd.Series, name: pd.Series) -> pd.Series:
        def one(b, n):
            if b is None:
                return None
            try:
                return bytes(b).decode(n or "utf-8", "replace")
            except LookupError:
                return bytes(b).decode("utf-8", "replace")

        return pd.Series([one(b, n) for b, n in zip(body, name)], dtype=object)

    return pages.withColumn("text", decode("body", charset))


def direct_or_reader(direct: DataFrame, reader: DataFrame) -> DataFrame:
    """url, text, via_reader, error: the page itself, else what the reader service fetched of it; if both failed the page's own error."""
    r = reader.select("url", F.col("text").alias("_reader"))
    return direct.join(r, "url", "left").select("url", F.coalesce("text", "_reader").alias("text"), (F.col("text").isNull() & F.col("_reader").isNotNull()).alias("via_reader"), F.when(F.coalesce("text", "_reader").isNull(), F.concat(F.lit("fetch-failed:"), F.coalesce("error", F.lit("")))).alias("error"))


def existing_titles(updates: DataFrame, as_of: str, days: int, label: Column) -> DataFrame:
    """id, title, label of the updates of the last days, the cutoff included."""
    cutoff = F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyy-MM-dd")
    return updates.where(F.col("date") >= cutoff).select("id", "title", label.alias("label"))


def first_appearance(df: DataFrame, value: str, pos: str) -> DataFrame:
    """Distinct values in the order in which they first appear."""
    return df.groupBy(value).agg(F.min(pos).alias("first_pos")).withColumn("ord", F.row_number().over(Window.orderBy("first_pos")))


def with_retry(call: Callable[[], object], waits: tuple[float, ...] = (60, 120, 240), again: Callable[[Exception], bool] = lambda e: getattr(e, "status", 0) == 429 or getattr(e, "status", 0) >= 500, sleep: Callable[[float], None] = time.sleep):
    """The result of a call to a service: after busy answers it waits and tries again, and any last failure is tried once more."""

    def patient():
        for wait in (*waits, None):
            try:
                return call()
            except Exception as e:
                if wait is None or not again(e):
                    raise
                sleep(wait)

    try:
        return patient()
    except Exception:
        return patient()
