"""Queries p1, p2 and p6: history, nested records and orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurisdiff.functions.codes import fold_width, norm_code, norm_instant, norm_term, trim_blanks
from jurisdiff.operators.history import coalesce_history
from jurisdiff.operators.nested import AXIS_NODES, DIFF_LISTS, distinct_objects, field_table, flatten_records, regulation_nodes, shape_regulation
from jurisdiff.operators.orphans import orphan_counts, orphan_rows
from jurisdiff.session import spread


def regulation_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every version of every regulation with its period and the values as compared."""
    snaps = spark.read.parquet(f"{sf}/regulation_snapshots.parquet")
    return coalesce_history(
        snaps, "regulation_id", "snapshot_at", ["loaded_at", "snapshot_key"],
        {"status": norm_term(F.col("status")), "approach": norm_term(F.col("approach")), "last_changed": norm_instant(F.col("last_changed"))},
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """regulation_id, valid_from, valid_to (9999-12-31: still valid) as UTC dates."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return regulation_history(spark, sf).select(F.col("entity").alias("regulation_id"), day("valid_from").alias("valid_from"), F.coalesce(day("valid_to"), F.lit("9999-12-31")).alias("valid_to"))


def flat_regulations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(bridge, bodies) of the regulation records as received."""
    raw = spread(spark.read.parquet(f"{sf}/regulation_raw.parquet").select("raw_id", "payload"))
    return flatten_records(raw, "raw_id", "payload", shape_regulation)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """raw_id, node, pos of every child record."""
    return regulation_nodes(*flat_regulations(spark, sf)).withColumnRenamed("record_id", "raw_id")


def p2_objects(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct subtrees of all records and how often each occurs."""
    return distinct_objects(*flat_regulations(spark, sf))


def p2_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """Every occurrence of a subtree: its record, its place, that of its parent, its position and the object it is."""
    return flat_regulations(spark, sf)[0].withColumnRenamed("record_id", "raw_id")


def _fields(spark: SparkSession, sf: str, node, fields: list[str], *more) -> DataFrame:
    return field_table(*flat_regulations(spark, sf), node, fields).select(F.col("record_id").alias("raw_id"), "record_no", "place", "parent_place", *more, *fields)


def p2_axes(spark: SparkSession, sf: str) -> DataFrame:
    """The axes of every record with their texts."""
    return _fields(spark, sf, F.col("node").isin(AXIS_NODES), ["summary", "detail"], F.substring_index("node", ".", -1).alias("axis"))


def p2_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The sources of the axes; an object gives its url."""
    return _fields(spark, sf, F.col("node").isin([f"{a}.sources" for a in AXIS_NODES]), ["url"], F.element_at(F.split("node", "[.]"), 2).alias("axis"), "pos")


def p2_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """The timeline entries of every record."""
    return _fields(spark, sf, F.col("node") == "axes.timeline", ["date", "event", "source"], "pos")


def p2_diffs(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of the four difference lists."""
    return _fields(spark, sf, F.col("node").isin([f"diff_vs_eu.{d}" for d in DIFF_LISTS]), ["topic", "note", "source"], F.substring_index("node", ".", -1).alias("list"), "pos")


def references(spark: SparkSession, sf: str) -> DataFrame:
    """src_table, field, dim, key, at, row_key of every reference; an anchor refers to a country and perhaps to an axis."""
    anchor = F.nullif(trim_blanks(fold_width(F.col("country_anchor"))), F.lit(""))
    u = spark.read.parquet(f"{sf}/updates.parquet").select("row_key", "country", anchor.alias("anchor"), F.col("ingested_at").alias("at"))
    country = norm_code(F.regexp_extract("anchor", r"/country/([^/#?]*)", 1))
    axis = F.nullif(F.lower(trim_blanks(F.regexp_extract("anchor", r"#axis-([^/#?&]*)", 1))), F.lit(""))
    one = lambda field, dim, key: F.struct(F.lit(field).alias("field"), F.lit(dim).alias("dim"), key.alias("key"))
    named = F.when(F.col("anchor").isNotNull(), F.coalesce(country, F.lit("")))
    # One scan gives the up to three references of a row.
    several = u.select("at", "row_key", F.explode(F.array(one("country", "country", norm_code(F.col("country"))), one("country_anchor", "country", named), one("country_anchor", "axis", axis))).alias("r"))
    of = lambda df, table: df.select(F.lit(table).alias("src_table"), "r.field", "r.dim", "r.key", "at", "row_key").where("key is not null")
    s = spark.read.parquet(f"{sf}/regulation_snapshots.parquet").select(F.col("snapshot_at").alias("at"), F.col("snapshot_key").alias("row_key"), one("jurisdiction", "country", norm_code(F.col("jurisdiction"))).alias("r"))
    return of(several, "updates").unionByName(of(s, "regulation_snapshots"))


def reference_targets(spark: SparkSession, sf: str) -> DataFrame:
    """dim, key, valid_from, valid_to of the records that can be referred to."""
    of = lambda name, key: spark.read.parquet(f"{sf}/{name}.parquet").select(F.lit("axis" if name == "axis_ref" else name).alias("dim"), key.alias("key"), F.col("added_at").alias("valid_from"), F.col("removed_at").alias("valid_to"))
    return of("country", norm_code(F.col("code"))).unionByName(of("axis_ref", F.lower(trim_blanks(F.col("axis"))))).where("key is not null and valid_from is not null")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """src_table, row_key, field of every orphan reference."""
    return orphan_rows(references(spark, sf), reference_targets(spark, sf))


def p6_counts(spark: SparkSession, sf: str) -> DataFrame:
    """References and orphans per table, field, kind of target and month."""
    return orphan_counts(references(spark, sf), reference_targets(spark, sf))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_objects": p2_objects, "p2_bridge": p2_bridge, "p2_axes": p2_axes, "p2_sources": p2_sources, "p2_timeline": p2_timeline, "p2_diffs": p2_diffs, "p6_found": p6_found, "p6_counts": p6_counts}

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c) != "＇") + "　"
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F) if chr(c) != "＇") + " "
_B = r"[\t\n\x0B\f\r\x{85} \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
_SEP = _B[:-1] + r"_\-\x{2010}-\x{2015}\x{2212}]"
_fold = lambda c: f"translate({c}, '{_WIDE}', '{_PLAIN}')"
_trim = lambda c: f"regexp_replace({c}, '^{_B}+|{_B}+$', '', 'g')"
_code = lambda c: f"nullif(lower({_trim(_fold(c))}), '')"
_term = lambda c: f"nullif(regexp_replace(lower({_trim(_fold(c))}), '{_SEP}+', '_', 'g'), '')"

_REFS = f"""
refs as (
  select 'updates' src_table, 'country' field, 'country' dim, {_code("country")} as "key", ingested_at as "at", row_key from updates
  union all
  select 'updates', 'country_anchor', 'country', coalesce({_code("regexp_extract(a, '/country/([^/#?]*)', 1)")}, ''), ingested_at, row_key
    from (select *, nullif({_trim(_fold("country_anchor"))}, '') a from updates) where a is not null
  union all
  select 'updates', 'country_anchor', 'axis', nullif(lower({_trim("regexp_extract(a, '#axis-([^/#?&]*)', 1)")}), ''), ingested_at, row_key
    from (select *, nullif({_trim(_fold("country_anchor"))}, '') a from updates) where a is not null
  union all
  select 'regulation_snapshots', 'jurisdiction', 'country', {_code("jurisdiction")}, snapshot_at, snapshot_key from regulation_snapshots
), dims as (
  select 'country' dim, {_code("code")} as "key", added_at, removed_at from country
  union all select 'axis', lower({_trim("axis")}), added_at, removed_at from axis_ref
), judged as (
  select r.*, exists(select 1 from dims d where d.dim = r.dim and d."key" = r."key" and d.added_at <= r."at" and (d.removed_at is null or r."at" < d.removed_at)) held
  from refs r where r."key" is not null
)"""

ORACLES = {
    "p1_found": f"""
with norm as (
  select regulation_id, snapshot_at, loaded_at, snapshot_key, {_term("status")} s, {_term("approach")} a,
    nullif({_trim("last_changed")}, '') c0
  from regulation_snapshots where regulation_id is not null and snapshot_at is not null
), kept as (
  select *, coalesce(cast(epoch_us(try_cast(c0 as timestamptz)) as varchar), '?' || c0) c from norm
  qualify row_number() over (partition by regulation_id, snapshot_at order by loaded_at desc nulls last, snapshot_key desc) = 1
), filled as (
  select regulation_id, snapshot_at,
    last_value(s ignore nulls) over w s, last_value(a ignore nulls) over w a, last_value(c ignore nulls) over w c
  from kept window w as (partition by regulation_id order by snapshot_at rows between unbounded preceding and current row)
), marked as (
  select *, row_number() over v = 1 or s is distinct from lag(s) over v or a is distinct from lag(a) over v or c is distinct from lag(c) over v begins
  from filled window v as (partition by regulation_id order by snapshot_at)
)
select regulation_id, strftime(snapshot_at at time zone 'UTC', '%Y-%m-%d') valid_from,
  coalesce(strftime(lead(snapshot_at) over (partition by regulation_id order by snapshot_at) at time zone 'UTC', '%Y-%m-%d'), '9999-12-31') valid_to
from marked where begins""",
    "p6_found": f"with {_REFS} select distinct src_table, row_key, field from judged where not held",
    "p6_counts": f"""with {_REFS} select src_table, field, dim, coalesce(strftime(judged."at" at time zone 'UTC', '%Y-%m'), '') as "month",
  count(*) as "references", count(*) filter (where not held) as orphans from judged group by 1, 2, 3, 4""",
}
