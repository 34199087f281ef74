"""Constraint validation: every violation of every row, in long form."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jurisdiff.functions.text import is_ymd
from jurisdiff.functions.values import APPROACHES, AXES, CHANGE_TYPES, DIFF_KEYS, LABEL_CHARS, RUN_STATUS, STATUS_ORDER, UPDATE_AXES

# Patterns and fields of the record schemas.
UPDATE_ID = r"^\d{4}-\d{2}-\d{2}-[a-z]{2}-\d{3}$"
_UPDATE_REQUIRED = ("id", "date", "country", "axis", "change_type", "title", "summary", "so_what", "impact", "sources", "country_anchor")


def _has(c: Column) -> Column:
    return c.isNotNull()


def _long(c: Column, most: int) -> Column:
    return _has(c) & (F.length(c) > most)


def update_rules() -> list[tuple[str, str, Column]]:
    """(path, rule, is it broken) of the update schema. A missing value breaks ``required`` and nothing else."""
    col = F.col
    rules = [(c, "required", col(c).isNull()) for c in _UPDATE_REQUIRED]
    rules += [(f"summary.{c}", "required", _has(col("summary")) & col(f"summary.{c}").isNull()) for c in ("what", "who", "when_impact")]
    rules += [("impact.diff_changed", "required", _has(col("impact")) & col("impact.diff_changed").isNull())]
    rules += [("id", "pattern", _has(col("id")) & ~col("id").rlike(UPDATE_ID)), ("country", "pattern", _has(col("country")) & ~col("country").rlike("^[a-z]{2}$"))]
    rules += [(c, "pattern", _has(col(c)) & ~is_ymd(col(c))) for c in ("date", "publication_date", "effective_date", "deadline_date")]
    rules += [("axis", "enum", _has(col("axis")) & ~col("axis").isin(UPDATE_AXES)), ("change_type", "enum", _has(col("change_type")) & ~col("change_type").isin(CHANGE_TYPES))]
    rules += [(c, "minLength", _has(col(c)) & (F.length(c) < 1)) for c in ("title", "so_what", "canonical_event")]
    rules += [(c, "maxLength", _long(col(c), LABEL_CHARS)) for c in ("title", "summary.what", "summary.who", "summary.when_impact")]
    rules += [("sources", "minItems", _has(col("sources")) & (F.size("sources") < 1))]
    rules += [("sources", "format", _has(col("sources")) & F.exists("sources", lambda u: F.try_parse_url(u, F.lit("PROTOCOL")).isNull()))]
    return rules


def snapshot_rules() -> list[tuple[str, str, Column]]:
    """(path, rule, is it broken) of the flat fields of the regulation schema."""
    col = F.col
    rules = [(c, "required", col(c).isNull()) for c in ("jurisdiction", "regulation_name", "status", "approach", "last_checked", "last_changed")]
    rules += [("jurisdiction", "pattern", _has(col("jurisdiction")) & ~col("jurisdiction").rlike("^[a-z]{2}$")), ("regulation_name", "minLength", _has(col("regulation_name")) & (F.length("regulation_name") < 1))]
    rules += [("status", "enum", _has(col("status")) & ~col("status").isin(STATUS_ORDER)), ("approach", "enum", _has(col("approach")) & ~col("approach").isin(APPROACHES))]
    rules += [(c, "format", _has(col(c)) & col(c).try_cast("timestamp").isNull()) for c in ("last_checked", "last_changed")]
    return rules


# The fields of each kind of object in a regulation, those it must have, and texts that must not be empty.
_AXIS_FIELDS = ("summary", "detail", "sources")
_DATED_FIELDS, _TOPIC_FIELDS = ("date", "event", "source"), ("topic", "note", "source")
_ROOT_REQUIRED = ("jurisdiction", "regulation_name", "status", "approach", "axes", "last_checked", "last_changed")


def regulation_kinds() -> list[tuple[Column, tuple, tuple, tuple]]:
    """(which occurrences, allowed fields, required fields, fields that must not be empty) of the objects below a regulation."""
    node, axes, lists = F.col("node"), [f"axes.{a}" for a in AXES], [f"diff_vs_eu.{k}" for k in DIFF_KEYS]
    return [
        (node == "", (*_ROOT_REQUIRED, "is_baseline", "diff_vs_eu"), _ROOT_REQUIRED, ("regulation_name",)),
        (node == "axes", (*AXES, "timeline"), (*AXES, "timeline"), ()), (node.isin(axes), _AXIS_FIELDS, _AXIS_FIELDS, ()),
        (node == "axes.timeline", _DATED_FIELDS, _DATED_FIELDS, ("event",)), (node == "diff_vs_eu", tuple(DIFF_KEYS), tuple(DIFF_KEYS), ()), (node.isin(lists), _TOPIC_FIELDS, _TOPIC_FIELDS, ("topic",)),
    ]


def regulation_violations(bridge: DataFrame, bodies: DataFrame) -> DataFrame:
    """record_id, record_no, place, field, rule of every broken nested rule: required, unknown, minLength, pattern (of a timeline's date).

    bridge and bodies: of flatten_records. A rule looks at an object only, so
    each distinct object is judged once for each kind of place it stands in, and
    its faults are then given to all its occurrences. An entry that is no object
    breaks ``type``; null and empty entries, which hold a position only, aren't looked at.
    """
    kinds = regulation_kinds()
    kind = F.coalesce(*[F.when(there, F.lit(i)) for i, (there, *_) in enumerate(kinds)])
    placed = bridge.where("filled").withColumn("kind", kind).where("kind is not null")
    texts = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    fault = lambda fields, rule: F.transform(fields, lambda f: F.struct(f.alias("field"), F.lit(rule).alias("rule")))
    keys = F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>"))
    found = []
    for i, (_, allowed, required, filled) in enumerate(kinds):
        empty = [F.when(F.get_json_object("body", f"$.{f}") == "", F.lit(f)) for f in filled]
        faults = [fault(F.array_except(texts(required), keys), "required"), fault(F.array_except(keys, texts(allowed)), "unknown"), fault(F.array_compact(F.array(*empty)) if empty else texts([]), "minLength")]
        if "date" in allowed:
            date = F.get_json_object("body", "$.date")
            faults.append(fault(F.array_compact(F.array(F.when(date.isNotNull() & ~is_ymd(date), F.lit("date")))), "pattern"))
        odd = fault(texts([""]), "type")
        found.append(F.when(F.col("kind") == i, F.when(F.startswith("body", F.lit("{")), F.concat(*faults)).otherwise(odd)))
    judged = placed.select("kind", "object_id").distinct().join(bodies.dropDuplicates(["object_id"]), "object_id").select("kind", "object_id", F.explode(F.coalesce(*found)).alias("x"))
    return placed.join(judged, ["kind", "object_id"]).select("record_id", "record_no", "place", "x.field", "x.rule")


def violations(df: DataFrame, key: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """key, path, rule of every broken rule; all of a row's, in one pass over it."""
    broken = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(p).alias("path"), F.lit(r).alias("rule"))) for p, r, bad in rules])
    return df.select(F.col(key), F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("v")).select(key, "v.path", "v.rule")


def exactly_one(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows where not exactly one of two fields is present, whatever its value."""
    return df.where(a.isNotNull() == b.isNotNull())


def unknown_properties(df: DataFrame, key: str, payload: str, allowed: dict[str, set[str]]) -> DataFrame:
    """key, path of object fields the schema doesn't know. allowed: path of an object ("" the root, ``a.b`` below) -> its fields; objects at other paths are free. What is no JSON object has none."""

    def walk(v, path: str) -> Iterator[str]:
        if isinstance(v, dict):
            for k, x in v.items():
                at = f"{path}.{k}" if path else k
                if path in allowed and k not in allowed[path]:
                    yield at
                else:
                    yield from walk(x, at)
        elif isinstance(v, list):
            for x in v:
                yield from walk(x, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, s in zip(pdf["key"].tolist(), pdf["payload"].tolist()):
                try:
                    out += [(k, p) for p in sorted(set(walk(json.loads(s), "")))] if isinstance(s, str) else []
                except (ValueError, RecursionError):
                    continue
            yield pd.DataFrame(out, columns=["key", "path"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(payload).alias("payload")).mapInPandas(run, f"key {kind}, path string").withColumnRenamed("key", key)


def meta_is_valid(meta: DataFrame) -> DataFrame:
    """meta with ``valid``: a text for the last sweep and a known status."""
    return meta.withColumn("valid", F.col("last_sweep").isNotNull() & F.coalesce(F.col("status").isin(RUN_STATUS), F.lit(False)))


def failing(found: DataFrame, by: str) -> DataFrame:
    """Number of errors per file or table, which gates a commit: any row stops it."""
    return found.groupBy(by).agg(F.count("*").alias("errors"))
