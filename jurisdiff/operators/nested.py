"""Deeply nested records as flat tables, by Merkle subtree identities.

Every record is brought to one shape, then each object and list entry is hashed
bottom-up over its canonical JSON, in which nested objects stand as the hashes
of their subtrees. Equal subtrees therefore have one identity and their bodies
are stored once; every occurrence is kept as a bridge row (record, place, place
of the parent, identity, path, ordinal). Flat tables are read from the two: an
occurrence takes its fields from the one object it points to. Records are
independent, so nothing is shuffled until objects are made distinct, and a task
passes each body on only once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.session import materialize

BRIDGE_SCHEMA = "record_id bigint, record_no int, place string, parent_place string, node string, pos bigint, filled boolean, object_id string"
_ROW_SCHEMA = BRIDGE_SCHEMA + ", body string"
#: Nesting that is read into objects; what lies deeper is kept as the text it is, under its hash like any value.
MAX_DEPTH = 200
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', re.S)


def _reject(x):
    raise ValueError(x)


def _without_depths(text: str) -> tuple[str, list[str]]:
    """(the text with every value nested deeper than MAX_DEPTH as a JSON string of its text, those texts)."""
    out, deep, at, depth, start = [], [], 0, 0, 0
    for m in _TOKEN.finditer(text):
        c = m[0]
        if c in "[{":
            depth += 1
            if depth == MAX_DEPTH + 1:
                start = m.start()
        elif c in "]}":
            if depth == MAX_DEPTH + 1:
                inner = text[start : m.end()]
                deep.append(inner)
                out += [text[at:start], json.dumps(inner)]
                at = m.end()
            depth -= 1
    return "".join([*out, text[at:]]), deep


def parse_json(text: str | None):
    """(value, True), or (None, False) if text is null or no complete JSON. One byte-order mark is left aside."""
    if text is None:
        return None, False
    text = text[1:] if text[:1] == "\ufeff" else text
    try:
        if text.count("[") + text.count("{") <= MAX_DEPTH:
            return json.loads(text, parse_constant=_reject), True
        shallow, deep = _without_depths(text)
        value = json.loads(shallow, parse_constant=_reject)
        while deep:  # what was set apart must be complete as well; each round goes MAX_DEPTH deeper
            inner, more = _without_depths(deep.pop())
            json.loads(inner, parse_constant=_reject)
            deep += more
        return value, True
    except (ValueError, RecursionError):
        return None, False


def snake(key: str) -> str:
    """camelCase and kebab-case field names as snake_case; acronyms keep together."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", key).replace("-", "_").lower()


def _empty(v) -> bool:
    return v is None or v == {} or v == [] or isinstance(v, str) and not v.strip()


def _digest(body: str) -> str:
    return hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def subtree_rows(record_id, record, record_no: int = 0) -> tuple[list[tuple], dict[str, str]]:
    """(bridge rows of one shaped record, body of each of its objects). The root has the empty place and no parent's; it comes last."""
    rows: list[tuple] = []
    bodies: dict[str, str] = {}

    def stored(body: str) -> str:
        own = _digest(body)
        bodies[own] = body
        return own

    def entry(v, node: str, place: str, parent: str, pos: int) -> dict[str, str]:
        own = identify(v, node, place)
        rows.append((record_id, record_no, place, parent, node, pos, not _empty(v), own))
        return {"@": own}

    def identify(v, node: str, place: str) -> str:
        if isinstance(v, list):
            return stored(json.dumps([entry(x, node + "[]", f"{place}[{i}]", place, i) for i, x in enumerate(v)]))
        if not isinstance(v, dict):
            return stored(json.dumps(v, ensure_ascii=False, sort_keys=True))
        flat = {}
        for key in sorted(v):
            x, at, there = v[key], f"{node}.{key}" if node else key, f"{place}.{key}" if place else key
            if isinstance(x, dict):
                flat[key] = entry(x, at, there, place, 0)
            else:
                flat[key] = [entry(y, at, f"{there}[{i}]", place, i) for i, y in enumerate(x)] if isinstance(x, list) else x
        return stored(json.dumps(flat, ensure_ascii=False, sort_keys=True))

    rows.append((record_id, record_no, "", None, "", 0, not _empty(record), identify(record, "", "")))
    return rows, bodies


def flatten_records(df: DataFrame, record_id: str, payload: str, shape: Callable[[object], list]) -> tuple[DataFrame, DataFrame]:
    """(bridge: record_id, record_no, place, parent_place, node, pos, filled, object_id; bodies: object_id, body), both stored.

    A task passes each body on once, so of an object that several tasks met
    there are as many equal rows; distinct_objects makes them one.

    shape: the parsed value -> the records in it, each in one uniform shape;
    record_no tells those of one payload apart. A payload that is null or no
    complete JSON gives no rows. Values nested deeper than MAX_DEPTH are kept
    as texts. Null, "" and {} entries of a list get a row with filled = false
    and hold their position. A repeated payload gives its rows under each
    record_id. Further columns of df are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in _ROW_SCHEMA.split(", ")]
        for pdf in batches:
            out: list[tuple] = []
            seen: set[str] = set()
            for rid, text in zip(pdf["record_id"].tolist(), pdf["payload"].tolist()):
                value, ok = parse_json(text if isinstance(text, str) else None)
                rid = None if pd.isna(rid) else int(rid)
                for no, record in enumerate(shape(value) if ok else ()):
                    rows, bodies = subtree_rows(rid, record, no)
                    for r in rows:
                        out.append((*r, None if r[-1] in seen else bodies[r[-1]]))  # a body goes along with the first occurrence only
                        seen.add(r[-1])
            yield pd.DataFrame(out, columns=names).astype({"record_id": "Int64", "record_no": "int32", "pos": "int64", "filled": "bool"})

    rows = materialize(df.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(payload).alias("payload")).mapInPandas(run, _ROW_SCHEMA), "occurrences")
    return rows.drop("body"), rows.where("body is not null").select("object_id", "body")


def distinct_objects(bridge: DataFrame, bodies: DataFrame) -> DataFrame:
    """object_id, body, occurrences: every subtree once."""
    return bodies.dropDuplicates(["object_id"]).join(bridge.groupBy("object_id").agg(F.count("*").alias("occurrences")), "object_id")


def field_table(bridge: DataFrame, bodies: DataFrame, node, fields: list[str]) -> DataFrame:
    """record_id, record_no, place, parent_place, node, pos and the fields of the filled occurrences at some nodes.

    node: condition on the path. A field that is no text is given as JSON; an
    entry that is itself a text gives it as the first field.
    """
    got = [F.get_json_object("body", f"$.{f}").alias(f) for f in fields]
    got[0] = F.coalesce(F.when(F.startswith("body", F.lit('"')), F.get_json_object(F.concat(F.lit("["), "body", F.lit("]")), "$[0]")), got[0]).alias(fields[0])
    there = bridge.where(F.col("filled") & node)
    read = bodies.dropDuplicates(["object_id"]).select("object_id", *got)
    return there.join(read, "object_id").select("record_id", "record_no", "place", "parent_place", "node", "pos", *fields)


# The regulation record: the shape all deliveries are brought to.

AXES = ("risk_classification", "prohibited_uses", "gpai_obligations", "transparency", "penalties", "enforcement_body")
DIFF_LISTS = ("stricter", "looser", "absent", "unique")
_LISTS = {"sources", "timeline", *DIFF_LISTS}
_ENVELOPES = ("record", "data", "regulation", "payload")


def _decoded(v):
    """A JSON text held in a string is read in its place."""
    if isinstance(v, str) and v.lstrip()[:1] in ("{", "["):
        inner, ok = parse_json(v.strip())
        return inner if ok else v
    return v


def _uniform(v):
    if isinstance(v, dict):
        out = {}
        for k, x in v.items():
            k = snake(k)
            x = _uniform(x)
            out[k] = x if k not in _LISTS or x is None or isinstance(x, list) else [x]
        return out
    return [_uniform(x) for x in v] if isinstance(v, list) else v


def _section(v, key: str):
    """A section of the record as an object; whatever else stands there is kept under the empty name."""
    v = _decoded(v)
    return v if isinstance(v, dict) or v is None else {"": v} if not _empty(v) else None


def shape_regulation(value) -> list[dict]:
    """The regulation records in a payload: envelopes opened, field names in snake_case, single values as lists, text axes as summaries."""
    value = _decoded(value)
    if isinstance(value, list):
        return [r for x in value for r in shape_regulation(x)]
    if not isinstance(value, dict):
        return []
    named = {snake(k): x for k, x in value.items()}
    if "axes" not in named and "diff_vs_eu" not in named:
        for e in _ENVELOPES:
            inner = _decoded(named.get(e))
            if isinstance(inner, (dict, list)):
                return shape_regulation(inner)
    for key in ("axes", "diff_vs_eu"):
        if key in named:
            named[key] = _section(named[key], key)
    r = _uniform(named)
    axes = r.get("axes")
    if isinstance(axes, dict):
        for a in AXES:
            if a in axes and isinstance(axes[a] if not isinstance(axes[a], str) else (d := _decoded(axes[a])), (str, dict)):
                x = _decoded(axes[a])
                axes[a] = {"summary": x} if isinstance(x, str) else _uniform(x)
    return [r]


AXIS_NODES = [f"axes.{a}" for a in AXES]
ENTRY_NODES = [*(f"{a}.sources" for a in AXIS_NODES), "axes.timeline", *(f"diff_vs_eu.{d}" for d in DIFF_LISTS)]


def regulation_nodes(bridge: DataFrame, bodies: DataFrame) -> DataFrame:
    """The child records of regulations: record_id, node, pos. An axis counts if the object it points to carries a summary text, an entry if it is filled."""
    summary = F.regexp_replace(F.get_json_object("body", "$.summary"), r"[\s\x{3000}\x{a0}]+", "")
    telling = bodies.where(F.length(summary) > 0).select("object_id")
    axes = bridge.where(F.col("filled") & F.col("node").isin(AXIS_NODES)).join(telling, "object_id", "left_semi")
    entries = bridge.where(F.col("filled") & F.col("node").isin(ENTRY_NODES))
    return axes.select("record_id", "node", "pos").unionByName(entries.select("record_id", "node", "pos")).distinct()
