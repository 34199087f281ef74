"""Orphans against a plain check, with periods, a hot key, repeated rows, nulls and clashing columns."""

import datetime as dt
import random
from collections import Counter

from jurisdiff.operators.orphans import orphan_counts, orphan_rows

REF = "src_table string, field string, dim string, key string, at timestamp, row_key bigint, verdict string, month string, n int"
DIM = "dim string, key string, valid_from timestamp, valid_to timestamp, at timestamp"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_against_a_loop(spark):
    rnd = random.Random(3)
    dims = [("c", "hot", day(10), day(200), None), ("c", "hot", day(220), None, None), ("c", "hot", day(220), None, None), ("c", "b", None, day(100), None), ("a", "hot", day(0), None, None), ("c", "z", day(5), day(5), None)]
    refs = [("u", rnd.choice("fg"), rnd.choice("ca"), "hot" if rnd.random() < 0.6 else rnd.choice(["b", "z", "none", None]), day(rnd.randrange(400)) if rnd.random() < 0.98 else None, i // 2, "x", "y", 1) for i in range(600)]
    held = lambda r: any(d[0] == r[2] and d[1] == r[3] and r[4] is not None and (d[2] is None or d[2] <= r[4]) and (d[3] is None or r[4] < d[3]) for d in dims)
    bad = [r for r in refs if r[3] is not None and not held(r)]
    R, D = spark.createDataFrame(refs, REF), spark.createDataFrame(dims, DIM)
    assert {tuple(x) for x in orphan_rows(R, D).collect()} == {(r[0], r[5], r[1]) for r in bad}
    key = lambda r: (r[0], r[1], r[2], r[4].strftime("%Y-%m") if r[4] else "")
    want, total = Counter(map(key, bad)), Counter(key(r) for r in refs if r[3] is not None)
    assert {tuple(x) for x in orphan_counts(R, D).collect()} == {(*k, n, want[k]) for k, n in total.items()}


def test_empty_tables(spark):
    none, dims = spark.createDataFrame([], REF), spark.createDataFrame([], DIM)
    some = spark.createDataFrame([("u", "f", "c", "k", day(1), 1, None, None, None)], REF)
    assert orphan_rows(none, dims).count() == 0 and orphan_counts(none, dims).count() == 0
    assert [tuple(x) for x in orphan_rows(some, dims).collect()] == [("u", 1, "f")]
