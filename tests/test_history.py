"""Versions of entities against a plain loop, with nulls, ties, late and corrected rows and a hot entity."""

import datetime as dt
import random

from pyspark.sql import functions as F

from jurisdiff.functions.codes import norm_code, norm_instant, norm_term
from jurisdiff.operators.history import coalesce_history

SCHEMA = "rid string, t timestamp, loaded timestamp, k bigint, a string, b string, entity string, pid int"
T0 = dt.datetime(2024, 1, 1)


def plain(rows):
    latest = {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            rank = (r[2] is not None, r[2] or T0, r[3])
            if (r[0], r[1]) not in latest or latest[r[0], r[1]][0] < rank:
                latest[r[0], r[1]] = (rank, r[4], r[5])
    out, state = [], {}
    for (e, t), (_, a, b) in sorted(latest.items()):
        old = state.get(e)
        new = (a if a is not None else old and old[0], b if b is not None else old and old[1])
        if old != new or e not in state:
            out.append([e, t, None, *new])
            for x in reversed(out[:-1]):
                if x[0] == e:
                    x[2] = t
                    break
        state[e] = new
    return sorted(map(repr, map(tuple, out)))


def run(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(rows, SCHEMA)
    got = coalesce_history(df, "rid", "t", ["loaded", "k"], {"a": F.col("a"), "b": F.col("b")}).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return sorted(repr(tuple(x)) for x in got)


def test_against_a_loop(spark):
    rnd = random.Random(1)
    for parts, hot in ((1, 0.1), (7, 0.5), (12, 0.95)):
        rows = []
        for k in range(400):
            e = "hot" if rnd.random() < hot else rnd.choice(["x", "y", "z", None])
            t = None if rnd.random() < 0.02 else T0 + dt.timedelta(days=rnd.randrange(150))
            loaded = None if rnd.random() < 0.05 else T0 + dt.timedelta(days=rnd.randrange(9))
            rows.append((e, t, loaded, k, rnd.choice(["p", "p", "p", "q", None, None]), rnd.choice(["1", "1", None]), "clash", 5))
        assert run(spark, rows, parts) == plain(rows)


def test_no_rows_and_only_nulls(spark):
    assert run(spark, [], 4) == []
    assert run(spark, [("x", T0, None, 1, None, None, None, None)], 4) == [repr(("x", T0, None, None, None))]
    assert run(spark, [(None, None, None, 1, "p", None, None, None)], 4) == []


def test_normal_values(spark):
    rows = [(" In-Force　", "２０２４", "2024-11-15T17:01:12+09:00", " Ｅu "), ("in force", " ", "2024-11-15T08:01:12.000Z", ""), ("IN_FORCE", None, "soon", None)]
    got = spark.createDataFrame(rows, "s string, x string, t string, c string").select(norm_term(F.col("s")), norm_term(F.col("x")), norm_instant(F.col("t")), norm_code(F.col("c"))).collect()
    assert [g[0] for g in got] == ["in_force"] * 3
    assert [g[1] for g in got] == ["2024", None, None]
    assert got[0][2] == got[1][2] and got[2][2] == "?soon"
    assert [g[3] for g in got] == ["eu", None, None]


def test_rounds_merge_what_neighbours_would():
    import numpy as np

    from jurisdiff.operators.history import _merge_rounds

    rnd = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 64, 1000):
        entity, a = np.sort(rnd.integers(0, 5, n)), rnd.integers(0, 2, n).astype(object)
        new = np.r_[True, entity[1:] != entity[:-1]]
        got = _merge_rounds(new, [a])
        assert all(got[i] == (new[i] or a[i] != a[i - 1]) for i in range(1, n))
