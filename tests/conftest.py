import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 4g --conf spark.ui.showConsoleProgress=false pyspark-shell")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from jurisdiff.session import build_session, purge

    s = build_session("local[4]", "tests", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    purge(s)
    s.stop()


@pytest.fixture(scope="session")
def oracle():
    """run(sql) -> (columns, rows) over the sf0.001 tables."""
    import duckdb

    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for f in sorted(os.listdir(SF)):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")

    def run(sql):
        r = c.sql(sql)
        return r.columns, r.fetchall()

    return run


def normal(rows, order):
    """Rows as sorted texts, with their columns in the given order."""
    one = lambda x: round(x, 6) if isinstance(x, float) else str(x) if hasattr(x, "tzinfo") else x
    return sorted(repr(tuple(one(r[i]) for i in order)) for r in rows)
