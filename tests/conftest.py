import math
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from shardloom.session import get_session

    s = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def same_as_sql(spark, name, module, folder="/root/testdata/sf0.001"):
    """Whether a module's query gives the rows of its SQL on the smallest test data."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f[:-8]} as from '{folder}/{f}'")
    df = module.queries()[name](spark, folder)
    cols = sorted(df.columns)
    flat = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else tuple(v) if isinstance(v, list) else v
    fixed = lambda rows: sorted((tuple(map(flat, r)) for r in rows), key=repr)
    got = con.sql(module.oracle_sql()[name])
    assert sorted(got.columns) == cols
    assert fixed(map(tuple, df.select(*cols).collect())) == fixed(got.select(*cols).fetchall())
