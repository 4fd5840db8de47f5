"""Every query with SQL gives the same rows and columns as that SQL."""

import glob
import math
import os

import duckdb
import pytest

from gleanery.plans import queries

DATA = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = queries.QUERIES[name](spark, DATA).toPandas(), duck.sql(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry_module_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.QUERIES) <= set(entry.queries())


def test_nothing_else_imports_the_training_data_subpackage():
    root = os.path.dirname(os.path.dirname(queries.__file__))
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "gleanery.llm" not in f.read(), name
