"""Every registered query of the library against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from lexspark.plans import queries as catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(catalogue.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(value):
    if hasattr(value, "__len__") and not isinstance(value, (str, bytes)):
        return tuple(map(plain, value))
    if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and value != value:
        return "null"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(map(plain, r)) for r in frame[names].itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, duck, name):
    assert rows(catalogue.queries()[name](spark, DIR).toPandas()) == rows(duck.execute(catalogue.oracle_sql()[name]).fetchdf())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
