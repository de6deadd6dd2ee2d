"""Every registered query of the catalogue against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from brandtide.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cells(frame, columns):
    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v) or str(v) == "NaT":
            return None
        return round(v, 9) if isinstance(v, float) else str(v.date() if hasattr(v, "date") else v)

    return sorted(str([cell(v) for v in row]) for row in frame[columns].astype(object).values.tolist())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got, sorted(got.columns)) == cells(want, sorted(got.columns))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
