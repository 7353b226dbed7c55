import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check_oracle import rows_of
from tallyframe import registry
from tallyframe.plans.staging import staging_root

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= spark_entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, con, name):
    ours = QUERIES[name](spark, small).toPandas()
    theirs = con.execute(ORACLE[name]).df()
    assert len(ours) > 0
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 1


def test_staging_uses_the_named_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
