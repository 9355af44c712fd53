"""Every registered query against its SQL in DuckDB, over the whole given tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from sluiceway.queries.oracle import ORACLE_SQL
from sluiceway.queries.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    order = plain.map(repr).sort_values(columns).index
    return plain.loc[order].reset_index(drop=True)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE_SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, oracle, name):
    result = _sorted(contract.queries()[name](spark, SF_DIR).toPandas())
    expected = _sorted(oracle.execute(contract.oracle_sql()[name]).fetch_df())
    assert len(expected) > 0
    assert list(result.columns) == list(expected.columns)
    pd.testing.assert_frame_equal(result, expected)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["message_id", "route", "name", "timestamp"]
    counts = result.groupBy("route").count().toPandas().set_index("route")["count"].to_dict()
    assert counts.keys() == {"A", "B"} and min(counts.values()) > 0
