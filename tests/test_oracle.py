"""Every registered query against its SQL counterpart, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from feedlake.plans.oracle import ORACLE
from feedlake.plans.queries import QUERIES

SF_DIR = registered.SMOKE_DIR
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN",
    "double": "DOUBLE", "decimal(18,0)": "DECIMAL(18,0)",
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= registered.queries().keys()
    assert ORACLE.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, tables, name):
    df = registered.queries()[name](spark, SF_DIR)
    cursor = tables.execute(registered.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == kinds
    got = rows_of(df.collect(), df.columns)
    assert got == rows_of(cursor.fetchall(), columns)
    assert got


def test_entry(spark):
    assert registered.entry(spark).count() > 0
