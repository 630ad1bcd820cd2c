"""Every registered corpus query against its SQL counterpart, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from feedlake.llm.queries import ORACLE, QUERIES

SF_DIR = registered.SMOKE_DIR


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return connection


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = registered.queries()
    assert [sum(name.startswith(f"op{number}_") for name in names) for number in range(1, 14)] == [1] * 13
    assert "pipeline" in names and ORACLE.keys() <= QUERIES.keys() <= names.keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_result(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = tables.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    got = rows_of(df.collect(), df.columns)
    assert got == rows_of(cursor.fetchall(), columns) and got
