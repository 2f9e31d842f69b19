"""The driver contract on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from catalog.oracle_sql import ORACLE
from catalog.spark_queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["split", "example", "input_ids", "target_ids"]
    row = df.filter("split = 'val'").first()
    x, y = row.input_ids.split(" "), row.target_ids.split(" ")
    assert len(x) == len(y) == 128 and x[0] == "1" and x[1:] == y[:-1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize(
    "name", ["corpus_lines", "split_docs", "packed_examples", "transcripts", "chat_segments", "eval_log"]
)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "events", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = contract.queries()[name](spark, SF)
    got = sorted(map(tuple, df.select(*sorted(df.columns)).collect()))
    columns = ", ".join(sorted(df.columns))
    con.execute(f"SELECT {columns} FROM ({contract.oracle_sql()[name]})")
    assert got == sorted(con.fetchall())
