"""Every registered query against its DuckDB oracle at sf0.001 (the driver's
t2 check in miniature), plus the smoke entry."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_key

SF = "/root/testdata/sf0.001"
# Spark simple type -> DuckDB result type
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour_ts", "product_id", "amount", "product_rank"]


def test_every_query_of_the_reference_has_an_oracle():
    missing = {*E.QUERIES, *E.STREAM_QUERIES} - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    d_types = {c[0]: str(c[1]) for c in rel.description}
    assert s_types == d_types
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_cols, s_rows) == rows_key(d_cols, d_rows)
