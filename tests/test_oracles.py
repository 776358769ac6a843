"""Every registered query against its DuckDB statement at sf0.01."""

import duckdb
import pytest

import __spark_entry__ as ent
from strandline.plans.queries import QUERIES
from tools.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ent.oracle_sql()
    r = compare(spark, con, name, ent.queries()[name], ent.oracle_sql()[name], SF)
    assert r[1] == "ok", r


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["event_id", "user_id", "event_type", "value", "_rescued_data"]
    assert df.count() > 0
