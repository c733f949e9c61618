"""A few queries of each kind against their SQL; check.py runs all of them."""

import duckdb
import pytest

from check import TABLES, digest
from registry.batch import QUERIES
from registry.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [
    "cleanse_valid", "quarantine", "fraud_history", "location_jump", "new_users_anti", "facts_orphans",
    "mart_user_daily_backfill", "mart_merchant_daily", "mart_hourly", "merge_user_mart", "report_live_feed",
    "report_realtime", "report_province", "dq_fk", "dq_completeness", "stream_hourly_window",
])
def test_same_result(spark, sql, name):
    df = QUERIES[name](spark, SF)
    expected = sql.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(df.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(expected.fetchall(), names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
