"""The physical plans are the ones meant."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from kwarta.operators import history
from kwarta.operators.keyed import newest
from kwarta.plans import marts, quality, reports
from kwarta.sinks import tables
from registry import batch
from registry import fixture as fx

SF = "/root/testdata/sf0.001"
#: Rows that load into stored tables while they are built; tests of loads and marts see to them.
RUN = ("alert_ids", "location_two", "marts_after", "mart_merchant_stored", "customers_", "dq_profiles")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in batch.QUERIES if not n.startswith(("stream_", "load_", "stored_", "history_", "quarantine_", "dq_tables", *RUN))])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(batch.QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoop", text)


def test_top_k_is_not_a_full_sort(spark):
    for name in ("report_province", "report_top_merchants"):
        assert "TakeOrderedAndProject" in plan(batch.QUERIES[name](spark, SF))
    latest = newest(fx.facts(spark, SF), [F.desc("event_timestamp")], 100)
    assert "TakeOrderedAndProject" in plan(latest)


def test_newest_rows_and_arrivals_open_the_newest_days_only(spark, stored):
    users, merchants = fx.users(spark, SF), fx.merchants(spark, SF)
    text = plan(reports.live_transactions(stored, users, merchants, limit=5))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-", text)
    late = quality.freshness(stored, fx.REPORT_AS_OF, timedelta(hours=1), lateness=timedelta(days=1))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-14", plan(late))
    rows = reports.live_transactions(stored, users, merchants, limit=5).collect()
    assert rows == reports.live_transactions(stored.filter("true"), users, merchants, limit=5).collect() and len(rows) == 5


def test_first_row_is_picked_before_the_shuffle(spark):
    text = plan(batch.dedupe_first(spark, SF))
    assert text.index("WindowGroupLimit [user_id", text.index("Final")) < text.index("Exchange")
    assert "Partial" in text[text.index("Exchange"):]


def test_history_shuffles_the_rows_once(spark):
    rows = fx.typed(spark, SF).select("event_id", "user_id", "event_timestamp")
    assert plan(history.recent_activity(rows, fx.SPARSE_RULES)).count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "fact_transactions")
    tables.append(tables.conform(fx.facts(spark, SF), tables.BY_NAME["fact_transactions"]), path, "event_date")
    return tables.read(spark, path)


def test_dates_prune_partitions_and_columns(spark, stored):
    text = plan(marts.hourly(stored, fx.MART_AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>= 2024-01-15", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(event_timestamp", text)
    assert "device_id" not in text and "ip_hash" not in text
    assert re.search(r"PartitionFilters: \[[^\]]*>= 2024-01-14", plan(reports.hourly_velocity(stored, fx.REPORT_AS_OF)))
    assert set(re.findall(r"event_date=([\d-]+)", " ".join(
        marts.hourly(stored, fx.MART_AS_OF).inputFiles()))) >= {"2024-01-15"}
