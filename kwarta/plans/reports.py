"""Operational reports over the stored tables. ``as_of`` stands for the present moment."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kwarta.functions import money
from kwarta.functions.clock import hour_floor, instant, time_range
from kwarta.operators.keyed import lookup, newest, newest_partitions

HOUR = timedelta(hours=1)


def _recent(facts: DataFrame, as_of: datetime | str, span: timedelta) -> DataFrame:
    now = instant(as_of)
    return time_range(facts, now - span, now, include_end=True)


def _count() -> Column:
    return F.count(F.lit(1))


def _volume(amount: str = "amount_php") -> Column:
    return F.sum(amount).cast("decimal(24,2)")


def _average(amount: str = "amount_php") -> Column:
    return money.mean(F.sum(amount), _count(), "decimal(14,2)")


def realtime_stats(facts: DataFrame, as_of: datetime | str, span: timedelta = HOUR) -> DataFrame:
    """One row of totals over the last hour. Volume and rates are 0 when there was nothing."""
    totals = _recent(facts, as_of, span).agg(
        _count().alias("total_transactions"),
        F.coalesce(_volume(), F.lit(0).cast("decimal(24,2)")).alias("total_volume"),
        _average().alias("avg_transaction"),
        F.count_if("fraud_flag").alias("fraud_count"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_count"),
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("merchant_id").alias("active_merchants"),
    )

    def rate(part: str) -> Column:
        none = F.lit(0).cast("decimal(5,2)")
        return F.coalesce(money.percent(F.col(part), F.col("total_transactions")), none)

    return totals.withColumns(
        {"success_rate": rate("success_count"), "fraud_rate": rate("fraud_count")}
    )


def hourly_velocity(facts: DataFrame, as_of: datetime | str, hours: int = 24) -> DataFrame:
    return (
        _recent(facts, as_of, hours * HOUR)
        .groupBy(hour_floor("event_timestamp").alias("hour"))
        .agg(
            _count().alias("tx_count"),
            _volume().alias("volume_php"),
            _average().alias("avg_amount"),
            F.count_if("fraud_flag").alias("fraud_count"),
        )
        .orderBy(F.desc("hour"))
    )


def fraud_alerts(
    alerts: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    limit: int | None = 20,
    since: datetime | None = None,
) -> DataFrame:
    """Newest open alerts with the names behind the ids; all of them when ``limit`` is None.

    The limit is taken before the names are looked up: keys are unique in the dimensions, so the
    rows are the same and the dimensions are only searched for the few that are shown. ``since`` is a bound on
    the alert's creation.
    """
    open_alerts = alerts.filter("status = 'NEW'")
    if since is not None:
        open_alerts = open_alerts.filter(F.col("created_at") >= F.lit(since))
    order = [F.desc("created_at"), F.asc("transaction_id"), F.asc("alert_type")]
    shown = _named(newest(open_alerts, order, limit), users, merchants).select(
        "alert_id", "transaction_id", "user_id", "alert_type", "fraud_score", "amount_php",
        "province", "event_timestamp", "status", "user_name", "merchant_name", "created_at",
    )
    return shown.orderBy(*order).drop("created_at")


def open_alerts(alerts: DataFrame) -> DataFrame:
    """The triage queue: every open alert, in no order."""
    return (
        alerts.filter("status = 'NEW'")
        .select("alert_id", "user_id", "alert_type", "fraud_score", "amount_php", "status")
    )


def _named(shown: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """With the names behind the ids. The dimensions are reduced to the ids shown before they are joined."""
    for dim, key, column in (
        (users, "user_id", F.col("full_name").alias("user_name")), (merchants, "merchant_id", F.col("merchant_name")),
    ):
        shown = lookup(shown, dim.join(shown.select(key), key, "left_semi"), key, [column])
    return shown


def _by_merchant(facts: DataFrame, as_of: datetime | str, merchants: DataFrame, columns: list[str]) -> DataFrame:
    """Last day's totals per merchant, joined with its description.

    Facts are summed per merchant first, so the join meets one row per merchant, not per sale.
    """
    per_merchant = (
        _recent(facts, as_of, 24 * HOUR)
        .groupBy("merchant_id")
        .agg(_count().alias("n"), F.sum("amount_php").alias("volume"))
    )
    return per_merchant.join(merchants.select("merchant_id", *columns), "merchant_id")


def category_breakdown(facts: DataFrame, merchants: DataFrame, as_of: datetime | str) -> DataFrame:
    return (
        _by_merchant(facts, as_of, merchants, ["category"])
        .groupBy("category")
        .agg(
            F.sum("n").alias("tx_count"),
            _volume("volume").alias("total_volume"),
            money.mean(F.sum("volume"), F.sum("n"), "decimal(14,2)").alias("avg_amount"),
        )
        .orderBy(F.desc("total_volume"), "category")
    )


def top_merchants(
    facts: DataFrame, merchants: DataFrame, as_of: datetime | str, limit: int = 10
) -> DataFrame:
    return (
        _by_merchant(facts, as_of, merchants, ["merchant_name", "category"])
        .groupBy("merchant_name", "category")
        .agg(F.sum("n").alias("tx_count"), _volume("volume").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "merchant_name", "category")
        .limit(limit)
    )


def provincial_heatmap(facts: DataFrame, as_of: datetime | str, limit: int = 10) -> DataFrame:
    return (
        _recent(facts, as_of, 24 * HOUR)
        .groupBy("province")
        .agg(
            _count().alias("tx_count"),
            _volume().alias("total_volume"),
            F.count_if("fraud_flag").alias("fraud_count"),
        )
        .orderBy(F.desc("total_volume"), "province")
        .limit(limit)
    )


def channel_distribution(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Per channel; rows without a channel form a group of their own."""
    return (
        _recent(facts, as_of, 24 * HOUR)
        .groupBy("channel")
        .agg(_count().alias("tx_count"), _volume().alias("total_volume"))
        .orderBy(F.desc("tx_count"), "channel")
    )


def live_transactions(
    facts: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    limit: int = 100,
    fraud_only: bool = False,
) -> DataFrame:
    """The newest transactions with names. ``fraud_only`` filters what is shown: it keeps the flagged
    ones among the newest ``limit``, it does not look for older flagged ones."""
    order = [F.desc("event_timestamp"), F.asc("transaction_id")]
    latest = newest_partitions(facts, limit).select(
        "transaction_id", "event_timestamp", "user_id", "merchant_id", "amount_php", "channel",
        "province", "fraud_flag", "fraud_score",
    )
    latest = newest(latest, order, limit)
    if fraud_only:
        latest = latest.filter("fraud_flag")
    return (
        _named(latest, users, merchants)
        .select(
            "transaction_id", "event_timestamp", "user_name", "merchant_name", "amount_php",
            "channel", "province", "fraud_flag", "fraud_score",
        )
        .orderBy(*order)
    )
