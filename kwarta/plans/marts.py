"""The daily and hourly marts. Each build is a function of ``as_of`` and can be repeated.

The user and merchant marts cover the day before ``as_of``, or the ``days`` days before it for a
backfill in one job. The hourly mart runs from the midnight before through ``as_of``. All can be built for any
set of days instead: every load notes the days whose facts it changes, and :func:`refresh` rebuilds those.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwarta import schemas
from kwarta.config import Lake
from kwarta.functions import money
from kwarta.functions.clock import hour_floor, instant, midnight, time_range
from kwarta.operators.keyed import first_per_key, lookup
from kwarta.operators.merge import merge_by_key
from kwarta.plans import quality
from kwarta.plans.load import together
from kwarta.sinks import arrivals, tables

DAY = timedelta(days=1)


def _stamp(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def days_before(as_of: datetime | str, days: int = 1) -> list[date]:
    end = midnight(as_of)
    return [(end - n * DAY).date() for n in range(days, 0, -1)]


def on_days(facts: DataFrame, days: Iterable[date]) -> DataFrame:
    """The facts of those days. Other partitions are not opened."""
    return facts.filter(F.col("event_date").isin(sorted(set(days))))


def user_daily(
    facts: DataFrame,
    merchants: DataFrame,
    as_of: datetime | str,
    days: int = 1,
    now: Column | None = None,
    on: Iterable[date] | None = None,
) -> DataFrame:
    """Spending of each user on each day, with the most frequent category and merchant.

    ``on`` names the days instead of ``days`` before ``as_of``.

    Facts are reduced to one row per (user, day, merchant) before the join, so a busy merchant
    reaches it as one row per user and a busy user as one row per merchant. Then they are dealt once by (user, day),
    which both groupings that follow use. The two modes are the largest of pre-counted groups; no per-user
    list of values is ever held.
    """
    end = midnight(as_of)
    key = ["user_id", "spend_date"]
    visits = (
        (time_range(facts, end - days * DAY, end) if on is None else on_days(facts, on))
        .groupBy("user_id", F.to_date("event_timestamp").alias("spend_date"), "merchant_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount_php").alias("spend"),
            F.count_if("fraud_flag").alias("alerts"),
        )
    )
    named = lookup(visits, merchants, "merchant_id", ["merchant_name", "category"])
    sums = ("n", "spend", "alerts")
    values = [
        F.struct(F.lit(kind).alias("is_category"), F.col(name).alias("value"), *sums)
        for kind, name in ((1, "category"), (0, "merchant_name"))
    ]
    by_value = (
        named.repartition(*key)
        .select(*key, F.inline(F.array(*values)))
        .groupBy(*key, "is_category", "value")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    is_category = F.col("is_category") == 1

    def most_frequent(within: Column) -> Column:
        rank = F.struct(-F.col("n"), F.col("value"))
        return F.min_by("value", F.when(within & F.col("value").isNotNull(), rank))

    def spend_on(category: str) -> Column:
        wanted = is_category & (F.col("value") == category)
        return F.sum(F.when(wanted, F.col("spend")).otherwise(F.lit(0))).cast("decimal(12,2)")

    spend = F.sum(F.when(is_category, F.col("spend")))
    n = F.sum(F.when(is_category, F.col("n")))
    return by_value.groupBy(*key).agg(
        spend.cast("decimal(16,2)").alias("total_spend_php"),
        n.alias("transaction_count"),
        money.mean(spend, n).alias("avg_transaction_php"),
        most_frequent(is_category).alias("top_category"),
        most_frequent(~is_category).alias("top_merchant"),
        spend_on("Food").alias("food_spend_php"),
        spend_on("Bills").alias("bills_spend_php"),
        spend_on("Transport").alias("transport_spend_php"),
        spend_on("E-commerce").alias("ecommerce_spend_php"),
        F.sum(F.when(is_category, F.col("alerts"))).alias("fraud_alerts_today"),
    ).withColumn("created_at", _stamp(now))


def _growth(today: Column, before: Column) -> Column:
    """Change in per cent; null where the day before had no volume."""
    change = (today - before).cast("decimal(20,2)") * F.lit(100).cast("decimal(3,0)")
    return F.try_divide(change, before.cast("decimal(18,2)")).cast("decimal(24,2)")


def merchant_daily(
    facts: DataFrame, as_of: datetime | str, days: int = 1, now: Column | None = None, on: Iterable[date] | None = None
) -> DataFrame:
    """Volume, customers, channels and growth of each merchant on each day. ``on`` names the days instead.

    Growth needs one more day of facts than is reported. Counting distinct users makes Spark group
    by (merchant, day, user) first, which spreads a busy merchant over all tasks.
    """
    end = midnight(as_of)
    start = end - days * DAY
    wanted = days_before(as_of, days) if on is None else sorted(set(on))
    daily = (
        (time_range(facts, start - DAY, end) if on is None else on_days(facts, [*wanted, *(d - DAY for d in wanted)]))
        .filter("merchant_id IS NOT NULL")
        .groupBy("merchant_id", F.to_date("event_timestamp").alias("analysis_date"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            money.total("amount_php", "decimal(18,2)").alias("total_volume_php"),
            F.sum("amount_php").alias("_sum"),
            F.countDistinct("user_id").alias("unique_customers"),
            F.count_if(F.col("channel") == "QR").alias("qr_count"),
            F.count_if(F.col("channel") == "InApp").alias("inapp_count"),
            F.count_if(F.col("channel") == "Online").alias("online_count"),
            F.count_if(F.col("status") == "SUCCESS").alias("_ok"),
            F.count_if("fraud_flag").alias("fraud_incidents"),
        )
    )
    n = F.col("transaction_count")
    return (
        daily.withColumn("growth_vs_yesterday", _day_over_day("analysis_date"))
        .filter(F.col("analysis_date").isin(wanted))
        .select(
            "merchant_id",
            "analysis_date",
            "transaction_count",
            "total_volume_php",
            money.mean(F.col("_sum"), n).alias("avg_ticket_php"),
            "unique_customers",
            "qr_count",
            "inapp_count",
            "online_count",
            money.percent(F.col("_ok"), n).alias("success_rate"),
            "fraud_incidents",
            "growth_vs_yesterday",
            _stamp(now).alias("created_at"),
        )
    )


def _day_over_day(day: str) -> Column:
    """Growth against the row before, if that is of the day before. Rows are one per merchant and
    day, so a window holds at most as many rows as there are days."""
    per_merchant = Window.partitionBy("merchant_id").orderBy(day)
    before = F.lag("total_volume_php").over(per_merchant)
    adjacent = F.datediff(F.col(day), F.lag(day).over(per_merchant)) == 1
    return F.when(adjacent, _growth(F.col("total_volume_php"), before))


def merchant_growth(facts: DataFrame) -> DataFrame:
    """Daily volume of every merchant over all days, with growth against the day before."""
    return (
        facts.filter("merchant_id IS NOT NULL")
        .groupBy("merchant_id", F.to_date("event_timestamp").alias("analysis_date"))
        .agg(money.total("amount_php", "decimal(18,2)").alias("total_volume_php"))
        .withColumn("growth_vs_yesterday", _day_over_day("analysis_date"))
    )


def hourly(facts: DataFrame, as_of: datetime | str, now: Column | None = None, on: Iterable[date] | None = None) -> DataFrame:
    """System-wide volume, rates and processing time per hour. ``on`` names whole days instead."""
    n, ok = F.count(F.lit(1)), F.count_if(F.col("status") == "SUCCESS")
    flagged = F.count_if("fraud_flag")
    return (
        (time_range(facts, midnight(as_of) - DAY, instant(as_of), include_end=True) if on is None else on_days(facts, on))
        .groupBy(hour_floor("event_timestamp").alias("window_hour"))
        .agg(
            n.alias("transaction_count"),
            money.total("amount_php", "decimal(16,2)").alias("total_volume_php"),
            F.count_if(F.col("transaction_type") == "PAYMENT").alias("payment_count"),
            F.count_if(F.col("transaction_type") == "TRANSFER").alias("transfer_count"),
            F.count_if(F.col("transaction_type") == "CASHOUT").alias("cashout_count"),
            money.percent(ok, n).alias("success_rate"),
            money.percent(flagged, n, "decimal(7,4)").alias("fraud_rate"),
            money.mean_delay_millis("event_timestamp", "processing_timestamp").alias("avg_processing_ms"),
        )
        .withColumn("created_at", _stamp(now))
    )


#: Buckets of a sketch of customers, as a power of two: a standard error of 1.2 % for many, none for few.
SKETCH_BITS = 13


def merchant_customers(facts: DataFrame, on: Iterable[date]) -> DataFrame:
    """A mergeable sketch of each merchant's distinct customers on each of the days."""
    return (
        on_days(facts, on).filter("merchant_id IS NOT NULL")
        .groupBy("merchant_id", F.to_date("event_timestamp").alias("analysis_date"))
        .agg(F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("customers"))
    )


def approximate_customers(customers: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """About how many customers each merchant had from one day through another, from the daily sketches alone."""
    if start is not None:
        customers = customers.filter(F.col("analysis_date") >= F.lit(start))
    if end is not None:
        customers = customers.filter(F.col("analysis_date") <= F.lit(end))
    return customers.groupBy("merchant_id").agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))


def build_customers(lake: Lake, facts: DataFrame, on: Iterable[date]) -> None:
    tables.replace_partitions(tables.conform(merchant_customers(facts, on), schemas.CUSTOMERS), lake.customers, "analysis_date")


def build_profiles(lake: Lake, facts: DataFrame, on: Iterable[date]) -> None:
    tables.replace_partitions(tables.conform(quality.profile(on_days(facts, on)), schemas.PROFILES), lake.profiles, "event_date")


def build_user_daily(
    lake: Lake, facts: DataFrame, merchants: DataFrame, as_of, days: int = 1, on: Iterable[date] | None = None
) -> None:
    rows = tables.conform(user_daily(facts, merchants, as_of, days, on=on), schemas.USER_DAILY)
    touched = days_before(as_of, days) if on is None else sorted(set(on))
    merge_by_key(lake.user_daily, rows, ["user_id", "spend_date"], "spend_date", touched)


def build_merchant_daily(lake: Lake, facts: DataFrame, as_of, days: int = 1, on: Iterable[date] | None = None) -> None:
    rows = tables.conform(merchant_daily(facts, as_of, days, on=on), schemas.MERCHANT_DAILY)
    touched = days_before(as_of, days) if on is None else sorted(set(on))
    merge_by_key(lake.merchant_daily, rows, ["merchant_id", "analysis_date"], "analysis_date", touched)


def build_hourly(lake: Lake, facts: DataFrame, as_of, on: Iterable[date] | None = None) -> None:
    dated = hourly(facts, as_of, on=on).withColumn("window_date", F.to_date("window_hour"))
    touched = [*days_before(as_of), instant(as_of).date()] if on is None else sorted(set(on))
    merge_by_key(lake.hourly, tables.conform(dated, schemas.HOURLY), ["window_hour"], "window_date", touched)


def touched_days(lake: Lake, spark, as_of) -> dict[date, list[str]]:
    """Closed days whose facts have changed since their marts were built, with the notes that say so."""
    days = sorted(map(date.fromisoformat, tables.names_in(spark, lake.touched)))
    return {d: notes for d in days if d < midnight(as_of).date() and (notes := tables.names_in(spark, f"{lake.touched}/{d}"))}


def _settle(lake: Lake, spark, seen: dict[date, list[str]]) -> None:
    """Forget notes that have been seen. What a load has noted meanwhile stays."""
    for day, notes in seen.items():
        for note in notes:
            tables.remove(spark, f"{lake.touched}/{day}/{note}")
        tables.remove_if_empty(spark, f"{lake.touched}/{day}")


def _rebuild(lake: Lake, facts: DataFrame, merchants: DataFrame, as_of, days: list[date]) -> None:
    """The marts, sketches and profiles of those days. A merchant's growth on the day after stands on them too."""
    after = {d + DAY for d in days if d + DAY < midnight(as_of).date()}
    together(
        facts.sparkSession,
        lambda: build_user_daily(lake, facts, merchants, as_of, on=days),
        lambda: build_merchant_daily(lake, facts, as_of, on={*days, *after}),
        lambda: build_hourly(lake, facts, as_of, on=days),
        lambda: build_customers(lake, facts, days),
        lambda: build_profiles(lake, facts, days),
    )


def refresh(lake: Lake, spark, as_of) -> list[date]:
    """Rebuild the marts of the closed days that loads have changed, however old; back come these days.

    Only their partitions are read and written. The notes are read before the facts and forgotten after the
    marts, so a load that comes in between is seen here or by the next refresh, and a refresh that fails
    is done again.
    """
    seen = touched_days(lake, spark, as_of)
    if seen:
        _rebuild(lake, tables.read(spark, lake.facts), tables.read(spark, lake.merchants), as_of, list(seen))
        _settle(lake, spark, seen)
    return list(seen)


def build_all(lake: Lake, spark, as_of) -> None:
    """The nightly build: yesterday, the hours up to now, and older days that late facts have changed."""
    seen = touched_days(lake, spark, as_of)
    facts, merchants = tables.read(spark, lake.facts), tables.read(spark, lake.merchants)
    if late := [d for d in seen if d not in days_before(as_of)]:
        _rebuild(lake, facts, merchants, as_of, late)
    together(
        spark,
        lambda: build_user_daily(lake, facts, merchants, as_of),
        lambda: build_merchant_daily(lake, facts, as_of),
        lambda: build_hourly(lake, facts, as_of),
        lambda: build_customers(lake, facts, days_before(as_of)),
        lambda: build_profiles(lake, facts, days_before(as_of)),
    )
    _settle(lake, spark, seen)


def triage(lake: Lake, decisions: DataFrame) -> None:
    """Store analysts' decisions on alerts: alert_id, status, investigated_by, notes, resolved_at.

    They are only ever appended, beside the alerts, which a running stream may be adding to.
    """
    tables.append(tables.conform(decisions, schemas.DECISIONS), lake.decisions)


def alerts_now(lake: Lake, spark, newest_open: int | None = None) -> DataFrame:
    """The stored alerts with the latest decision on each.

    With ``newest_open`` only those of the newest loads, so many loads that they hold this many open ones, if there
    are: the notes that loads leave tell their days and times, so older partitions and files are not opened. A
    look at the alerts per doubling is taken while the frame is being built.
    """
    alerts, decisions = tables.read(spark, lake.alerts), tables.read(spark, lake.decisions)
    if newest_open is None:
        return decided(alerts, decisions)
    days, found, wanted = set(), 0, newest_open
    for arrival in arrivals.newest(spark, lake, with_alerts=True):
        days.update(arrival.days)
        found += arrival.alerts
        if found >= wanted:
            some = on_days(alerts, days).filter(F.col("created_at") >= F.timestamp_micros(F.lit(arrival.micros)))
            some = decided(some, decisions.join(some.select("alert_id"), "alert_id", "left_semi"))
            if some.filter("status = 'NEW'").limit(newest_open).count() >= newest_open:
                return some
            wanted = 2 * found
    return decided(alerts, decisions)


TRIAGE_COLUMNS = ["status", "investigated_by", "notes", "resolved_at"]


def decided(alerts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Alerts with the triage columns of their latest decision, where there is one.

    The latest is the one resolved last; of several resolved at once the same one is taken every time. A
    decision on an alert that is not there is ignored.
    """
    order = [F.col("resolved_at").desc_nulls_last(), F.xxhash64("status", "investigated_by", "notes")]
    latest = first_per_key(decisions.select("alert_id", *TRIAGE_COLUMNS), ["alert_id"], order)
    latest = latest.select("alert_id", *[F.col(c).alias(f"_{c}") for c in TRIAGE_COLUMNS])
    joined = alerts.join(latest.withColumn("_decided", F.lit(True)), "alert_id", "left")
    return joined.select(
        *[
            F.when(F.col("_decided"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
            if c in TRIAGE_COLUMNS else F.col(c)
            for c in alerts.columns
        ]
    )
