"""Fraud rules on a single row, and what follows from a rule's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kwarta.config import DEFAULT_RULES, NEW_ALERT_STATUS, RULE_SCORES, Rules


def static_reason(rules: Rules = DEFAULT_RULES) -> Column:
    """Name of the first row-local rule that applies (night, round, international), or null."""
    amount = F.col("amount_php")
    at_night = F.hour("event_timestamp").between(rules.night_from_hour, rules.night_to_hour)
    unit = F.lit(rules.round_unit)
    return (
        F.when((amount > rules.night_amount) & at_night, "HIGH_AMOUNT_NIGHT")
        .when((amount > rules.round_amount) & (amount % unit == 0), "ROUND_AMOUNT")
        .when(
            F.col("is_international") & (amount > rules.international_amount),
            "INTERNATIONAL_HIGH_AMOUNT",
        )
    )


def score_of(reason: Column) -> Column:
    """Points of a rule, 0 for none. A map lookup, so the reason is evaluated once."""
    pairs = [F.lit(x) for name, points in RULE_SCORES.items() for x in (name, points)]
    points = F.try_element_at(F.create_map(*pairs), reason)
    return F.coalesce(points, F.lit(0)).cast("decimal(5,2)")


def flag_of(reason: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Whether a rule's points reach the flagging score. Points are fixed per rule, so this is a
    membership test on the name: a filter on the flag does not drag the scoring along."""
    flagged = [name for name, points in RULE_SCORES.items() if points >= rules.flag_score]
    return F.coalesce(reason.isin(*flagged), F.lit(False))


def with_reason(rows: DataFrame, reason: Column, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Set fraud_reason and the score and flag that follow from it."""
    name = F.col("fraud_reason")
    return rows.withColumn("fraud_reason", reason).withColumns(
        {"fraud_score": score_of(name), "fraud_flag": flag_of(name, rules)}
    )


def band(rules: Rules = DEFAULT_RULES) -> Column:
    """What to do with a scored row: AUTO_FLAG, MONITOR or NORMAL."""
    points = F.col("fraud_score")
    return (
        F.when(points >= rules.flag_score, "AUTO_FLAG")
        .when(points >= rules.monitor_score, "MONITOR")
        .otherwise("NORMAL")
    )


def alerts(scored: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One alert per flagged row, with an id that a replay computes again."""
    key = "event_id" if "event_id" in scored.columns else "transaction_id"
    return scored.filter("fraud_flag").select(
        F.xxhash64(F.col(key), F.col("fraud_reason")).alias("alert_id"),
        F.col(key).alias("transaction_id"),
        "user_id",
        "merchant_id",
        F.col("fraud_reason").alias("alert_type"),
        "fraud_score",
        "amount_php",
        "province",
        "event_timestamp",
        F.lit(NEW_ALERT_STATUS).alias("status"),
        F.lit(None).cast("string").alias("investigated_by"),
        F.lit(None).cast("string").alias("notes"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.to_date("event_timestamp").alias("event_date"),
    )
