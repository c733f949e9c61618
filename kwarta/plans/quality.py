"""Data-quality checks. Each returns rows of ``check, expected, actual, passed``."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta import schemas
from kwarta.config import Lake
from kwarta.functions.clock import literal_like, instant, midnight
from kwarta.sinks import arrivals, tables


def _verdict(check: Column, expected: str, actual: Column, passed: Column) -> list[Column]:
    return [
        check.alias("check"), F.lit(expected).alias("expected"),
        actual.alias("actual"), passed.alias("passed"),
    ]


def _none_allowed(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row per measure, all counted in a single pass; a check passes at zero."""
    wide = df.agg(*[m.alias(name) for name, m in measures.items()])
    tall = wide.unpivot([], list(measures), "check", "actual")
    return tall.select(*_verdict(F.col("check"), "= 0", F.col("actual"), F.col("actual") == 0))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def constraints(df: DataFrame, not_null: list[str], positive: list[str] = ()) -> DataFrame:
    """Rows that lack a required value, and rows whose amount is not above zero."""
    measures = {f"{c} is null": F.count_if(F.col(c).isNull()) for c in not_null}
    measures |= {f"{c} not positive": F.count_if(F.col(c) <= 0) for c in positive}
    return _none_allowed(df, measures)


def lengths(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose text is longer than the column may hold."""
    return _none_allowed(
        df, {f"{c} longer than {n}": F.count_if(F.length(c) > n) for c, n in limits.items()}
    )


def unique_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.groupBy(*key).count().filter("count > 1").agg(F.count(F.lit(1)).alias("n"))
    label = F.lit(f"repeated {', '.join(key)}")
    return repeated.select(*_verdict(label, "= 0", F.col("n"), F.col("n") == 0))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """The offending key values themselves, with how often each occurs."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def references(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows whose key is not in its dimension. Rows are counted per key before the anti-join."""
    parts = []
    for key, dim in dims.items():
        per_key = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        orphans = per_key.join(dim.select(key), key, "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n")
        )
        parts.append(
            orphans.select(
                *_verdict(F.lit(f"{key} without match"), "= 0", F.col("n"), F.col("n") == 0)
            )
        )
    return _union(parts)


def completeness(df: DataFrame, columns: list[str], target: str = "99.9") -> DataFrame:
    """Share of rows with a value, per column, in per cent."""
    n = F.count(F.lit(1)).cast("decimal(18,0)")
    filled = {
        c: F.try_divide(F.count(c).cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)"), n)
        for c in columns
    }
    wide = df.agg(*[share.cast("decimal(7,4)").alias(c) for c, share in filled.items()])
    tall = wide.unpivot([], columns, "check", "actual")
    limit = F.lit(target).cast("decimal(7,4)")
    return tall.select(
        *_verdict(F.col("check"), f"> {target}", F.col("actual"), F.col("actual") > limit)
    )


def mart_counts(
    user_daily: DataFrame, merchant_daily: DataFrame, hourly: DataFrame, as_of: datetime | str
) -> DataFrame:
    """Whether the three marts have rows for the day before ``as_of``. A warning, not an error."""
    start = midnight(as_of) - timedelta(days=1)
    day = F.lit(start.date())
    hour_from = F.col("window_hour") >= literal_like(hourly, "window_hour", start)
    if "window_date" in hourly.columns:
        hour_from = hour_from & (F.col("window_date") >= day)
    parts = [
        ("user mart rows", user_daily.filter(F.col("spend_date") == day)),
        ("merchant mart rows", merchant_daily.filter(F.col("analysis_date") == day)),
        ("hourly mart rows", hourly.filter(hour_from)),
    ]
    return _union(
        [
            rows.agg(F.count(F.lit(1)).alias("n")).select(
                *_verdict(F.lit(name), "> 0", F.col("n"), F.col("n") > 0)
            )
            for name, rows in parts
        ]
    )


def freshness(
    facts: DataFrame, as_of: datetime | str, span: timedelta = timedelta(minutes=10),
    lateness: timedelta | None = None,
) -> DataFrame:
    """Arrivals in the last minutes, and the last arrival among them. A warning, not an error.

    With ``lateness``, events older than that on arrival are not looked for, so only the newest days of the
    stored table are opened.
    """
    now = instant(as_of)
    column = "processing_timestamp"
    recent = facts.filter(
        F.col(column).between(
            literal_like(facts, column, now - span), literal_like(facts, column, now)
        )
    )
    if lateness is not None:
        recent = recent.filter(F.col("event_date") >= F.lit((now - span - lateness).date()))
    found = recent.agg(F.count(F.lit(1)).alias("n"), F.max(column).alias("last_arrival"))
    return found.select(
        *_verdict(F.lit("recent arrivals"), "> 0", F.col("n"), F.col("n") > 0), "last_arrival"
    )


def stored_freshness(lake: Lake, spark: SparkSession, as_of: datetime | str, span: timedelta = timedelta(minutes=10)) -> DataFrame:
    """:func:`freshness` of the stored facts. A row is stored after it has arrived, so only the days of loads that have
    begun since the start of the span are opened."""
    facts, since = tables.read(spark, lake.facts), instant(as_of) - span
    days = {day for arrival in arrivals.newest(spark, lake, since) for day in arrival.days}
    return freshness(facts.filter(F.col("event_date").isin(sorted(days)) if days else F.lit(False)), as_of, span)


def _measures() -> dict[str, Column]:
    """What a profile counts of the facts, by name: rows, missing and present values, bad amounts, texts that are too long."""
    facts = schemas.FACTS.names
    return {
        "rows": F.count(F.lit(1)),
        **{f"{c} is null": F.count_if(F.col(c).isNull()) for c in facts},
        "amount_php not positive": F.count_if(F.col("amount_php") <= 0),
        **{f"{c} longer than {n}": F.count_if(F.length(c) > n) for c, n in schemas.MAX_LENGTH["fact_transactions"].items()},
    }


def profile(facts: DataFrame) -> DataFrame:
    """event_date, measure, value: counts of each day that add up over days."""
    measures = _measures()
    daily = facts.groupBy(F.col("event_date").alias("_day")).agg(*[m.alias(name) for name, m in measures.items()])
    return daily.unpivot(["_day"], list(measures), "measure", "value").withColumnRenamed("_day", "event_date")


def profiled(lake: Lake, spark: SparkSession) -> DataFrame:
    """measure, value over all facts. Profiles of days that no load has changed since are added up as they are stored;
    only the other days are scanned."""
    facts, stored = tables.read(spark, lake.facts), tables.read(spark, lake.profiles)
    changed = {date.fromisoformat(d) for d in tables.names_in(spark, lake.touched)}
    known = set(tables.stored_dates(stored)) - changed
    open_days = sorted(set(tables.stored_dates(facts)) - known)
    counts = stored.filter(F.col("event_date").isin(sorted(known)) if known else F.lit(False)).select("measure", "value")
    if open_days:
        counts = counts.unionByName(profile(facts.filter(F.col("event_date").isin(open_days))).select("measure", "value"))
    return counts.groupBy("measure").agg(F.sum("value").alias("value"))


def profile_checks(profiles: DataFrame, not_null: list[str], positive: list[str] = (), limits: dict[str, int] | None = None) -> DataFrame:
    """The verdicts of :func:`constraints` and :func:`lengths`, from counts alone."""
    wanted = [*(f"{c} is null" for c in not_null), *(f"{c} not positive" for c in positive),
              *(f"{c} longer than {n}" for c, n in (limits or {}).items())]
    counts = profiles.filter(F.col("measure").isin(wanted))
    return counts.select(*_verdict(F.col("measure"), "= 0", F.col("value"), F.col("value") == 0))


def profile_completeness(profiles: DataFrame, columns: list[str], target: str = "99.9") -> DataFrame:
    """The verdicts of :func:`completeness`, from counts alone."""
    missing = {c: F.max(F.when(F.col("measure") == f"{c} is null", F.col("value"))) for c in columns}
    rows = F.max(F.when(F.col("measure") == "rows", F.col("value"))).cast("decimal(18,0)")
    wide = profiles.agg(*[
        F.try_divide((rows - n.cast("decimal(18,0)")) * F.lit(100).cast("decimal(3,0)"), rows).cast("decimal(7,4)").alias(c)
        for c, n in missing.items()
    ])
    limit = F.lit(target).cast("decimal(7,4)")
    return wide.unpivot([], columns, "check", "actual").select(
        *_verdict(F.col("check"), f"> {target}", F.col("actual"), F.col("actual") > limit))


def has_messages(source: DataFrame, at_most: int = 100) -> DataFrame:
    """Whether a source holds anything, looking at a bounded sample of it only."""
    found = source.limit(at_most).agg(F.count(F.lit(1)).alias("n"))
    return found.select(*_verdict(F.lit("messages sampled"), "> 0", F.col("n"), F.col("n") > 0))


def tables_exist(spark: SparkSession, names: list[str]) -> DataFrame:
    """Whether each table is there, by name or path."""
    found = [
        (name.rstrip("/").rsplit("/", 1)[-1], "exists", int(tables.exists(spark, name)))
        for name in names
    ]
    rows = spark.createDataFrame(found, "check string, expected string, actual bigint")
    return rows.withColumn("passed", F.col("actual") == 1)


def layers_complete(spark: SparkSession, lake: Lake) -> DataFrame:
    """How many of the silver and gold tables exist: all three and all four are needed."""
    found = tables_exist(spark, lake.silver()).withColumn("layer", F.lit("silver tables")).unionByName(
        tables_exist(spark, lake.gold()).withColumn("layer", F.lit("gold tables"))
    )
    return found.groupBy("layer").agg(F.sum("actual").alias("actual"), F.count(F.lit(1)).alias("n")).select(
        F.col("layer").alias("check"),
        F.concat(F.lit(">= "), F.col("n")).alias("expected"),
        "actual",
        (F.col("actual") >= F.col("n")).alias("passed"),
    )
