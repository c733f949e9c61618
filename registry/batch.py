"""Every query by name: ``(spark, folder of the test tables) -> DataFrame``."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta import schemas
from kwarta.config import Lake
from kwarta.operators import fraud, history
from kwarta.operators.keyed import first_per_key
from kwarta.operators.merge import merge_rows
from kwarta.plans import load, marts, quality, reports, silver
from kwarta.session import work_folder
from kwarta.sinks import tables
from kwarta.sources import files
from kwarta.streaming import job, windows
from registry import fixture as fx

NIGHTLY = date(2024, 1, 15)
AUDIT = ["created_at", "updated_at", "registration_date", "onboarding_date", "resolved_at"]


def plain(df: DataFrame) -> DataFrame:
    """Without wall-clock columns, and with instants as zone-less timestamps like the test tables'."""
    kept = df.drop(*AUDIT)
    stamps = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in kept.schema.fields if f.dataType.typeName() == "timestamp"
    }
    return kept.withColumns(stamps) if stamps else kept


# --- bronze to silver ---------------------------------------------------------------------------


def bronze_parse(spark: SparkSession, sf: str) -> DataFrame:
    """All payload fields. The amount is compared as a number: its text depends on the JSON writer."""
    parsed = silver.parse(fx.read_payloads(spark, sf), fx.EXTRA_FIELDS).drop("payload")
    return parsed.withColumn("amount_php", F.col("amount_php").cast("decimal(14,2)"))


def dirty_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """All payloads, of which eight in sixteen are damaged, each in its own way."""
    rows = fx.bronze(spark, sf, spread=True).drop("geo_key").withColumn("event_no", F.col("event_id").cast("bigint"))
    sent = silver.publish(rows, also=("event_no",))
    text, number = F.col("value"), F.col("event_no").cast("string")
    damage = [
        F.regexp_replace(text, '"amount_php":', '"amount_php":-'),
        F.regexp_replace(text, '"amount_php":[0-9.]+', '"amount_php":"x"'),
        F.regexp_replace(text, '"event_timestamp":"[^"]+"', '"event_timestamp":"yesterday"'),
        F.regexp_replace(text, '"user_id":', '"who":'),
        F.regexp_replace(text, '"transaction_type":', '"what":'),
        F.regexp_replace(text, '"event_id":', '"which":'),
        F.concat(F.lit("not json, event_no "), number),
        F.concat(F.lit("["), text, F.lit("]")),
    ]
    broken = F
    for kind, as_sent in enumerate(damage, start=1):
        broken = broken.when(F.pmod("event_no", F.lit(16)) == kind, as_sent)
    damaged = sent.select(broken.otherwise(text).alias("value"))
    return files.read_payloads(spark, fx.landed(damaged))


def _dirty_cleansed(spark: SparkSession, sf: str) -> DataFrame:
    return silver.cleanse(silver.parse(dirty_payloads(spark, sf), fx.EXTRA_FIELDS))


def cleanse_valid(spark: SparkSession, sf: str) -> DataFrame:
    return plain(silver.valid(_dirty_cleansed(spark, sf)))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    number = F.regexp_extract("payload", r"event_no\D+(\d+)", 1).cast("bigint")
    return silver.quarantined(_dirty_cleansed(spark, sf)).select(
        number.alias("event_no"), "reject_reason"
    )


def pii_hash(spark: SparkSession, sf: str) -> DataFrame:
    return fx.typed(spark, sf).select("event_id", "phone_hash", "ip_hash")


# --- fraud rules --------------------------------------------------------------------------------


def fraud_static(spark: SparkSession, sf: str) -> DataFrame:
    return fx.scored(spark, sf).select("event_id", "fraud_score", "fraud_reason", "fraud_flag")


def fraud_band(spark: SparkSession, sf: str) -> DataFrame:
    return (
        fx.scored(spark, sf)
        .groupBy(fraud.band().alias("band"))
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount_php").alias("volume"))
    )


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    return fraud.alerts(fx.scored(spark, sf), F.col("processing_timestamp"))


def fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts(spark, sf).drop("alert_id", "created_at", "resolved_at", "investigated_by", "notes")


def rolling_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.typed(spark, sf).select("event_id", "user_id", "event_timestamp")
    return history.recent_activity(rows, fx.SPARSE_RULES).select("event_id", "user_id", "tx_in_window")


def velocity_spike(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.typed(spark, sf).select("event_id", "user_id", "event_timestamp")
    active = history.recent_activity(rows, fx.SPARSE_RULES)
    return active.filter(history.velocity_hit(fx.SPARSE_RULES)).select(
        "event_id", "user_id", "event_timestamp", "tx_in_window"
    )


def location_jump(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.typed(spark, sf).select("event_id", "user_id", "event_timestamp", "province", "geo_key")
    active = history.recent_activity(rows, fx.SPARSE_RULES, place=fx.place())
    return active.filter(history.location_hit(fx.SPARSE_RULES)).select(
        "event_id", "user_id", "event_timestamp", "province", "since_prev_us",
        F.round("km_from_prev").cast("bigint").alias("km_from_prev"),
    )


def dormant(spark: SparkSession, sf: str) -> DataFrame:
    hits = history.dormant_hits(fx.typed(spark, sf), fx.SPARSE_RULES)
    return hits.select("event_id", "user_id", "amount_php", "event_us", "prev_us")


def fraud_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.typed(spark, sf).select(
        "event_id", "user_id", "event_timestamp", "amount_php", "is_international", "geo_key"
    )
    return history.score_with_history(rows, fx.SPARSE_RULES, place=fx.place()).select(
        "event_id", "fraud_score", "fraud_reason", "fraud_flag"
    )


# --- loads --------------------------------------------------------------------------------------


def _before_and_after(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = fx.typed(spark, sf)
    cut = F.lit(fx.STORED_BEFORE.isoformat(sep=" ")).cast("timestamp_ntz")
    return rows.filter(F.col("event_timestamp") < cut), rows.filter(F.col("event_timestamp") >= cut)


def new_users_anti(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _before_and_after(spark, sf)
    return plain(load.new_users(incoming, stored.select("user_id").distinct()))


def new_merchants_anti(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = _before_and_after(spark, sf)
    known = stored.filter("merchant_id IS NOT NULL").select("merchant_id").distinct()
    return plain(load.new_merchants(incoming, known))


def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.typed(spark, sf).select(
        "user_id", "event_id", "event_timestamp", "amount_php", "province", "city"
    )
    return first_per_key(rows, ["user_id"], ["event_timestamp", "event_id"])


def _stored_dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    known = fx.typed(spark, sf).filter("merchant_name IS NOT NULL AND merchant_id IS NOT NULL")
    return known.select("user_id").distinct(), known.select("merchant_id").distinct()


def facts_load(spark: SparkSession, sf: str) -> DataFrame:
    return load.facts(fx.scored(spark, sf), *_stored_dims(spark, sf))


def facts_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return load.fact_orphans(fx.scored(spark, sf), *_stored_dims(spark, sf)).select(
        "transaction_id", "user_id", "merchant_id", "amount_php", "orphan_reason"
    )


def load_replay(spark: SparkSession, sf: str) -> DataFrame:
    """All payloads loaded into stored tables, twice; then the fact table as it was written."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    sent = fx.read_payloads(spark, sf)
    for _ in range(2):
        load.load_batch(sent, lake, "all", extra=fx.EXTRA_FIELDS)
    return plain(tables.read(spark, lake.facts))


def load_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """All payloads loaded; then all again with their date moved by a day, alone and among all as first sent."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    sent = fx.read_payloads(spark, sf)
    text = F.get_json_object("value", "$.event_timestamp")
    later = F.date_format(text.cast("timestamp") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    moved = sent.withColumn("value", F.replace("value", text, later))
    for load_id, rows in (("all", sent), ("alone", moved), ("among", moved.union(sent))):
        load.load_batch(rows, lake, load_id, extra=fx.EXTRA_FIELDS)
    return plain(tables.read(spark, lake.facts))


def stored_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts as stored after the same load has run twice."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    sent = fx.read_payloads(spark, sf)
    for _ in range(2):
        load.load_batch(sent, lake, "all", extra=fx.EXTRA_FIELDS)
    return plain(tables.read(spark, lake.alerts)).drop("alert_id", "investigated_by", "notes")


def alert_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The stored alerts of two loads of the same payloads: one id each, and the same id again."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    sent = fx.read_payloads(spark, sf)
    for load_id in ("one", "two"):
        load.load_batch(sent, lake, load_id, extra=fx.EXTRA_FIELDS)
    stored = tables.read(spark, lake.alerts).select("alert_id", "transaction_id")
    again = fraud.alerts(fx.scored(spark, sf)).select("alert_id", "transaction_id", F.lit(True).alias("same"))
    return stored.join(again, ["alert_id", "transaction_id"], "left").agg(
        F.count("alert_id").alias("alerts"), F.countDistinct("alert_id").alias("ids"),
        F.count_if(F.col("alert_id").isNull()).alias("without_id"), F.count("same").alias("recomputed"))


def quarantine_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in quarantine after a load of damaged payloads, and after the same load with repaired ones."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    out = []
    for step, sent in (("damaged", dirty_payloads(spark, sf)), ("repaired", fx.read_payloads(spark, sf))):
        load.load_batch(sent.select("value"), lake, "one", extra=fx.EXTRA_FIELDS)
        rows = tables.read(spark, lake.quarantine)
        out.append((step, rows.count()))
    return spark.createDataFrame(out, "step string, rejected bigint")


def _history_alerts(spark: SparkSession, lake: Lake) -> DataFrame:
    return tables.read(spark, lake.alerts).select("transaction_id", "user_id", "alert_type", "fraud_score")


def _two_loads(spark: SparkSession, sent: DataFrame) -> DataFrame:
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    cut, at = F.lit("2024-01-15").cast("timestamp"), F.get_json_object("value", "$.event_timestamp").cast("timestamp")
    for load_id, part in (("one", sent.filter(at < cut)), ("two", sent.filter(at >= cut))):
        load.load_batch(part, lake, load_id, fx.SPARSE_RULES, history=True, extra=fx.EXTRA_FIELDS)
    return _history_alerts(spark, lake)


def history_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of all rules, the events loaded in two parts."""
    return _two_loads(spark, fx.read_payloads(spark, sf))


def location_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """The same with events in known provinces, whose distances the engine looks up."""
    sent = silver.publish(fx.located(fx.bronze(spark, sf, spread=True)).drop("geo_key"))
    return _two_loads(spark, files.read_payloads(spark, fx.landed(sent)))


def quarantine_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in quarantine after micro-batches that run twice: one that arrived three days ago, one whose rows bring
    times of their own, or none."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    sent = dirty_payloads(spark, sf).select("value")
    ago = F.current_timestamp() - F.expr("INTERVAL 3 DAYS")
    out = []
    for batch, cleansed in (("ago", silver.cleanse(silver.parse(sent), ago)), ("own", silver.cleanse(silver.parse(sent, fx.EXTRA_FIELDS)))):
        for run in (1, 2):
            job.load_micro_batch(cleansed, f"q-{batch}", lake)
            stored = tables.read(spark, lake.quarantine).groupBy("load_id").agg(F.count(F.lit(1)).alias("n"))
            out += [(batch, run, r.load_id, r.n) for r in stored.collect()]
    return spark.createDataFrame(out, "batch string, run int, load_id string, rejected bigint")


def facts_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table written in date partitions, and counted by partition when read again."""
    path = Lake(work_folder(spark, "facts")).facts
    tables.append(tables.conform(fx.facts(spark, sf), schemas.FACTS), path, "event_date")
    return (
        tables.read(spark, path).groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount_php").alias("volume"))
    )


# --- marts --------------------------------------------------------------------------------------


def mart_user_daily(spark: SparkSession, sf: str) -> DataFrame:
    return plain(marts.user_daily(fx.facts(spark, sf), fx.merchants(spark, sf), fx.MART_AS_OF))


def mart_user_daily_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Thirty days of the user mart in one job."""
    end = datetime(2024, 1, 31)
    return plain(marts.user_daily(fx.facts(spark, sf), fx.merchants(spark, sf), end, days=30))


def mart_merchant_daily(spark: SparkSession, sf: str) -> DataFrame:
    return plain(marts.merchant_daily(fx.facts(spark, sf), fx.MART_AS_OF))


def mart_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return plain(marts.hourly(fx.facts(spark, sf), fx.MART_AS_OF))


def marts_after_late_load(spark: SparkSession, sf: str) -> DataFrame:
    """The merchant mart of all days, built as far as facts were there, then refreshed after late ones have come."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    late = F.col("event_id").cast("bigint") % 9 == 4
    for load_id, part in (("first", ~late), ("late", late)):
        load.load_batch(fx.read_payloads(spark, sf, part), lake, load_id, extra=fx.EXTRA_FIELDS)
        marts.refresh(lake, spark, datetime(2024, 2, 1))
    return plain(tables.read(spark, lake.merchant_daily))


def customers_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of each merchant over all days, from daily sketches, and whether that is within 3 % of the true count."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    facts = fx.facts(spark, sf)
    marts.build_customers(lake, facts, [d for (d,) in facts.select("event_date").distinct().collect()])
    about = marts.approximate_customers(tables.read(spark, lake.customers))
    exact = facts.groupBy("merchant_id").agg(F.countDistinct("user_id").alias("exact"))
    close = F.abs(F.col("customers") - F.col("exact")) <= F.col("exact") * 0.03
    return exact.join(about, "merchant_id", "left").select("merchant_id", "exact", F.coalesce(close, F.lit(False)).alias("within"))


def mart_merchant_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The merchant mart as two nightly builds of the same day leave it."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    load.load_batch(fx.read_payloads(spark, sf), lake, "all", extra=fx.EXTRA_FIELDS)
    for _ in range(2):
        marts.build_all(lake, spark, fx.MART_AS_OF)
    return plain(tables.read(spark, lake.merchant_daily).filter(F.col("analysis_date") == F.lit(NIGHTLY)))


def merchant_growth(spark: SparkSession, sf: str) -> DataFrame:
    return marts.merchant_growth(fx.facts(spark, sf))


def _facts_until(spark: SparkSession, sf: str, moment: datetime) -> DataFrame:
    cut = F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return fx.facts(spark, sf).filter(F.col("event_timestamp") < cut)


def merge_user_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as it stood at noon and the day before, with the whole day merged into it."""
    merchants = fx.merchants(spark, sf)
    stored = marts.user_daily(_facts_until(spark, sf, fx.REPORT_AS_OF), merchants, fx.MART_AS_OF, days=2)
    fresh = marts.user_daily(fx.facts(spark, sf), merchants, fx.MART_AS_OF)
    return plain(merge_rows(stored, fresh, ["user_id", "spend_date"]))


def merge_merchant_mart(spark: SparkSession, sf: str) -> DataFrame:
    """As above, replacing counts and volume only: channel counts keep their noon values."""
    stored = marts.merchant_daily(_facts_until(spark, sf, fx.REPORT_AS_OF), fx.MART_AS_OF)
    fresh = marts.merchant_daily(fx.facts(spark, sf), fx.MART_AS_OF)
    return plain(
        merge_rows(
            stored, fresh, ["merchant_id", "analysis_date"],
            ["transaction_count", "total_volume_php", "avg_ticket_php", "unique_customers",
             "success_rate", "fraud_incidents"],
        )
    )


def merge_hourly_mart(spark: SparkSession, sf: str) -> DataFrame:
    stored = marts.hourly(_facts_until(spark, sf, fx.REPORT_AS_OF + timedelta(minutes=30)), fx.MART_AS_OF)
    fresh = marts.hourly(fx.facts(spark, sf), fx.MART_AS_OF)
    return plain(
        merge_rows(
            stored, fresh, ["window_hour"],
            ["transaction_count", "total_volume_php", "success_rate", "fraud_rate"],
        )
    )


def alert_triage(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the highest rule are dismissed, then confirmed; the others stay open."""
    alerts = _alerts(spark, sf)
    highest, resolved = alerts.filter("fraud_score >= 85"), F.col("created_at").cast("timestamp")
    first = highest.select(
        "alert_id", F.lit("DISMISSED").alias("status"), F.lit("night shift").alias("investigated_by"),
        F.lit("at first sight").alias("notes"), (resolved - F.expr("INTERVAL 1 HOUR")).alias("resolved_at"),
    )
    last = highest.select(
        "alert_id",
        F.lit("CONFIRMED").alias("status"),
        F.concat(F.lit("analyst of "), "province").alias("investigated_by"),
        F.col("transaction_id").alias("notes"),
        resolved.alias("resolved_at"),
    )
    decisions = first.union(last)
    return marts.decided(alerts, decisions).select(
        "transaction_id", "alert_type", "status", "investigated_by", "notes"
    )


# --- reports ------------------------------------------------------------------------------------


def report_realtime(spark: SparkSession, sf: str) -> DataFrame:
    return reports.realtime_stats(fx.facts(spark, sf), fx.REPORT_AS_OF)


def report_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.hourly_velocity(fx.facts(spark, sf), fx.REPORT_AS_OF))


def report_alerts(spark: SparkSession, sf: str) -> DataFrame:
    shown = reports.fraud_alerts(_alerts(spark, sf), fx.users(spark, sf), fx.merchants(spark, sf))
    return shown.drop("alert_id")


def report_open_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.open_alerts(_alerts(spark, sf)).drop("alert_id")


def report_category(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_breakdown(fx.facts(spark, sf), fx.merchants(spark, sf), fx.REPORT_AS_OF)


def report_province(spark: SparkSession, sf: str) -> DataFrame:
    return reports.provincial_heatmap(fx.facts(spark, sf), fx.REPORT_AS_OF)


def report_top_merchants(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_merchants(fx.facts(spark, sf), fx.merchants(spark, sf), fx.REPORT_AS_OF)


def report_channel(spark: SparkSession, sf: str) -> DataFrame:
    return reports.channel_distribution(fx.facts(spark, sf), fx.REPORT_AS_OF)


def report_live_feed(spark: SparkSession, sf: str) -> DataFrame:
    return reports.live_transactions(fx.facts(spark, sf), fx.users(spark, sf), fx.merchants(spark, sf))


def report_live_fraud(spark: SparkSession, sf: str) -> DataFrame:
    return reports.live_transactions(
        fx.facts(spark, sf), fx.users(spark, sf), fx.merchants(spark, sf), fraud_only=True
    )


# --- data quality -------------------------------------------------------------------------------


def dq_constraints(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.scored(spark, sf).withColumnRenamed("event_id", "transaction_id")
    columns = [*schemas.NOT_NULL["fact_transactions"], "merchant_id", "channel"]
    return quality.constraints(rows, columns, ["amount_php"])


def dq_pk_unique(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.facts(spark, sf)
    return quality.unique_key(rows, ["transaction_id"]).unionByName(
        quality.unique_key(rows, ["user_id", "merchant_id"])
    )


def dq_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated_keys(fx.facts(spark, sf), ["user_id", "merchant_id"])


def dq_fk(spark: SparkSession, sf: str) -> DataFrame:
    stored, _ = _before_and_after(spark, sf)
    return quality.references(
        fx.facts(spark, sf),
        {
            "user_id": stored.select("user_id").distinct(),
            "merchant_id": stored.select("merchant_id").distinct(),
        },
    )


def dq_length(spark: SparkSession, sf: str) -> DataFrame:
    limits = schemas.MAX_LENGTH["fact_transactions"]
    return quality.lengths(fx.facts(spark, sf), {**limits, "transaction_type": 7, "province": 8})


def dq_completeness(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["event_id", "user_id", "merchant_id", "merchant_name", "province", "channel"]
    return quality.completeness(fx.typed(spark, sf), columns)


def dq_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Constraints, lengths and completeness of the stored facts from daily profiles, of which the last days are not
    stored yet."""
    lake = Lake(work_folder(spark, "lake"))
    load.create_tables(spark, lake)
    load.load_batch(fx.read_payloads(spark, sf), lake, "all", extra=fx.EXTRA_FIELDS)
    marts.refresh(lake, spark, datetime(2024, 1, 21))
    found, actual = quality.profiled(lake, spark), F.col("actual").cast("decimal(24,4)").alias("actual")
    limits = schemas.MAX_LENGTH["fact_transactions"]
    checks = quality.profile_checks(found, schemas.NOT_NULL["fact_transactions"], ["amount_php"], limits)
    filled = quality.profile_completeness(found, ["user_id", "merchant_id", "province", "channel"])
    return checks.withColumn("actual", actual).unionByName(filled.withColumn("actual", actual))


def dq_mart_counts(spark: SparkSession, sf: str) -> DataFrame:
    facts, merchants = fx.facts(spark, sf), fx.merchants(spark, sf)
    return quality.mart_counts(
        marts.user_daily(facts, merchants, fx.MART_AS_OF),
        marts.merchant_daily(facts, fx.MART_AS_OF),
        marts.hourly(facts, fx.MART_AS_OF),
        fx.MART_AS_OF,
    )


def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.freshness(fx.facts(spark, sf), fx.REPORT_AS_OF, timedelta(hours=1))


def dq_topic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return quality.has_messages(fx.read_payloads(spark, sf))


def dq_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables that a load and a nightly build of the events leave behind."""
    lake = Lake(work_folder(spark, "tables"))
    load.create_tables(spark, lake)
    sent = fx.read_payloads(spark, sf)
    load.load_batch(sent, lake, "all", extra=fx.EXTRA_FIELDS)
    marts.build_all(lake, spark, fx.MART_AS_OF)
    return quality.tables_exist(spark, lake.silver() + lake.gold()).unionByName(
        quality.layers_complete(spark, lake)
    )


# --- streams ------------------------------------------------------------------------------------


def _run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what there is, into a written table."""
    spark, folder = stream.sparkSession, work_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def stream_facts(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "silver")
    lake = Lake(folder)
    load.create_tables(spark, lake)
    job.start(
        fx.stream_payloads(spark, sf), lake, f"{folder}/checkpoint",
        interval=None, extra=fx.EXTRA_FIELDS,
    ).awaitTermination()
    return plain(tables.read(spark, lake.facts))


def _streamed_history(spark: SparkSession, sf: str, places: bool) -> DataFrame:
    folder = work_folder(spark, "silver")
    lake = Lake(folder)
    load.create_tables(spark, lake)
    cuts = [datetime(2024, 1, day) for day in (7, 13, 19, 25)]
    raw = files.stream_payloads(spark, fx.landed_in_order(spark, sf, cuts, places), files_per_trigger=fx.SPAN_FILES)
    job.start(
        raw, lake, f"{folder}/checkpoint", fx.SPARSE_RULES, history=True, interval=None, extra=fx.EXTRA_FIELDS,
    ).awaitTermination()
    return _history_alerts(spark, lake)


def stream_history(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of all rules, the events streamed in five micro-batches."""
    return _streamed_history(spark, sf, places=False)


def stream_location(spark: SparkSession, sf: str) -> DataFrame:
    """The same with events in known provinces."""
    return _streamed_history(spark, sf, places=True)


def stream_hourly_window(spark: SparkSession, sf: str) -> DataFrame:
    return plain(_run_to_table(windows.hourly_metrics(fx.scored_stream(spark, sf)), "hourly"))


def stream_hourly_live(spark: SparkSession, sf: str) -> DataFrame:
    """The stored hourly mart as a stream of five micro-batches keeps it, open hours included."""
    folder = work_folder(spark, "live")
    lake = Lake(folder)
    load.create_tables(spark, lake)
    cuts = [datetime(2024, 1, day) for day in (7, 13, 19, 25)]
    raw = files.stream_payloads(spark, fx.landed_in_order(spark, sf, cuts), files_per_trigger=fx.SPAN_FILES)
    scored = silver.score(silver.valid(silver.cleanse(silver.parse(raw, fx.EXTRA_FIELDS))))
    windows.start_live_hours(scored, lake, f"{folder}/checkpoint", interval=None).awaitTermination()
    return plain(tables.read(spark, lake.hourly)).drop("window_date")


def stream_velocity_window(spark: SparkSession, sf: str) -> DataFrame:
    spikes = windows.velocity_windows(fx.scored_stream(spark, sf), 2, "6 hours", "1 hour")
    return plain(_run_to_table(spikes, "velocity"))


def stream_unique_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every payload delivered twice, and each event kept once."""
    twice = fx.scored_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = windows.unique_events(twice).select("event_id", "user_id", "event_timestamp", "amount_php")
    return plain(_run_to_table(once, "unique"))


QUERIES = {
    f.__name__: f
    for f in (
        bronze_parse, cleanse_valid, quarantine, pii_hash,
        fraud_static, fraud_band, fraud_alerts,
        rolling_count, velocity_spike, location_jump, dormant, fraud_history,
        new_users_anti, new_merchants_anti, dedupe_first, facts_load, facts_orphans,
        load_replay, load_redelivery, stored_alerts, alert_ids, quarantine_reload, quarantine_replay, history_two_loads,
        location_two_loads, facts_by_partition,
        mart_user_daily, mart_user_daily_backfill, mart_merchant_daily, mart_merchant_stored, mart_hourly,
        marts_after_late_load, customers_approximate,
        merchant_growth, merge_user_mart, merge_merchant_mart, merge_hourly_mart, alert_triage,
        report_realtime, report_hourly, report_alerts, report_open_alerts, report_category,
        report_province, report_top_merchants, report_channel, report_live_feed, report_live_fraud,
        dq_constraints, dq_pk_unique, dq_repeated_keys, dq_fk, dq_length, dq_completeness, dq_profiles,
        dq_mart_counts, dq_freshness, dq_topic_sample, dq_tables,
        stream_facts, stream_history, stream_location, stream_hourly_window, stream_hourly_live, stream_velocity_window, stream_unique_events,
    )
}
