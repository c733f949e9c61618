"""Loading scored rows into the star schema and the alert mart.

Every load is keyed, so running one again for the same rows adds nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, timedelta
from hashlib import sha256

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kwarta import schemas
from kwarta.config import DEFAULT_RULES, NEW_USER_KYC, NEW_USER_STATUS, Lake, Rules
from kwarta.functions import geo
from kwarta.operators import fraud
from kwarta.operators.history import history_hits, score_with_history, score_with_hits, stretches_of
from kwarta.operators.keyed import first_per_key, lookup, missing_from, present_in
from kwarta.plans import silver
from kwarta.session import even_splits
from kwarta.sinks import arrivals, segments, tables

# The fact table's columns besides its key and date.
FACT_COLUMNS = [
    "event_timestamp", "user_id", "merchant_id", "transaction_type", "amount_php", "channel",
    "province", "city", "is_international", "device_id", "ip_hash", "fraud_score", "fraud_flag",
    "fraud_reason", "status", "processing_timestamp",
]

_EARLIEST = ["event_timestamp", "event_id"]
_EPOCH = date(1970, 1, 1)


def new_users(
    scored: DataFrame,
    stored: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Users met for the first time, described by their earliest row. Stored users never change."""
    stamp = F.current_timestamp() if now is None else now
    first = _first_seen(
        scored, "user_id", ["phone_hash", "user_name", "province", "city"], stored
    )
    return first.select(
        "user_id",
        "phone_hash",
        F.col("user_name").alias("full_name"),
        F.col("province").alias("home_province"),
        F.col("city").alias("home_city"),
        F.lit(NEW_USER_KYC).alias("kyc_level"),
        F.lit(NEW_USER_STATUS).alias("account_status"),
        F.to_date(stamp).alias("registration_date"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def new_merchants(
    scored: DataFrame,
    stored: DataFrame | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Merchants met for the first time, described by their earliest row."""
    stamp = F.current_timestamp() if now is None else now
    first = _first_seen(
        scored, "merchant_id", ["merchant_name", "merchant_category", "province", "city"],
        stored,
    )
    return first.select(
        "merchant_id",
        "merchant_name",
        F.col("merchant_category").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        "province",
        "city",
        F.lit(False).alias("is_partner"),
        F.to_date(stamp).alias("onboarding_date"),
        F.lit(0).cast("smallint").alias("risk_score"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def _first_seen(scored: DataFrame, key: str, columns: list[str], stored: DataFrame | None) -> DataFrame:
    rows = scored.filter(F.col(key).isNotNull()).select(key, *columns, *_EARLIEST)
    first = first_per_key(rows, [key], _EARLIEST)
    return first if stored is None else missing_from(first, stored, [key])


def as_facts(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("event_id").alias("transaction_id"),
        *FACT_COLUMNS,
        F.to_date("event_timestamp").alias("event_date"),
    )


def facts(scored: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Rows whose user and merchant are both stored. A row without a merchant is not a fact."""
    known = present_in(as_facts(scored), users, ["user_id"])
    return present_in(known, merchants, ["merchant_id"])


def fact_orphans(scored: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """The valid rows :func:`facts` leaves out, each with the reason. One pass over the rows."""
    found = F.lit(True)
    marked = lookup(as_facts(scored), users, "user_id", [found.alias("_user")])
    marked = lookup(marked, merchants, "merchant_id", [found.alias("_merchant")])
    reason = (
        F.when(F.col("merchant_id").isNull(), "NO_MERCHANT")
        .when(F.col("_user").isNull(), "UNKNOWN_USER")
        .when(F.col("_merchant").isNull(), "UNKNOWN_MERCHANT")
    )
    return (
        marked.withColumn("orphan_reason", reason)
        .filter(F.col("orphan_reason").isNotNull())
        .drop("_user", "_merchant")
    )


def _same_days(stored: DataFrame, rows: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """The stored rows of the days that ``rows`` span."""
    first, last = rows.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return stored.filter(F.col("event_date").between(F.lit(first), F.lit(last)))


#: Rows of a load whose keys are searched for as a list; a larger load is joined with all stored keys.
LISTED = 50_000
#: Hits of the history rules that every task is told; more are met by a shuffle.
TOLD = 500_000


def keys_in(rows: DataFrame, columns: tuple[str, ...] = ("event_id", "user_id", "merchant_id")) -> dict[str, list[int]] | None:
    """The hashes of a small load's keys, by column. None for a load of more than LISTED rows."""
    if rows.count() > LISTED:  # a limit would send as many rows of every task to a single one before it knew
        return None
    hashes = [F.when(F.col(c).isNotNull(), segments.hash_of(c)).alias(c) for c in columns]
    found = rows.select(F.struct(*hashes).alias("k")).agg(F.collect_list("k")).first()[0]
    return {c: sorted({r[c] for r in found} - {None}) for c in columns}


def _stored(rows: DataFrame, path: str, column: str, keys: dict[str, list[int]] | None, rare: bool = False) -> DataFrame:
    """What a keyed table holds of the rows' keys. `rare`: most are not stored, so their hashes are looked for first."""
    spark, key = rows.sparkSession, segments.kind_of(path).key
    if keys is None:
        return segments.read(spark, path).join(rows.select(F.col(column).alias(key)), key, "left_semi")
    hashes = segments.known_hashes(spark, path, keys[column]) if rare else keys[column]
    return segments.lookup(spark, path, hashes)


def _known(rows: DataFrame, lake: Lake, keys: dict[str, list[int]] | None) -> DataFrame:
    return _stored(rows, lake.event_keys, "event_id", keys, rare=True).select(
        F.col("transaction_id").alias("_known"), F.col("event_date").alias("_date"), F.col("load_id").alias("_load"))


def judged(rows: DataFrame, lake: Lake, load_id: str) -> DataFrame:
    """Per id of a large load: how many rows have it, and ``gone``: another load has brought it, so that none of them is
    new. The first of an id's rows has its least date, so that date and the stored keys tell. No whole row is shuffled."""
    mine = rows.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("event_timestamp")).alias("_day"))
    own = F.coalesce((F.col("_load") == load_id) & (F.col("_date") == F.col("_day")), F.lit(False))
    seen = mine.join(_known(rows, lake, None), F.col("event_id") == F.col("_known"), "left")
    return seen.groupBy("event_id").agg(
        F.max("n").alias("n"), F.max(F.col("_known").isNotNull() & ~own).alias("gone"))


def irregular(rows: DataFrame, lake: Lake, load_id: str) -> DataFrame:
    """Ids that several rows have, or that another load has brought: all that :func:`unseen` must look at in a large load."""
    return judged(rows, lake, load_id).filter((F.col("n") > 1) | F.col("gone")).select("event_id")


def fresh_rows(rows: DataFrame, lake: Lake, load_id: str, stage: str) -> DataFrame | None:
    """What :func:`unseen` finds in a large load; ``rows`` themselves if that is all, and None if it is nothing.

    Rows of ids that another load has brought are left out by one join, and none is read where all ids are such. Only rows
    of ids that several new ones share are compared whole.
    """
    told = Observation()
    ids = judged(rows, lake, load_id).observe(told, F.count(F.lit(1)).alias("ids"))
    odd = _staged(ids.filter((F.col("n") > 1) | F.col("gone")), f"{stage}/irregular")
    gone, several = odd.agg(F.count_if("gone"), F.count_if(~F.col("gone"))).first()
    if gone == told.get["ids"]:
        return None
    if gone:
        rows = rows.join(odd.filter("gone").select("event_id"), "event_id", "left_anti")
    return unseen(rows, lake, load_id, among=odd.filter(~F.col("gone")).select("event_id")) if several else rows


def unseen(
    rows: DataFrame, lake: Lake, load_id: str, keys: dict[str, list[int]] | None = None, among: DataFrame | None = None,
) -> DataFrame:
    """One row per event, and none that another load has brought, on whatever day.

    What this very load has stored under the same date is kept: the load is then being repeated, after a
    crash perhaps, and the later steps find what is stored already. ``among`` has the :func:`irregular` ids, if these
    are known: rows of other ids pass as they are.
    """
    some = rows if among is None else rows.join(among, "event_id", "left_semi")
    told = [c for c in rows.columns if c != "fraud_reason"]  # a stream keeps the same row of several as a batch does
    unique = first_per_key(some, ["event_id"], ["event_timestamp", F.xxhash64(*told)])
    own = (F.col("_load") == load_id) & (F.col("_date") == F.to_date("event_timestamp"))
    new = unique.join(_known(some, lake, keys), (F.col("event_id") == F.col("_known")) & ~own, "left_anti")
    return new if among is None else rows.join(among, "event_id", "left_anti").unionByName(new)


def earlier(
    rows: DataFrame, lake: Lake, load_id: str, rules: Rules = DEFAULT_RULES, keys: dict[str, list[int]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What other loads have stored of these rows' users: events as far back as a rule looks, and stretches."""
    spark, users = rows.sparkSession, rows.select("user_id").distinct()
    back = max(rules.velocity_window, rules.jump_window) // timedelta(microseconds=1)
    at = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    start, end = F.timestamp_micros(F.min(at) - back), F.timestamp_micros(F.max(at))
    first, last, first_day, last_day = rows.agg(
        F.unix_micros(start), F.unix_micros(end), F.to_date(start), F.to_date(end)).first()
    others = ~F.col("load_id").eqNullSafe(F.lit(load_id))  # folded stretches name no load
    events = tables.read(spark, lake.activity).filter(others)
    if first is None:
        events = events.filter("false")
    else:
        events = events.filter(
            F.col("event_date").between(F.lit(first_day), F.lit(last_day))
            & F.col("event_timestamp").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))))
    stretches = _stored(users, lake.stretches, "user_id", keys).filter(others)
    if keys is not None:  # found by their hashes, which other users may share
        stretches = stretches.join(users, "user_id", "left_semi")
    return events.join(users, "user_id", "left_semi"), stretches


def create_tables(spark: SparkSession, lake: Lake) -> None:
    """Create whichever of the tables are not there yet."""
    for path in (lake.users, lake.merchants, lake.decisions):
        tables.create(spark, path)
    for path in lake.segmented():
        segments.create(spark, path)
    for path in (lake.facts, lake.alerts, lake.activity):
        tables.create(spark, path, "event_date")
    tables.create(spark, lake.quarantine, "load_group", "arrival_date")
    tables.create(spark, lake.user_daily, "spend_date")
    tables.create(spark, lake.merchant_daily, "analysis_date")
    tables.create(spark, lake.hourly, "window_date")
    tables.create(spark, lake.customers, "analysis_date")
    tables.create(spark, lake.profiles, "event_date")


def together(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run steps that do not wait for each other at the same time: small writes take longer to plan than to run."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def load_dimension(
    scored: DataFrame, lake: Lake, load_id: str, key: str, keys: dict[str, list[int]] | None = None, again: bool = False,
) -> None:
    """Store the users or merchants that no load has met. Their keys come first: the repeated load knows its own,
    and looks in the dimension itself for what it has stored."""
    spark = scored.sparkSession
    path, keyed, build, schema = {
        "user_id": (lake.users, lake.user_keys, new_users, schemas.USERS),
        "merchant_id": (lake.merchants, lake.merchant_keys, new_merchants, schemas.MERCHANTS),
    }[key]
    if not tables.exists(spark, path):
        return
    known = _stored(scored, keyed, key, keys).filter(F.col("load_id") != load_id)
    new = build(scored, known)
    if again:
        new = missing_from(new, tables.read(spark, path), [key])
    stage, few = lake.table(f"_stage/{uuid.uuid4().hex}"), keys is not None
    if few:
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
    else:  # a cached frame keeps a task and a file per shuffle partition, however few its rows
        new = _staged(new, stage)
    try:
        if segments.append(new.select(key, F.lit(load_id).alias("load_id")), keyed, load_group(load_id), few):
            tables.conform(new, schema).write.mode("append").parquet(path)
    finally:
        new.unpersist()
        tables.remove(spark, stage)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    """Rows written once and read from there."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def touch(spark: SparkSession, lake: Lake, days: Iterable[date], load_id: str) -> None:
    """Note the days whose facts a load is about to change, for the marts that stand on them."""
    for day in days:
        tables.put_text(spark, f"{lake.touched}/{day.isoformat()}/{load_group(load_id)}", load_id)


def _append_missing(rows: DataFrame, path: str, stored: DataFrame, keys: list[str]) -> None:
    """Add the rows whose key is not stored. Keys alone are compared; whole rows are read only where some are missing."""
    missing = missing_from(rows.select(*keys), stored, keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not missing.isEmpty():
            tables.append(rows.join(missing, keys, "left_semi").select(*rows.columns), path, "event_date")
    finally:
        missing.unpersist()


def load_facts(scored: DataFrame, lake: Lake, again: bool = False) -> None:
    """Rows with a merchant. Their users and merchants have just been stored with the same rows.

    ``again``: the load is repeated, so what it has stored is looked for on the days it spans.
    """
    spark = scored.sparkSession
    if not all(tables.exists(spark, t) for t in lake.silver()):
        return
    rows = as_facts(scored).filter("merchant_id IS NOT NULL")
    rows = tables.conform(rows, schemas.FACTS)
    if again:
        _append_missing(rows, lake.facts, _same_days(tables.read(spark, lake.facts), scored), ["transaction_id"])
    else:
        tables.append(rows, lake.facts, "event_date")


def load_alerts(scored: DataFrame, lake: Lake, again: bool = False) -> None:
    spark = scored.sparkSession
    if not tables.exists(spark, lake.alerts):
        return
    rows = tables.conform(fraud.alerts(scored), schemas.ALERTS)
    if again:
        _append_missing(rows, lake.alerts, _same_days(tables.read(spark, lake.alerts), scored), ["transaction_id", "alert_type"])
    else:
        tables.append(rows, lake.alerts, "event_date")


STREAMED = "stream"


def load_group(load_id: str) -> str:
    """Folder name of what belongs to a load alone."""
    return f"{re.sub('[^A-Za-z0-9_.-]', '_', load_id)}-{sha256(load_id.encode()).hexdigest()[:8]}"


def begin(spark: SparkSession, lake: Lake, load_id: str) -> bool:
    """Mark a load as begun. Back comes whether it had begun before, so that this is a repetition."""
    mark = lake.load_mark(load_group(load_id), "begun")
    if tables.is_there(spark, mark):
        return True
    tables.put_text(spark, mark, load_id)
    return False


def finish(spark: SparkSession, lake: Lake, load_id: str) -> None:
    """Mark a load as done: what it stored may be folded with what others stored."""
    tables.put_text(spark, lake.load_mark(load_group(load_id), "done"), load_id)


def fold(spark: SparkSession, lake: Lake) -> None:
    """Fold the keyed tables' segments where enough have come together. Every load does it before it begins."""
    for path in lake.segmented():
        if segments.is_due(spark, path):
            segments.fold(spark, path, lambda load: tables.is_there(spark, lake.load_mark(load, "done")))


@dataclass(frozen=True)
class Counts:
    """Rows of a load: new valid events, those of them that a rule flagged, and rejected payloads."""

    accepted: int = 0
    flagged: int = 0
    rejected: int = 0


def load_quarantine(rejected: DataFrame, lake: Lake, load_id: str, streamed: bool = False, again: bool = True) -> int:
    """Store rejected rows of a load. Loading it again replaces them, on whatever day and by however many.

    A batch has a folder of its own, which is removed first; a crash in between is repaired by running the
    load again. Micro-batches share a folder per day. A repeated one is skipped if any of its rows is there,
    whatever their days: rows without a time of their own arrive on the day they are read. The rows of one
    load are committed together, so none is missing then.
    """
    spark = rejected.sparkSession
    group = STREAMED if streamed else load_group(load_id)
    seen = Observation()
    rows = rejected.withColumns({"load_id": F.lit(load_id), "load_group": F.lit(group)})
    if streamed:
        if again and not tables.read(spark, lake.quarantine).filter((F.col("load_group") == group) & (F.col("load_id") == load_id)).isEmpty():
            return 0
    else:
        tables.remove(spark, f"{lake.quarantine}/load_group={group}")
    counted = tables.conform(rows, schemas.QUARANTINE).observe(seen, F.count(F.lit(1)).alias("rejected"))
    counted.write.mode("append").partitionBy("load_group", "arrival_date").parquet(lake.quarantine)
    return seen.get.get("rejected", 0)


def remember(
    scored: DataFrame, lake: Lake, load_id: str, rules: Rules = DEFAULT_RULES, history: bool = False, few: bool = False,
) -> None:
    """Store the keys of a load's events, and with ``history`` what later loads look back on.

    This comes before the facts: after a crash in between, the repeated load knows its own keys.
    """
    spark = scored.sparkSession
    day, mine, load = F.to_date("event_timestamp").alias("event_date"), F.lit(load_id).alias("load_id"), load_group(load_id)
    keys = scored.select(F.col("event_id").alias("transaction_id"), day, mine)
    steps = [lambda: segments.append(keys, lake.event_keys, load, few)]
    if history:
        where = (geo.latitude(F.col("province")).alias("lat"), geo.longitude(F.col("province")).alias("lon"))
        events = tables.conform(scored.select("user_id", "event_id", "event_timestamp", *where, mine, day), schemas.ACTIVITY)
        stretches = stretches_of(scored, rules).select("user_id", "stretch", F.col("first.us").alias("first_us"), "last_us", mine)
        steps += [
            lambda: tables.append(events, lake.activity, "event_date"),
            lambda: segments.append(stretches, lake.stretches, load, few),
        ]
    together(spark, *steps)


def load_rows(
    rows: DataFrame, lake: Lake, load_id: str, rules: Rules = DEFAULT_RULES, history: bool = False, again: bool | None = None,
    reasoned: bool = False,
) -> Counts:
    """Score a load's valid rows and store what follows from them. Loading it again changes nothing.

    ``rows`` is read several times: pass a cached micro-batch or a written table. With ``history`` the rules on
    a user's past see what all earlier loads with ``history`` brought; rows stored before, or delivered
    twice, do not count as activity. Keys and dimensions come before facts and alerts. ``again`` tells whether
    this load had begun before; by default that is looked up. ``reasoned``: the rows have been through
    :func:`silver.reasoned`, which is for loads without ``history``.
    """
    spark = rows.sparkSession
    if not tables.exists(spark, lake.event_keys):
        return Counts()
    if again is None:
        again = begin(spark, lake, load_id)
    fold(spark, lake)
    keys = keys_in(rows)
    if keys is not None and not keys["event_id"]:
        return Counts()
    stage = lake.table(f"_stage/{uuid.uuid4().hex}")
    fresh, changed = rows, True
    try:
        if keys is not None:
            fresh = unseen(rows, lake, load_id, keys)
        else:
            fresh = fresh_rows(rows, lake, load_id, stage)
            if fresh is None:
                return Counts()
            changed = fresh is not rows
        if not history:  # fresh rows are read once, by the write below, or are the rows themselves
            scored = fraud.with_reason(fresh, F.col("fraud_reason"), rules) if reasoned else silver.score(fresh, rules)
        elif keys is not None:
            fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
            scored = score_with_history(fresh, rules, before=earlier(fresh, lake, load_id, rules, keys))
        else:
            if changed:
                fresh = _staged(fresh, f"{stage}/fresh")
            hits = _staged(history_hits(fresh, rules, before=earlier(fresh, lake, load_id, rules)), f"{stage}/hits")
            scored = score_with_hits(fresh, hits.hint("broadcast" if hits.count() <= TOLD else "shuffle_hash"), rules)
        told = [
            F.count(F.lit(1)).alias("accepted"), F.count_if("fraud_flag").alias("flagged"),
            F.collect_set(F.unix_date(F.to_date("event_timestamp"))).alias("days"),
        ]
        seen, steps = {}, [
            lambda: remember(scored, lake, load_id, rules, history, few=keys is not None),
            lambda: load_dimension(scored, lake, load_id, "user_id", keys, again),
            lambda: load_dimension(scored, lake, load_id, "merchant_id", keys, again),
        ]
        if changed or history:
            # Written, not cached: appending to a table would have every cached plan that reads it computed again.
            observed, schema = Observation(), scored.schema
            scored.observe(observed, *told).write.parquet(f"{stage}/scored")
            scored, seen = spark.read.schema(schema).parquet(f"{stage}/scored"), observed.get
            if not seen["accepted"]:
                return Counts()
        else:  # the rows are there already, more than LISTED, and the rules look at single ones
            steps.append(lambda: seen.update(scored.agg(*told).first().asDict()))
        if fresh is not rows:
            fresh.unpersist()
        together(spark, *steps)
        counts = Counts(seen["accepted"], seen["flagged"])
        days = [_EPOCH + timedelta(days=n) for n in seen["days"]]
        touch(spark, lake, days, load_id)
        arrivals.note(spark, lake, load_group(load_id), counts.flagged, days)
        together(spark, lambda: load_facts(scored, lake, again), lambda: load_alerts(scored, lake, again))
        return counts
    finally:
        if fresh is not None and fresh is not rows:
            fresh.unpersist()
        tables.remove(spark, stage)


def load_batch(
    raw: DataFrame,
    lake: Lake,
    load_id: str,
    rules: Rules = DEFAULT_RULES,
    history: bool = False,
    extra: tuple[str, ...] = (),
    stage: str | None = None,
) -> Counts:
    """Load raw payloads of any volume in one go, with all rules or only the row-local ones.

    The parsed rows are written once, to ``stage`` (default: a new folder below the lake), loaded from there,
    and removed: the JSON is parsed once, and a lost executor costs a file read, not the lineage. Good rows
    are staged without their payload.
    """
    spark = raw.sparkSession
    stage = stage or lake.table(f"_stage/{uuid.uuid4().hex}")
    cleansed = silver.lean(silver.cleanse(silver.parse(raw, extra)))
    even_splits(spark)
    cleansed.write.parquet(stage)
    try:
        staged = spark.read.schema(cleansed.schema).parquet(stage)
        counts = load_rows(silver.valid(staged), lake, load_id, rules, history)
        rejected = load_quarantine(silver.quarantined(staged), lake, load_id)
        finish(spark, lake, load_id)
        return replace(counts, rejected=rejected)
    finally:
        tables.remove(spark, stage)
