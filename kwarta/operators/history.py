"""Fraud rules that look at a user's earlier transactions.

A plain window per user would put all rows of a user into one task, and a sliding range frame is
re-aggregated for every row, which is quadratic for a burst. Both are avoided here:

* time is cut into slots and rows near the end of a slot are carried into the next one, so a group
  is one user *and* one slot;
* the trailing count is a running sum of +1 at a transaction and -1 when it leaves the window, which
  costs the same per row whether the user has ten transactions in the window or ten million;
* dormancy is settled on two timestamps per user and half-year, which are reduced before the shuffle.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kwarta.config import DEFAULT_RULES, Rules
from kwarta.functions import geo
from kwarta.operators import fraud

DEFAULT_SLOT = timedelta(minutes=30)

# Record kinds in the order they count at equal times: a transaction carried over from the slot
# before, a transaction, the moment after which a transaction has left the window.
_CARRIED, _ARRIVES, _LEAVES = 0, 1, 2


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _epoch(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _floor_to(value: Column, step: int) -> Column:
    return value - F.pmod(value, F.lit(step))


def slot_length(rules: Rules, slot: timedelta = DEFAULT_SLOT) -> timedelta:
    """Slots at least as long as what a rule looks back over, so only one slot is carried."""
    return max(slot, rules.velocity_window, rules.jump_window)


def recent_activity(
    rows: DataFrame,
    rules: Rules = DEFAULT_RULES,
    slot: timedelta = DEFAULT_SLOT,
    place: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Add what each user did just before each row, in one shuffle and one sort.

    * ``tx_in_window``: transactions of the user in the trailing velocity window, both ends and the
      row itself included, rows of the same instant included;
    * ``since_prev_us`` and ``km_from_prev``: time and distance from the user's previous row, if that
      lies within the jump window, else null;
    * ``slot_us``: the slot, by which (with user_id) the result is partitioned.
    """
    length = _micros(slot_length(rules, slot))
    velocity, jump = _micros(rules.velocity_window), _micros(rules.jump_window)
    look_back = max(velocity, jump)
    lat, lon = place or (F.lit(None).cast("double"), F.lit(None).cast("double"))

    at = F.col("_us")
    own_slot = _floor_to(at, length)
    next_slot = own_slot + length
    payload = F.struct(*rows.columns)
    no_payload = F.lit(None)

    def record(slot_us: Column, when: Column, kind: int, delta: Column, body: Column) -> Column:
        seen = F.when(F.lit(kind) != _LEAVES, F.struct(at.alias("us"), F.col("_lat"), F.col("_lon")))
        return F.struct(
            F.col("user_id").alias("_user"),
            slot_us.alias("slot_us"),
            when.alias("_t"),
            F.lit(kind).alias("_kind"),
            delta.alias("_delta"),
            at.alias("_at"),
            F.col("event_id").alias("_id"),
            seen.alias("_seen"),
            body.alias("_row"),
        )

    one, zero, minus = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    leaves_at = at + velocity
    records = F.array(
        record(own_slot, at, _ARRIVES, one, payload),
        record(_floor_to(leaves_at, length), leaves_at, _LEAVES, minus, no_payload),
        F.when(
            at + look_back >= next_slot,
            record(
                next_slot, next_slot, _CARRIED,
                F.when(leaves_at >= next_slot, one).otherwise(zero), no_payload,
            ),
        ),
    )
    timeline = (
        rows.withColumns({"_us": _epoch("event_timestamp"), "_lat": lat, "_lon": lon})
        .select(F.inline_outer(records))
        .filter(F.col("_kind").isNotNull())
    )

    group = Window.partitionBy("_user", "slot_us")
    before = group.orderBy("_t", "_kind", "_at", "_id").rowsBetween(Window.unboundedPreceding, -1)
    so_far = group.orderBy("_t", "_kind").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (
        timeline.withColumn("_prev", F.last("_seen", ignorenulls=True).over(before))
        .withColumn("tx_in_window", F.sum("_delta").over(so_far))
        .filter(F.col("_kind") == _ARRIVES)
    )
    gap = F.col("_at") - F.col("_prev.us")
    km = geo.haversine_km(
        F.col("_prev._lat"), F.col("_prev._lon"), F.col("_seen._lat"), F.col("_seen._lon")
    )
    near = gap <= jump
    return marked.select(
        "_row.*",
        "tx_in_window",
        F.when(near, gap).alias("since_prev_us"),
        F.when(near, km).alias("km_from_prev"),
        "slot_us",
    )


def velocity_hit(rules: Rules = DEFAULT_RULES) -> Column:
    return F.col("tx_in_window") > rules.velocity_count


def location_hit(rules: Rules = DEFAULT_RULES) -> Column:
    """False where the place of either row is unknown."""
    return F.coalesce(F.col("km_from_prev") > rules.jump_km, F.lit(False))


def stretches_of(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per user and stretch as long as the gap: the first row and the last instant."""
    return (
        rows.select("user_id", _epoch("event_timestamp").alias("us"), "event_id", "amount_php")
        .groupBy("user_id", _floor_to(F.col("us"), _micros(rules.dormant_gap)).alias("stretch"))
        .agg(
            F.min(F.struct("us", "event_id", "amount_php")).alias("first"),
            F.max("us").alias("last_us"),
        )
    )


def dormant_hits(rows: DataFrame, rules: Rules = DEFAULT_RULES, earlier: DataFrame | None = None) -> DataFrame:
    """Rows that end a user's silence: ``user_id, event_id, amount_php, event_us, prev_us``.

    Within a stretch as long as the gap no row but the first can end a silence, so each (user,
    stretch) is reduced to its first row and its last time. Only those few are put in order.
    ``earlier`` has the stretches of rows loaded before (user_id, stretch, first_us, last_us).
    """
    gap = _micros(rules.dormant_gap)
    stretches = stretches_of(rows, rules)
    if earlier is not None:
        kinds = {f.name: f.dataType for f in stretches.schema["first"].dataType.fields}
        stored = earlier.select(
            "user_id", "stretch",
            F.struct(
                F.col("first_us").alias("us"), F.lit(None).cast(kinds["event_id"]).alias("event_id"),
                F.lit(None).cast(kinds["amount_php"]).alias("amount_php"),
            ).alias("first"),
            "last_us",
        )
        stretches = stretches.unionByName(stored).groupBy("user_id", "stretch").agg(
            F.min("first").alias("first"), F.max("last_us").alias("last_us"))
    in_order = Window.partitionBy("user_id").orderBy("stretch")
    return (
        stretches.withColumn("prev_us", F.lag("last_us").over(in_order))
        .filter(
            F.col("first.event_id").isNotNull() & (F.col("first.us") - F.col("prev_us") >= gap)
            & (F.col("first.amount_php") >= rules.dormant_amount)
        )
        .select(
            "user_id",
            F.col("first.event_id").alias("event_id"),
            F.col("first.amount_php").alias("amount_php"),
            F.col("first.us").alias("event_us"),
            "prev_us",
        )
    )


def with_history(
    rows: DataFrame,
    rules: Rules = DEFAULT_RULES,
    slot: timedelta = DEFAULT_SLOT,
    place: tuple[Column, Column] | None = None,
    before: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Mark each row with ``velocity_hit``, ``location_hit`` and ``dormant_hit``.

    The dormancy marks are joined on (user, slot), by which the activity is partitioned already, so
    the large side is shuffled once in all. ``before`` has what was loaded earlier: events near these rows
    (user_id, event_id, event_timestamp, lat, lon), and stretches as in :func:`dormant_hits`.
    """
    length = slot_length(rules, slot)
    if rules.dormant_gap < length:
        raise ValueError("the dormancy gap is shorter than a slot")
    if place is None:
        place = (geo.latitude(F.col("province")), geo.longitude(F.col("province")))
    both = rows.withColumns({"_lat0": place[0], "_lon0": place[1], "_own": F.lit(True)})
    if before is not None:
        near = before[0].select(
            "user_id", "event_id", F.col("event_timestamp").cast(rows.schema["event_timestamp"].dataType).alias("event_timestamp"),
            F.col("lat").alias("_lat0"), F.col("lon").alias("_lon0"), F.lit(False).alias("_own"))
        both = both.unionByName(near, allowMissingColumns=True)
    active = recent_activity(both, rules, slot, (F.col("_lat0"), F.col("_lon0"))).filter("_own").drop("_lat0", "_lon0", "_own")
    dormant = dormant_hits(rows, rules, None if before is None else before[1]).select(
        F.col("user_id").alias("_user"),
        _floor_to(F.col("event_us"), _micros(length)).alias("_slot"),
        F.col("event_id").alias("_woken_by"),
    )
    joined = active.join(
        dormant,
        (F.col("user_id") == F.col("_user")) & (F.col("slot_us") == F.col("_slot")),
        "left",
    )
    return joined.withColumns(
        {
            "velocity_hit": velocity_hit(rules),
            "location_hit": location_hit(rules),
            "dormant_hit": F.coalesce(F.col("event_id") == F.col("_woken_by"), F.lit(False)),
        }
    ).drop("_user", "_slot", "_woken_by", "slot_us", "tx_in_window", "since_prev_us", "km_from_prev")


def past_reason() -> Column:
    """Velocity, location and dormancy, each only where none before it has hit."""
    return (
        F.when(F.col("velocity_hit"), "VELOCITY_SPIKE")
        .when(F.col("location_hit"), "LOCATION_JUMP")
        .when(F.col("dormant_hit"), "DORMANT_REACTIVATION")
    )


def full_reason(rules: Rules = DEFAULT_RULES) -> Column:
    """Row-local rules first; then those on the user's past."""
    return F.coalesce(fraud.static_reason(rules), past_reason())


def score_with_history(
    rows: DataFrame,
    rules: Rules = DEFAULT_RULES,
    slot: timedelta = DEFAULT_SLOT,
    place: tuple[Column, Column] | None = None,
    before: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Valid rows scored by all six rules."""
    marked = with_history(rows, rules, slot, place, before)
    return fraud.with_reason(marked, full_reason(rules), rules).drop(
        "velocity_hit", "location_hit", "dormant_hit"
    )


def history_hits(
    rows: DataFrame, rules: Rules = DEFAULT_RULES, before: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Rows, one per event, that a rule on the user's past hits and no row-local one: ``event_id, past_reason``.

    Only what the rules look at goes through the timeline.
    """
    looked_at = rows.select("user_id", "event_id", "event_timestamp", "amount_php", "is_international", "province")
    marked = with_history(looked_at, rules, before=before).filter(fraud.static_reason(rules).isNull())
    return marked.select("event_id", past_reason().alias("past_reason")).filter("past_reason IS NOT NULL")


def score_with_hits(rows: DataFrame, hits: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Valid rows, one per event, scored by all six rules, given their :func:`history_hits`."""
    told = hits.select(F.col("event_id").alias("_hit"), "past_reason")
    joined = rows.join(told, F.col("event_id") == F.col("_hit"), "left")
    reason = F.coalesce(fraud.static_reason(rules), F.col("past_reason"))
    return fraud.with_reason(joined, reason, rules).drop("_hit", "past_reason")
