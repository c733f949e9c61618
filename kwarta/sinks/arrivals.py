"""When loads stored their rows, and on which days: a zone map by time of arrival.

Facts and alerts lie by the day of their event, so what arrived last may lie anywhere. Every load leaves a note before
it stores: its time, how many alerts it may raise, and the days of its events. Questions about the newest alerts
or arrivals read the newest notes and then only the partitions these name.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import SparkSession

from kwarta.config import Lake
from kwarta.sinks import tables


@dataclass(frozen=True)
class Arrival:
    """A load's note: microseconds since the epoch, alerts at most, and the days of its events."""

    micros: int
    alerts: int
    days: tuple[date, ...]


def note(spark: SparkSession, lake: Lake, load: str, alerts: int, days: Iterable[date]) -> None:
    """Leave a load's note. It comes before the rows, so none of them is older than their note."""
    micros = time.time_ns() // 1000
    folder = datetime.fromtimestamp(micros / 1e6, UTC).date().isoformat()
    text = json.dumps(sorted(d.isoformat() for d in days))
    tables.put_text(spark, f"{lake.arrivals}/{folder}/{micros:020d}.{alerts}.{load}", text)


def newest(spark: SparkSession, lake: Lake, since: datetime | None = None, with_alerts: bool = False) -> Iterator[Arrival]:
    """Notes, newest first, a day's folder at a time; those before `since` (UTC) are not looked at."""
    least = 0 if since is None else int(since.replace(tzinfo=since.tzinfo or UTC).timestamp() * 1e6)
    for day in sorted(tables.names_in(spark, lake.arrivals), reverse=True):
        if since is not None and date.fromisoformat(day) < since.date():
            return
        for name in sorted((n for n in tables.names_in(spark, f"{lake.arrivals}/{day}") if not n.endswith(".draft")), reverse=True):
            micros, alerts = map(int, name.split(".")[:2])
            if micros < least:
                return
            if alerts or not with_alerts:
                days = json.loads(tables.text_of(spark, f"{lake.arrivals}/{day}/{name}"))
                yield Arrival(micros, alerts, tuple(map(date.fromisoformat, days)))
