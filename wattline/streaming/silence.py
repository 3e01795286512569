"""Devices that fall silent: event-time sessions that end when nothing follows in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def silence_alarms(
    rows: DataFrame, device: str, time: str, value: str, *, after_seconds: int, lateness: str
) -> DataFrame:
    """A row per time a device fell silent: ``device, last_seen, alarm_time, last_value``.

    A device is silent from the message that none of it follows within ``after_seconds``; a message exactly that much
    later still follows. The alarm carries that message's time and ``value`` (the greatest text of several at one time)
    and is sent once the watermark, the latest time seen less ``lateness``, has passed ``alarm_time``; so messages out
    of order within the lateness raise none. Messages that follow each other in time are one session, of which the state
    keeps the span and the last message; a silent device has none.
    Rows without a device or a time are left out. The session needs idle batches (``stateful_session``).
    """
    watched = (
        rows.where(F.col(device).isNotNull() & F.col(time).isNotNull())
        .withWatermark(time, lateness)
        .select(
            F.col(device).alias("device"),
            F.col(time).alias("event_time"),
            F.col(value).cast("string").alias("last_value"),
        )
    )
    # A session ends before its end, and a message exactly ``after_seconds`` later still belongs to it.
    session = F.session_window("event_time", f"{after_seconds} seconds 1 microsecond")
    last = F.max(F.struct("event_time", "last_value")).alias("last")
    alarms = watched.groupBy("device", session.alias("session")).agg(last)
    return alarms.select(
        "device",
        F.col("last.event_time").alias("last_seen"),
        (F.col("last.event_time") + F.make_dt_interval(secs=F.lit(after_seconds))).alias("alarm_time"),
        F.col("last.last_value").alias("last_value"),
    )
