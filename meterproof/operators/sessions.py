"""Meter events to one row per charging session."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterproof.functions.columns import METER_PATH


def session_lifecycle(events: DataFrame) -> DataFrame:
    """First start, last end and the readings that belong to those two events.

    One shuffle on (run, session); every aggregate keeps a fixed-size state, so
    map-side combining absorbs a session that owns a large share of the events.
    """
    reading = F.get_json_object("payload", METER_PATH).try_cast("bigint")
    event = F.struct("event_time", "sequence_number", reading.alias("meter_wh"))
    timed = F.col("event_time").isNotNull()
    started, ended = (F.col("event_type") == kind for kind in ("Started", "Ended"))
    return (
        events.groupBy(F.col("transaction_id").alias("session_id"), "run_id")
        .agg(
            F.min(F.when(started & timed, event)).alias("first"),
            F.max(F.when(ended & timed, event)).alias("last"),
            F.bool_or(ended).alias("has_end"),
        )
        .select(
            "run_id",
            "session_id",
            F.col("first.event_time").alias("started_at"),
            F.col("last.event_time").alias("ended_at"),
            F.col("first.meter_wh").alias("meter_start_wh"),
            F.col("last.meter_wh").alias("meter_end_wh"),
            F.when(F.col("has_end"), "Completed").otherwise("In Progress").alias("status"),
        )
    )
