"""Energy use from device telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.numbers import day_of, minute_of
from gridmill.operators.rules import in_time


def readings(direct: DataFrame, battery: DataFrame, first: Column, last: Column) -> DataFrame:
    """Power of both sources while current flows, filtered before they are put together."""
    d = in_time(direct, "event_time", first, last, "motor_current").select("device_id", "event_time", (F.col("motor_current") * F.col("panel_voltage")).alias("power"), F.lit("Direct").alias("source"))
    b = in_time(battery, "event_time", first, last, "output_current").select("device_id", "event_time", (F.col("output_current") * F.col("output_voltage")).alias("power"), F.lit("Battery").alias("source"))
    return d.unionByName(b)


def usage(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Minutes with power and mean power per device, day and source."""
    minutes = F.approx_count_distinct(minute_of(F.col("event_time"))) if approximate else F.count_distinct(minute_of(F.col("event_time")))
    return rows.groupBy("device_id", day_of(F.col("event_time")).alias("usage_date"), "source").agg(minutes.alias("minutes"), F.avg("power").alias("avg_power"))


def energy(direct: DataFrame, battery: DataFrame, first: Column, last: Column, devices: Column) -> DataFrame:
    used = usage(readings(direct, battery, first, last)).where(devices)
    kwh = F.round(F.col("avg_power") * F.col("minutes") / 60.0 / 1000.0, 3)
    return used.select("usage_date", F.col("device_id").alias("meter_id"), "source", F.col("minutes").alias("time_interval_minutes"), kwh.alias("energy_kwh"))
