"""Device messages and statistics, in DataFrame form and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riverglass.functions.messages import json_rows, number, string_payload
from riverglass.functions.times import FIRST_SECOND, LAST_SECOND, epoch_millis

# Numbers are read as text and cast, so that "89" and 89 both count and bad text becomes null.
DEVICE = "device string, device_type string, signal string, time string"


def device_rows(messages: DataFrame) -> DataFrame:
    """Typed rows from device messages; messages without a device type are left out."""
    parsed = json_rows(messages, string_payload(F.col("value")), DEVICE)
    return parsed.where(F.col("device_type").isNotNull()).select(
        "device", "device_type",
        number(F.col("signal")).alias("signal"),
        epoch_millis(F.col("time")).alias("ts"),
    )


def device_rows_sql(messages: DataFrame) -> DataFrame:
    """`device_rows` with SQL JSON functions; `inline` keeps the parser from being copied into the filter."""
    return messages.sparkSession.sql(f"""
        SELECT device, device_type, nullif(try_cast(signal AS double), double('NaN')) AS signal,
               timestamp_millis(CASE WHEN try_cast(time AS bigint) BETWEEN {FIRST_SECOND * 1000}
                                     AND {LAST_SECOND * 1000 + 999} THEN try_cast(time AS bigint) END) AS ts
        FROM (SELECT inline(array(from_json(cast(value AS string), '{DEVICE}'))) FROM {{messages}})
        WHERE device_type IS NOT NULL""", messages=messages)


def strong_signals(devices: DataFrame, above: float = 30.0) -> DataFrame:
    """Devices whose signal is above the limit."""
    return devices.where(F.col("signal") > above)


def strong_signals_sql(devices: DataFrame, above: float = 30.0) -> DataFrame:
    return devices.sparkSession.sql("SELECT * FROM {devices} WHERE signal > {above}", devices=devices, above=float(above))


def devices_by_type(devices: DataFrame, distinct: bool = False) -> DataFrame:
    """Rows per device type, or distinct devices, exactly: Spark counts those in two steps that spread
    one type over all tasks. For live distinct devices see `device_sketches` and `messages_by_device`."""
    amount = F.count_distinct("device") if distinct else F.count(F.lit(1))
    return devices.groupBy("device_type").agg(amount.alias("devices"))


def mean_signal_by_type(devices: DataFrame) -> DataFrame:
    return devices.groupBy("device_type").agg(F.avg("signal").alias("mean_signal"))


def devices_by_type_sql(devices: DataFrame) -> DataFrame:
    return devices.sparkSession.sql(
        "SELECT device_type, count(1) AS devices FROM {devices} GROUP BY device_type", devices=devices)


def mean_signal_by_type_sql(devices: DataFrame) -> DataFrame:
    return devices.sparkSession.sql(
        "SELECT device_type, avg(signal) AS mean_signal FROM {devices} GROUP BY device_type", devices=devices)


def device_stats(devices: DataFrame, above: float | None = 30.0) -> DataFrame:
    """Count and mean signal per type in one pass, of the strong devices or (None) of all."""
    chosen = devices if above is None else strong_signals(devices, above)
    return chosen.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("devices"), F.avg("signal").alias("mean_signal"))


def device_stats_sql(devices: DataFrame, above: float | None = 30.0) -> DataFrame:
    condition = "true" if above is None else f"signal > {float(above)}"
    return devices.sparkSession.sql(f"""
        SELECT device_type, count(1) AS devices, avg(signal) AS mean_signal
        FROM {{devices}}
        WHERE {condition}
        GROUP BY device_type""", devices=devices)


def device_sums(devices: DataFrame, above: float | None = 30.0) -> DataFrame:
    """What `device_stats` can be added up from: devices, known signals and their sum, per type."""
    chosen = devices if above is None else strong_signals(devices, above)
    return chosen.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("devices"), F.count("signal").alias("signals"),
        F.coalesce(F.sum("signal"), F.lit(0.0)).alias("signal_sum"))


def device_sums_sql(devices: DataFrame, above: float | None = 30.0) -> DataFrame:
    condition = "true" if above is None else f"signal > {float(above)}"
    return devices.sparkSession.sql(f"""
        SELECT device_type, count(1) AS devices, count(signal) AS signals, coalesce(sum(signal), 0D) AS signal_sum
        FROM {{devices}}
        WHERE {condition}
        GROUP BY device_type""", devices=devices)


def stats_of_sums(sums: DataFrame) -> DataFrame:
    """`device_stats` from sums that were added up."""
    return sums.select("device_type", "devices", F.try_divide("signal_sum", "signals").alias("mean_signal"))


def device_sketches(devices: DataFrame, log_size: int = 12) -> DataFrame:
    """One sketch of the devices of each type, of at most 2^log_size bytes or so; sketches can be merged.

    The standard error of `devices_of_sketches` is about 1.04 / 2^(log_size / 2): 1.6 percent at 12.
    """
    return devices.where(F.col("device").isNotNull()).groupBy("device_type").agg(
        F.hll_sketch_agg("device", F.lit(log_size)).alias("sketch"))


def devices_of_sketches(sketches: DataFrame) -> DataFrame:
    """About how many devices each type has."""
    return sketches.select("device_type", F.hll_sketch_estimate("sketch").alias("devices"))


def messages_by_device(devices: DataFrame) -> DataFrame:
    """Messages per type and device; a live job stores them, and the stored rows per type are the
    exact number of distinct devices."""
    return devices.groupBy("device_type", "device").agg(F.count(F.lit(1)).alias("messages"))
