"""Live device statistics from JSON messages.

The streams keep no state: a batch stores what its own rows add up to, and the tables merge that when
they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from riverglass.operators.devices import (device_rows, device_rows_sql, device_sketches, device_sums,
                                          device_sums_sql, messages_by_device, strong_signals)
from riverglass.sinks.batches import BatchSink, fan_out
from riverglass.sinks.keyed import MergedTable
from riverglass.streaming.run import batches_to, files_to


def stats_table(spark: SparkSession, path: str, **options) -> MergedTable:
    """For `live_stats`; `operators.devices.stats_of_sums` gives the statistics."""
    return MergedTable(spark, path, "device_type string, devices bigint, signals bigint, signal_sum double",
                       ["device_type"], {"devices": "sum", "signals": "sum", "signal_sum": "sum"}, **options)


def devices_table(spark: SparkSession, path: str, **options) -> MergedTable:
    """For `live_devices`: one row per device, exact."""
    return MergedTable(spark, path, "device_type string, device string, messages bigint",
                       ["device_type", "device"], {"messages": "sum"}, **options)


def sketches_table(spark: SparkSession, path: str, **options) -> MergedTable:
    """For `live_sketches`: one row per type, whatever the number of devices."""
    return MergedTable(spark, path, "device_type string, sketch binary", ["device_type"], {"sketch": "hll"}, **options)


def live_stats(messages: DataFrame, store: MergedTable, above: float | None = 30.0,
               sql: bool = False) -> DataStreamWriter:
    """Count and mean signal per type, of the strong devices or (None) of all."""
    rows, sums = (device_rows_sql, device_sums_sql) if sql else (device_rows, device_sums)
    return batches_to(rows(messages), lambda batch, batch_id: store.write(sums(batch, above), batch_id))


def live_report(messages: DataFrame, strong: MergedTable, everything: MergedTable, rows: BatchSink,
                above: float = 30.0, seen: MergedTable | None = None, sketches: MergedTable | None = None,
                more: BatchSink | None = None) -> DataStreamWriter:
    """The whole report in one query, which reads and parses the topic once.

    Statistics of the strong devices and of all, the strong devices' `rows`, and distinct devices: exact (`seen`)
    or from `sketches`. `more` gets the strong devices' sums, for printing or a database.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        sums = device_sums(batch, above)
        fan_out(strong.write, more)(sums, batch_id) if more else strong.write(sums, batch_id)
        everything.write(device_sums(batch, None), batch_id)
        rows(strong_signals(batch, above), batch_id)
        if seen is not None:
            seen.write(messages_by_device(batch), batch_id)
        if sketches is not None:
            sketches.write(device_sketches(batch), batch_id)

    return batches_to(device_rows(messages), fan_out(step))


def live_devices(messages: DataFrame, store: MergedTable) -> DataStreamWriter:
    """The devices seen so far, for exact distinct counts."""
    return batches_to(device_rows(messages),
                      lambda batch, batch_id: store.write(messages_by_device(batch), batch_id))


def live_sketches(messages: DataFrame, store: MergedTable, log_size: int = 12) -> DataStreamWriter:
    """Sketches of the devices seen so far, for approximate distinct counts of bounded size."""
    return batches_to(device_rows(messages),
                      lambda batch, batch_id: store.write(device_sketches(batch, log_size), batch_id))


def live_strong(messages: DataFrame, path: str, above: float = 30.0) -> DataStreamWriter:
    """The strong devices themselves, appended to files."""
    return files_to(strong_signals(device_rows(messages), above), path)
