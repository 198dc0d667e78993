"""Batch sinks for `foreachBatch`, the keyed table, the version registry and topics."""

from riverglass.sinks.batches import connector, fan_out, files, jdbc, show
from riverglass.sinks.keyed import BatchTable, KeyedTable, MergedTable, OtherWriter
from riverglass.sinks.registry import Registry
from riverglass.sinks.topics import append_to_topic, kafka_writer, messages, topic_writer

__all__ = ["BatchTable", "KeyedTable", "MergedTable", "OtherWriter", "Registry", "append_to_topic", "connector", "fan_out", "files", "jdbc",
           "kafka_writer", "messages", "show", "topic_writer"]
