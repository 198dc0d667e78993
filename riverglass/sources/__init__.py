"""Batch tables, streams, topics and stored results."""

from riverglass.sources.batch import (RATINGS, SEARCH_LOG, dictionary, ratings, search_log, spread,
                                      table, wrap_search_log)
from riverglass.sources.stored import jdbc_by_predicates, jdbc_by_range, latest, newest
from riverglass.sources.streams import MESSAGE, file_stream, kafka_stream, message_columns, topic_replay

__all__ = ["MESSAGE", "RATINGS", "SEARCH_LOG", "dictionary", "file_stream", "jdbc_by_predicates",
           "jdbc_by_range", "kafka_stream", "latest", "message_columns", "newest", "ratings", "search_log",
           "spread", "table", "topic_replay", "wrap_search_log"]
