"""Column functions: text, times and messages."""

from riverglass.functions.messages import json_rows, json_text, number, parse_json, string_payload
from riverglass.functions.text import segment_words, segments, term_costs, words
from riverglass.functions.times import day_time, epoch_millis, epoch_seconds, period, utc_wall

__all__ = ["day_time", "epoch_millis", "epoch_seconds", "json_rows", "json_text", "number",
           "parse_json", "period", "segment_words", "segments", "string_payload", "term_costs",
           "utc_wall", "words"]
