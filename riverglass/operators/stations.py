"""Cleaning of base-station call messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riverglass.functions.messages import json_rows, string_payload

STATION = ("station_id string, call_out string, call_in string, status string, "
           "call_time string, duration string")
REQUIRED = ("station_id", "call_out", "call_in")
STATUSES = ("success", "fail", "busy", "barring")


def station_rows(messages: DataFrame) -> DataFrame:
    """Typed rows from station messages; a field that cannot be read is null."""
    parsed = json_rows(messages, string_payload(F.col("value")), STATION)
    return parsed.select(
        *(F.trim(c).alias(c) for c in REQUIRED),
        F.lower(F.trim("status")).alias("status"),
        F.try_to_timestamp("call_time").alias("call_time"),
        F.col("duration").try_cast("long").alias("duration"),
    )


def complete_calls(required: Sequence[str] = REQUIRED,
                   statuses: Sequence[str] = STATUSES) -> Column:
    """The default rule: required fields filled, a known status, a time, no negative duration."""
    rule = F.col("status").isin(*statuses) & F.col("call_time").isNotNull() & (F.col("duration") >= 0)
    for name in required:
        rule = rule & F.col(name).isNotNull() & (F.col(name) != "")
    return rule


def clean(rows: DataFrame, rule: Column | None = None) -> DataFrame:
    """The rows that meet the rule; a rule that gives null counts as not met."""
    return rows.where(complete_calls() if rule is None else rule)
