"""Counts over tumbling and sliding event-time windows, for tables and for streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riverglass.operators.toplists import counts, top_per_group

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}


def watermarked(stream: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Rows more than `delay` behind the newest time seen may be dropped, and state that old is
    let go."""
    return stream.withWatermark(ts, delay)


def tumbling_counts(df: DataFrame, size: str, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Rows per window and key."""
    return counts(df, F.window(ts, size), *keys)


def sliding_counts(df: DataFrame, size: str, slide: str, keys: Sequence[str],
                   ts: str = "ts") -> DataFrame:
    """Rows per sliding window and key. Each row is counted in size / slide windows.

    A table is counted by panes where the size allows it. A stream keeps its state per window.
    """
    if not df.isStreaming and is_multiple(size, slide):
        return sliding_counts_by_panes(df, size, slide, keys, ts)
    return counts(df, F.window(ts, size, slide), *keys)


def is_multiple(size: str, slide: str) -> bool:
    """Whether windows are made of whole panes, for lengths such as "2 hours"."""
    def seconds(length: str) -> float:
        number, unit = length.split()
        return float(number) * SECONDS[unit.lower().rstrip("s")]

    try:
        return seconds(size) % seconds(slide) == 0
    except (KeyError, ValueError):  # another way to write an interval
        return False


def sliding_counts_by_panes(df: DataFrame, size: str, slide: str, keys: Sequence[str],
                            ts: str = "ts") -> DataFrame:
    """Sliding counts of a table from counts per slide-long pane.

    Each row is counted once, and the panes, which are far fewer than the rows, are added up in
    every window that holds them. The size must be a multiple of the slide.
    """
    panes = counts(df, F.window(ts, slide), *keys)
    return windows_of_panes(edges(panes), size, slide, keys)


def windows_of_panes(panes: DataFrame, size: str, slide: str, keys: Sequence[str]) -> DataFrame:
    """Sliding counts from tumbling counts whose windows are `slide` long."""
    spread = panes.select(F.window("window_start", size, slide).alias("window"), *keys, "n")
    return spread.groupBy("window", *keys).agg(F.sum("n").alias("n"))


def edges(df: DataFrame) -> DataFrame:
    """The `window` struct as two columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def top_per_window(df: DataFrame, n: int, ties: Sequence[str], by: str = "n") -> DataFrame:
    """The first `n` rows of each window; `df` comes from `edges`."""
    return top_per_group(df, n, ["window_start", "window_end"], by, ties)
