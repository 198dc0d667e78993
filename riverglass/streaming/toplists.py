"""Top lists of sliding windows over a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from riverglass.operators.windows import (edges, is_multiple, sliding_counts, top_per_window,
                                          tumbling_counts, watermarked, windows_of_panes)
from riverglass.sinks.keyed import KeyedTable
from riverglass.streaming.run import batches_to

BatchSink = Callable[[DataFrame, int], None]


def closed_top(stream: DataFrame, size: str, slide: str, key: str, n: int, delay: str,
               sink: BatchSink, ts: str = "ts") -> DataStreamWriter:
    """The first `n` keys of each window, once, when the watermark has passed the window's end.

    In append mode all keys of a window arrive in one micro-batch, so ranking that batch is exact
    and needs no second state.
    """
    counted = edges(sliding_counts(watermarked(stream, ts, delay), size, slide, [key], ts))

    def rank(batch: DataFrame, batch_id: int) -> None:
        sink(top_per_window(batch, n, [key]), batch_id)

    return batches_to(counted, rank)


def live_counts(stream: DataFrame, size: str, slide: str, key: str, delay: str,
                store: KeyedTable, ts: str = "ts") -> DataStreamWriter:
    """Store the changed counts of every batch, of open windows too; `live_top` ranks them."""
    counted = edges(sliding_counts(watermarked(stream, ts, delay), size, slide, [key], ts))
    return batches_to(counted, store.write, "update")


def live_top(store: KeyedTable, n: int, key: str) -> DataFrame:
    """The first `n` keys of each window by the counts stored so far."""
    return top_per_window(store.current(), n, [key])


def pane_delay(size: str, slide: str, delay: str) -> str:
    """How long a pane has to wait so that it is open as long as the last window that holds it."""
    if not is_multiple(size, slide):
        raise ValueError(f"windows of {size} are not made of panes of {slide}")
    number, unit = slide.split()
    return f"{delay} {size} -{number} {unit}"


def live_panes(stream: DataFrame, size: str, slide: str, key: str, delay: str, store: KeyedTable,
               ts: str = "ts") -> DataStreamWriter:
    """Store counts per `slide`-long pane; `live_top_of_panes` adds them up to sliding windows.

    State and stored rows do not grow with size / slide, as they do in `live_counts`. A pane stays open
    until its last window closes, so no late row of an open window is lost; one that comes that late is counted
    in all windows of its pane, also in those that closed before.
    """
    counted = edges(tumbling_counts(watermarked(stream, ts, pane_delay(size, slide, delay)), slide, [key], ts))
    return batches_to(counted, store.write, "update")


def closed_counts(stream: DataFrame, size: str, slide: str, key: str, delay: str, ts: str = "ts") -> DataFrame:
    """Counts of closed sliding windows by two chained aggregates, for append mode.

    Rows are counted once, in their pane; closed panes go on, by their time, into the windows that hold
    them. A row is not copied into size / slide windows, and state is one count per pane and key, and per window and key
    of panes that closed. A pane waits as in `live_panes`, so a window comes size - slide later than from
    `closed_top`, with the late rows of that time.
    """
    panes = tumbling_counts(watermarked(stream, ts, pane_delay(size, slide, delay)), slide, [key], ts)
    window = F.window(F.window_time("window"), size, slide).alias("window")
    return edges(panes.groupBy(window, key).agg(F.sum("n").alias("n")))


def closed_top_of_panes(stream: DataFrame, size: str, slide: str, key: str, n: int, delay: str,
                        sink: BatchSink, ts: str = "ts") -> DataStreamWriter:
    """`closed_top` from `closed_counts`."""
    def rank(batch: DataFrame, batch_id: int) -> None:
        sink(top_per_window(batch, n, [key]), batch_id)

    return batches_to(closed_counts(stream, size, slide, key, delay, ts), rank)


def live_top_of_panes(store: KeyedTable, size: str, slide: str, n: int, key: str) -> DataFrame:
    """The first `n` keys of each sliding window by the pane counts stored so far."""
    return top_per_window(edges(windows_of_panes(store.current(), size, slide, [key])), n, [key])


def live_counts_schema(key: str) -> str:
    return f"window_start timestamp, window_end timestamp, {key} string, n bigint"
