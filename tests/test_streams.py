"""Streams fed by one file per batch."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from riverglass.functions import utc_wall
from riverglass.operators import windows as W
from riverglass.operators.devices import devices_by_type, devices_of_sketches, device_rows, stats_of_sums
from riverglass.plans import device_report
from riverglass.sinks import KeyedTable, MergedTable, append_to_topic, fan_out, files, messages, topic_writer
from riverglass.sources import MESSAGE, file_stream, topic_replay
from riverglass.streaming import late, toplists as LT
from riverglass.streaming.run import batches_to, console, drain, files_to, start

SCHEMA = "ts timestamp, key string"


class Feed:
    """A folder that grows by one file per batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.number = spark, str(path), 0

    def add(self, rows):
        self.number += 1
        (self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
         .write.parquet(f"{self.path}/batch={self.number:03d}"))

    def stream(self):
        return file_stream(self.spark, f"{self.path}/batch=*", SCHEMA, files_per_batch=1)


def drain_each(feed, batches, writer, checkpoint):
    """One finished query run per batch, as if the job were restarted every time."""
    for batch in batches:
        feed.add(batch)
        drain(writer(), checkpoint)


def clocks(df):
    return sorted((r.window_start.strftime("%H:%M"), r.key, r.n) for r in df.collect())


def test_late_rows(spark, tmp_path, at):
    feed, out = Feed(spark, tmp_path / "in"), str(tmp_path / "out")
    counted = lambda: files_to(W.edges(W.tumbling_counts(
        W.watermarked(feed.stream(), "ts", "10 minutes"), "5 minutes", ["key"])), out)
    drain_each(feed, [
        [(at("00:01"), "a")],
        [(at("01:00"), "a")],
        [(at("01:01"), "a")],
        [(at("00:02"), "a"), (at("00:56"), "a")],  # the first is behind the watermark of 00:50
        [(at("03:00"), "z")],
    ], counted, str(tmp_path / "checkpoint"))
    got = clocks(spark.read.parquet(out))
    assert got == [("00:00", "a", 1), ("00:55", "a", 1), ("01:00", "a", 2)]


def kept_apart(spark, feed, folder, delay="10 minutes"):
    """A run of `late.apart` over what the feed holds, with counts of five minutes."""
    store = MergedTable(spark, f"{folder}/counts", "window_start timestamp, window_end timestamp, key string, n bigint",
                        ["window_start", "window_end", "key"], {"n": "sum"})
    marks = late.marks_table(spark, f"{folder}/marks")

    def count(batch, batch_id):
        store.write(W.edges(W.tumbling_counts(batch, "5 minutes", ["key"])), batch_id)

    writer = late.apart(feed.stream(), delay, count, f"{folder}/late", marks)
    return store, marks, writer


def test_late_rows_are_kept_apart(spark, tmp_path, at):
    """Judged by the newest time of earlier batches, over restarts, and the same again after a crash."""
    feed = Feed(spark, tmp_path / "in")
    batches = [[(at("00:01"), "a")], [(at("01:00"), "a"), (at("00:30"), "a")], [(at("01:01"), "a"), (None, "n")],
               [(at("00:02"), "a"), (at("00:51"), "a"), (at("00:50"), "b")], [(at("03:00"), "z"), (at("02:00"), "y")]]
    for batch in batches:
        feed.add(batch)
        store, marks, writer = kept_apart(spark, feed, tmp_path)
        drain(writer, str(tmp_path / "checkpoint"))

    def seen():
        got = late.late_rows(spark, str(tmp_path / "late"), SCHEMA).collect()
        row = marks.current().first()
        return (sorted((r.ts.strftime("%H:%M"), r.key, r.watermark.strftime("%H:%M"), r.batch_id) for r in got),
                (row.newest.strftime("%H:%M"), row.rows, row.late), sorted(store.current().collect(), key=repr))

    once = seen()
    # 00:51 is exactly at the limit, 10 minutes before 01:01; what shares a batch with 03:00 is on time.
    assert once[:2] == ([("00:02", "a", "00:51", 3), ("00:50", "b", "00:51", 3)], ("03:00", 10, 2))
    assert sum(r.n for r in once[2]) == 7  # the row without a time has no window
    for file in ("4", ".4.crc"):
        (tmp_path / "checkpoint/commits" / file).unlink()
    drain(kept_apart(spark, feed, tmp_path)[2], str(tmp_path / "checkpoint"))
    assert seen() == once


def test_late_rows_of_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    feed.add([])
    store, marks, writer = kept_apart(spark, feed, tmp_path)
    drain(writer, str(tmp_path / "checkpoint"))
    assert late.late_rows(spark, str(tmp_path / "late"), SCHEMA).count() == store.current().count() == 0
    assert marks.current().count() <= 1


LATE = [[("00:10", "a"), ("01:10", "a"), ("01:20", "b")], [("02:30", "a"), ("01:30", "b")], [("01:40", "a"), ("02:10", "c")],
        [("03:50", "a")], [("02:50", "c"), ("03:10", "b")], [("08:00", "z")], [("09:30", "z")]]


def test_chained_windows_equal_live_counts_on_late_rows(spark, tmp_path, at):
    """Rows behind the newest, but in windows that are open: panes and copied rows count the same."""
    feed = Feed(spark, tmp_path / "in")
    keys = ["window_start", "window_end", "key"]
    copied = KeyedTable(spark, str(tmp_path / "copied"), LT.live_counts_schema("key"), keys)
    paned = KeyedTable(spark, str(tmp_path / "paned"), LT.live_counts_schema("key"), keys)
    out = str(tmp_path / "out")
    for batch in LATE:
        feed.add([(at(t), k) for t, k in batch])
        drain(LT.live_counts(feed.stream(), "3 hours", "1 hour", "key", "1 hour", copied), str(tmp_path / "c1"))
        drain(LT.live_panes(feed.stream(), "3 hours", "1 hour", "key", "1 hour", paned), str(tmp_path / "c2"))
        drain(files_to(LT.closed_counts(feed.stream(), "3 hours", "1 hour", "key", "1 hour"), out), str(tmp_path / "c3"))
    want = sorted(copied.current().collect())
    assert want and sorted(W.edges(W.windows_of_panes(paned.current(), "3 hours", "1 hour", ["key"])).select(*copied.columns).collect()) == want
    closed = sorted(spark.read.parquet(out).select(*copied.columns).collect())
    limit = at("06:30")  # 09:30 less an hour of delay and two hours that a pane waits
    assert closed == [r for r in want if r.window_end.replace(tzinfo=limit.tzinfo) <= limit] and len(closed) > 8
    everything = spark.createDataFrame([(at(t), k) for b in LATE for t, k in b], SCHEMA)
    assert want == sorted(W.edges(W.sliding_counts(everything, "3 hours", "1 hour", ["key"])).collect())


def test_panes_keep_late_rows_of_open_windows(spark, tmp_path, at):
    """A row whose pane would be closed by the delay alone still counts in the window that is open."""
    feed, keys = Feed(spark, tmp_path / "in"), ["window_start", "window_end", "key"]
    store = KeyedTable(spark, str(tmp_path / "table"), LT.live_counts_schema("key"), keys)
    live = lambda: LT.live_panes(feed.stream(), "6 hours", "1 hour", "key", "10 minutes", store)
    drain_each(feed, [[(at("01:00"), "a")], [(at("05:30"), "a")], [(at("05:31"), "a")], [(at("02:30"), "late")], [(at("05:40"), "a")]],
               live, str(tmp_path / "checkpoint"))
    counted = W.edges(W.windows_of_panes(store.current(), "6 hours", "1 hour", ["key"]))
    assert counted.where("key = 'late'").count() == 6


def test_panes_must_make_up_the_window():
    with pytest.raises(ValueError):
        LT.pane_delay("90 minutes", "1 hour", "10 minutes")


BATCHES = [["a", "a", "b"], ["b", "c", "d"], ["d", "d", "a"], ["e"]]


def batch_rows(at):
    return [[(at(f"0{i}:1{j}"), k) for j, k in enumerate(keys)] for i, keys in enumerate(BATCHES)]


def test_closed_top_over_restarts(spark, tmp_path, at):
    feed = Feed(spark, tmp_path / "in")
    store = KeyedTable(spark, str(tmp_path / "table"),
                       LT.live_counts_schema("key") + ", place int", ["window_start", "place"])
    sink = fan_out(files(str(tmp_path / "files")), store.write)
    drain_each(feed, batch_rows(at), lambda: LT.closed_top(
        feed.stream(), "2 hours", "1 hour", "key", 2, "10 minutes", sink), str(tmp_path / "checkpoint"))

    everything = spark.createDataFrame([r for b in batch_rows(at) for r in b], SCHEMA)
    ranked = W.top_per_window(W.edges(W.sliding_counts(everything, "2 hours", "1 hour", ["key"])), 2, ["key"])
    closed = ranked.where("window_end <= (timestamp'2024-01-01 03:10:00Z' - interval 10 minutes)")
    assert sorted(store.current().collect()) == sorted(closed.collect())
    assert sorted(spark.read.parquet(str(tmp_path / "files")).drop("batch_id").collect()) == sorted(closed.collect())


def test_live_top_and_replayed_batches(spark, tmp_path, at):
    feed = Feed(spark, tmp_path / "in")
    keys = ["window_start", "window_end", "key"]
    store = KeyedTable(spark, str(tmp_path / "table"), LT.live_counts_schema("key"), keys)
    live = lambda: LT.live_counts(feed.stream(), "2 hours", "1 hour", "key", "10 minutes", store)
    drain_each(feed, batch_rows(at), live, str(tmp_path / "checkpoint"))

    everything = spark.createDataFrame([r for b in batch_rows(at) for r in b], SCHEMA)
    want = sorted(W.top_per_window(
        W.edges(W.sliding_counts(everything, "2 hours", "1 hour", ["key"])), 2, ["key"]).collect())
    assert sorted(LT.live_top(store, 2, "key").collect()) == want
    # The whole input again, as a new query with the same batch ids, is refused.
    with pytest.raises(Exception, match="is written by"):
        drain(live(), str(tmp_path / "second-checkpoint"))
    assert sorted(LT.live_top(store, 2, "key").collect()) == want
    # Nor does a restart with no new input.
    drain(live(), str(tmp_path / "checkpoint"))
    assert sorted(LT.live_top(store, 2, "key").collect()) == want


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 59), st.sampled_from("ab")), min_size=1, max_size=6),
                min_size=1, max_size=3))
def test_complete_mode_equals_batch_however_split(spark, tmp_path_factory, at, batches):
    folder = tmp_path_factory.mktemp("split")
    feed = Feed(spark, folder / "in")
    rows = [[(at(f"00:{m:02d}"), k) for m, k in b] for b in batches]
    for batch in rows:
        feed.add(batch)
    store = KeyedTable(spark, str(folder / "table"), LT.live_counts_schema("key"),
                       ["window_start", "window_end", "key"])
    drain(batches_to(W.edges(W.tumbling_counts(feed.stream(), "10 minutes", ["key"])), store.write,
                     "complete"), str(folder / "checkpoint"))
    whole = spark.createDataFrame([r for b in rows for r in b], SCHEMA)
    want = W.edges(W.tumbling_counts(whole, "10 minutes", ["key"]))
    assert sorted(store.current().collect()) == sorted(want.collect())


def device_messages(spark, rows):
    df = spark.createDataFrame(rows, "device string, device_type string, signal double, time long")
    return messages(df, "device")


def test_devices_in_both_forms(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for batch in ([("d1", "route", 31.0, 1), ("d2", "db", 30.0, 2)],
                  [("d1", "route", 41.0, 3), ("d3", "db", 90.0, 4)]):
        append_to_topic(device_messages(spark, batch).coalesce(1), topic, "iotTopic")
    append_to_topic(device_messages(spark, [("d9", "other", 99.0, 1)]).coalesce(1), topic, "elsewhere")
    for sql in (False, True):
        store = device_report.stats_table(spark, str(tmp_path / f"table-{sql}"))
        stream = topic_replay(spark, topic, "iotTopic", files_per_batch=1)
        drain(device_report.live_stats(stream, store, sql=sql), str(tmp_path / f"checkpoint-{sql}"))
        assert sorted(tuple(r) for r in stats_of_sums(store.current()).collect()) == [("db", 1, 90.0), ("route", 2, 36.0)]


def test_distinct_devices_live_in_both_forms(spark, tmp_path):
    """Exact rows per device, and sketches: within three standard errors, and no larger with more devices."""
    topic = str(tmp_path / "topic")
    sizes = []
    for part in range(3):  # devices come again in later batches
        rows = [(f"d{i % 4000 + 1000 * part}", "route" if i % 4 else "db", 40.0, i) for i in range(6000)]
        append_to_topic(device_messages(spark, rows).coalesce(1), topic, "iotTopic")
        exact = device_report.devices_table(spark, str(tmp_path / "exact"))
        near = device_report.sketches_table(spark, str(tmp_path / "near"))
        for name, store, live in (("exact", exact, device_report.live_devices), ("near", near, device_report.live_sketches)):
            drain(live(topic_replay(spark, topic, "iotTopic", files_per_batch=1), store), str(tmp_path / f"checkpoint-{name}"))
        sizes.append(near.current().selectExpr("max(length(sketch))").first()[0])
    want = dict(map(tuple, devices_by_type(device_rows(spark.read.schema(MESSAGE).parquet(topic)), distinct=True).collect()))
    assert dict(map(tuple, devices_by_type(exact.current()).collect())) == want == {"route": 4500, "db": 1500}
    found = dict(map(tuple, devices_of_sketches(near.current()).collect()))
    assert all(abs(found[t] - n) <= 3 * 0.0163 * n for t, n in want.items())
    assert sizes[2] <= 4096 + 100 and near.current().count() == 2


def test_live_sums_over_three_batches_and_a_repeat(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for batch in ([("d1", "route", 31.0, 1), ("d1", "db", None, 2)], [("d2", "route", 10.0, 3)], [("d3", "route", 50.5, 4)]):
        append_to_topic(device_messages(spark, batch).coalesce(1), topic, "iotTopic")
    store = device_report.stats_table(spark, str(tmp_path / "table"))
    stream = lambda: topic_replay(spark, topic, "iotTopic", files_per_batch=1)
    drain(device_report.live_stats(stream(), store, above=None), str(tmp_path / "checkpoint"))
    want = [("db", 1, None), ("route", 3, 30.5)]
    assert sorted(tuple(r) for r in stats_of_sums(store.current()).collect()) == want
    state = tmp_path / "checkpoint/state"
    assert not state.exists()  # the query keeps none
    # The last batch is delivered again, as after a crash between the write and the commit.
    (tmp_path / "checkpoint/commits/2").unlink()
    (tmp_path / "checkpoint/commits/.2.crc").unlink()
    drain(device_report.live_stats(stream(), store, above=None), str(tmp_path / "checkpoint"))
    assert sorted(tuple(r) for r in stats_of_sums(store.current()).collect()) == want


def test_topic_round_trip(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    append_to_topic(device_messages(spark, [("d1", "route", 31.0, 1)]), source, "a")
    stream = topic_replay(spark, source, "a")
    drain(topic_writer(stream.select("key", "value"), target, "b"), str(tmp_path / "checkpoint"))
    row = spark.read.schema(MESSAGE).parquet(target).first()
    assert (bytes(row.key), row.topic) == (b"d1", "b")
    assert b'"signal":31.0' in bytes(row.value)


def test_console_and_processing_time(spark, tmp_path, at):
    feed = Feed(spark, tmp_path / "in")
    feed.add([(at("00:01"), "a")])
    query = start(console(feed.stream()), str(tmp_path / "checkpoint"), every="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_wall_clock_is_kept(spark, at):
    df = spark.createDataFrame([(at("12:34"),)], "ts timestamp")
    assert str(df.select(utc_wall(df.ts)).first()[0]) == "2024-01-01 12:34:00"
