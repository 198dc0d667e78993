from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riverglass.sinks import KeyedTable, MergedTable, OtherWriter, Registry, keyed
from riverglass.sources import file_stream, latest, newest
from riverglass.streaming.run import batches_to, drain

SCHEMA = "key string, value double"


def table(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["key"], **options)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_newest_batch_wins(spark, tmp_path, rows):
    store = table(spark, tmp_path)
    assert rows(store.current()) == []
    store.write(batch(spark, ("a", 1.0), ("b", 1.0), (None, 1.0)), 0)
    store.write(batch(spark, ("c", 1.0)), 1)
    store.write(batch(spark, ("a", 3.0), (None, 2.0)), 2)
    store.write(batch(spark, ("a", 3.0), (None, 2.0)), 2)
    assert rows(store.current()) == [("a", 3.0), ("b", 1.0), ("c", 1.0), (None, 2.0)]
    assert store.history().count() == 6


def test_a_second_delivery_replaces_the_first(spark, tmp_path, rows):
    store = table(spark, tmp_path)
    store.write(batch(spark, ("a", 1.0), ("b", 1.0)), 0)
    store.write(batch(spark, ("a", 2.0)), 0)
    assert rows(store.current()) == [("a", 2.0)]


@pytest.mark.parametrize("span", [1, 3, 100])
def test_compaction_changes_nothing_visible(spark, tmp_path, rows, monkeypatch, span):
    monkeypatch.setattr(keyed, "SPAN", span)
    store = table(spark, tmp_path)
    for number in range(4):
        store.write(batch(spark, ("a", float(number)), (f"k{number}", 0.0)), number)
    before = rows(store.current())
    store.compact(1)
    assert rows(store.current()) == before
    store.compact(2)
    store.compact(2)
    store.compact(0)
    assert rows(store.current()) == before
    store.write(batch(spark, ("a", 9.0)), 4)
    assert ("a", 9.0) in rows(store.current())
    # A new reader of the same path sees the same.
    assert rows(table(spark, tmp_path).current()) == rows(store.current())


def test_readers_list_nothing_before_the_base(spark, tmp_path, rows, monkeypatch):
    """Spans that a base covers are not touched: here they hold files that cannot be read."""
    monkeypatch.setattr(keyed, "SPAN", 2)
    store = table(spark, tmp_path)
    for number in range(6):
        store.write(batch(spark, ("a", float(number))), number)
    store.compact(3)
    for old in (0, 1):
        for file in (tmp_path / f"table/generation=0/span={old}").rglob("*.parquet"):
            file.write_bytes(b"no parquet")
            crc = file.parent / f".{file.name}.crc"
            crc.write_bytes(b"crc\0")
    seen = []
    given = store._span
    monkeypatch.setattr(store, "_span", lambda g, s: (seen.append(s), given(g, s))[1])
    assert rows(store.current()) == [("a", 5.0)]
    assert seen == [2, 3]


def fed(spark, tmp_path, *batches):
    for number, rows in enumerate(batches):
        batch(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/batch={number}"))


def run(spark, tmp_path, store, checkpoint):
    stream = file_stream(spark, str(tmp_path / "in/batch=*"), SCHEMA, files_per_batch=1)
    drain(batches_to(stream, store.write), str(tmp_path / checkpoint))


def test_a_new_checkpoint_is_refused(spark, tmp_path, rows):
    fed(spark, tmp_path, [("a", 1.0)], [("a", 2.0)])
    store = table(spark, tmp_path)
    run(spark, tmp_path, store, "checkpoint")
    before = rows(store.current())
    run(spark, tmp_path, store, "checkpoint")  # a restart with the same checkpoint goes on
    with pytest.raises(Exception, match="is written by"):
        run(spark, tmp_path, table(spark, tmp_path), "another")
    with pytest.raises(OtherWriter):
        store.write(batch(spark, ("a", 9.0)), 0)
    assert rows(store.current()) == before == [("a", 2.0)]


def test_a_new_checkpoint_starts_a_generation(spark, tmp_path, rows):
    fed(spark, tmp_path, [("a", 1.0)], [("a", 2.0)], [("old", 7.0)])
    run(spark, tmp_path, table(spark, tmp_path), "checkpoint")
    fed(spark, tmp_path, [("a", 3.0)])
    next_ = table(spark, tmp_path, on_new_query="generation")
    # Batch 0 of the new query is newer than batch 2 of the old one, and keys it doesn't bring stay.
    next_.write(batch(spark, ("a", 4.0)), 0)
    assert rows(next_.current()) == [("a", 4.0), ("old", 7.0)]
    assert rows(table(spark, tmp_path).current()) == rows(next_.current())
    # The first query is shut out now, whatever its table's setting.
    with pytest.raises(Exception, match="is written by"):
        run(spark, tmp_path, table(spark, tmp_path, on_new_query="generation"), "checkpoint")


def test_a_table_may_begin_at_a_later_batch(spark, tmp_path, rows):
    store = table(spark, tmp_path)
    store.write(batch(spark, ("a", 1.0)), 1234)
    store.write(batch(spark, ("a", 2.0)), 1235)
    assert rows(store.current()) == [("a", 2.0)]


def sums(spark, tmp_path, **options):
    schema = "key string, n long, first timestamp, last timestamp, sketch binary"
    return MergedTable(spark, str(tmp_path / "sums"), schema, ["key"],
                       {"n": "sum", "first": "min", "last": "max", "sketch": "hll"}, **options)


def share(spark, *rows):
    """Partial results of (key, hour, who)."""
    df = spark.createDataFrame([(k, datetime(2024, 1, 1, h), w) for k, h, w in rows], "key string, ts timestamp, who string")
    return df.groupBy("key").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"),
                                 F.hll_sketch_agg("who").alias("sketch"))


def shown(store):
    got = store.current().select("key", "n", F.hour("first"), F.hour("last"), F.hll_sketch_estimate("sketch"))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_sums_are_merged_and_redelivery_changes_nothing(spark, tmp_path):
    store = sums(spark, tmp_path)
    assert shown(store) == []
    deliveries = [share(spark, ("a", 5, "x"), ("a", 6, "y"), (None, 1, "x")), share(spark, ("b", 7, "x")),
                  share(spark, ("a", 2, "x"), ("a", 9, "z"), (None, 3, "x"))]
    for number, rows_ in enumerate(deliveries):
        store.write(rows_, number)
    want = [("a", 4, 2, 9, 3), ("b", 1, 7, 7, 1), (None, 2, 1, 3, 1)]
    assert shown(store) == want
    store.write(deliveries[2], 2)  # delivered again
    assert shown(store) == want
    store.compact(1)
    assert shown(store) == want
    store.write(deliveries[2], 2)
    store.compact(2)
    assert shown(store) == want
    store.write(share(spark, ("b", 1, "w")), 3)
    assert shown(store)[1] == ("b", 2, 1, 7, 2)


def test_columns_must_be_keys_or_merged(spark, tmp_path):
    with pytest.raises(ValueError):
        MergedTable(spark, str(tmp_path / "x"), "key string, n long, other long", ["key"], {"n": "sum"})
    with pytest.raises(ValueError):
        table(spark, tmp_path, on_new_query="whatever")


def test_copies_of_a_version_count_once(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 2), ("a", 2.0, 2), ("b", None, 1)],
                               "key string, value double, batch_id long")
    assert rows(latest(df, ["key"])) == [("a", 2.0, 2), ("b", None, 1)]


def test_newest_row_without_sorting(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", None, 2), (None, 5.0, 1), (None, 4.0, 0)],
                               "key string, value double, batch_id long")
    got = newest(df, ["key"])
    assert rows(got) == [("a", None, 2), (None, 5.0, 1)]
    assert "Sort" not in got._jdf.queryExecution().executedPlan().toString()


def test_registry(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "registry"))
    assert registry.current() is None
    registry.publish(1, "/models/1")
    registry.publish(2, "/models/2")
    assert tuple(Registry(spark, registry.path).current()) == (2, "/models/2")
    assert registry.versions().where("published_at is null").count() == 0
