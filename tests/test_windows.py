from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from riverglass.operators import toplists as T, windows as W
from riverglass.operators.toplists import counts


def table(spark, events):
    return spark.createDataFrame(events, "ts timestamp, key string")


def clocks(df):
    return sorted((r.window_start.strftime("%d %H:%M"), r.key, r.n) for r in df.collect())


def test_edges_belong_to_the_next_window(spark, at):
    df = table(spark, [(at("00:00"), "a"), (at("00:59:59"), "a"), (at("01:00"), "a")])
    assert clocks(W.edges(W.tumbling_counts(df, "1 hour", ["key"]))) == [
        ("01 00:00", "a", 2), ("01 01:00", "a", 1)]


def test_sliding(spark, at):
    df = table(spark, [(at("01:00"), "a"), (at("01:30"), "a"), (None, "a")])
    assert clocks(W.edges(W.sliding_counts(df, "1 hour", "30 minutes", ["key"]))) == [
        ("01 00:30", "a", 1), ("01 01:00", "a", 2), ("01 01:30", "a", 1)]


def test_sizes_that_are_no_multiple(spark, at):
    assert W.is_multiple("2 days", "12 hours") and not W.is_multiple("1 hour", "25 minutes")
    assert not W.is_multiple("interval 1 hour", "1 hour")
    df = table(spark, [(at("01:00"), "a")])
    assert len(clocks(W.edges(W.sliding_counts(df, "1 hour", "25 minutes", ["key"])))) in (2, 3)


def test_ties_and_short_windows(spark, at):
    events = [(at("00:01"), k) for k in "aaabbccdd"] + [(at("05:00"), "z")]
    counted = W.edges(W.tumbling_counts(table(spark, events), "1 hour", ["key"]))
    got = sorted((r.window_start.hour, r.place, r.key) for r in W.top_per_window(counted, 3, ["key"]).collect())
    assert got == [(0, 1, "a"), (0, 2, "b"), (0, 3, "c"), (5, 1, "z")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3 * 86400), st.sampled_from("abc")), min_size=1, max_size=60))
def test_panes_equal_sliding(spark, at, offsets):
    from datetime import timedelta

    df = table(spark, [(at("00:00") + timedelta(seconds=s), k) for s, k in offsets])
    direct = clocks(W.edges(counts(df, F.window("ts", "6 hours", "1 hour"), "key")))
    assert clocks(W.edges(W.sliding_counts(df, "6 hours", "1 hour", ["key"]))) == direct
    assert sum(n for _, _, n in direct) == 6 * len(offsets)


def test_long_lists_per_group_are_dealt_out(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"),
        (F.col("id") % 7).alias("n"), F.col("id").alias("key"))
    long = T.top_per_group(df, 1500, ["g"], "n", ["key"])
    plain = df.withColumn("place", F.expr("row_number() over (partition by g order by n desc, key)"))
    assert sorted(long.collect()) == sorted(plain.where("place <= 1500").collect())
