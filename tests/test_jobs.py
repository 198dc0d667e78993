"""The jobs end to end, over files."""

import pytest
from pyspark.sql import functions as F

from riverglass import jobs
from riverglass.operators import devices
from riverglass.plans import device_report, standins as G

SMALL = "/root/testdata/sf0.001"


def run(spark, *words):
    jobs.run(spark, jobs.parser().parse_args([str(w) for w in words]))


def test_search(spark, tmp_path):
    (tmp_path / "log").write_text("00:00:01\tu1\t[智能手機]\t1 1\tx\n01:00:01\tu2\t手機\t1 1\tx\n")
    (tmp_path / "terms").write_text("智能\n手機\n智能手機\n")
    run(spark, "search", "--log", tmp_path / "log", "--day", "2024-01-01",
        "--dictionary", tmp_path / "terms", "--out", tmp_path / "out")
    read = lambda name: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / name)).collect())
    assert read("hot_keywords") == [("手機", 1), ("智能手機", 1)]
    assert read("search_heat") == [(0, 1), (1, 1)]
    assert len(read("user_hot_terms")) == len(read("user_top_terms")) == 2


def test_ratings_and_recommendations(spark, tmp_path):
    lines = [f"{u}::{m}::{(u + m) % 5 + 1}::1" for u in range(20) for m in range(6)]
    (tmp_path / "ratings").write_text("\n".join(lines))
    run(spark, "ratings", "--ratings", tmp_path / "ratings", "--sep", "::", "--more-than", 19, "--out", tmp_path / "out")
    assert spark.read.parquet(str(tmp_path / "out/rating_top")).count() == 6
    run(spark, "recommend", "--ratings", tmp_path / "ratings", "--sep", "::", "--top", 2, "--out", tmp_path / "out")
    assert spark.read.parquet(str(tmp_path / "out/user_recommendations")).count() == 40
    assert spark.read.parquet(str(tmp_path / "out/film_recommendations")).count() == 12


def test_toplist(spark, tmp_path, at):
    rows = [(at(f"0{h}:0{m}"), k) for h in range(4) for m, k in enumerate("aabbcd")]
    spark.createDataFrame(rows, "ts timestamp, key string").coalesce(1).write.parquet(str(tmp_path / "in"))
    run(spark, "toplist", "--input", tmp_path / "in", "--size", "1 hour", "--slide", "1 hour", "--once", "--out", tmp_path / "out")
    got = spark.read.parquet(str(tmp_path / "out/top/generation=0/span=0")).where("window_start = timestamp'2024-01-01 00:00:00Z'")
    assert sorted((r.place, r.key, r.n) for r in got.collect()) == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]


def test_stations_and_devices(spark, tmp_path):
    G.station_topic(spark, SMALL, str(tmp_path / "stationTopic"))
    run(spark, "stations", "--topic", tmp_path / "stationTopic", "--target", tmp_path / "etlTopic", "--once", "--out", tmp_path / "out")
    assert spark.read.parquet(str(tmp_path / "etlTopic")).count() == 0  # no event type is a call status
    G.device_topic(spark, SMALL, str(tmp_path / "iotTopic"))
    run(spark, "devices", "--topic", tmp_path / "iotTopic", "--above", 50, "--once", "--out", tmp_path / "out")
    strong = spark.read.parquet(str(tmp_path / "out/strong")).drop("batch_id")
    stats = device_report.stats_table(spark, str(tmp_path / "out/stats")).current()
    assert strong.where("signal <= 50").count() == 0
    assert strong.count() == sum(r.devices for r in stats.collect())


def test_learning_loop(spark, tmp_path):
    topic, out = tmp_path / "answerTopic", tmp_path / "out"
    G.answer_topic(spark, SMALL, str(topic))
    run(spark, "answers", "--topic", topic, "--once", "--out", out)
    run(spark, "report", "--progress", out / "progress", "--out", out)
    assert spark.read.parquet(str(out / "report")).selectExpr("sum(answers)").first()[0] == 1000
    run(spark, "retrain", "--progress", out / "progress", "--registry", out / "registry", "--out", out / "models")
    run(spark, "questions", "--topic", topic, "--registry", out / "registry", "--top", 3, "--once", "--out", out)
    rows = spark.read.parquet(str(out / "recommended/generation=0/span=0")).where("student_id is not null").collect()
    assert rows and all(len(r.questions) == 3 for r in rows)


def test_devices_of_all_kinds(spark, tmp_path):
    """Counts and means of all devices beside the strong ones, in bounded batches, and distinct devices both ways."""
    G.device_topic(spark, SMALL, str(tmp_path / "iotTopic"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    for kind in ("exact", "sketch"):
        out = tmp_path / kind
        run(spark, "devices", "--topic", tmp_path / "iotTopic", "--per-batch", 5, "--distinct", kind, "--once", "--out", out)
        everything = device_report.stats_table(spark, str(out / "all_stats"))
        assert everything.history().select("batch_id").distinct().count() == 2
        assert everything.current().selectExpr("sum(devices)").first()[0] == events.count()
    want = dict(map(tuple, events.groupBy("event_type").agg(F.count_distinct("user_id")).collect()))
    seen = device_report.devices_table(spark, str(tmp_path / "exact/seen")).current()
    assert dict(map(tuple, devices.devices_by_type(seen).collect())) == want
    about = devices.devices_of_sketches(device_report.sketches_table(spark, str(tmp_path / "sketch/sketches")).current())
    assert all(abs(n - want[t]) <= 0.05 * want[t] for t, n in about.collect())


def test_given_users_and_films(spark, tmp_path):
    lines = [f"u{u}::{m + 10**10}::{(u + m) % 5 + 1}::1" for u in range(20) for m in range(6)]
    (tmp_path / "ratings").write_text("\n".join(lines))
    (tmp_path / "users").write_text("u3\nu7\nnobody\n")
    (tmp_path / "films").write_text(f"{10**10 + 2}\n")
    given = ["recommend", "--ratings", tmp_path / "ratings", "--sep", "::", "--top", 2, "--out", tmp_path / "out"]
    run(spark, *given, "--users", tmp_path / "users", "--films", tmp_path / "films")
    users = spark.read.parquet(str(tmp_path / "out/user_recommendations")).collect()
    assert sorted((r.user, r.place) for r in users) == [("u3", 1), ("u3", 2), ("u7", 1), ("u7", 2)]
    films = spark.read.parquet(str(tmp_path / "out/film_recommendations")).collect()
    assert {r.item for r in films} == {str(10**10 + 2)} and all(r.user.startswith("u") for r in films)
    run(spark, *given, "--ids", "string", "--films", tmp_path / "films")
    assert spark.read.parquet(str(tmp_path / "out/film_recommendations")).count() == 2


def test_results_are_printed_too(spark, tmp_path, capsys):
    (tmp_path / "ratings").write_text("\n".join(f"{u}::7::4::1" for u in range(3)))
    run(spark, "ratings", "--ratings", tmp_path / "ratings", "--sep", "::", "--more-than", 2, "--show", 5, "--out", tmp_path / "out")
    assert "|7 " in capsys.readouterr().out
    spark.createDataFrame([("k1", 1)], "key string, n int").selectExpr("timestamp'2024-01-01 00:00:00' as ts", "key").coalesce(1).write.parquet(str(tmp_path / "in"))
    run(spark, "toplist", "--input", tmp_path / "in", "--panes", "--size", "1 hour", "--slide", "1 hour", "--once", "--show", 5, "--out", tmp_path / "top")


def test_other_checkpoints_are_refused_or_take_over(spark, tmp_path):
    G.device_topic(spark, SMALL, str(tmp_path / "iotTopic"))
    args = ["devices", "--topic", tmp_path / "iotTopic", "--once", "--out", tmp_path / "out"]
    run(spark, *args)
    (tmp_path / "out/checkpoints").rename(tmp_path / "kept-checkpoints")
    with pytest.raises(Exception, match="is written by"):
        run(spark, *args)


def test_kafka_options(spark, monkeypatch):
    """The start and the rate bound reach the reader; there is no broker here."""
    seen = {}

    def kafka(spark, servers, topic, start="latest", per_batch=None, **options):
        seen.update(servers=servers, topic=topic, start=start, per_batch=per_batch)
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs, "kafka_stream", kafka)
    monkeypatch.setattr(jobs.topic_etl, "kafka_stream", kafka)
    for job, more in (("answers", []), ("stations", ["--target", "t"])):
        seen.clear()
        with pytest.raises(KeyboardInterrupt):
            run(spark, job, "--servers", "h:1", "--topic", "x", "--start", "earliest", "--per-batch", 7, "--out", "/nowhere", *more)
        assert seen == {"servers": "h:1", "topic": "x", "start": "earliest", "per_batch": 7}


def test_database_option(spark, tmp_path, monkeypatch):
    """Results go to the sink for databases under their names; it takes no server to see that."""
    seen = []
    monkeypatch.setattr(jobs, "jdbc", lambda url, name, **o: lambda df, batch_id: seen.append((url, name, df.count(), batch_id)))
    (tmp_path / "ratings").write_text("\n".join(f"{u}::7::4::1" for u in range(3)))
    run(spark, "ratings", "--ratings", tmp_path / "ratings", "--sep", "::", "--more-than", 2, "--jdbc", "jdbc:x", "--out", tmp_path / "out")
    assert seen == [("jdbc:x", "rating_top", 1, 0)]


def test_gbk_log(spark, tmp_path):
    (tmp_path / "log").write_bytes("00:00:01,u1,[研究生命],1 1,x\n".encode("gbk"))
    (tmp_path / "terms").write_text("研究\t50\n生命\t50\n研究生\t1\n")
    run(spark, "search", "--log", tmp_path / "log", "--sep", ",", "--charset", "GBK", "--day", "2024-01-01",
        "--dictionary", tmp_path / "terms", "--out", tmp_path / "out")
    assert sorted(r.term for r in spark.read.parquet(str(tmp_path / "out/hot_keywords")).collect()) == ["生命", "研究"]


def test_a_missing_option_is_an_error():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["ratings", "--out", "x"])
