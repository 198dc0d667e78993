"""The jobs for `spark-submit`: python -m riverglass.jobs JOB [options]."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from riverglass.operators import als, devices, learning
from riverglass.operators.models import CurrentModel, retrain
from riverglass.operators.ratings import rating_top
from riverglass.operators.searches import by_table
from riverglass.plans import device_report, learning_loop, topic_etl
from riverglass.plans.search_report import search_report
from riverglass.session import build_session
from riverglass.sinks import KeyedTable, Registry, fan_out, files, jdbc, show
from riverglass.sinks.batches import BatchSink
from riverglass.sources import dictionary, file_stream, kafka_stream, ratings, search_log, topic_replay
from riverglass.streaming import toplists
from riverglass.streaming.recommend import RECOMMENDATIONS, live_recommendations
from riverglass.streaming.run import drain, start


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="riverglass.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, help, *options):
        sub = jobs.add_parser(name, help=help)
        sub.add_argument("--out", required=True, help="folder for results")
        sub.add_argument("--show", type=int, metavar="ROWS", help="also print so many rows of each result or micro-batch")
        sub.add_argument("--jdbc", metavar="URL", help="also append results to tables of this database")
        sub.add_argument("--on-new-query", choices=("refuse", "generation"), default="refuse",
                         help="live tables fed by another checkpoint: refuse the query, or let it take over")
        for option, settings in options:
            sub.add_argument(option, **settings)
        return sub

    stream = [
        ("--servers", {"help": "Kafka servers; without them --topic is a folder of files"}),
        ("--topic", {"required": True}),
        ("--start", {"default": "latest", "help": "Kafka: earliest, latest or offsets as JSON, for a new checkpoint"}),
        ("--per-batch", {"type": int, "help": "at most so many Kafka records, or files of a folder, per micro-batch"}),
        ("--once", {"action": "store_true", "help": "stop at the end of what is there now"}),
    ]
    ids = {"default": "string", "help": "type of the ids in delimited ratings"}
    above = ("--above", {"type": float, "default": 30.0})

    job("search", "hot keywords, terms per user, search heat",
        ("--log", {"required": True}), ("--day", {}), ("--unit", {"default": "hour_of_day"}),
        ("--sep", {"default": "\t"}), ("--charset", {"default": "UTF-8"}), ("--top", {"type": int, "default": 10}),
        ("--dictionary", {"help": "text file of terms and, after a tab, how often each was seen, for text without blanks"}))
    job("ratings", "best mean ratings",
        ("--ratings", {"required": True}), ("--sep", {}), ("--ids", ids), ("--top", {"type": int, "default": 10}),
        ("--more-than", {"type": int, "default": 200}))
    job("recommend", "ALS recommendations for all users and all films, or for given ones",
        ("--ratings", {"required": True}), ("--sep", {}), ("--ids", ids), ("--top", {"type": int, "default": 10}),
        ("--users", {"help": "text file of user ids, one a line: lists for these"}),
        ("--films", {"help": "text file of film ids, one a line: lists for these"}))
    job("toplist", "top 3 per sliding window of a file stream with columns ts and key",
        ("--input", {"required": True}), ("--size", {"default": "10 minutes"}),
        ("--slide", {"default": "5 minutes"}), ("--delay", {"default": "10 minutes"}),
        ("--panes", {"action": "store_true", "help": "count panes first, for many windows per row"}),
        ("--once", {"action": "store_true"}))
    job("stations", "clean one topic into another", *stream,
        ("--target", {"required": True, "help": "the cleaned topic, or its folder of files"}))
    job("devices", "strong devices, counts and means per type of the strong devices and of all", *stream, above,
        ("--distinct", {"choices": ("exact", "sketch"), "help": "also count distinct devices, exactly or about"}))
    job("answers", "live answer statistics and progress", *stream)
    job("questions", "live recommendation of error-prone questions", *stream,
        ("--registry", {"required": True}), ("--top", {"type": int, "default": 10}))
    job("retrain", "train on stored progress and publish the model; --out is the models' folder",
        ("--progress", {"required": True}), ("--registry", {"required": True}), ("--top", {"type": int, "default": 10}))
    job("report", "learning report of stored progress", ("--progress", {"required": True}))
    return top


def messages(spark: SparkSession, args) -> DataFrame:
    if args.servers:
        return kafka_stream(spark, args.servers, args.topic, args.start, args.per_batch)
    return topic_replay(spark, args.topic, files_per_batch=args.per_batch)


def extra_sink(args, name: str) -> BatchSink | None:
    """What `--show` and `--jdbc` ask for beside the folder, for the micro-batches of a result."""
    sinks = [show(args.show)] if args.show else []
    if args.jdbc:
        sinks.append(jdbc(args.jdbc, name))
    return fan_out(*sinks) if sinks else None


def with_extra(args, sink: BatchSink, name: str) -> BatchSink:
    more = extra_sink(args, name)
    return fan_out(sink, more) if more else sink


def finish(spark: SparkSession, args, **writers) -> None:
    """Run streaming queries, each with its own checkpoint, to the end or until one fails."""
    for name, writer in writers.items():
        checkpoint = f"{args.out}/checkpoints/{name}"
        if args.once:
            drain(writer, checkpoint)
        else:
            start(writer, checkpoint)
    if not args.once:
        spark.streams.awaitAnyTermination()


def run(spark: SparkSession, args) -> None:
    def save(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        more = extra_sink(args, name)
        if more:
            more(spark.read.schema(df.schema).parquet(f"{args.out}/{name}"), 0)

    table = {"on_new_query": args.on_new_query}

    if args.job == "search":
        log = search_log(spark, args.log, args.sep, args.day, args.charset)
        cut = by_table(dictionary(spark, args.dictionary)) if args.dictionary else None
        with search_report(log, args.top, unit=args.unit, cut=cut) as lists:
            for name, df in lists.items():
                save(df, name)
    elif args.job == "ratings":
        save(rating_top(ratings(spark, args.ratings, args.sep, args.ids), args.top, args.more_than), "rating_top")
    elif args.job == "recommend":
        rated = ratings(spark, args.ratings, args.sep, args.ids)
        trained = als.train(als.rating_matrix(rated, "user_id", "movie_id", "rating"), folder=f"{args.out}/model")

        def given(path: str | None, column: str) -> DataFrame | None:
            return path and spark.read.text(path).select(F.trim("value").cast(rated.schema[column].dataType))

        if args.users or not args.films:
            save(als.lists_for_users(trained, args.top, given(args.users, "user_id")), "user_recommendations")
        if args.films or not args.users:
            save(als.lists_for_items(trained, args.top, given(args.films, "movie_id")), "film_recommendations")
    elif args.job == "toplist":
        stream = file_stream(spark, args.input, "ts timestamp, key string")
        store = KeyedTable(spark, f"{args.out}/top", toplists.live_counts_schema("key") + ", place int",
                           ["window_start", "place"], **table)
        closed = toplists.closed_top_of_panes if args.panes else toplists.closed_top
        writer = closed(stream, args.size, args.slide, "key", 3, args.delay, with_extra(args, store.write, "top"))
        finish(spark, args, top=writer)
    elif args.job == "stations":
        if args.servers:
            writer = topic_etl.kafka_to_kafka(spark, args.servers, source=args.topic, target=args.target,
                                              start=args.start, per_batch=args.per_batch)
        else:
            writer = topic_etl.files_to_files(spark, args.topic, args.target, files_per_batch=args.per_batch)
        finish(spark, args, etl=writer)
    elif args.job == "devices":
        tables = [device_report.stats_table(spark, f"{args.out}/{name}", **table) for name in ("stats", "all_stats")]
        seen = device_report.devices_table(spark, f"{args.out}/seen", **table) if args.distinct == "exact" else None
        sketches = device_report.sketches_table(spark, f"{args.out}/sketches", **table) if args.distinct == "sketch" else None
        finish(spark, args, devices=device_report.live_report(
            messages(spark, args), *tables, files(f"{args.out}/strong"), args.above, seen, sketches, extra_sink(args, "devices")))
    elif args.job == "answers":
        stats = learning_loop.stats_table(spark, f"{args.out}/question_stats", **table)
        progress = learning_loop.progress_table(spark, f"{args.out}/progress", **table)
        more = extra_sink(args, "question_stats")
        finish(spark, args, answers=learning_loop.live_answers(
            learning.answer_rows(messages(spark, args)), stats, progress, *([more] if more else [])))
    elif args.job == "questions":
        models = CurrentModel(Registry(spark, args.registry))
        store = KeyedTable(spark, f"{args.out}/recommended", RECOMMENDATIONS, ["student_id"], **table)
        rows = learning.answer_rows(messages(spark, args))
        try:
            finish(spark, args, questions=live_recommendations(
                rows, models, args.top, with_extra(args, store.write, "recommended")))
        finally:
            models.release()
    elif args.job == "retrain":
        stored = learning_loop.progress_table(spark, args.progress).current()
        retrain(learning.ratings_of_progress(stored), Registry(spark, args.registry), args.out, top=args.top)
    elif args.job == "report":
        save(learning_loop.offline_report(learning_loop.progress_table(spark, args.progress)), "report")


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"riverglass-{args.job}")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
