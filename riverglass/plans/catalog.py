"""The registered queries: every operator bound to the given tables.

Each function takes the session and the folder of the tables. Streaming queries run to the end
of their input and return what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riverglass.functions.text import term_costs
from riverglass.functions.times import utc_wall
from riverglass.operators import als, devices as D, features, learning as L, measures as M, ratings as R
from riverglass.operators import searches as S, stations, windows as W
from riverglass.operators.models import CurrentModel
from riverglass.plans import device_report, learning_loop, standins as G, topic_etl
from riverglass.session import stored, work_dir
from riverglass.sinks import KeyedTable, MergedTable, Registry, fan_out, files
from riverglass.sources.batch import search_log
from riverglass.sources.streams import MESSAGE
from riverglass.streaming import late, toplists as LT
from riverglass.streaming.recommend import RECOMMENDATIONS, with_stored
from riverglass.streaming.run import drain, files_to

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Syllables of the generated prose: they stand in for the words of a script without spaces.
SYLLABLES = ["en", "er", "es", "eau", "eaux", "ent", "entier", "ier", "in", "ing", "on", "ou",
             "re", "st", "the", "th", "tion", "wh"]


EACH = r"\p{L}\p{M}\p{N}"  # every character that is in no syllable stands alone


def short_terms(spark, sf_dir):
    """A dictionary that Spark counts itself: the words of up to six characters that users write."""
    said = S.term_counts(G.user_searches(spark, sf_dir))
    return term_costs(said.where(F.length("term") <= 6))


# --- ratings ---------------------------------------------------------------------------------

@query
def rating_top10(spark, sf_dir):
    return R.rating_top(G.item_ratings(spark, sf_dir))


@query
def rating_top10_sql(spark, sf_dir):
    return R.rating_top_sql(G.item_ratings(spark, sf_dir))


@query
def rating_top10_named(spark, sf_dir):
    """Films by name, of which about half have more than 200 ratings."""
    return R.rating_top(G.named_ratings(spark, sf_dir))


@query
def rated_often_named(spark, sf_dir):
    """All films above the limit."""
    return R.mean_ratings(G.named_ratings(spark, sf_dir)).where(F.col("ratings") > 200)


@query
def mean_ratings(spark, sf_dir):
    return R.mean_ratings(G.item_ratings(spark, sf_dir))


# --- search log ------------------------------------------------------------------------------

@query
def hot_keywords_top10(spark, sf_dir):
    return S.hot_keywords(G.document_searches(spark, sf_dir))


@query
def hot_segments_top10(spark, sf_dir):
    return S.hot_keywords(G.document_searches(spark, sf_dir), cut=S.by_dictionary(SYLLABLES, EACH))


@query
def hot_segments_top10_lookup(spark, sf_dir):
    """With a dictionary that is a table, counted from what users write."""
    return S.hot_keywords(G.document_searches(spark, sf_dir), cut=S.by_table(short_terms(spark, sf_dir)))


@query
def segment_counts(spark, sf_dir):
    return S.term_counts(G.document_searches(spark, sf_dir), cut=S.by_table(short_terms(spark, sf_dir)))


@query
def user_segments_top10(spark, sf_dir):
    return S.user_hot_terms(G.user_searches(spark, sf_dir), cut=S.by_dictionary(SYLLABLES, EACH))


@query
def keyword_counts(spark, sf_dir):
    return S.term_counts(G.document_searches(spark, sf_dir))


@query
def user_hot_terms_top10(spark, sf_dir):
    return S.user_hot_terms(G.user_searches(spark, sf_dir))


@query
def user_top_terms(spark, sf_dir):
    return S.user_top_terms(G.user_searches(spark, sf_dir))


@query
def user_keywords_top10(spark, sf_dir):
    """Hot keywords added up from the counts per user and term."""
    return S.hot_keywords_from_pairs(S.user_term_counts(G.user_searches(spark, sf_dir)))


@query
def search_heat_by_hour(spark, sf_dir):
    return S.search_heat(G.given(spark, sf_dir, "events"))


@query
def search_heat_by_day(spark, sf_dir):
    return S.search_heat(G.given(spark, sf_dir, "events"), unit="day")


@query
def search_log_scan(spark, sf_dir):
    """A raw click log read back as typed rows."""
    out = work_dir(spark, "search-log")
    G.search_log_files(spark, sf_dir, f"{out}/log")
    return search_log(spark, f"{out}/log").withColumn("ts", utc_wall(F.col("ts")))


@query
def search_log_report(spark, sf_dir):
    """Hot terms of a raw click log's users."""
    out = work_dir(spark, "search-log")
    G.search_log_files(spark, sf_dir, f"{out}/log")
    return S.user_top_terms(search_log(spark, f"{out}/log"), 2)


# --- windows ---------------------------------------------------------------------------------

@query
def tumbling_counts(spark, sf_dir):
    return W.edges(W.tumbling_counts(G.given(spark, sf_dir, "events"), "1 hour", ["event_type"]))


@query
def sliding_counts(spark, sf_dir):
    rows = G.given(spark, sf_dir, "events")
    return W.edges(W.sliding_counts(rows, "1 hour", "20 minutes", ["event_type"]))


@query
def sliding_counts_by_panes(spark, sf_dir):
    rows = G.given(spark, sf_dir, "events")
    return W.edges(W.sliding_counts_by_panes(rows, "1 day", "1 hour", ["event_type"]))


@query
def sliding_top3(spark, sf_dir):
    rows = G.given(spark, sf_dir, "events")
    counted = W.edges(W.sliding_counts(rows, "2 days", "1 day", ["event_type"]))
    return W.top_per_window(counted, 3, ["event_type"])


def wall_edges(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", utc_wall(F.col("window_start")))
            .withColumn("window_end", utc_wall(F.col("window_end"))))


@query
def tumbling_counts_stream(spark, sf_dir):
    out = work_dir(spark, "tumbling")
    stream = W.watermarked(G.events_stream(spark, sf_dir))
    counted = W.edges(W.tumbling_counts(stream, "1 hour", ["event_type"]))
    drain(files_to(counted, f"{out}/rows"), f"{out}/checkpoint")
    return wall_edges(spark.read.schema(counted.schema).parquet(f"{out}/rows"))


@query
def sliding_top3_stream(spark, sf_dir):
    """Closed windows only, written both as plain files and to the keyed table."""
    out = work_dir(spark, "sliding-closed")
    store = KeyedTable(spark, f"{out}/table",
                       LT.live_counts_schema("event_type") + ", place int",
                       ["window_start", "place"])
    sink = fan_out(files(f"{out}/files"), store.write)
    drain(LT.closed_top(G.events_stream(spark, sf_dir), "2 days", "1 day", "event_type", 3,
                        "10 minutes", sink), f"{out}/checkpoint")
    return wall_edges(store.current())


@query
def sliding_top3_live(spark, sf_dir):
    """All windows, open ones too."""
    out = work_dir(spark, "sliding-live")
    store = KeyedTable(spark, f"{out}/table", LT.live_counts_schema("event_type"),
                       ["window_start", "window_end", "event_type"])
    drain(LT.live_counts(G.events_stream(spark, sf_dir), "2 days", "1 day", "event_type",
                         "10 minutes", store), f"{out}/checkpoint")
    return wall_edges(LT.live_top(store, 3, "event_type"))


@query
def sliding_top3_live_panes(spark, sf_dir):
    """The same from stored pane counts."""
    out = work_dir(spark, "panes-live")
    store = KeyedTable(spark, f"{out}/table", LT.live_counts_schema("event_type"),
                       ["window_start", "window_end", "event_type"])
    drain(LT.live_panes(G.events_stream(spark, sf_dir), "2 days", "1 day", "event_type", "10 minutes", store),
          f"{out}/checkpoint")
    return wall_edges(LT.live_top_of_panes(store, "2 days", "1 day", 3, "event_type"))


@query
def sliding_counts_chained_stream(spark, sf_dir):
    """Closed windows of six hours every hour, from panes."""
    out = work_dir(spark, "chained")
    counted = LT.closed_counts(G.events_stream(spark, sf_dir), "6 hours", "1 hour", "event_type", "10 minutes")
    drain(files_to(counted, f"{out}/rows"), f"{out}/checkpoint")
    return wall_edges(spark.read.schema(counted.schema).parquet(f"{out}/rows"))


def kept_apart(spark, sf_dir):
    """Counts per hour of the rows on time, the late rows and the marks of a stream with late rows."""
    out = work_dir(spark, "late")
    counts_ = MergedTable(spark, f"{out}/counts", "window_start timestamp, window_end timestamp, event_type string, n bigint",
                          ["window_start", "window_end", "event_type"], {"n": "sum"})
    marks = late.marks_table(spark, f"{out}/marks")

    def count(batch, batch_id):
        counts_.write(W.edges(W.tumbling_counts(batch, "1 hour", ["event_type"])), batch_id)

    drain(late.apart(G.delayed_stream(spark, sf_dir, f"{out}/in"), G.DELAY, count, f"{out}/late", marks), f"{out}/checkpoint")
    return counts_, late.late_rows(spark, f"{out}/late", G.EVENTS), marks


@query
def late_rows_stream(spark, sf_dir):
    """Events that arrive too late, with the batch they came in."""
    _, rows, _ = kept_apart(spark, sf_dir)
    return rows.select("event_id", "event_type", F.unix_micros("ts").alias("micros"),
                       F.unix_micros("watermark").alias("limit_micros"), "batch_id")


@query
def on_time_counts_stream(spark, sf_dir):
    """What is counted without them."""
    counts_, _, _ = kept_apart(spark, sf_dir)
    return wall_edges(counts_.current())


@query
def late_totals_stream(spark, sf_dir):
    _, _, marks = kept_apart(spark, sf_dir)
    return marks.current().select(F.unix_micros("newest").alias("newest_micros"), "rows", "late")


# --- devices ---------------------------------------------------------------------------------

def device_table(spark, sf_dir):
    return G.device_signals(G.given(spark, sf_dir, "events"))


@query
def signal_over_30(spark, sf_dir):
    return D.strong_signals(device_table(spark, sf_dir))


@query
def signal_over_30_sql(spark, sf_dir):
    return D.strong_signals_sql(device_table(spark, sf_dir))


@query
def devices_by_type(spark, sf_dir):
    return D.devices_by_type(G.devices(G.given(spark, sf_dir, "events")))


@query
def devices_by_type_sql(spark, sf_dir):
    return D.devices_by_type_sql(G.devices(G.given(spark, sf_dir, "events")))


@query
def mean_signal_by_type_sql(spark, sf_dir):
    return D.mean_signal_by_type_sql(device_table(spark, sf_dir))


@query
def distinct_devices_by_type(spark, sf_dir):
    return D.devices_by_type(G.devices(G.given(spark, sf_dir, "events")), distinct=True)


@query
def mean_signal_by_type(spark, sf_dir):
    return D.mean_signal_by_type(device_table(spark, sf_dir))


@query
def device_stats(spark, sf_dir):
    return D.device_stats(device_table(spark, sf_dir))


@query
def device_stats_sql(spark, sf_dir):
    return D.device_stats_sql(device_table(spark, sf_dir))


def device_stream(spark, sf_dir, out):
    count = G.device_topic(spark, sf_dir, f"{out}/iotTopic")
    return G.replay(spark, f"{out}/iotTopic", "iotTopic", count)


def device_stats_live(spark, sf_dir, above, sql):
    out = work_dir(spark, "devices")
    store = device_report.stats_table(spark, f"{out}/table")
    drain(device_report.live_stats(device_stream(spark, sf_dir, out), store, above, sql),
          f"{out}/checkpoint")
    return D.stats_of_sums(store.current())


@query
def device_stats_stream(spark, sf_dir):
    return device_stats_live(spark, sf_dir, 30.0, sql=False)


@query
def device_stats_stream_sql(spark, sf_dir):
    return device_stats_live(spark, sf_dir, 30.0, sql=True)


@query
def all_device_stats_stream(spark, sf_dir):
    return device_stats_live(spark, sf_dir, None, sql=False)


@query
def distinct_devices_stream(spark, sf_dir):
    """Devices seen are stored live; the stored rows per type are counted."""
    out = work_dir(spark, "devices-seen")
    store = device_report.devices_table(spark, f"{out}/table")
    drain(device_report.live_devices(device_stream(spark, sf_dir, out), store), f"{out}/checkpoint")
    return D.devices_by_type(store.current())


@query
def distinct_devices_sketched(spark, sf_dir):
    """Whether the stored sketches of each type come within five percent of its devices."""
    out = work_dir(spark, "devices-sketched")
    store = device_report.sketches_table(spark, f"{out}/table")
    drain(device_report.live_sketches(device_stream(spark, sf_dir, out), store), f"{out}/checkpoint")
    exact = distinct_devices_by_type(spark, sf_dir).withColumnRenamed("devices", "exact")
    return D.devices_of_sketches(store.current()).join(exact, "device_type").select(
        "device_type", (F.abs(F.col("devices") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


@query
def signal_over_30_stream(spark, sf_dir):
    out = work_dir(spark, "strong")
    drain(device_report.live_strong(device_stream(spark, sf_dir, out), f"{out}/rows"),
          f"{out}/checkpoint")
    rows = spark.read.schema("device string, device_type string, signal double, ts timestamp")
    return rows.parquet(f"{out}/rows").select(
        "device", "device_type", "signal", F.unix_millis("ts").alias("millis"))


# --- stations --------------------------------------------------------------------------------

@query
def station_etl(spark, sf_dir):
    """From stationTopic to etlTopic; the result is what a reader of etlTopic sees."""
    out = work_dir(spark, "stations")
    count = G.station_topic(spark, sf_dir, f"{out}/stationTopic")
    rule = (stations.complete_calls(statuses=("click", "purchase", "signup", "view"))
            & (F.col("duration") >= 10))
    drain(topic_etl.files_to_files(spark, f"{out}/stationTopic", f"{out}/etlTopic", rule,
                                   files_per_batch=G.half(count)), f"{out}/checkpoint")
    cleaned = stations.station_rows(spark.read.schema(MESSAGE).parquet(f"{out}/etlTopic"))
    return cleaned.withColumn("call_time", utc_wall(F.col("call_time")))


# --- learning --------------------------------------------------------------------------------

def answer_table(spark, sf_dir):
    return G.answers(G.given(spark, sf_dir, "events"))


@query
def answer_stats(spark, sf_dir):
    return L.answer_stats(answer_table(spark, sf_dir))


@query
def answer_stats_by_grade(spark, sf_dir):
    return L.answer_stats(answer_table(spark, sf_dir), ["subject", "grade"])


@query
def error_prone_top(spark, sf_dir):
    return L.error_prone(answer_table(spark, sf_dir))


@query
def learning_report(spark, sf_dir):
    return L.learning_report(L.progress(answer_table(spark, sf_dir)))


def answer_stream(spark, sf_dir, out):
    count = G.answer_topic(spark, sf_dir, f"{out}/answerTopic")
    return L.answer_rows(G.replay(spark, f"{out}/answerTopic", "answerTopic", count))


@query
def answer_stats_stream(spark, sf_dir):
    out = work_dir(spark, "answers")
    store = learning_loop.stats_table(spark, f"{out}/table")
    drain(learning_loop.live_stats(answer_stream(spark, sf_dir, out), store), f"{out}/checkpoint")
    return L.stats_of_sums(store.current())


@query
def learning_report_stored(spark, sf_dir):
    """Live progress into the keyed table, compacted, then the offline SQL report over it."""
    out = work_dir(spark, "progress")
    store = learning_loop.progress_table(spark, f"{out}/table")
    drain(learning_loop.live_progress(answer_stream(spark, sf_dir, out), store), f"{out}/checkpoint")
    store.compact(0)
    report = L.learning_report_sql(store.current())
    return (report.withColumn("first_answer", utc_wall(F.col("first_answer")))
            .withColumn("last_answer", utc_wall(F.col("last_answer"))))


# --- recommendations -------------------------------------------------------------------------

def part_model(spark, sf_dir):
    return als.train(G.part_matrix(spark, sf_dir), als.AlsSettings(iterations=5))


@query
def als_user_recs(spark, sf_dir):
    return als.lists_for_users(part_model(spark, sf_dir), 5)


@query
def als_item_recs(spark, sf_dir):
    return als.lists_for_items(part_model(spark, sf_dir), 5)


@query
def als_subset_user_recs(spark, sf_dir):
    """For the customers of one market segment."""
    chosen = G.given(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return als.lists_for_users(part_model(spark, sf_dir), 5, chosen.select("c_custkey"))


@query
def als_subset_item_recs(spark, sf_dir):
    """For the parts of one type."""
    chosen = G.given(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")
    return als.lists_for_items(part_model(spark, sf_dir), 5, chosen.select("p_partkey"))


def shape(rows: DataFrame, who: str, what: str) -> DataFrame:
    """What must hold for any model: the number of recommendations of each id, that they are
    distinct, that the places run from 1, and that scores do not rise with the place."""
    marks = rows.groupBy(who).agg(
        F.count(F.lit(1)).alias("recommendations"),
        F.count_distinct(what).alias("distinct_ids"),
        F.max("place").cast("long").alias("last_place"),
        (F.max_by("score", "place") <= F.min_by("score", "place")).alias("best_first"))
    return marks.withColumnRenamed(who, "id").withColumn("id", F.col("id").cast("long"))


@query
def als_user_recs_shape(spark, sf_dir):
    return shape(als_user_recs(spark, sf_dir), "user", "item")


@query
def als_item_recs_shape(spark, sf_dir):
    return shape(als_item_recs(spark, sf_dir), "item", "user")


@query
def als_subset_user_recs_shape(spark, sf_dir):
    return shape(als_subset_user_recs(spark, sf_dir), "user", "item")


@query
def als_subset_item_recs_shape(spark, sf_dir):
    return shape(als_subset_item_recs(spark, sf_dir), "item", "user")


@query
def als_rmse(spark, sf_dir):
    matrix, _, _ = als.numbered(G.part_matrix(spark, sf_dir), work_dir(spark, "als"))
    train, test = als.split(stored(matrix, "numbered"))
    return als.evaluate(als.fit(train, als.AlsSettings(iterations=5)), train, test)


def held_out_ratings(spark, sf_dir):
    """Planted ratings and which are for testing."""
    return G.planted_ratings(spark, sf_dir).withColumn("test", M.held_out("user", "item"))


def liked():
    return (F.col("rating") >= 5).alias("relevant")


@query
def baseline_ranking_by_user(spark, sf_dir):
    """How a ranking by the items' means does on each user's held-out items."""
    rows = held_out_ratings(spark, sf_dir)
    means = M.item_means(rows.where("not test"))
    scored = rows.where("test").join(means, "item", "left").select("user", "item", "score", liked())
    return M.ranking_by_user(scored, 3)


@query
def baseline_ranking(spark, sf_dir):
    return M.ranking_summary(baseline_ranking_by_user(spark, sf_dir))


@query
def baseline_errors(spark, sf_dir):
    """The error of the items' means and of the mean of all, on held-out ratings of items that were seen."""
    rows = held_out_ratings(spark, sf_dir)
    train = rows.where("not test")
    mean = train.agg(F.avg("rating")).first()[0]
    guessed = rows.where("test").join(M.item_means(train).withColumnRenamed("score", "item_mean"), "item").withColumn(
        "mean", F.lit(mean))
    return M.errors(guessed, "rating", ("item_mean", "mean"))


@query
def als_ranking(spark, sf_dir):
    """Whether the factors rank held-out items better than the items' means, and beat their error by half."""
    rows = stored(held_out_ratings(spark, sf_dir), "held-out")
    train, test = rows.where("not test").drop("test"), rows.where("test").drop("test")
    trained = als.train(train, als.AlsSettings(rank=4, iterations=10, reg=0.02))
    keyed = test.join(trained.users.toDF("user", "u"), "user").join(trained.items.toDF("item", "i"), "item")
    scored = stored(trained.model.transform(keyed.select(F.col("u").alias("user"), F.col("i").alias("item"), "rating")).join(
        M.item_means(train.join(trained.items.toDF("item", "i"), "item").select(F.col("i").alias("item"), "rating")), "item"), "scored")
    judge = lambda score: M.ranking_summary(M.ranking_by_user(
        scored.select("user", "item", F.col(score).alias("score"), liked()), 3))
    error = M.errors(scored, "rating", ("prediction", "score")).first()
    return judge("prediction").select(
        F.lit(error.rows).alias("test_rows"), "users", (F.col("ndcg") > judge("score").first().ndcg).alias("ranks_better"),
        F.lit(error.rmse_of_prediction < error.rmse_of_score / 2).alias("half_the_error"))


@query
def difficulty_ratings(spark, sf_dir):
    return L.difficulty_ratings(answer_table(spark, sf_dir))


def live_recs_store(spark, sf_dir):
    out = work_dir(spark, "recommend")
    registry = Registry(spark, f"{out}/registry")
    learning_loop.retrain_from(answer_table(spark, sf_dir), registry, f"{out}/models",
                               als.AlsSettings(iterations=5))
    store = KeyedTable(spark, f"{out}/table", RECOMMENDATIONS, ["student_id"])
    stream = answer_stream(spark, sf_dir, out)
    models = CurrentModel(registry)
    try:
        drain(learning_loop.recommend_live(stream, models, 2, store), f"{out}/checkpoint")
    finally:
        models.release()
    return store


@query
def live_recs(spark, sf_dir):
    """Train, publish, then recommend to the students of a live stream."""
    return live_recs_store(spark, sf_dir).current()


@query
def live_recs_shape(spark, sf_dir):
    return live_recs(spark, sf_dir).select(
        "student_id", "model_version", F.size("questions").alias("questions"),
        F.size(F.array_distinct(F.col("questions.question_id"))).alias("distinct_questions"))


@query
def answers_with_recs(spark, sf_dir):
    """Each answer of a stream beside the stored recommendations of its student."""
    store = live_recs_store(spark, sf_dir)
    out = work_dir(spark, "join")
    joined = with_stored(answer_stream(spark, sf_dir, out), store.current()).select(
        "student_id", "question_id", "subject", "correct", F.size("questions").alias("questions"))
    drain(files_to(joined, f"{out}/rows"), f"{out}/checkpoint")
    return spark.read.schema(joined.schema).parquet(f"{out}/rows")


# --- machine learning ------------------------------------------------------------------------

@query
def ml_cleaning(spark, sf_dir):
    """Signals below 5 count as missing and are filled with the mean; error rows are dropped."""
    rows = device_table(spark, sf_dir).select(
        "event_id", "device_type", F.when(F.col("signal") >= 5, F.col("signal")).alias("signal"))
    cleaned = features.clean(rows, ["signal"], ["device_type"], "device_type <> 'error'")
    return cleaned.select("event_id", "device_type", "signal_filled",
                          F.col("device_type_index").cast("long").alias("type_index"))


@query
def ml_held_out(spark, sf_dir):
    """Held-out vectors on each side of a plane, and whether the classifier finds most of them on their side."""
    rows = G.given(spark, sf_dir, "embeddings").withColumns({
        "test": F.col("vec_id") % 5 == 0, "side": (F.expr("embedding[0] + embedding[1]") > 0).cast("int")})
    model = features.train_classifier(rows.where("not test"), "embedding", "side")
    found = M.hits(features.classify(model, rows.where("test"), "embedding"), "side")
    return found.select("side", "rows", (F.col("share") > 0.8).alias("mostly_right"))


@query
def ml_pipeline(spark, sf_dir):
    rows = G.given(spark, sf_dir, "embeddings")
    model = features.train_classifier(rows, "embedding", "label")
    return features.classify(model, rows, "embedding").select("vec_id", "label", "prediction")
