import pytest

from riverglass.operators import als
from riverglass.operators.als import AlsSettings
from riverglass.operators.learning import difficulty_ratings
from riverglass.operators.models import CurrentModel, retrain
from riverglass.plans import learning_loop
from riverglass.sinks import KeyedTable, Registry
from riverglass.sources import file_stream
from riverglass.streaming.recommend import RECOMMENDATIONS, recommend, with_stored
from riverglass.streaming.run import drain

SETTINGS = AlsSettings(rank=3, iterations=3, blocks=2)
ANSWERS = "student_id string, question_id string, correct int"


@pytest.fixture(scope="module")
def answers(spark):
    rows = [(f"s{s}", f"q{q}", int((s + q) % 3 > 0)) for s in range(12) for q in range(8) if (s * q) % 5]
    return spark.createDataFrame(rows, ANSWERS)


def test_registry_and_reload(spark, tmp_path, answers):
    registry = Registry(spark, str(tmp_path / "registry"))
    current = CurrentModel(registry)
    assert current.get() is None
    assert retrain(difficulty_ratings(answers), registry, str(tmp_path / "models"), SETTINGS) == 1
    first = current.get()
    assert first.version == 1 and current.get() is first
    assert retrain(difficulty_ratings(answers), registry, str(tmp_path / "models"), SETTINGS) == 2
    assert current.get().version == 2

    students = answers.select("student_id").union(spark.createDataFrame([("new",), (None,)], "student_id string"))
    got = {r.student_id: r for r in recommend(students, current.get(), 2).collect()}
    assert set(got) == {r.student_id for r in answers.select("student_id").distinct().collect()} | {"new"}
    assert got["new"].questions == []
    for student, row in got.items():
        if student != "new":
            assert [q.place for q in row.questions] == [1, 2]
            assert row.questions[0].score >= row.questions[1].score
            assert all(q.question_id.startswith("q") for q in row.questions)


def test_live(spark, tmp_path, answers):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    registry = Registry(spark, str(tmp_path / "registry"))
    store = KeyedTable(spark, out, RECOMMENDATIONS, ["student_id"])

    def feed(rows):
        spark.createDataFrame(rows, ANSWERS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = file_stream(spark, source, ANSWERS)
        models = CurrentModel(registry)
        drain(learning_loop.recommend_live(stream, models, 2, store), str(tmp_path / "checkpoint"))
        models.release()

    feed([("s1", "q1", 1)])
    run()
    assert [tuple(r) for r in store.current().collect()] == [("s1", None, [])]  # no model yet
    learning_loop.retrain_from(answers, registry, str(tmp_path / "models"), SETTINGS)
    feed([("s1", "q1", 1), ("s2", "q1", 0)])
    run()
    assert {(r.student_id, r.model_version, len(r.questions)) for r in store.current().collect()} == {
        ("s1", 1, 2), ("s2", 1, 2)}
    learning_loop.retrain_from(answers, registry, str(tmp_path / "models"), SETTINGS)
    feed([("s2", "q1", 0), ("stranger", "q1", 0)])
    run()
    assert {(r.student_id, r.model_version, len(r.questions)) for r in store.current().collect()} == {
        ("s1", 1, 2), ("s2", 2, 2), ("stranger", 2, 0)}
    assert store.history().select("batch_id").distinct().count() == 3

    joined = with_stored(answers.where("student_id in ('s1', 's3')"), store.current())
    assert {(r.student_id, r.questions is None) for r in joined.collect()} == {("s1", False), ("s3", True)}


def test_a_micro_batch_makes_no_pairs(spark, tmp_path, answers):
    """One equality join with the published lists, and no factors."""
    registry = Registry(spark, str(tmp_path / "registry"))
    retrain(difficulty_ratings(answers), registry, str(tmp_path / "models"), SETTINGS, top=3)
    current = CurrentModel(registry)
    plan = recommend(answers, current.get(), 2)._jdf.queryExecution().optimizedPlan().toString()
    current.release()
    assert plan.count("Join LeftOuter") == 1 and "Cross" not in plan and "features" not in plan


def test_published_lists_are_the_models_lists(spark, tmp_path, answers):
    registry = Registry(spark, str(tmp_path / "registry"))
    retrain(difficulty_ratings(answers), registry, str(tmp_path / "models"), SETTINGS, top=4)
    path = registry.current().path
    trained = als.Trained(als.load(f"{path}/model"), spark.read.parquet(f"{path}/users/ids"), spark.read.parquet(f"{path}/items/ids"))
    want = {}
    for r in als.lists_for_users(trained, 4).orderBy("place").collect():
        want.setdefault(r.user, []).append(r.item)
    got = {r.student_id: [q.question_id for q in r.questions] for r in CurrentModel(registry).get().lists.collect()}
    assert got == want and all(len(v) == 4 for v in got.values())
