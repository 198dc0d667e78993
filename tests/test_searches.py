from riverglass.operators import searches as S
from riverglass.plans.search_report import search_report
from riverglass.sources import search_log

DICTIONARY = ["智能", "手機", "智能手機", "價格", "比較"]
LOG = """\
2024-01-01 00:00:00\tu1\t[智能手機價格比較]\t1\t1\ta.example/x
2024-01-01 23:59:59\tu1\t智能手機\t2 7\tb.example/y
2024-01-01 10:00:00\tu2\tspark "sql\tbad\t1\tc.example
2024-01-01 10:30:00\t\tspark\t1\t1\td.example
not a time\tu3\t?!\t1\t1\te.example
2024-01-02 10:00:00\tu3\t\t1\t1\tf.example
"""


def load(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text(LOG)
    return search_log(spark, str(path))


cut = S.by_dictionary(DICTIONARY)


def test_fields(spark, tmp_path, rows):
    got = rows(load(spark, tmp_path).select("user_id", "query", "result_rank", "click_seq", "url"))
    assert ("u1", "智能手機價格比較", 1, 1, "a.example/x") in got
    assert ("u1", "智能手機", 2, 7, "b.example/y") in got
    assert ("u2", 'spark "sql', None, 1, "c.example") in got
    assert len(got) == 6


def test_time_of_day_only(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text("00:00:01\tu\tq\t1\t1\tx\nlate\tu\tq\t1\t1\tx\n")
    stamps = [r.ts for r in search_log(spark, str(path), day="2024-05-01").orderBy("ts").collect()]
    assert stamps[0] is None and str(stamps[1]) == "2024-05-01 00:00:01"


def test_hot_keywords(spark, tmp_path):
    got = [tuple(r) for r in S.hot_keywords(load(spark, tmp_path), 3, cut=cut).collect()]
    # Two searches each; "sql", "價格" and "比較" have one, and the smallest comes first.
    assert got == [("spark", 2), ("智能手機", 2), ("sql", 1)]


def test_user_lists(spark, tmp_path):
    log = load(spark, tmp_path)
    hot = [tuple(r) for r in S.user_hot_terms(log, 2, cut=cut).collect()]
    assert hot == [("u1", "智能手機", 2), (None, "spark", 1)]
    top = {tuple(r) for r in S.user_top_terms(log, 1, cut=cut).collect()}
    assert top == {("u1", "智能手機", 2, 1), ("u2", "spark", 1, 1), (None, "spark", 1, 1)}


def test_heat(spark, tmp_path, rows):
    log = load(spark, tmp_path)
    assert rows(S.search_heat(log)) == [(0, 1), (10, 3), (23, 1), (None, 1)]
    days = [(str(p), n) for p, n in rows(S.search_heat(log, unit="day").where("period is not null"))]
    assert sorted(days) == [("2024-01-01 00:00:00", 4), ("2024-01-02 00:00:00", 1)]


def test_report_equals_single_lists(spark, tmp_path, rows):
    log = load(spark, tmp_path)
    with search_report(log, 3, cut=cut) as lists:
        assert rows(lists["hot_keywords"]) == rows(S.hot_keywords(log, 3, cut=cut))
        assert rows(lists["user_hot_terms"]) == rows(S.user_hot_terms(log, 3, cut=cut))
        assert rows(lists["user_top_terms"]) == rows(S.user_top_terms(log, 3, cut=cut))
        assert rows(lists["search_heat"]) == rows(S.search_heat(log))


def test_other_character_sets(spark, tmp_path):
    (tmp_path / "log").write_bytes("00:00:01,u1,[研究生命],1 2,x\n".encode("gbk"))
    row = search_log(spark, str(tmp_path / "log"), ",", "2024-01-01", "GBK").first()
    assert (row.query, row.result_rank, row.click_seq) == ("研究生命", 1, 2)
