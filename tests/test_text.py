
import regex
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riverglass.functions import text as X
from riverglass.operators import searches as S
from riverglass.sources import dictionary

# Longest match takes 研究生 (graduate student) and is left with 命; the best path reads 研究 / 生命 / 起源.
HAN = {"研究": 4000, "研究生": 6000, "生命": 4500, "命": 7000, "起源": 5000, "的": 1500}


def split(spark, values, make):
    df = spark.createDataFrame(list(enumerate(values)), "i int, q string")
    return [r[0] for r in df.select("i", make(F.col("q")).alias("t")).orderBy("i").select("t").collect()]


def by_join(spark, values, costs, alone=X.ALONE):
    """The words of `values` cut with the dictionary as a table, in the shape of `split`."""
    table = spark.createDataFrame(list(costs.items()), "term string, cost long")
    words = spark.createDataFrame([(w,) for w in sorted({w for v in values for w in v})], "term string")
    cut = {r.term: r.parts for r in X.segment_words(words, table, "term", alone).collect()}
    return [[t for w in v for t in cut[w]] for v in values]


def test_words_keep_digits_and_marks(spark):
    assert split(spark, ["Über-fast, 2 cars", None, "iPhone 12 4G 5g", "नमस्ते दुनिया", "été", "١٢٣ 、"], X.words) == [
        ["über", "fast", "2", "cars"], None, ["iphone", "12", "4g", "5g"], ["नमस्ते", "दुनिया"], ["été"], ["١٢٣"]]


def test_best_path_reads_ambiguous_text(spark):
    texts = ["研究生命起源", "研究生", "研究的起源", "買研究", "iPhone 15研究!", "研究iPhone15的", "", None, "，。!"]
    want = [["研究", "生命", "起源"], ["研究生"], ["研究", "的", "起源"], ["買", "研究"], ["iphone", "15", "研究"],
            ["研究", "iphone15", "的"], [], None, []]
    assert split(spark, texts, lambda c: X.segments(c, HAN)) == want
    given_ = [w for w in split(spark, texts, X.words) if w is not None]
    assert by_join(spark, given_, HAN) == [w for w in want if w is not None]


def test_other_scripts(spark):
    thai = {"ตา": 3000, "ตาก": 4000, "ลม": 3500, "กลม": 3800, "ไทย": 3000}
    # ตากลม reads ตา/กลม (round eyes) or ตาก/ลม (to take the air): the cheaper one wins.
    assert split(spark, ["ตากลม", "ไทยx9ตา"], lambda c: X.segments(c, thai)) == [["ตา", "กลม"], ["ไทย", "x9", "ตา"]]
    assert split(spark, ["がく", "привет мир"], lambda c: X.segments(c, {"мир": 1000})) == [
        ["が", "く"], ["привет", "мир"]]


def test_equal_paths_prefer_the_longer_first_term(spark):
    assert split(spark, ["天地人"], lambda c: X.segments(c, ["天", "天地", "地人", "人"])) == [["天地", "人"]]


def every_path(word, costs, alone):
    """All ways through a word, from the rule."""
    if not word:
        return [(0, ())]
    single = regex.match(rf"[{alone}]\p{{M}}*|[^{alone}]+", word)
    # A mark that stands first, after its character was taken by a term, goes with what follows it.
    loose = single.group() if single else word[0]
    sizes = {(len(t), c) for t, c in costs.items() if word.startswith(t)} | {(len(loose), X.LOOSE_COST * len(loose))}
    return [(c + rest, (word[:n], *path)) for n, c in sizes for rest, path in every_path(word[n:], costs, alone)]


@settings(max_examples=60, deadline=None)
@given(st.text("天地人ab1", min_size=1, max_size=9), st.dictionaries(
    st.text("天地人ab", min_size=1, max_size=3), st.integers(1, 9).map(lambda n: n * 1000), max_size=8))
def test_best_path_is_the_best_of_all(word, costs):
    ways = every_path(word, costs, X.ALONE)
    least = min(c for c, _ in ways)
    want = max((p for c, p in ways if c == least), key=lambda p: [len(x) for x in p])
    assert X.cutter(costs)(word) == list(want)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("天地人ab .", max_size=12), min_size=1, max_size=20),
       st.dictionaries(st.text("天地人a", min_size=1, max_size=3), st.integers(500, 9000), min_size=1, max_size=8))
def test_both_engines_agree(spark, values, costs):
    given_ = split(spark, values, X.words)
    assert split(spark, values, lambda c: X.segments(c, costs)) == by_join(spark, given_, costs)


def test_long_words_take_linear_time():
    word = "x" * 300_000 + "天地" * 100_000
    found = X.cutter({"天地": 1000, "xx": 40_001})(word)
    assert found[0] == "x" * 300_000 and len(found) == 100_001


def test_a_dictionary_of_any_size(spark):
    """300,000 terms as a table: nothing is refused, nothing is switched."""
    many = spark.range(300_000).select(F.concat(F.lit("詞"), F.col("id").cast("string")).alias("term"), F.lit(1000).alias("cost"))
    found = X.segment_words(spark.createDataFrame([("詞299999詞7", )], "term string"), many).first().parts
    assert found == ["詞299999", "詞7"]


def test_empty_dictionary_and_empty_words(spark):
    none = spark.createDataFrame([], "term string, cost long")
    got = X.segment_words(spark.createDataFrame([("天地x1",), ("",), (None,)], "term string"), none).collect()
    assert sorted(((r.term, r.parts) for r in got), key=repr) == [("", []), ("天地x1", ["天", "地", "x1"]), (None, None)]


def test_costs_follow_counts(spark):
    counts = spark.createDataFrame([("The", 75), ("the", 15), ("rare", 10), ("", 5), (None, 5), ("no", 0)], "term string, searches long")
    assert dict(map(tuple, X.term_costs(counts).collect())) == {"the": 105, "rare": 2303}


def test_dictionary_file(spark, tmp_path):
    (tmp_path / "terms").write_text("研究\t900\n生命\t90\n起源\nbad\tx\n")
    costs = dict(map(tuple, dictionary(spark, str(tmp_path / "terms")).collect()))
    assert set(costs) == {"研究", "生命", "起源", "bad"} and costs["研究"] < costs["生命"] < costs["起源"] == costs["bad"]


def test_counts_are_added_up_per_term(spark):
    log = spark.createDataFrame([("u", "研究生命"), ("u", "研究生命 研究"), ("v", "生命"), (None, "研究"), ("v", None)], "user_id string, query string")
    cut = S.by_dictionary(HAN)
    assert dict(map(tuple, S.term_counts(log, cut=cut).collect())) == {"研究": 4, "生命": 3}
    pairs = {(r.user_id, r.term): r.searches for r in S.user_term_counts(log, cut=cut).collect()}
    assert pairs == {("u", "研究"): 3, ("u", "生命"): 2, ("v", "生命"): 1, (None, "研究"): 1}
    table = spark.createDataFrame(list(HAN.items()), "term string, cost long")
    assert {(r.user_id, r.term): r.searches for r in S.user_term_counts(log, cut=S.by_table(table)).collect()} == pairs
