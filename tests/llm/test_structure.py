"""Conversation repair, language profiles and the manifest beside plain versions."""

import random
import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

import brute
from riverglass.llm import conversation_repair as repair
from riverglass.llm import merkle_manifest as merkle
from riverglass.llm import rank_profiles as profiles
from riverglass.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def given(name, *columns):
    return [tuple(r[c] for c in columns) for r in ds.dataset(f"{SMALL}/{name}.parquet").to_table().to_pylist()]


# --- conversations ---------------------------------------------------------------------------

def talk(spark, rows):
    """Conversations with an extra column whose name the operator uses itself."""
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, gone string")


def by_conv(df):
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}
    return got


def test_repair_of_the_whole_table(spark):
    rows = given("conversations", "conv_id", "turn", "role", "text")
    got = QUERIES["op11_conversation_repair"](spark, SMALL)
    assert got.columns == ["conv_id", *COLUMNS]
    assert by_conv(got) == {c: brute.repaired(r) for c, r in brute.damage(rows).items()}


def made_up(seed, convs, longest):
    random.seed(seed)
    roles, texts = ("user", "assistant", "system", "uncle", "tool", "User"), ("Yes.", "No", "", " \t", "Well?", "Hm!", "so")
    return [(c, t, random.choice(roles[:3] if random.random() < .8 else roles), random.choice(texts))
            for c in range(convs) for t in range(random.randrange(1, longest))]


@pytest.mark.parametrize("limits", [(2000, 500), (0, 3), (4, 1)])
def test_repair_of_odd_talk_in_blocks_and_whole(spark, monkeypatch, limits):
    monkeypatch.setattr(repair, "LONG", limits[0])
    monkeypatch.setattr(repair, "BLOCK", limits[1])
    rows = made_up(3, 120, 24)
    rows += [(None, 1, "user", "A null id."), (None, 2, "assistant", "Is one of its own."), (900, None, "user", "No turn."),
             (900, None, None, None), (900, 7, "assistant", "So."), (901, 3, "", "Empty role."), (902, 5, "user", None),
             (903, -2, "user", "é? "), (903, 9, "assistant", "\x1f")]
    rows.append((904, next(t for t in range(99) if zlib.crc32(f"904:{t}".encode()) % 20 == 0), "user", "Dropped."))
    want = {c: brute.repaired(r) for c, r in brute.damage(rows).items()}
    assert by_conv(repair.repair_report(talk(spark, rows).repartition(3))) == want
    assert any(not v[6] for v in want.values())


def test_repair_of_repeated_and_dropped_rows(spark):
    rows = [(5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 1, "assistant", "Tied."), (6, 2, "user", "x" * 300_000 + ".")]
    df = talk(spark, rows + [(7, 0, "user", "Gone.")]).drop("gone").withColumn("gone", F.col("conv_id") == 7)
    got = by_conv(repair.repair(df))
    assert got[5][1:7] == (0, 1, 0, 1, 4, "RRD")
    assert got[7] == (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    assert got[6][5:7] == (2, "D")
    empty = repair.repair_report(talk(spark, []))
    assert empty.columns == ["conv_id", *COLUMNS] and empty.count() == 0


def test_search_is_exhaustive():
    """Against every list of edits of short conversations, one after the other."""
    random.seed(8)
    for _ in range(400):
        rows = [(i, random.choice(("user", "assistant", "system", "tool")), random.choice(("Yes.", "No", "", "Well?")))
                for i in range(random.randrange(7))]
        seen = set()
        faults = [repair.fault(r, t, seen) for _, r, t in rows]
        cost, audit = repair.search([(r[0], f) for (_, r, _), f in zip(rows, faults)])
        assert (cost, audit.decode()) == brute.repaired(rows)[5:7]


def test_search_between_states_chains():
    random.seed(9)
    for _ in range(100):
        rows = [(random.choice("suat"), random.randrange(4)) for _ in range(random.randrange(2, 14))]
        cut = random.randrange(1, len(rows))
        ways = []
        for middle in repair.STATES:
            one, two = repair.search(rows[:cut], ends=(middle,)), repair.search(rows[cut:], begin=middle)
            if one and two:
                ways.append((one[0] + two[0], one[1] + two[1]))
        assert min(ways) == repair.search(rows)


def test_long_conversations_stay_cheap():
    rows = [("ua"[i % 2] if i % 7 else "t", random.Random(i).choice((0, 0, 0, 1, 2, 3))) for i in range(2000)]
    assert len(repair.search(rows)[1]) >= 2000


# --- languages -------------------------------------------------------------------------------

def texts(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_languages_as_brute(spark):
    rows = given("documents", "doc_id", "text", "lang")
    known = brute.language_profiles(rows)
    got = {r.doc_id: r for r in QUERIES["op12_rank_profiles"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        lang, score = brute.language(known, t)
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-9


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = profiles.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    row = found.agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert row[0] > 200 and row[1] > 0.97


def test_languages_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(profiles, "PIECE", 50)
    rows = [(1, "Der Hund und die Katze. " * 40, "de"), (3, "the dog and the cat " * 40, "en"), (None, "the dog", "xx"),
            (4, None, "de"), (5, "", "de"), (6, " 12 _ ! ", "en"), (7, "the cat", None), (7, "the cat", None), (8, "日本 語", None)]
    got = profiles.languages(texts(spark, rows))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in got.collect()), key=repr)
    known = brute.language_profiles(rows)
    assert found == sorted(((i, *(lambda x: (x[0], round(x[1], 9)))(brute.language(known, t))) for i, t, _ in rows), key=repr)
    assert [f[1] for f in found if f[0] in (4, 5, 6)] == ["und"] * 3
    assert profiles.languages(texts(spark, [])).count() == 0
    assert {r.lang_pred for r in profiles.languages(texts(spark, [(1, "abc", None)])).collect()} == {"und"}


def test_pieces_count_like_the_whole(monkeypatch):
    text = " ".join(random.Random(4).choice(("Straße", "été", "l'eau", "x1y", "I")) for _ in range(3000))
    whole = profiles.gram_counts(text)
    monkeypatch.setattr(profiles, "PIECE", 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, profiles.gram_counts(text)))


def test_profiles_of_a_sample(spark):
    """A bound far below the number of documents still tells the languages apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = profiles.languages(docs, per_language=20).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


# --- manifest --------------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def proofs(df):
    return sorted((tuple(r[c] for c in PROOF) for r in df.collect()), key=repr)


def test_manifest_of_the_whole_table(spark):
    assert proofs(QUERIES["op13_merkle_manifest"](spark, SMALL)) == brute.manifest(given("documents", *FIELDS))


def test_manifest_of_odd_rows(spark):
    """A source of three levels, sources of one row and of exactly one run, nulls, repeats and more than 16 sources."""
    rows = [(i, "big", "en", i, f"Text {i}") for i in range(300)] + [(1000 + i, f"s{i}", None, None, "One") for i in range(20)]
    rows += [(2000 + i, "run", "de", 1, "RUN") for i in range(16)] + [(None, None, None, None, None)] * 3
    rows += [(7, "big", "en", 7, "Text 7"), (7, "big", "en", 7, "Other"), (-5, "é", "fr", 0, ""), (40, "long", "x", 1, "Ä" * 400_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, "
                               "leaf string, rank int").repartition(7)
    assert proofs(merkle.proof_report(df)) == brute.manifest(rows)
    assert proofs(merkle.proof_report(df.limit(0))) == []
    assert proofs(merkle.proof_report(df.where("source = 'long'"))) == brute.manifest(rows[-1:])


def test_proofs_of_some_leaves(spark):
    rows = [(i, "ab"[i % 3 == 0], "en", i, f"Text {i}") for i in range(500)]
    tree = merkle.build(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    wanted = tree.table("leaves").where("doc_id in (0, 17, 499)").select("tree", "rank", "doc_id", "leaf")
    got = merkle.prove(tree, wanted).withColumn("root", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert sorted(r.doc_id for r in got) == [0, 17, 499]
    assert all(r.root == tree.root and r.digest == r.leaf for r in got)


def test_damaged_record_is_noticed(spark):
    rows = [(i, "a", "en", i, f"Text {i}") for i in range(40)]
    tree = merkle.build(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    path = f"{tree.folder}/sources/height=1"
    bad = spark.read.parquet(path).withColumn("children", F.reverse("children")).collect()
    spark.createDataFrame(bad, spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
    with pytest.raises(Exception, match="damaged record"):
        merkle.prove(tree, tree.table("leaves").select("tree", "rank")).collect()
