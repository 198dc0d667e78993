"""The operators beside plain versions, and their results for nulls, empty tables, ties and repeats."""

import hashlib
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import brute
from riverglass.llm import (
    components, decontaminate, line_crf, line_dedup, mixing, multi_index, phrase_automata, repeats,
    simhash_bktree, suffix_buckets, toxicity, warc)
from riverglass.llm.queries import QUERIES
from riverglass.session import work_dir

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, bucket string, copy int"


def prose(seed, n):
    random.seed(seed)
    return " ".join(random.choice("alpha beta gamma delta omega sigma kappa rho tau zeta eta".split())
                    + str(random.randrange(40)) for _ in range(n))


def table(spark, rows):
    """Documents of (doc_id, text[, source]) with extra columns whose names operators use themselves."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 7, "x", 9) for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Copies, near copies, shared passages, a long text, periodic text, blanks, empty and null texts."""
    base = prose(1, 300)
    rows = [(i, prose(100 + i, 120)) for i in range(12)]
    rows += [(20, base), (21, base), (22, base.replace("alpha1 ", "beta9 ")), (23, "start " + base[:900]),
             (24, prose(5, 40) + "\n" + base[500:1300] + "\n" + prose(6, 40)), (25, "ab" * 400), (26, "a" * 350),
             (27, "x " * 130), (28, ""), (29, None), (30, " \t\n "), (31, "one two"), (32, "é" * 90 + base[:300]),
             (33, "\n".join(["The quick brown fox jumps over it.", "The quick brown fox jumps over it!",
                             "The quick brown fox jumped over it.", "Another line that is long enough"])),
             (34, "\n".join(["The quick brown fox jumps over it.", "Another line that is long enoug",
                             "hAnother line that is long enough", "short", "short", ""])),
             (35, prose(7, 9000) + " " + base)]
    return rows


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_simhash_as_brute(spark, odd):
    got = by_id(simhash_bktree.near_duplicates(table(spark, odd)), "fingerprint", "component_id")
    assert got == brute.near_groups(odd)
    assert got[28] == got[29] == got[30] == ("0" * 16, 28)


def test_bktree_shards_and_overflow(spark, monkeypatch):
    random.seed(3)
    base = random.getrandbits(64)
    values = {random.getrandbits(64) for _ in range(300)}
    for _ in range(300):
        values.add(base ^ sum(1 << b for b in random.sample(range(64), random.randrange(4))))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    monkeypatch.setattr(simhash_bktree, "SHARD", 40)
    found = components.components(simhash_bktree.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2))
    got = {r.node & (2**64 - 1): r.root for r in found.collect()}
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for k, a in enumerate(ordered):
        for b in ordered[:k]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    for k, a in enumerate(ordered):
        for b in ordered[:k]:
            assert (root(a) == root(b)) == (got.get(a, a) == got.get(b, b))


def test_keep_one(spark, odd):
    docs = table(spark, odd + [(20, odd[12][1])])
    kept = simhash_bktree.keep_one(docs)
    want = sorted({g for _, g in brute.near_groups(odd).values()})
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == want


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_substring_and_phrase_removal(spark, odd, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 8000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 8000)
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    docs = table(spark, odd).repartition(5)
    got = by_id(suffix_buckets.removal_report(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.substring_removal(odd)
    got = by_id(phrase_automata.removal_report(docs), "n_words", "n_removed", "kept_sha256")
    assert got == brute.phrase_removal(odd)


def test_the_automata_decide(spark, odd, monkeypatch):
    """Without what they find, no word goes; a passage that a document doesn't have removes nothing."""
    docs = table(spark, odd)
    assert sum(r.n_removed for r in phrase_automata.removal_report(docs).collect()) > 500
    words = [f"w{i}".encode() for i in range(120)]
    other = [*words[:60], b"else", *words[61:]]
    wanted = {tuple(words[5:70]): 1, tuple(words[20:90]): 7}
    gone = phrase_automata.located([(5, words), (9, words), (1, words), (9, other), (9, words[20:90])], wanted)
    assert [int(g.sum()) for g in gone] == [65, 85, 0, 0, 70]
    monkeypatch.setattr(phrase_automata, "AUTOMATON_WORDS", 66)
    assert len(list(phrase_automata.automata(wanted))) == 2
    again = phrase_automata.located([(5, words), (9, words), (1, words), (9, other), (9, words[20:90])], wanted)
    assert all((a == b).all() for a, b in zip(gone, again))


def test_no_automata_no_removal(spark, odd, monkeypatch):
    monkeypatch.setattr(phrase_automata, "_passages", lambda texts, requests, window: requests.limit(0))
    assert sum(r.n_removed for r in phrase_automata.removal_report(table(spark, odd)).collect()) == 0


def test_repeated_rows_are_looked_at_once(spark, odd):
    """A third of the table is one row, and there are rows without id: each copy gets the row's result."""
    base = odd[12][1]
    rows = [*odd, *[(23, odd[15][1])] * 20, (None, base), (None, base), (40, base)]
    docs = table(spark, rows).repartition(3)
    for report, brute_of in ((phrase_automata.removal_report, brute.phrase_removal), (suffix_buckets.removal_report, brute.substring_removal)):
        got = sorted((tuple(r) for r in report(docs).collect()), key=repr)
        want = brute_of([(-1 if i is None else i, t) for i, t in dict.fromkeys(rows)])
        assert got == sorted(((i, *want[-1 if i is None else i]) for i, _ in rows), key=repr)
    assert phrase_automata.removal_report(table(spark, [])).count() == suffix_buckets.removal_report(table(spark, [])).count() == 0


def test_common_anchor_is_dealt_by_class(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    line = prose(50, 12)
    rows = [(i, prose(1000 + i, 30) + " " + line + " " + prose(2000 + i % 7, 30)) for i in range(60)]
    got = by_id(suffix_buckets.removal_report(table(spark, rows)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.substring_removal(rows)
    assert any(v[1] for v in got.values())


def test_anchors_are_leftmost_minima():
    random.seed(1)
    order = np.array([random.randrange(50) << 30 for _ in range(500)], np.uint64)
    for width in (1, 2, 7, 8, 51):
        want = [i + int(np.argmin(order[i:i + width])) for i in range(len(order) - width + 1)]
        assert repeats.anchors(order, width).tolist() == want


def test_line_removal_as_brute(spark, odd):
    rows = [r for r in odd if r[0] != 25]
    got = by_id(line_dedup.line_report(table(spark, rows)), "n_lines", "n_removed", "kept_sha256")
    want = {k: (a, b, hashlib.sha256(t.encode()).hexdigest()) for k, (a, b, t) in brute.line_removal(rows).items()}
    assert got == want
    assert got[33][1] == 1 and got[34][1] == 4  # the second "short" too


def test_line_removal_on_edits_everywhere(spark):
    random.seed(9)
    rows = []
    for i in range(120):
        line = "".join(random.choice("abc") for _ in range(random.choice((20, 21, 33, 80))))
        for _ in range(3):
            kind, at = random.randrange(4), random.randrange(len(line))
            other = (line[:at] + line[at + 1:], line[:at] + "z" + line[at:], line[:at] + "y" + line[at + 1:],
                     line[:at] + "y" + line[at + 1:-1] + "w")[kind]
            rows.append((random.randrange(10**6), line + "\n" + other if random.random() < .5 else other))
    rows = list({r[0]: r for r in rows}.values())
    got = by_id(line_dedup.line_report(table(spark, rows)), "n_lines", "n_removed")
    assert got == {k: v[:2] for k, v in brute.line_removal(rows).items()}


def test_short_lines_go_if_equal(spark):
    rows = [(1, "Les.\n\n}\nLes.\nLet."), (2, "}\n \n\nA line of twenty chars\nLes."), (3, "Les.\n}"), (4, " ")]
    left = line_dedup.dedup_lines(table(spark, rows))
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [
        (1, "Les.\n\n}\nLet."), (2, " \n\nA line of twenty chars"), (4, " ")]


@pytest.mark.parametrize("edits_from", [0, 5, 60])
def test_line_removal_from_other_lengths(spark, odd, edits_from):
    rows = [r for r in odd if r[0] != 35] + [(60, "abc\nabd\nabcd\n12\n13\n\n \n2"), (61, "12\nabc \nb")]
    got = by_id(line_dedup.line_report(table(spark, rows), edits_from), "n_lines", "n_removed")
    assert got == {k: v[:2] for k, v in brute.line_removal(rows, edits_from).items()}


def test_very_long_lines(spark):
    # lines of 150,000 characters: one replaced, one inserted, one deleted, two apart, and one of 40,000
    line = prose(3, 30000)[:150000]
    other = [line[:100000] + "#" + line[100001:], line[:77] + "#" + line[77:], line[:-1], "#" + line[1:-1] + "#", line[:40000]]
    rows = [(1, line)] + [(k, x) for k, x in enumerate(other, 2)] + [(9, other[4][:20000] + other[4][20001:])]
    start = time.monotonic()
    got = by_id(line_dedup.line_report(table(spark, rows)), "n_removed")
    assert got == {1: (0,), 2: (1,), 3: (1,), 4: (1,), 5: (0,), 6: (0,), 9: (1,)}
    assert time.monotonic() - start < 180


def test_no_documents_no_lines(spark):
    assert line_dedup.line_report(table(spark, [])).count() == line_dedup.dedup_lines(table(spark, [])).count() == 0


def test_deduped_documents(spark):
    rows = [(1, "A line of twenty chars\nend"), (2, "A line of twenty chars"), (3, ""), (4, None),
            (None, "A line of twenty char\nof no id"), (1, "A line of twenty chars\nend")]
    docs = table(spark, rows)
    left = line_dedup.dedup_lines(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, "end"), (1, "end"), (3, ""), (4, None), (None, "A line of twenty char\nof no id")], key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in rows], "page_id long, url string, html string")


def test_warc_round_trip(spark, monkeypatch):
    big, half = "é" * 600, "x" * 999
    rows = [(i, f"<p>{i}</p>" * (i % 400)) for i in range(300)]
    rows += [(1000, big), (1001, big), (5, "y" * 1000), (6, "y" * 1000), (1002, half), (1003, half), (1004, None), (1005, "")]
    rows = list(dict(rows).items())
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    folder = work_dir(spark, "warc-test")
    manifest = warc.write(pages(spark, rows), folder, roll=2000)
    first = sorted(map(tuple, manifest.collect()))
    got = {r.page_id: r for r in warc.read(spark, folder).collect()}
    assert {k: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for k, r in got.items()} == brute.archive(rows)
    assert all(bytes(r.payload).decode() == (dict(rows)[k] or "") for k, r in got.items() if r.record_type == "response")
    assert len(first) > 5 and all(r[2] > 0 for r in first)
    again = work_dir(spark, "warc-test")
    assert sorted(map(tuple, warc.write(pages(spark, rows).repartition(7), again, roll=2000).collect())) == first


def test_warc_odd_rows(spark):
    same = "z" * 2000
    folder = work_dir(spark, "warc-test")
    rows = [(7, same), (7, same), (None, same), (None, None)]
    got = sorted(map(tuple, warc.round_trip(pages(spark, rows), folder).collect()), key=repr)
    assert [(r[0], r[1], r[3], r[4]) for r in got] == sorted(
        [(7, 2000, "response", None), (7, 2000, "revisit", 7), (None, 2000, "revisit", 7), (None, 0, "response", None)], key=repr)
    assert warc.round_trip(pages(spark, []), work_dir(spark, "warc-test")).count() == 0


@pytest.mark.parametrize("odd_ids", [[], [None], [10**17], [None, 10**17, -(10**15)]])
def test_warc_shards_hold_equal_bytes(spark, monkeypatch, odd_ids):
    """One null id or one far id does not crowd the others into one shard, nor do 200 null ids."""
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    rows = [(i, prose(i, 100)) for i in range(300)] + [(i, "odd") for i in odd_ids] + [(None, prose(900 + i, 100)) for i in range(200 * (None in odd_ids))]
    folder = work_dir(spark, "warc-test")
    manifest = warc.write(pages(spark, rows), folder).groupBy("shard").agg(F.sum("records").alias("n")).collect()
    total = sum(len(h) for _, h in rows)
    assert abs(len(manifest) - total / 20_000) <= 2 and sum(r.n for r in manifest) == len(rows)
    assert max(r.n for r in manifest) < 60
    got = sorted(((r.page_id, r.payload_digest) for r in warc.read(spark, folder).collect()), key=repr)
    assert got == sorted(((i, hashlib.sha1(h.encode()).hexdigest()) for i, h in rows), key=repr)


def test_warc_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 20_000)
    folder = work_dir(spark, "warc-test")
    warc.write(pages(spark, [(i, prose(i, 100)) for i in range(300)]).repartition(4), folder)
    parts = [p for p in spark.read.format("binaryFile").load(f"{folder}/_manifest").select("path", "length").collect() if p.length]
    assert len(parts) > 1


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination(spark):
    bench = [(i, prose(300 + i, 25).capitalize() + ". " + prose(400 + i, 8).capitalize() + ".") for i in range(40)]
    rows = [(i, prose(600 + i, 200)) for i in range(20)]
    rows += [(50, prose(1, 90) + " " + bench[3][1].upper() + " " + prose(2, 90)), (51, bench[4][1]),
             (52, prose(8, 300) + bench[5][1].split(". ")[0]), (53, None), (54, ""), (None, bench[6][1])]
    docs, table_ = table(spark, rows), items(spark, bench + [(99, None), (98, "")])
    found = {(r.doc_id, r.item_id): r for r in decontaminate.report(docs, table_).collect()}
    assert {k for k, r in found.items() if r.contaminated} == {(50, 3), (51, 4), (None, 6)}
    assert not any(r.contaminated for k, r in found.items() if k[0] == 52)
    left = decontaminate.clean(docs, table_)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {*range(20), 52, 53, 54}
    assert decontaminate.clean(docs, items(spark, [])).count() == len(rows)


def test_block_max_wand_finds_what_scoring_all_finds(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 3)
    bench = [(i, prose(i % 30, 6) + " " + prose(500 + i, 5)) for i in range(150)]
    frequency = {}
    for _, t in bench:
        for w in set(decontaminate.tokens(t)):
            frequency[w] = frequency.get(w, 0) + 1
    index = decontaminate.Index(bench, len(bench), 11.0, frequency, 0.4)
    for seed in range(200):
        words = set(decontaminate.tokens(prose(seed % 40, 6) + " " + prose(500 + seed, 3)))
        score = {}
        for w in words & index.postings.keys():
            for at, weight in zip(*index.postings[w]):
                score[at] = score.get(at, 0) + weight
        want = {at for at, s in score.items() if s >= 0.4 - 1e-9}
        assert {at for at, _ in index.search(words)} == want
        assert not want or not index.needed.isdisjoint(words)


@pytest.mark.parametrize("rows, share", [
    ([(None, prose(i, 10), "s") for i in range(100)], 0.75),  # no ids, different texts
    ([(7 if i < 100 else 1000 + i, prose(i, 10), "s") for i in range(300)], 0.67),  # a third of one id
    ([(7, prose(1, 10), "s")] * 100 + [(1000 + i, prose(i, 10), "s") for i in range(200)], 1.5),  # a third is one row
    ([(None, prose(1, 10), "s")] * 100, 0.755)])  # nothing but one row
def test_mixing_comes_near_the_target_whatever_repeats(spark, rows, share):
    """Each document has ten words, so the nearest is within five."""
    docs = table(spark, rows).repartition(5)
    plan = mixing.mixing_plan(docs, share=share).collect()
    assert len(plan) == len(rows)
    assert abs(sum(r.taken for r in plan) - share * 10 * len(rows)) <= 5
    again = mixing.mixing_plan(docs.repartition(3), share=share)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, plan), key=repr)


def test_neighbours_of_far_and_tiny_vectors(spark):
    """Finite components whose squares are not."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(8) * (1e200, 1e-200, 1.0)[i % 3]).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.neighbours(df, F.col("vec_id") % 50 == 0, k=5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute.nearest([(i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in rows])
    assert got.keys() == want.keys() == {0, 50}
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_mixing_as_brute(spark):
    random.seed(4)
    rows = [(i, prose(i, random.randrange(1, 60)), random.choice(["a", "b", "b", "b", "c", "é", None])) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", "zero"), (1002, " ", None)]
    got = by_id(mixing.mixing_plan(table(spark, rows)), "size", "source_size", "target", "taken")
    want = brute.mixing(rows)
    for k, (size, total, goal, taken) in want.items():
        assert got[k][:2] == (size, total) and got[k][2] == pytest.approx(goal) and got[k][3] == taken
    assert sum(v[3] for v in got.values()) == pytest.approx(1.5 * sum(v[0] for v in got.values()), rel=0.05)
    mixed = mixing.mix(table(spark, rows))
    count = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(count.get(k, 0) * v[0] == v[3] for k, v in got.items())


def test_mixing_few_sources(spark):
    assert mixing.mixing_plan(table(spark, [])).count() == 0
    got = by_id(mixing.mixing_plan(table(spark, [(1, "a b", "x"), (2, "c", "x")])), "target", "taken")
    assert got[1][0] == pytest.approx(4.5) and sum(v[1] for v in got.values()) in (3, 4, 5)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_with_odd_rows(spark):
    random.seed(2)
    rows = [(i, [random.gauss(0, 1) for _ in range(8)], 0) for i in range(300)]
    rows += [(i, rows[10][1], 0) for i in range(400, 420)]
    rows += [(50_000, None, 0), (50_050, [0.0] * 8, 0), (50_100, [float("nan")] + [1.0] * 7, 0),
             (50_150, [None] + [1.0] * 7, 0), (50_200, [float("inf")] + [1.0] * 7, 0), (50_250, [1.0] * 3, 0), (None, [1.0] * 8, 0)]
    got = {}
    for r in multi_index.neighbours(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute.nearest([r[:2] for r in rows if r[0] is not None and (r[1] is None or len(r[1]) == 8)])
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in near])
    assert multi_index.neighbours(vectors(spark, []), F.lit(True)).count() == 0


def test_nearest_recall_with_few_visits(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(10, 16))
    rows = [(i, (centers[i % 10] + 0.4 * rng.normal(size=16)).tolist(), 0) for i in range(3000)]
    got = {}
    for r in multi_index.neighbours(vectors(spark, rows), F.col("vec_id") % 50 == 0, visit=900).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    data = [(r.vec_id, r.embedding) for r in vectors(spark, rows).collect()]
    want = brute.nearest(data)
    assert sum(len(got[q] & {i for i, _ in near}) for q, near in want.items()) >= 0.9 * 5 * len(want)


def test_nearest_is_whole_where_a_query_first_visits_few(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = list(enumerate(rng.normal(size=(40_000, 48))))
    assert len(rows) > 6 * multi_index.VISIT
    pq.write_table(pa.table({"vec_id": [i for i, _ in rows], "embedding": [v for _, v in rows]}), tmp_path / "v.parquet")
    table_ = spark.read.parquet(str(tmp_path / "v.parquet"))
    got = {}
    for r in multi_index.neighbours(table_, F.col("vec_id") % 2000 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in near] for q, near in brute.nearest(rows, every=2000).items()}


def test_crf_chain_is_exact():
    rng = np.random.default_rng(5)
    unary, turn = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    weight = np.zeros(6)
    total = 0.0
    for labels in range(64):
        y = [labels >> i & 1 for i in range(6)]
        w = np.exp(sum(unary[0, i] for i in range(6) if y[i]) + sum(turn[a, b] for a, b in zip(y, y[1:])))
        total += w
        weight += w * np.array(y)
    odds, _ = line_crf._chain(unary, np.ones((1, 6), bool), turn)
    assert 1 / (1 + np.exp(-odds[0])) == pytest.approx(weight / total)
    field = line_crf.Field.empty()
    field.turn = turn
    field.unary = lambda bins: unary[0]
    assert field.marginals(np.zeros((6, line_crf.FEATURES), np.uint8)) == pytest.approx(weight / total)


def test_quality_on_held_out_rows(spark):
    docs = [(i, prose(i, 60) if i % 4 else (prose(i, 60).upper().replace(" ", "!! ") if i % 8 else "go go go go " * 40))
            for i in range(400)] + [(500, ""), (501, None)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), None) for i in range(400)] + [(1, None, None), (None, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = by_id(line_crf.quality(table(spark, docs), labels), "held_out", "score", "predicted")
    held = [k for k, v in got.items() if v[0] and k < 400]
    assert len(held) > 50 and all(got[k][2] == int(k % 4 > 0) for k in held)
    assert got[500][1] == got[501][1] and 0 <= got[500][1] <= 1
    none = by_id(line_crf.quality(table(spark, docs[:5]), labels.limit(0)), "score", "predicted")
    assert set(none.values()) == {(0.5, 1)}
    assert line_crf.quality(table(spark, []), labels).count() == 0


def test_quality_of_repeated_ids_and_rows(spark):
    docs = [(i, prose(i, 60) if i % 4 else "GO!! " * 40) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)], "doc_id long, quality int")
    field = line_crf.learn(table(spark, docs), labels)
    # a labelled id with a third of all rows, equal and different, counts as one text
    again = line_crf.learn(table(spark, docs + [docs[3]] * 100), labels)
    assert (again.weights == field.weights).all()
    different = [(3, prose(1000 + i, 30)) for i in range(100)]
    hot = line_crf.learn(table(spark, docs + different), labels)
    assert np.abs(hot.weights - field.weights).max() < 0.5
    got = line_crf.quality(table(spark, docs + [docs[3]] * 5), labels).where("doc_id = 3").select("score").collect()
    assert len(got) == 6 and len(set(got)) == 1


def test_fit_is_bounded_by_chains(spark, monkeypatch):
    given = []
    monkeypatch.setattr(line_crf, "fit_field", lambda chains: given.append(chains) or line_crf.Field.empty())
    docs = table(spark, [(i, "\n".join(["a line"] * 5000)) for i in range(1, 20)])
    labels = spark.createDataFrame([(i, 1) for i in range(1, 20)], "doc_id long, quality int")
    line_crf.learn(docs, labels)
    line_crf.learn(docs, labels, chains=10)
    used = sum(not held for held in (r[0] for r in docs.select(line_crf.held_out(F.col("doc_id"))).collect()))
    assert [len(x) for x in given] == [used * line_crf.PER_TEXT, 10]
    assert all(len(bins) <= line_crf.CHAIN for x in given for bins, _ in x)


@pytest.mark.parametrize("block", [1 << 18, 40])
def test_features_in_blocks_are_those_of_the_whole(monkeypatch, block):
    texts = ["", "\n", "a\n", "a a b\n\n" + "long " * 40 + "long\tLONG\n", prose(2, 90).replace("a1", "\n")]
    whole = [line_crf.line_features(t) for t in texts]
    field = line_crf.Field.empty()
    field.weights = np.random.default_rng(1).normal(size=field.weights.shape)
    field.turn = np.array([[1.0, 0.2], [0.1, 1.3]])
    odds = [field.marginals(bins) for bins, _ in whole]
    monkeypatch.setattr(line_crf, "BLOCK", block)
    for text, (bins, weight), p in zip(texts, whole, odds):
        assert len(bins) == text.count("\n") + 1
        again, sizes = line_crf.line_features(text)
        assert (again == bins).all() and (sizes == weight).all()
        assert field.marginals(bins) == pytest.approx(p)


@pytest.mark.parametrize("text", ["x yz\n" * 500_000, "word " * 600_000])
def test_long_texts_take_bounded_memory(text):
    tracemalloc.start()
    bins, _ = line_crf.line_features(text)
    line_crf.Field.empty().marginals(bins)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * len(text)


def test_severity(spark):
    docs = [(i, prose(i, 60) + (" vile" + str(i % 5) + "ness nasty" * (1 + i % 3) if i % 4 == 0 else "")) for i in range(400)]
    docs += [(500, ""), (501, None), (502, "some vile9ness nasty text")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400) if i % 5] + [(7, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = by_id(toxicity.severity(table(spark, docs), labels), "severity", "grade", "toxic")
    # words with vile0 are in no labelled row
    assert all(got[i][2] == int(i % 4 == 0) for i in range(400) if i % 5)
    assert got[502][2] == 1 and got[500][2] == got[501][2] == 0
    assert by_id(toxicity.severity(table(spark, docs[:3]), labels.limit(0)), "toxic") == {0: (0,), 1: (0,), 2: (0,)}


def test_ordinal_thresholds_rise():
    rng = np.random.default_rng(2)
    rows = [([j for j in range(5) if rng.random() < 0.4], 0) for _ in range(500)]
    rows = [(f, min(3, len(f))) for f, _ in rows]
    weights, cuts = toxicity.fit_severity(rows, 5, 4)
    assert (np.diff(cuts) > 0).all() and (weights > 0).all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_are_registered_and_run(spark, name):
    import __spark_entry__ as contract
    assert name in contract.queries()
    assert QUERIES[name](spark, SMALL).count() > 0


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SMALL)
        if name == "lines":
            given = [(k, t) for k, (n, gone, t) in brute.line_removal(given).items() if gone < n]
        else:
            groups = brute.near_groups(given)
            given = [(k, t) for k, t in given if groups[k][1] == k]
        assert sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()) == sorted(given)
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns) and out.count() > 0
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
