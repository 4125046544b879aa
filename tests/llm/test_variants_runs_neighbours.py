"""Spelling groups, periodic runs and nearest neighbours against brute force and on edge cases: nulls, empty and long
texts, ties, repeated rows, empty tables and further columns whose names clash with the operator's own."""

import os
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from gearledger.llm import kmeans_tree, periodic_runs, spelling
from gearledger.llm import queries as llm
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, n long, word string, runs string, leaf long"


def frame(spark, texts, first=0):
    rows = [(i, t, 1, "x", "y", 2) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# --- spelling ------------------------------------------------------------------------------

def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows, every):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").encode().lower().decode()):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def plain_groups(words):
    out = {}
    for w, n in words.items():
        near = sorted((-m, x) for x, m in words.items() if plain_near(w, x))
        best = near[0] if near and -near[0][0] >= 2 * n else None
        out[w] = (n, len(near), best[1] if best else None, -best[0] if best else None)
    rows = set()
    for w, (n, count, form, form_n) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, n, count, form, form_n, root))
    return rows


@pytest.mark.parametrize("few", [0, 1000])
def test_scan_finds_all_pairs(few):
    r = random.Random(3)
    for _ in range(300):
        start = r.choice(["", "x", "ab", "aaa"])
        def some(n):
            return [start + "".join(r.choice("abé") for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, n))]
        listed, asked = sorted(set(some(40))), some(20)
        found = list(zip(*spelling.one_edit_pairs(listed, asked, len(start), few)))
        assert sorted(found) == [(i, j) for i, a in enumerate(listed) for j, b in enumerate(asked) if plain_near(a, b)]


def test_scan_passes_over_far_ranges():
    """Asking for one word among many reads few letters, as words behind a prefix too far away are passed over."""
    listed = sorted({"".join(random.Random(i).choices("abcdefghij", k=8)) for i in range(5000)})
    read = []

    class Counted(str):
        def __getitem__(self, at):
            read.append(at)
            return str.__getitem__(self, at)

    common = [0, *(len(os.path.commonprefix(x)) for x in zip(listed, listed[1:]))]
    spelling._scan_for_one([Counted(w) for w in listed], common, "abcdefgh", 0)
    assert len(read) < 2500


def mixed_texts():
    r = random.Random(9)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(3, 7))) for _ in range(400)]
    texts = [" ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=150)) for _ in range(40)]
    return [None, "", " \n", "ÉCOLE école ECOLE ecole", "x" * 30000, "a1b2c3 foo_bar 中文 \U0001f600",
            " ".join(words * 30), *texts, texts[0]]


def test_spelling_groups(spark):
    texts = mixed_texts()
    docs = frame(spark, texts).union(frame(spark, ["nulls nulls nulls"]).selectExpr(
        "CAST(NULL AS LONG)", "text", "n", "word", "runs", "leaf"))
    wanted = plain_words([*enumerate(texts), (None, "nulls nulls nulls")], 7)
    counted = spelling.word_counts(docs, noise_every=7)
    assert {tuple(x) for x in counted.collect()} == set(wanted.items())
    rows = plain_groups(wanted)
    assert any(x[2] for x in rows) and any(x[3] and x[5] != x[3] for x in rows)
    assert {tuple(x) for x in spelling.spelling_groups(counted).collect()} == rows
    # The same with cells of a few words, so that most groups are dealt to several cells.
    assert {tuple(x) for x in spelling.spelling_groups(counted, cell_words=4).collect()} == rows


def test_spelling_counts_are_whole_when_workers_hold_little(spark, monkeypatch):
    texts = mixed_texts()
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = spelling._count(None, 5)(iter(frame(spark, texts).selectExpr("'1' AS name", "text").toArrow().to_batches()))
    total = Counter()
    for batch in rows:
        for word, n in zip(*(c.to_pylist() for c in batch.columns)):
            total[word] += n
    assert {w: n for w, n in total.items() if n >= 3} == plain_words(enumerate(texts), None)


def test_spelling_edges(spark):
    def groups(*rows):
        return sorted(tuple(x) for x in spelling.spelling_groups(
            spark.createDataFrame(list(rows), "word string, n long, form string, root string")).collect())

    assert groups() == []
    assert groups((None, 3, "", ""), ("words", None, "", "")) == []
    # Ties go to the smaller word; a form needs twice the count, and roots follow the chain.
    assert groups(("words", 4, "q", "q"), ("wordz", 8, "q", "q"), ("wordy", 8, "q", "q"), ("wordyy", 16, "q", "q")) == [
        ("words", 4, 2, "wordy", 8, "wordyy"), ("wordy", 8, 3, "wordyy", 16, "wordyy"),
        ("wordyy", 16, 1, None, None, "wordyy"), ("wordz", 8, 2, None, None, "wordz")]
    assert groups(("words", 5, "", ""), ("wordz", 9, "", "")) == [
        ("words", 5, 1, None, None, "words"), ("wordz", 9, 1, None, None, "wordz")]
    assert spelling.word_counts(frame(spark, [])).collect() == []


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(70)], "word string, form string")
    assert {r.root for r in spelling.roots(chain).collect()} == {"w070"}


# --- periodic runs -------------------------------------------------------------------------

def plain_runs(x, least=6):
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 4 * q):
                s = x[i : i + size]
                if not any(s[d:] == s[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda t: (t[0], t[2]))


def periodic_words(r):
    k = r.choice([1, 2, 3, 6])
    x = [r.randrange(k) for _ in range(r.randint(0, 60))]
    for _ in range(r.randint(0, 3)):
        block = [r.randrange(k) for _ in range(r.randint(1, 9))]
        i = r.randint(0, len(x))
        x[i:i] = (block * r.randint(2, 8))[: r.randint(1, 60)]
    return x


@pytest.mark.parametrize("least", [4, 6, 11])
def test_runs_are_all_found(least):
    r = random.Random(4)
    for _ in range(1500):
        x = periodic_words(r)
        assert periodic_runs.periodic_runs(np.array(x, np.int64), least) == plain_runs(x, least)


def test_runs_of_very_long_texts():
    assert periodic_runs.periodic_runs(np.zeros(300_000)) == [(0, 300_000, 1)]
    block = np.random.default_rng(1).permutation(50_000)
    assert periodic_runs.periodic_runs(np.tile(block, 5)) == [(0, 250_000, 50_000)]
    # A cube of a long block has too few periods; two-letter words that avoid cubes have no run at all.
    assert periodic_runs.periodic_runs(np.tile(block, 3)) == []
    cube_free = [bin(i).count("1") % 2 for i in range(1 << 14)]
    assert periodic_runs.periodic_runs(np.array(cube_free)) == []


def plain_planted(doc_id, text):
    words = (text or "").encode().split()
    h = crc32(str(doc_id).encode())
    if h % 10 == 0 and words and doc_id is not None:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_find_runs(spark):
    r = random.Random(8)
    texts = [" ".join("w%d" % w for w in periodic_words(r)) for _ in range(120)]
    texts += [None, "", " \n\t ", "one", "x " * 40, "la la la la la", "é É " * 20, "ab " * 60000, "w" * 50000]
    rows = [*enumerate(texts), (None, "a b " * 9), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], SCHEMA).repartition(3)
    found = periodic_runs.find_runs(docs)
    assert found.columns == ["doc_id", "runs", "collapsed_text"]
    got = Counter((x.doc_id, tuple(tuple(y) for y in x.runs), x.collapsed_text) for x in found.collect())
    wanted = Counter()
    for i, t in rows:
        words = (t or "").encode().split()
        runs = [(0, 60000, 1)] if len(words) == 60000 else plain_runs(words)
        wanted[i, tuple(runs), plain_collapsed(words, runs)] += 1
    assert got == wanted
    planted = periodic_runs.with_planted_runs(docs).collect()
    assert Counter((x.doc_id, tuple((x.text or "").encode().split())) for x in planted) == Counter(
        (i, tuple(plain_planted(i, t))) for i, t in rows)
    assert any(plain_planted(i, t) != (t or "").encode().split() for i, t in rows)
    none = frame(spark, [])
    assert periodic_runs.find_runs(none).collect() == [] and periodic_runs.with_planted_runs(none).collect() == []


def test_strongest_run(spark):
    r = random.Random(2)
    lists = [[(r.randrange(9), r.randint(6, 40), r.randint(1, 4)) for _ in range(r.randint(0, 5))] for _ in range(200)]
    lists = [sorted(x, key=lambda t: (t[0], t[2])) for x in lists]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], f"i long, runs {periodic_runs._RUNS}")
    for row in rows.withColumn("best", periodic_runs.strongest("runs")).collect():
        runs = lists[row.i]
        best = max(runs, key=lambda t: (Fraction(t[1], t[2]), -t[0], -t[2])) if runs else None
        assert (tuple(row.best) if row.best else None) == best


# --- nearest neighbours --------------------------------------------------------------------

def cosines(rows, asked):
    ids = np.array([i for i, _ in rows])
    cells = np.array([v for _, v in rows], float)
    norms = np.linalg.norm(cells, axis=1)
    at = {i: v for i, v in reversed(rows)}
    out = {}
    for q in asked:
        v = np.array(at[q], float)
        score = (cells * v).sum(axis=1) / norms / np.linalg.norm(v)
        out[q] = sorted(((-round(s, 12), i) for i, s in zip(ids.tolist(), score.tolist()) if i != q))
    return out


def test_neighbours_of_the_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = llm.queries()["op13_nearest_neighbours"](spark, SMALL).collect()
    asked = sorted(i for i, _ in rows if i % 50 == 0)
    truth = cosines(rows, asked)
    assert sorted((r.query_id, r.rank) for r in found) == [(q, k) for q in asked for k in range(1, 6)]
    exact = {(q, i): -s for q, near in truth.items() for s, i in near}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-9 for r in found)
    hits = {(r.query_id, r.vec_id) for r in found}
    assert sum((q, i) in hits for q in asked for _, i in truth[q][:5]) >= 0.9 * 5 * len(asked)


def test_recall_is_calibrated_on_a_tree_with_levels(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12))
    cells = (centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 12))).round(6)
    rows = list(enumerate(cells.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = kmeans_tree.nearest(frame, frame.where("vec_id % 50 = 0"), 5, leaf_rows=40, cell_rows=64).collect()
    truth = cosines(rows, range(0, 4000, 50))
    hits = {(r.query_id, r.vec_id) for r in found}
    assert len(found) == 400
    assert sum((q, i) in hits for q, near in truth.items() for _, i in near[:5]) >= 0.9 * 400
    # The tree has levels, and far from all leaves are visited.
    unit = kmeans_tree._units(cells)
    tree = kmeans_tree.fit_tree(unit, 100)
    leaf = tree.leaf_of(unit)
    assert tree.leaves > 50 and len(tree.leaf) > tree.leaves + kmeans_tree.BRANCHES
    assert sorted(tree.visits(unit[7], tree.leaves)) == list(range(tree.leaves)) and tree.visits(unit[7], 1) == [leaf[7]]
    held = spark.createDataFrame([([i], v, int(x)) for (i, v), x in zip(rows, leaf)],
                                 "ids array<long>, cells array<double>, leaf long")
    few, low = kmeans_tree.calibrated_visits(held, tree, 12, 5, 0.5)
    many, high = kmeans_tree.calibrated_visits(held, tree, 12, 5, 0.97)
    assert few <= many < tree.leaves // 2 and low >= 0.5 and high >= 0.97
    assert kmeans_tree.calibrated_visits(held, tree, 12, 5, 1.0)[1] == 1.0


def test_neighbour_edges(spark):
    kind = "vec_id long, embedding array<float>, leaf int, score double, ids string"

    def run(rows, k=3, step=1, **more):
        frame = spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], kind).repartition(2)
        found = kmeans_tree.nearest(frame, frame.where(f"vec_id % {step} = 0"), k, **more)
        return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in found.collect())

    assert run([]) == []
    inf, nan = float("inf"), float("nan")
    bad = [(7, None), (8, [0.0, 0.0]), (9, [None, 1.0]), (10, [inf, 1.0]), (11, [nan, 1.0]), (12, []), (None, [1.0, 1.0])]
    assert run(bad) == []
    assert run([(1, [1.0, 0.0]), *bad]) == []
    # Fewer candidates than asked for, ties by id, scaled copies, vectors of other lengths, a repeated row.
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0, 0.0]), (5, [-1e-20, 0.0])]
    assert run([*rows, *bad], 9) == [
        (1, 1, 2, 1), (1, 2, 3, 1), (1, 3, 4, 0), (1, 4, 5, -1), (2, 1, 1, 1), (2, 2, 3, 1), (2, 3, 4, 0), (2, 4, 5, -1),
        (3, 1, 1, 1), (3, 2, 2, 1), (3, 3, 4, 0), (3, 4, 5, -1), (4, 1, 1, 0), (4, 2, 2, 0), (4, 3, 3, 0), (4, 4, 5, 0),
        (5, 1, 4, 0), (5, 2, 1, -1), (5, 3, 2, -1), (5, 4, 3, -1)]
    # A vector that stands very often: the smallest ids come first, and every query still gets its neighbours.
    many = [(i, [1.0, 2.0, 3.0]) for i in range(3000)] + [(i, [1.0, float(i % 7), 3.0]) for i in range(3000, 3040)]
    found = run(many, step=500, leaf_rows=4, cell_rows=8)
    assert found[:3] == [(0, 1, 1, 1), (0, 2, 2, 1), (0, 3, 3, 1)] and len(found) == 3 * 7


def test_no_query_goes_short_when_leaves_are_small(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 6)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = kmeans_tree.nearest(frame, frame, 40, recall=0.01, leaf_rows=10)
    assert found.count() == 300 * 40


def test_neighbours_are_found_over_many_partitions(spark):
    rng = np.random.default_rng(8)
    rows = list(enumerate(rng.normal(size=(2000, 8)).tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        found = kmeans_tree.nearest(frame, frame.where("vec_id % 50 = 0"), 5, leaf_rows=100, cell_rows=64).collect()
    finally:
        for c, value in old.items():
            spark.conf.set(c, value)
    truth = cosines(rows, range(0, 2000, 50))
    hits = {(r.query_id, r.vec_id) for r in found}
    assert len(found) == 200
    assert sum((q, i) in hits for q, near in truth.items() for _, i in near[:5]) >= 0.9 * 200


def test_queries_unlike_the_other_rows_find_their_neighbours(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 16))
    cells = centres[rng.integers(0, 20, 4000)] + 0.02 * rng.normal(size=(4000, 16))
    cells[::50] = rng.normal(size=(80, 16))
    rows = list(enumerate(cells.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = kmeans_tree.nearest(frame, frame.where("vec_id % 50 = 0"), 5, leaf_rows=40).collect()
    truth = cosines(rows, range(0, 4000, 50))
    hits = {(r.query_id, r.vec_id) for r in found}
    assert sum((q, i) in hits for q, near in truth.items() for _, i in near[:5]) >= 0.9 * 400
