"""License spans, vector codes and periodic runs against brute force, and their odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from partylens.llm import licenses, periodic, vector_codes
from partylens.llm.queries import planted
from partylens.session import stable


def slow_runs(word, least):
    found = {}
    for d in range(1, len(word) // 2 + 1):
        i = d
        while i < len(word):
            s = i
            while i < len(word) and word[i] == word[i - d]:
                i += 1
            if i > s and i - s >= max(least - d, d):
                found.setdefault((s - d, i - s + d), d)
            i += i == s
    return sorted(((s, n, d) for (s, n), d in found.items()), key=lambda r: (r[0], r[2]))


def drawn_words(rng):
    word = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 150))]
    for _ in range(rng.randint(0, 3)):
        if word:
            a, p = rng.randrange(len(word)), rng.randint(1, 30)
            for i in range(a + p, rng.randint(a, len(word))):
                word[i] = word[i - p]
    return word


def test_runs_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [drawn_words(rng) for _ in range(rng.randint(1, 6))]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        least = rng.choice([12, 12, 3, 25])
        got = periodic.find_runs(np.array(sum(texts, []), np.int64), bounds, least, rng.choice([1, 9, 1 << 20]))
        assert got.tolist() == [[s + b, n, d] for t, b in zip(texts, bounds.tolist()) for s, n, d in slow_runs(t, least)]


def test_runs_of_long_texts_end_soon():
    same = periodic.find_runs(np.zeros(200_000, np.int64), np.array([0, 200_000]))
    assert same.tolist() == [[0, 200_000, 1]]
    rng = np.random.default_rng(1)
    word = np.concatenate([np.tile(rng.integers(0, 50_000, 30_000), 3), rng.integers(0, 50_000, 1_000)])
    assert periodic.find_runs(word, np.array([0, len(word)])).tolist() == [[0, 90_000, 30_000]]


def test_hash_collisions_do_not_make_runs(monkeypatch):
    monkeypatch.setattr(periodic, "span_hashes", lambda sums, a, z: (z - a).astype(np.uint64))
    word = np.array([7, 8] * 9 + [1, 2, 3] * 5 + list(range(10, 40)), np.int64)
    assert periodic.find_runs(word, np.array([0, len(word)])).tolist() == [list(r) for r in slow_runs(word.tolist(), 12)]


def test_periodic_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000)) + " tail" * 20_000
    rows = [(1, None, 0), (2, "", 0), (None, "a b " * 8 + "énd", 0), (3, " \t\n", 0), (4, "x\t\n" * 12, 0), (4, "x " * 12, 0), (4, "x " * 11, 0), (5, long, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumn("collapsed", F.lit("own")).withColumn("_id", F.lit(0))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed[-9:]) for r in periodic.periodic_runs(docs).collect()]
    assert got == [
        (1, 0, [], ""), (2, 0, [], ""), (None, 17, [(0, 16, 2)], "a b énd"), (3, 0, [], ""), (4, 12, [(0, 12, 1)], "x"), (4, 12, [(0, 12, 1)], "x"),
        (4, 11, [], "x x x x x"), (5, 60_000, [(40_000, 20_000, 1)], "9999 tail")]
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_planted_words(spark):
    import zlib

    text = "  ".join(f"w{i}" for i in range(23)) + " "
    rows = [(i, text) for i in range(60)] + [(7, ""), (7, None), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for doc_id, said, made in docs.select("doc_id", "text", planted(F.col("doc_id"), F.col("text")).alias("made")).collect():
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 or not said:
            assert made == said
            continue
        w, g = said.split(), h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        assert made == " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)))


MIT = licenses.NOTICES[0].text


def test_license_spans(spark):
    edited = MIT.replace("without restriction, including", "without ANY restriction including").replace("merge, publish", "publish")
    rows = [
        (1, "Released under the MIT License. again: UNDER the\nMIT license!"), (2, "pre " * 7 + edited + " post" * 9), (3, "apache license versioné 2 and cc-by.nc"),
        (4, "the software and the rights to use copies of the software " * 30), (None, None), (5, ""), (5, ""), (6, "x " * 60_000 + "Apache License, Version 2.0"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("_key", F.lit("k")).withColumn("n_words", F.lit(0))
    spans = licenses.license_spans(docs)
    got = {r.doc_id: r for r in licenses.license_digest(spans).collect() if r.doc_id not in (None, 5)}
    assert spans.count() == len(rows)
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels, got[1].score) == (10, 2, 1, 6, "mit", "mit", 1.0)
    assert (got[2].n_base, got[2].base_labels, got[2].labels) == (0, "", "mit") and 0.95 <= got[2].score < 1
    notice = [s for r in spans.where("doc_id = 2").collect() for s in r.spans]
    assert [(s.template, s.first_word) for s in notice] == [(3, 7)]
    assert (got[3].n_base, got[3].first_word, got[3].labels) == (1, 5, "cc-by-nc")
    assert (got[4].n_base, got[4].labels, got[4].first_word) == (0, "", None)
    assert (got[6].first_word, got[6].base_labels) == (60_000, "apache-2")
    assert licenses.license_spans(docs.limit(0)).count() == 0
    in_blocks = licenses.license_spans(docs, block=150)
    assert sorted(map(repr, in_blocks.collect())) == sorted(map(repr, spans.collect()))


def test_license_votes_are_verified(spark, monkeypatch):
    """With one hash for all runs every place would vote, but the words decide."""
    monkeypatch.setattr(licenses, "_places", lambda templates, gram: [(places[0][0], *p[1:]) for p in places])
    places = [(licenses._hashed(np.frombuffer(b"under the mit", np.uint8), np.array([0, 13]), 3)[0].item(), w, 0, j) for j, w in enumerate(("under the mit", "the mit licence"))]
    docs = spark.createDataFrame([(1, "released under THE mit license today")], "doc_id long, text string")
    wrong = licenses.license_spans(docs, [licenses.Template("mit", "under the mit licence", True)]).first()
    assert (wrong.n_words, wrong.spans) == (6, [])
    half = licenses.license_spans(docs, [licenses.Template("mit", "under the mit licence")]).first()
    assert [(s.first_word, s.n_words, s.score) for s in half.spans] == [(1, 3, 0.75)]
    monkeypatch.undo()
    with pytest.raises(ValueError):
        licenses.license_spans(docs, [licenses.Template("x", "two words")])


def test_copied_license_texts_are_counted_once(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(MIT)).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = licenses.license_digest(licenses.license_spans(docs.repartition(7))).groupBy("labels", "score").count().collect()
    assert sorted(map(tuple, got)) == [("", 0.0, 200), ("mit", 1.0, 100)]


def slow_codes(vectors, parts, entries, rounds):
    whole = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64)
    out, books = [], []
    for x in np.split(whole, parts, axis=1):
        book = x[:entries].copy()
        for r in range(rounds + 1):
            away = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
            to = away.argmin(axis=1)
            if r < rounds:
                for e in range(len(book)):
                    if (to == e).any():
                        book[e] = x[to == e].sum(axis=0) // (to == e).sum()
        out.append((to, away[np.arange(len(x)), to]))
        books.append(book)
    return out, books


@pytest.mark.parametrize("spread", [0.02, 1.0, 2500.0])
def test_vector_codes_against_brute_force(spark, spread):
    rng = np.random.default_rng(4)
    vectors = (rng.integers(-2, 3, (700, 8)) + spread * rng.normal(size=(700, 8))).astype(np.float32)
    vectors[200:420] = vectors[200]
    rows = [(i, v.tolist(), i % 3 or None) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").orderBy(F.xxhash64("vec_id")).repartition(5)
    made = vector_codes.compress(df, keep={"label": "label"}, entries=16, chunk=90)
    (codes, books) = slow_codes(vectors, 4, 16, 4)
    assert all((a == b).all() for a, b in zip(made.codebooks, books))
    grouped = vector_codes.with_group_error(stable(made.rows, "codes"), "label", "label_error").collect()
    assert len(grouped) == 700
    by_label = {}
    for r in grouped:
        by_label[r.label] = by_label.get(r.label, 0) + r.error
    for r in grouped:
        assert r.code == "".join(f"{to[r.vec_id]:02x}" for to, _ in codes)
        assert r.error == sum(away[r.vec_id] for _, away in codes) and r.label_error == by_label[r.label]


def test_cover_tree_holds_its_bounds():
    rng = np.random.default_rng(2)
    for points in (rng.integers(-40, 40, (500, 3)), np.zeros((50, 4), int), rng.integers(0, 2, (300, 2)), np.zeros((0, 3), int)):
        tree = vector_codes.cover_tree(points, leaf=4)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        for i in range(len(tree.start)):
            inside = tree.points[tree.start[i]:tree.end[i]]
            away = np.sqrt(((inside - tree.points[tree.center[i]]) ** 2).sum(axis=1))
            assert np.isclose(away.max(), tree.radius[i])
            children = range(tree.first[i], tree.first[i + 1])
            if children:
                assert [tree.start[c] for c in children] + [tree.end[i]] == [tree.start[i]] + [tree.end[c] for c in children]
                assert all(tree.radius[c] <= tree.radius[i] / vector_codes.SHRINK + 1e-9 for c in children)


def test_subtrees_go_whole():
    """Far groups and few entries: nodes, not points, are assigned."""
    rng = np.random.default_rng(2)
    points = (rng.integers(0, 4, (1000, 1)) * 10_000 + rng.integers(0, 50, (1000, 3))).astype(np.int64)
    node, _, single, _ = vector_codes.assign(vector_codes.cover_tree(points), np.array([[i * 10_000] * 3 for i in range(4)]))
    assert len(single) == 0 and len(node) < 50


def test_vector_odd_rows(spark):
    rows = [
        (5, [1.0, 2.0, 3.0], "a"), (None, [1.0, 2.0, 3.0], None), (3, None, "a"), (4, [1.0, None, 2.0], "a"), (6, [float("nan"), 0.0], "a"),
        (7, [float("inf")], "a"), (2, [], None), (2, [1e30, -1e30, 0.0, 0.0, -0.0005], None), (5, [1.0, 2.0, 3.0], "a"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("code", F.lit(1)).withColumn("_vector", F.lit(1))
    made = vector_codes.compress(df, keep={"label": "label", "error_in": "code"})
    got = sorted((r.vec_id or 0, r.label, r.error_in, r.code, r.error) for r in made.rows.collect())
    assert [g[:3] for g in got] == [(0, None, 1), (2, None, 1), (2, None, 1), (5, "a", 1), (5, "a", 1)]
    assert len(made.codebooks) == 4 and made.codebooks[0].shape == (5, 2) and made.codebooks[0][1].tolist() == [vector_codes.LARGEST, -vector_codes.LARGEST]
    assert made.codebooks[2][1].tolist() == [-1, 0] and {g[4] for g in got} == {0}
    # Equal rows take the first of equal entries; an entry without points stays.
    assert {g[3] for g in got if g[0] in (0, 5)} == {"02020000"}
    none = vector_codes.compress(df.limit(0))
    assert none.rows.count() == 0 and none.spelled() == ""
    empty = vector_codes.compress(df.where("vec_id = 2 and size(embedding) = 0"))
    assert [(r.code, r.error) for r in empty.rows.collect()] == [("00000000", 0)]
