"""The registered queries: SQL where there is some, held-out accuracy for the classifiers, the pipeline stage by stage."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partylens.llm.queries import QUERIES, SQL, fold, table
from verification.check import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert compare(df, connect(FOLDER), SQL[name]) is None
    else:
        assert df.count() == table(spark, FOLDER, "documents").count()


@pytest.mark.parametrize(("name", "label"), [("op1_quality", "quality"), ("op4_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    scored = QUERIES[name](spark, LARGER).where("held_out").join(table(spark, LARGER, "labels"), "doc_id")
    right, every = scored.agg(F.sum((F.col("predicted") == F.col(label)).cast("int")), F.count(F.lit(1))).first()
    assert right >= 0.9 * every


def test_toxic_rows_of_a_small_table_are_found(spark):
    scored = QUERIES["op4_toxicity"](spark, FOLDER).join(table(spark, FOLDER, "labels"), "doc_id")
    found, toxic, alarms = scored.agg(
        F.sum(F.col("predicted") * F.col("toxic")), F.sum("toxic"), F.sum(F.col("predicted") * (1 - F.col("toxic")))
    ).first()
    assert found >= 0.5 * toxic and alarms <= 0.1 * found


def test_katz_beats_single_words(spark):
    sums = QUERIES["op9_katz"](spark, LARGER).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == columns
        ids = {r[0] for r in kept.select("doc_id").collect()}
        assert ids <= {r[0] for r in docs.select("doc_id").collect()}, name
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() and set(columns) <= set(last.columns)
    assert docs.where(fold(F.col("doc_id"), 5) == 0).count() > 0


def test_pipeline_with_odd_rows(spark):
    schema = table(spark, FOLDER, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "src1", 0), (2, "same text here", "en", None, 3), (2, "same text here", "en", None, 3), (3, "same text here", "en", "src1", 3)], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, FOLDER).count() <= 5
        assert stage(spark, odd.limit(0), FOLDER).count() == 0
    near = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, odd, FOLDER)
    assert sorted((r["doc_id"] for r in near.collect()), key=repr) == [1, 2, None]


def test_pipeline_decides_by_row(spark):
    schema = table(spark, FOLDER, "documents").schema
    passage = table(spark, FOLDER, "benchmark").where(F.length("text") > 80).first()["text"]
    stages = dict(corpus_pipeline.STAGES)

    def left(stage, rows):
        docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], schema)
        return sorted(((r["doc_id"], r["text"]) for r in stages[stage](spark, docs, FOLDER).collect()), key=repr)

    clean, same = "nothing of that kind in here", " ".join(f"w{i}" for i in range(60))
    assert left("benchmark_decontamination", [(None, passage), (1, clean), (1, passage), (None, clean)]) == [(1, clean), (None, clean)]
    assert left("ngram_jaccard_join", [(None, same), (4, same), (None, same + " tail"), (5, same + " tail"), (5, clean), (None, None), (None, None)]) == [(4, same), (5, clean), (None, None), (None, None)]
    assert left("ngram_jaccard_join", [(None, same), (None, same)]) == [(None, same)]


def test_pipeline_keeps_exactly_the_right_rows(spark):
    """Planted copies, passages and crowded ids, with columns named like the stages' own."""
    schema = table(spark, FOLDER, "documents").schema
    passage = table(spark, FOLDER, "benchmark").where(F.length("text") > 80).first()["text"]
    stages = dict(corpus_pipeline.STAGES)
    near = [" ".join(f"a{i}x{j}" for j in range(80)) for i in range(4)]
    data = [(i % 3, near[i % 4] + (" tail" if i % 2 else "")) for i in range(24)]  # ids say nothing on texts
    data += [(7, f"{passage} and row {i}") for i in range(5)] + [(7, "".join(f" own{i}_{j}" for j in range(9))) for i in range(5)]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in data], schema)
    for name in ("_row", "_toxicity", "_used", "size", "slot", "shard", "leaf", "tokens", "copies", "component_id", "n_hit", "id", "at", "first"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))

    def left(stage, rows):
        kept = stages[stage](spark, rows, FOLDER)
        assert kept.columns == rows.columns
        assert all(r[c] == f"own {c}" for r in kept.collect() for c in rows.columns[5:])
        return kept

    def texts(rows):
        return sorted((r["doc_id"], r["text"]) for r in rows.collect())

    groups = {}
    for i, t in data:
        groups.setdefault(t.removesuffix(" tail") if t.startswith("a") else t, []).append((i, t))
    want = [min(g)[0] for g in groups.values()]
    got = texts(left("ngram_jaccard_join", docs))
    alone = {t for i, t in data if i == 7 and t.startswith(" own")}
    assert sorted(i for i, t in got if t.startswith("a")) == sorted(w for w in want if w != 7)
    assert alone <= {t for _, t in got}
    assert texts(left("benchmark_decontamination", docs)) == sorted((i, t) for i, t in data if not t.startswith(passage))
    assert left("toxicity", docs).count() == len(data)
    used = left("mixing", docs)
    words = sum(len(t.split()) for _, t in data)
    kept = sum(len(t.split()) for _, t in texts(used))
    assert corpus_pipeline.BUDGET * words - 1 <= kept < corpus_pipeline.BUDGET * words + 81
    last = stages["sharding"](spark, docs, FOLDER).collect()
    assert sorted((r["doc_id"], r["text"]) for r in last) == sorted(data)
    for shard in {r["shard"] for r in last}:
        slots = sorted(r["slot"] for r in last if r["shard"] == shard)
        assert slots == list(range(len(slots)))
