import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partylens.operators import aggregates as agg
from partylens.operators import bitmaps, columns, encoders, gram, impute, joins, quality
from partylens.plans import features


@pytest.fixture(scope="module")
def skewed(spark):
    """Three thousand rows, a third of them of one party, and one currency with half of all rows."""
    rng = random.Random(7)
    data = [
        (1 if i % 3 == 0 else rng.randrange(2, 200), "EUR" if rng.random() < 0.5 else rng.choice(["USD", "HUF", "PLN"]),
         round(rng.uniform(-50, 50), 2), rng.randrange(40))
        for i in range(3000)
    ] + [(None, "EUR", 1.0, 1), (5, None, 2.0, 2)]
    return spark.createDataFrame(data, "party_id long, currency string, amount double, transfer_id int").cache()


def plain(df):
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)


def test_canonical_names():
    assert columns.canonical_name("sum(TAXINCLUSIVEAMOUNT)") == "sum_taxinclusiveamount"
    assert columns.canonical_name("PARTY_ID") == "party_id"


def test_null_key_vanishes(skewed):
    found = agg.statistics_by_key(skewed, "party_id", {"amount": ["sum"]})
    assert found.where("party_id is null").count() == 0


def test_single_pass_equals_joined_aggregates(skewed):
    once = agg.statistics_by_key(
        skewed, "party_id", {"amount": ["sum", "avg", "min", "max"]}, F.count(F.lit(1)).alias("n"))
    joined = skewed.groupBy("party_id").agg(F.sum("amount").alias("sum_amount"))
    for f, name in ((F.avg, "avg"), (F.min, "min"), (F.max, "max")):
        joined = joined.join(skewed.groupBy("party_id").agg(f("amount").alias(f"{name}_amount")), "party_id")
    joined = joined.join(skewed.groupBy("party_id").agg(F.count(F.lit(1)).alias("n")), "party_id")
    left, right = (plain(d).sort_values("party_id").reset_index(drop=True) for d in (once, joined))
    pd.testing.assert_frame_equal(left, right)


def test_value_lists_say_the_same_as_collected_lists(skewed):
    ours = agg.value_lists(skewed, "party_id", "currency").select("party_id", agg.spelled_out(F.col("entries")))
    theirs = skewed.where("party_id is not null").groupBy("party_id").agg(F.array_sort(F.collect_list("currency")))
    assert dict(map(tuple, ours.collect())) == dict(map(tuple, theirs.collect()))


def test_count_vectors_equal_spark_count_vectorizer(skewed):
    from pyspark.ml.feature import CountVectorizer

    lists = skewed.where("party_id is not null").groupBy("party_id").agg(F.collect_list("currency").alias("c"))
    model = CountVectorizer(inputCol="c", outputCol="v").fit(lists)
    theirs = {r.party_id: list(r.v.toArray()) for r in model.transform(lists).collect()}
    terms = agg.vocabulary(skewed.where("party_id is not null"), "currency")
    assert [r.currency for r in terms.orderBy("pos").collect()] == model.vocabulary
    ours = encoders.count_vectors(skewed, "party_id", "currency")
    ours = ours.select("party_id", encoders.dense_counts(F.col("entries"), len(model.vocabulary)))
    assert {r[0]: [float(x) for x in r[1]] for r in ours.collect()} == {k: v for k, v in theirs.items() if sum(v)}


def test_vocabulary_keeps_every_term(skewed):
    assert agg.vocabulary(skewed, "currency").count() == skewed.select("currency").dropna().distinct().count()


def test_exact_quantiles_with_repeats(spark):
    rng = random.Random(3)
    data = [(0.5 if rng.random() < 0.4 else rng.gauss(0, 10), float(rng.randrange(5)), None if i % 7 else 1.0 * i)
            for i in range(2001)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    frame = pd.DataFrame(data, columns=["a", "b", "c"]).astype(float)
    found = quality.exact_quantiles(df, ["a", "b", "c"], (0.0, 0.25, 0.5, 0.9, 1.0))
    for r in found.collect():
        assert r.quantile == pytest.approx(frame[r.column_name].quantile(r.probability)), r
    assert found.count() == 15


def test_describe_equals_pandas(spark):
    data = [(1.0, 5), (2.0, 5), (4.5, None), (None, 7)]
    df = spark.createDataFrame(data, "x double, y int")
    frame = pd.DataFrame(data, columns=["x", "y"]).astype(float).describe()
    for r in quality.describe_exact(df, ["x", "y"]).collect():
        want = frame[r.column_name]
        assert [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]] == pytest.approx(list(want))


def test_correlation_of_constant_and_missing(spark):
    data = [(1.0, 2.0, 5.0), (2.0, 3.9, 5.0), (3.0, None, 5.0), (4.0, 8.2, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    want = pd.DataFrame(data, columns=["a", "b", "c"]).astype(float).corr().round(2)
    for r in quality.correlation_matrix(df, ["a", "b", "c"]).collect():
        expected = want.loc[r.a, r.b]
        assert (r.r is None and expected != expected) or r.r == pytest.approx(expected), r


def test_correlation_of_many_columns(spark):
    """Columns with gaps, large means, constants and one without values, over blocks and tasks of any size, in one scan."""
    rng = np.random.default_rng(1)
    data = rng.normal(size=(400, 12)) + rng.normal(size=(400, 1))
    data[:, 3] += 1e9
    data[rng.random(data.shape) < 0.2] = np.nan
    data[:, 4], data[:, 5] = 0.1, np.nan
    names = [f"c{i}" for i in range(12)]
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(row)) for row in data]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    want = pd.DataFrame(data, columns=names).corr(min_periods=2)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for parts, block, slots in ((1, 64, 64), (9, 5, 2), (400, 12, 1)):
        before = seen.value
        pairs = gram.co_moments(df.repartition(parts).mapInArrow(counted, df.schema), names, block, slots).collect()
        assert seen.value - before == 400 and len(pairs) == 12 * 13 // 2
        for p in pairs:
            expected = want.loc[p.a, p.b]
            assert p.n == int((~np.isnan(data[:, names.index(p.a)]) & ~np.isnan(data[:, names.index(p.b)])).sum())
            if p.a in ("c4", "c5") or p.b in ("c4", "c5"):
                assert p.m_a == 0 or p.m_b == 0
            else:
                assert p.c / (p.m_a * p.m_b) ** 0.5 == pytest.approx(expected, abs=1e-6), (p.a, p.b)
    found = {(r.a, r.b): r.r for r in quality.correlation_matrix(df, names).collect()}
    assert len(found) == 144 and found["c0", "c1"] == found["c1", "c0"] == round(want.loc["c0", "c1"], 2) and found["c4", "c4"] is None
    empty = quality.correlation_matrix(df.limit(0), names[:3]).collect()
    assert len(empty) == 9 and {r.r for r in empty} == {None}


def test_sketched_summary(spark):
    df = spark.range(20_000).select((F.col("id") % 997).cast("int").alias("x"), F.when(F.col("id") % 2 == 0, F.exp(F.col("id") / 5000)).alias("y"), F.lit(None).cast("double").alias("z"))
    frame = df.toPandas()
    for r in quality.sketched_summary(df.repartition(6), ["x", "y", "z"]).collect():
        if r.column_name == "z":
            assert (r["count"], r["mean"], r["min"], r["p50"]) == (0, None, None, None)
            continue
        values = frame[r.column_name].dropna()
        assert (r["count"], r["min"], r["max"]) == (len(values), values.min(), values.max())
        assert (r["mean"], r["std"]) == pytest.approx((values.mean(), values.std()))
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            assert (values < r[name]).mean() - quality.sketch_error() <= p <= (values <= r[name]).mean() + quality.sketch_error()


def test_bitmaps_hold_what_a_key_has(spark):
    rng = random.Random(4)
    data = [(rng.choice([1, 2, 3, None]), rng.choice([None, *[f"v{i:03}" for i in range(200)]])) for _ in range(400)] + [(9, None), (1, "v000"), (1, "v000")]
    df = spark.createDataFrame(data, "party_id int, v string").repartition(5)
    terms = encoders.alphabetic_codes(df, "v", "pos")
    values = [r.v for r in terms.orderBy("pos").collect()]
    made = bitmaps.value_bitmaps(df, "party_id", "v", terms)
    want = {k: {v for p, v in data if p == k and v} for k in (1, 2, 3, 9)}
    rows = {r.party_id: r for r in made.select("party_id", "bits", bitmaps.bitmap_positions(F.col("bits")).alias("at"), bitmaps.bitmap_entries(F.col("bits")).alias("entries")).collect()}
    assert set(rows) == set(want) and rows[9].bits == []
    for key, r in rows.items():
        assert r["at"] == sorted(values.index(v) for v in want[key]) and [(e.pos, e.n) for e in r.entries] == [(p, 1) for p in r["at"]]
        assert [w.word for w in r.bits] == sorted({p // 64 for p in r["at"]})
    wide = bitmaps.bitmap_columns(made, values, "has_")
    assert len(wide.columns) == 1 + len(values)
    for r in wide.collect():
        assert [r[f"has_{v}"] for v in values] == [int(v in want[r.party_id]) for v in values]
    assert bitmaps.value_bitmaps(df.limit(0), "party_id", "v").count() == 0


def test_keys_in_all_takes_one_exchange(spark):
    frames = [spark.createDataFrame([(k,) for k in ks], "party_id int") for ks in ([1, 2, 3, 3, None], [3, 2, 2, None], [2, 3, 7])]
    found = joins.keys_in_all("party_id", *frames)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted(r[0] for r in found.collect()) == [2, 3]
    with pytest.raises(ValueError):
        joins.keys_in_all("party_id", *frames * 22)


def test_distinct_counts_come_from_the_one_scan(spark):
    rows = [(1, "a", 2.0, "EUR"), (1, "a", 3.0, "USD"), (1, None, None, "USD"), (1, "b", 1.0, None), (2, None, 4.0, "EUR"), (None, "c", 1.0, "EUR")]
    df = spark.createDataFrame(rows, "party_id int, transfer_id string, amount double, currency string")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = {r.party_id: r for r in features.transfer_features(df.mapInArrow(counted, df.schema)).collect()}
    assert seen.value == len(rows) and set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one.uniq_transfer_id_count, one["count"], one.sum_amount, one.avg_amount, one.min_amount, one.max_amount, one.transfer_curr) == (2, 4, 6.0, 2.0, 1.0, 3.0, "EUR:1 USD:2")
    assert (two.uniq_transfer_id_count, two["count"], two.sum_amount, two.transfer_curr) == (0, 1, 4.0, "EUR:1")


def test_mode_ties_and_empty_groups(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", None), ("c", 9), (None, 3)], "county string, region int")
    found = {r.county: r.region for r in agg.most_common_by(df, "county", "region").collect()}
    assert found == {"a": 1, "b": None, "c": 9}


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1, "a", 2), (2, "a", 2), (3, "a", None), (4, None, 7), (5, "b", None)], "id int, county string, region int")
    filled = impute.fill_most_common_by(impute.fill_most_common(df, "county"), "region", "county")
    assert sorted(map(tuple, filled.collect())) == [(1, "a", 2), (2, "a", 2), (3, "a", 2), (4, "a", 7), (5, "b", None)]
    means = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert sorted(r.x for r in impute.fill_mean(means, "x").collect()) == [1.0, 1.5, 2.0]


def test_duplicates_keep_lowest_row(spark):
    df = spark.createDataFrame([(3, "x", None), (1, "x", None), (2, "y", 1)], "index int, a string, b int")
    assert sorted(map(tuple, columns.drop_duplicate_rows(df, "index").collect())) == [(1, "x", None), (2, "y", 1)]


def test_first_rows_are_cut_before_the_shuffle(skewed):
    first = columns.first_rows(skewed, "party_id", [F.asc("amount")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    want = plain(skewed).dropna(subset=["party_id"]).groupby("party_id").amount.min().to_dict()
    assert {r.party_id: r.amount for r in first.where("party_id is not null").collect()} == want


def test_ranking_in_pieces(spark):
    values = [f"v{i:04d}" for i in range(500)]
    shuffled = random.Random(2).sample(values, len(values))
    df = spark.createDataFrame([(v,) for v in shuffled], "v string").repartition(6)
    found = encoders.ranked(df, [F.asc("v")])
    assert {r.v: r.code for r in found.collect()} == {v: i for i, v in enumerate(values)}


def test_frequency_codes_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "v string")
    assert {r.v: r.code for r in encoders.frequency_codes(df, "v").collect()} == {"c": 0, "a": 1, "b": 2}


def test_one_hot_rows_sum_to_one_and_null_to_zero(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    wide = encoders.one_hot(df, "v", encoders.listed_values(df, "v"), "is_")
    assert [r.is_a + r.is_b for r in wide.collect() if r.v] == [1, 1, 1]
    vector = encoders.one_hot_vector(df, "v", "x")
    assert [(r.v, list(r.x.toArray())) for r in vector.collect()] == [
        ("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("a", [1.0, 0.0]), (None, [0.0, 0.0])]
    with pytest.raises(ValueError):
        encoders.listed_values(df, "v", most=1)


def test_unit_columns_have_length_one(spark):
    df = spark.createDataFrame([(3.0, 0.0), (4.0, 0.0)], "x double, z double")
    assert [tuple(r) for r in encoders.unit_columns(df, ["x", "z"]).collect()] == [(0.6, 0.0), (0.8, 0.0)]


def test_assembler_skips_or_fails(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 1.0)], "x double, y double")
    assert encoders.assembled(df, ["x", "y"], invalid="skip").count() == 1
    assert df.where(~encoders.complete(["x", "y"])).count() == 2
    with pytest.raises(Exception):
        encoders.assembled(df, ["x", "y"]).collect()


def test_keys_in_all_and_suffixes(spark, rows):
    a = spark.createDataFrame([(1, 5), (2, 6), (2, 6), (None, 1)], "k int, n int")
    b = spark.createDataFrame([(2, 7), (3, 8), (None, 1)], "k int, n int")
    assert rows(joins.keys_in_all("k", a, b)) == [(2,)]
    assert joins.inner_with_suffixes(a, b, "k").columns == ["k", "n_x", "n_y"]


def test_left_join_defaults(spark, rows):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, 5, 9)], "k int, n int, m int")
    assert rows(joins.left_with_defaults(a, b, "k", {"n": 0})) == [(1, 5, 9), (2, 0, None)]


def test_reconciliation(spark):
    history = spark.sql("""select * from values (1, timestamp'2020-01-01'), (1, timestamp'2020-01-02'),
        (2, timestamp'2020-01-02'), (3, null), (4, null), (5, timestamp'2020-01-01'), (6, timestamp'2020-01-01')
        as t(party_id, last_login)""")
    master = spark.sql("""select * from values (0, 1, timestamp'2020-01-02'), (1, 2, timestamp'2020-01-01 12:00:00'),
        (2, 3, timestamp'2020-01-01'), (3, 4, null), (4, 5, null), (9, 2, timestamp'2020-01-02')
        as t(index, party_id, last_login)""")
    found = joins.reconcile_last_login(history, master, "party_id", [F.asc("index")])
    assert {r.party_id: r.seconds_apart for r in found.collect()} == {2: 43200.0, 3: None, 4: None, 5: None}


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert sorted(map(tuple, quality.null_counts(df).collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, quality.profile_table(df, distinct=True).collect())) == [
        ("a", "int", 3, 2, 2), ("b", "string", 3, 1, 1)]
