import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partylens.operators import clustering, lloyd
from partylens.operators.encoders import assembled
from partylens.plans import customers, profiles


@pytest.fixture(scope="module")
def points(spark):
    data = [(i, x, y, place) for i, (x, y, place) in enumerate(
        [(0.0, 0.0, "a"), (0.0, 1.0, "a"), (1.0, 0.0, "b"), (10.0, 10.0, "b"), (10.0, 11.0, "b"), (11.0, 10.0, "c")])]
    return spark.createDataFrame(data, "party_id int, x double, y double, place string").cache()


def test_kmeans_finds_the_two_groups(points):
    vectors = assembled(points, ["x", "y"])
    model = clustering.fit_kmeans(vectors, 2)
    found = {r.party_id: r.prediction for r in model.transform(vectors).collect()}
    assert len({found[i] for i in range(3)}) == 1 and found[0] != found[3]
    sizes = clustering.cluster_sizes(model.transform(vectors))
    assert [r.n for r in sizes.collect()] == [3, 3]


def test_nearest_center_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(5.0, 5.0), (0.0, 1.0), (9.0, 9.0)], "x double, y double")
    centers = [[0.0, 0.0], [10.0, 10.0]]
    assert [r[0] for r in df.select(clustering.nearest_center(["x", "y"], centers)).collect()] == [0, 0, 1]


def test_elbow(points):
    vectors = assembled(points, ["x", "y"])
    costs = {r.k: r.cost for r in clustering.elbow(vectors, range(1, 4)).collect()}
    xy = np.array([[r.x, r.y] for r in points.collect()])
    assert costs[1] == pytest.approx(((xy - xy.mean(axis=0)) ** 2).sum())
    assert costs[1] > costs[2] >= costs[3] >= 0


def test_silhouette_is_high_for_far_groups(points):
    vectors = assembled(points, ["x", "y"])
    assert clustering.silhouette(clustering.fit_kmeans(vectors, 2).transform(vectors)) > 0.9


def test_explanation_equals_flag_correlations(points):
    assigned = points.withColumn("prediction", F.when(F.col("x") < 0.5, 0).when(F.col("x") < 10.5, 1).otherwise(2))
    found = {(r.feature, r.cluster): r.r for r in clustering.explain_clusters(assigned, ["x", "y"], "place").collect()}
    frame = pd.DataFrame([tuple(r) for r in assigned.collect()], columns=assigned.columns)
    wide = pd.get_dummies(frame[["x", "y", "place", "prediction"]], columns=["place", "prediction"]).astype(float)
    want = wide.corr()
    for (feature, cluster), value in found.items():
        name = feature if feature in ("x", "y") else f"place_{feature}"
        assert value == pytest.approx(round(want.loc[name, f"prediction_{cluster}"], 2)), (feature, cluster)
    assert len(found) == 5 * 3


def test_single_cluster_has_no_correlation(points):
    assigned = points.withColumn("prediction", F.lit(0))
    assert {r.r for r in clustering.explain_clusters(assigned, ["x"], "place").collect()} == {None}


@pytest.fixture(scope="module")
def groups(spark):
    data = [(i, float(i % 5) + (100.0 if i % 2 else 0.0), float(i % 3)) for i in range(80)]
    return spark.createDataFrame(data, "party_id int, x double, y double").cache()


def test_validated_fit_uses_all_rows(groups):
    model = clustering.fit_validated(assembled(groups, ["x", "y"]), 2, train_ratio=0.75)
    assert model.transform(assembled(groups, ["x", "y"])).count() == 80
    assert model.validationMetrics[0] > 0.9


def test_validated_fit_without_a_second_held_out_cluster(spark):
    vectors = assembled(spark.createDataFrame([(i, 1.0, 2.0) for i in range(12)], "party_id int, x double, y double"), ["x", "y"])
    model = clustering.fit_validated(vectors, 2)
    assert np.isnan(model.validationMetrics[0]) and model.transform(vectors).count() == 12


def test_train_counts_skipped_rows(spark, groups):
    rows = groups.unionByName(spark.createDataFrame([(100, None, 1.0)], "party_id int, x double, y double"))
    found = customers.train_clusters(rows, k=2)
    assert found.skipped == 1 and found.columns == ["x", "y"] and found.assigned.count() == 80
    assert -1 <= found.silhouette() <= 1
    assert customers.train_clusters(rows, k=2, include_ids=True).columns == ["party_id", "x", "y"]


def test_model_is_saved_and_read_back(spark, groups):
    from pyspark.ml import PipelineModel

    from partylens.session import stage_path

    found = customers.train_clusters(groups, k=2)
    path = stage_path(spark, "model")
    customers.save_model(found, path)
    again = PipelineModel.load(path).transform(assembled(groups, ["x", "y"]))
    assert {r.party_id: r.prediction for r in again.collect()} == {
        r.party_id: r.prediction for r in found.assigned.collect()}


@pytest.fixture(scope="module")
def profile(spark):
    data = [(i, i % 4, i % 3, 10 * i, 100 + i, f"R {i % 3}") for i in range(30)] + [(99, None, 1, 1, 0, "R 1")]
    return spark.createDataFrame(
        data, "party_id int, login_count long, transfer_count long, transfer_amount long, duration long, region string")


def test_profile_variants(profile):
    assert profiles.profile_rows(profile, "all").count() == 30
    regions = profiles.common_regions(profile)
    assert len(regions) == 2
    pair = profiles.profile_rows(profile, "pair", regions)
    assert pair.count() == 20
    flags = [r.features.toArray()[4:] for r in profiles.profile_vectors(pair, weight=0.05).collect()]
    assert all(sorted(f) == [0.0, 0.05] for f in flags)
    assert "region" not in profiles.profile_rows(profile, "none", regions).columns
    with pytest.raises(ValueError):
        profiles.profile_rows(profile, "pair")


def test_cluster_profile_and_sweep(profile):
    found = profiles.cluster_profile(profile, k=3, ks=[1, 2, 3])
    assert found.assigned.count() == 30 and found.elbow.count() == 3
    assert found.explanation.count() == 3 * (4 + 3) and found.correlations.count() == 16
    assert profiles.sweep_profile(profile, [4, 3]).count() == (4 + 3) * 4


def test_explanation_leaves_out_missing_values(spark):
    rows = [(i % 2, float(i) if i % 5 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "prediction int, x double")
    got = {r.cluster: r.r for r in clustering.explain_clusters(df, ["x"]).collect()}
    for c in (0, 1):
        want = df.where("x is not null").select(F.corr(F.when(F.col("prediction") == c, 1.0).otherwise(0.0), "x")).first()[0]
        assert got[c] == pytest.approx(round(want, 2), abs=0.011)


def slow_lloyd(points, k, rounds=20):
    """The rule of the grid fit in plain numpy, on whole numbers."""
    def away(x, c):
        return ((x[:, None, :] - c[None]) ** 2).sum(axis=2)

    seeds = [min(points.tolist(), key=lambda p: (-sum(v * v for v in p), p))]
    while len(seeds) < k:
        least = away(points, np.array(seeds)).min(axis=1)
        if least.max() == 0:
            break
        seeds.append(min(points[least == least.max()].tolist()))
    centers = np.array(seeds)
    for _ in range(rounds):
        to = away(points, centers).argmin(axis=1)
        centers = np.array([points[to == j].sum(axis=0) // (to == j).sum() if (to == j).any() else centers[j] for j in range(len(centers))])
    least = away(points, centers)
    return centers, sum(least.min(axis=1).tolist()), least.argmin(axis=1)


@pytest.fixture(scope="module")
def spots(spark):
    rng = np.random.default_rng(5)
    data = np.round(rng.integers(0, 4, (300, 1)) * 3.0 + rng.normal(size=(300, 3)), 2)
    data[100:140] = data[100]
    return spark.createDataFrame([(i, *p) for i, p in enumerate(data.tolist())], "party_id int, x double, y double, z double").cache()


def test_lloyd_equals_brute_force_for_every_k(spots):
    rows, scale, width = lloyd.on_grid(assembled(spots, ["x", "y", "z"]))
    whole = np.array([r._whole for r in rows.orderBy("party_id").collect()])
    assert scale == 2.0 ** 25 and (whole == np.floor(np.array([[r.x, r.y, r.z] for r in spots.orderBy("party_id").collect()]) * scale)).all()
    ks = [1, 2, 3, 5, 8]
    for parts, at_once in ((1, lloyd.AT_ONCE), (7, lloyd.AT_ONCE), (7, 0)):
        found = lloyd.fit_lloyd(rows.repartition(parts), ks, scale, width, at_once=at_once)
        for k in ks:
            centers, cost, _ = slow_lloyd(whole, k)
            assert (found.centers[k] == centers).all() and found.steps[k] == cost
            assert found.cost(k) == cost / scale**2
    given = [r.predictions for r in found.assigned(rows, [5, 2]).orderBy("party_id").collect()]
    assert given == [list(p) for p in zip(slow_lloyd(whole, 5)[2].tolist(), slow_lloyd(whole, 2)[2].tolist())]


def test_lloyd_stops_at_the_wanted_round(spots):
    rows, scale, width = lloyd.on_grid(assembled(spots, ["x", "y", "z"]))
    whole = np.array([r._whole for r in rows.collect()])
    for rounds in (0, 1, 3):
        found = lloyd.fit_lloyd(rows, [6], scale, width, rounds=rounds)
        centers, cost, _ = slow_lloyd(whole, 6, rounds)
        assert (found.centers[6] == centers).all() and found.steps[6] == cost


def test_lloyd_with_few_points(spark):
    rows = assembled(spark.createDataFrame([(1.0, 0.0), (1.0, 0.0), (-1.0, 0.5)], "x double, y double"), ["x", "y"])
    points, scale, width = lloyd.on_grid(rows)
    found = lloyd.fit_lloyd(points, [2, 4], scale, width)
    assert [len(found.centers[k]) for k in (2, 4)] == [2, 2] and found.steps == {2: 0, 4: 0}
    none, scale, width = lloyd.on_grid(rows.limit(0))
    assert lloyd.fit_lloyd(none, [2], scale, width).cost(2) == 0
    zeros, scale, width = lloyd.on_grid(assembled(spark.createDataFrame([(0.0,), (0.0,)], "x double"), ["x"]))
    assert lloyd.fit_lloyd(zeros, [3], scale, width).centers[3].tolist() == [[0]]


def test_explanations_of_several_clusterings_take_one_scan(spark, spots):
    rows = spots.select(
        "x", F.when(F.col("party_id") % 7 > 0, F.col("y")).alias("y"), F.lit(0.1).alias("same"), F.when(F.col("party_id") % 3 > 0, F.col("party_id") % 3).cast("string").alias("place"),
        F.array(F.col("party_id") % 2, F.when(F.col("party_id") > 20, F.col("party_id") % 4)).alias("predictions"))
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    seen = clustering.explain_each(rows.mapInArrow(counted, rows.schema), ["x", "y", "same"], "place", ks=[2, 4])
    got = {(r.k, r.feature, r.cluster): r.r for r in seen.collect()}
    assert scans.value == 300
    frame = rows.toPandas()
    assert len(got) == (2 + 4) * 5
    for (k, feature, cluster), value in got.items():
        flag = frame["predictions"].map(lambda p: float(p[0 if k == 2 else 1] == cluster))
        other = frame[feature].astype(float) if feature in ("x", "y", "same") else (frame["place"] == feature).astype(float)
        known = other.notna()
        want = None if feature == "same" else np.corrcoef(flag[known], other[known])[0, 1]
        assert value is None if want is None else value == pytest.approx(want, abs=0.0051), (k, feature, cluster)
