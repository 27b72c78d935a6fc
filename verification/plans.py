"""Whole jobs: feature tables, profiles, reports, clusters."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partylens.operators import clustering
from partylens.operators.encoders import assembled
from partylens.plans import customers, features, profiles, reports
from partylens.session import stable
from verification.fixtures import Business
from verification.lloyd_sql import lloyd
from verification.registry import query, r, tidy
from verification.sql_views import ACTIVITY, CLEAN, COMBINED, INVOICES, PROFILE, TRANSFERS, UNIT, rates

PARTY = "party_id"


def combined(b: Business) -> DataFrame:
    return features.combined_features(
        features.invoice_features(b.invoices),
        features.transfer_features(b.transfers),
        features.static_features(features.clean_static(b.static)),
    )


def login_profile(b: Business) -> DataFrame:
    return profiles.login_profile(features.located(b.static), b.logins, b.transfers)


@query("q01_invoice_features", "SELECT * FROM invoices", INVOICES)
def _(b: Business) -> DataFrame:
    return tidy(features.invoice_features(b.invoices))


_FLAGS = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("q02_wide_invoice_features", """SELECT party_id, round(sum(taxexclusiveamount), 6) AS sum_taxexclusiveamount,
round(sum(taxinclusiveamount), 6) AS sum_taxinclusiveamount, count(*) AS invoice_count, """ + ", ".join(
    f"max(CAST(currency = '{v}' AS INT)) AS currency_{v.lower()}" for v in _FLAGS) + """,
min(inv_period) AS min_inv_period, max(inv_period) AS max_inv_period FROM invoice_history GROUP BY party_id""")
def _(b: Business) -> DataFrame:
    return tidy(features.wide_invoice_features(b.invoices, _FLAGS))


@query("q03_transfer_features", "SELECT * FROM transfers", TRANSFERS)
def _(b: Business) -> DataFrame:
    return tidy(features.transfer_features(b.transfers))


@query("q04_clean_static", """SELECT index_ AS "index", * EXCLUDE (index_) FROM clean""", CLEAN)
def _(b: Business) -> DataFrame:
    return features.clean_static(b.static)


@query("q05_static_features", """SELECT index_ AS "index", * EXCLUDE (index_), '[' || region || '.0,' || county || '.0]' AS features
FROM clean""", CLEAN)
def _(b: Business) -> DataFrame:
    return features.static_features(features.clean_static(b.static))


@query("q06_combined_features", """SELECT index_ AS "index", * EXCLUDE (index_, curr, currency_vec, transfer_curr, transfer_currency_vec)
FROM combined""", COMBINED)
def _(b: Business) -> DataFrame:
    return tidy(features.training_rows(combined(b), include_ids=True))


@query("q06_combined_with_suffixes", """SELECT * EXCLUDE (index_, invoices_count, transfers_count),
invoices_count AS count_x, transfers_count AS count_y FROM combined""", COMBINED)
def _(b: Business) -> DataFrame:
    return tidy(features.combined_with_suffixes(
        features.invoice_features(b.invoices),
        features.transfer_features(b.transfers),
        features.static_features(features.clean_static(b.static)),
    ))


@query("q07_strict_profile", "SELECT * FROM result", ACTIVITY + rates("strict", "result"))
def _(b: Business) -> DataFrame:
    return profiles.strict_profile(features.located(b.static), b.logins, b.invoices, b.transfers)


@query("q08_login_profile", "SELECT * FROM profile", PROFILE)
def _(b: Business) -> DataFrame:
    return login_profile(b)


@query("q08_most_active", "SELECT * FROM profile ORDER BY login_count DESC, party_id LIMIT 20", PROFILE)
def _(b: Business) -> DataFrame:
    return profiles.most_active(login_profile(b))


@query("q13_login_reconciliation", """SELECT l.party_id, epoch_us(newest) AS history_login, epoch_us(last_login) AS master_login,
(epoch_us(newest) - epoch_us(last_login)) / 1000000 AS seconds_apart
FROM (SELECT party_id, max(last_login) AS newest FROM customer_login GROUP BY party_id) l
JOIN static_raw s USING (party_id) WHERE NOT coalesce(newest = last_login, false)""")
def _(b: Business) -> DataFrame:
    found = reports.login_reconciliation(b.logins, b.static)
    return found.withColumns({c: F.unix_micros(c) for c in ("history_login", "master_login")})


@query("q14_static_quality", " UNION ALL ".join(
    [f"SELECT 'missing' AS measure, '{c}' AS item, count(*) - count({c}) AS n FROM static_raw"
     for c in ("size", "package", "lob_code")]
    + [f"SELECT '{c} values', {c}, count(*) FROM static_raw WHERE {c} IS NOT NULL GROUP BY {c}"
       for c in ("county", "package", "size")]
    + ["""SELECT 'regions of county', county || ' ' || region, count(*) FROM static_raw
          WHERE county IS NOT NULL AND region IS NOT NULL GROUP BY county, region"""]
    + [f"SELECT 'created_on', '{w}', date_diff('day', TIMESTAMP '1970-01-01', {f}(created_on)) FROM static_raw"
       for w, f in (("first", "min"), ("last", "max"))]))
def _(b: Business) -> DataFrame:
    return reports.static_quality(b.static)


# Clustering. SQL sides use fixed centres or assignments, so no random start enters.

_CENTERS = [[500_000.0, 500_000.0], [1_500_000.0, 1_400_000.0], [3_000_000.0, 2_800_000.0]]
_AMOUNTS = ["sum_taxinclusiveamount", "sum_taxexclusiveamount"]


def _nearest_sql(columns: list[str], centers: list[list[float]]) -> str:
    distances = [" + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(columns, center)) for center in centers]
    listed = "[" + ", ".join(distances) + "]"
    return f"CAST(list_position({listed}, list_min({listed})) - 1 AS INT)"


# Places a million apart: with as many clusters as places, k-means must find the places. Its numbers are
# free, so a cluster is named by its lowest party.

def _named(assigned: DataFrame, *more: str) -> DataFrame:
    first = F.min(PARTY).over(Window.partitionBy("prediction")).alias("first_party")
    return assigned.select(PARTY, first, *more)


def far_places(b: Business) -> tuple[DataFrame, int]:
    rows = features.clean_static(b.static).withColumn("spot", F.col("county") * F.lit(1e6))
    vectors = stable(assembled(rows.select(PARTY, "spot"), ["spot"]))
    return vectors, vectors.select("spot").distinct().count()


_FAR = "SELECT party_id, min(party_id) OVER (PARTITION BY county) AS first_party"


@query("m01_kmeans_fit", f"{_FAR}, 0.0::DOUBLE AS cost FROM clean", CLEAN)
def _(b: Business) -> DataFrame:
    vectors, places = far_places(b)
    model = clustering.fit_kmeans(vectors, places)
    cost = r(F.lit(float(model.summary.trainingCost))).alias("cost")
    return _named(model.transform(vectors).withColumn("cost", cost), "cost")


@query("m02_nearest_center", f"SELECT party_id, {_nearest_sql(_AMOUNTS, _CENTERS)} AS prediction FROM invoices", INVOICES)
def _(b: Business) -> DataFrame:
    rows = tidy(features.invoice_features(b.invoices))
    return rows.select(PARTY, clustering.nearest_center(_AMOUNTS, _CENTERS).alias("prediction"))


@query("m03_validated_fit", f"{_FAR}, 1.0::DOUBLE AS silhouette FROM clean", CLEAN)
def _(b: Business) -> DataFrame:
    vectors, places = far_places(b)
    model = clustering.fit_validated(vectors, places)
    return _named(model.transform(vectors).withColumn("silhouette", r(F.lit(model.validationMetrics[0]))), "silhouette")


_PLACES = [[3.0, 0.0], [12.0, 2.0], [20.0, 4.0]]


@query("m04_silhouette", """SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
AS silhouette FROM ab""", CLEAN + f""",
pts AS (SELECT party_id, region::DOUBLE AS x, county::DOUBLE AS y, {_nearest_sql(['region', 'county'], _PLACES)} AS c FROM clean),
st AS (SELECT c AS k, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS q FROM pts GROUP BY c),
d AS (SELECT party_id, c, k, n, x * x + y * y + q / n - 2 * (x * sx + y * sy) / n AS dist FROM pts CROSS JOIN st),
ab AS (SELECT party_id, max(CASE WHEN c = k THEN dist * n / greatest(n - 1, 1) END) AS a,
       min(CASE WHEN c <> k THEN dist END) AS b, max(CASE WHEN c = k THEN n END) AS n FROM d GROUP BY party_id)""")
def _(b: Business) -> DataFrame:
    rows = assembled(features.clean_static(b.static), ["region", "county"])
    rows = stable(rows.withColumn("prediction", clustering.nearest_center(["region", "county"], _PLACES)))
    found = clustering.silhouette(rows)
    return b.spark.createDataFrame([(found,)], "silhouette double").select(r("silhouette").alias("silhouette"))


@query("m05_cost_of_one_cluster", "SELECT 1 AS k, round(" + " + ".join(
    f"sum({c} * {c}) - count(*) * avg({c}) * avg({c})" for c in profiles.ACTIVITY) + ", 6) AS cost FROM unit", UNIT)
def _(b: Business) -> DataFrame:
    rows = profiles.profile_vectors(profiles.profile_rows(login_profile(b), "none"))
    return tidy(clustering.elbow(stable(rows), [1]))


_POINTS = "[" + ", ".join(profiles.ACTIVITY) + "]"
_SINGLE = " + ".join(f"sum({c} * {c}) - count(*) * avg({c}) * avg({c})" for c in profiles.ACTIVITY)


@query("m05_elbow_curve", f"""SELECT 1 AS k, round({_SINGLE}, 6) AS cost FROM unit
UNION ALL SELECT k, round(cost, 6) FROM m_cost""", UNIT + f""",
points AS (SELECT party_id AS id, {_POINTS} AS v FROM unit)""" + lloyd("m", "points", list(range(2, 16))))
def _(b: Business) -> DataFrame:
    profile = stable(login_profile(b), "profile")
    return tidy(clustering.elbow(stable(profiles.profile_vectors(profiles.profile_rows(profile, "none")))))


@query("m05_elbow_at_the_places", """SELECT CAST(count(DISTINCT county) AS INT) AS k, 0.0::DOUBLE AS cost FROM clean""", CLEAN)
def _(b: Business) -> DataFrame:
    vectors, places = far_places(b)
    return tidy(clustering.elbow(vectors, range(1, places + 1)).where(F.col("k") == places))


_STEPS = [[500.0], [1500.0], [2200.0]]
_M7 = PROFILE + f""",
assigned AS (SELECT *, {_nearest_sql(['duration'], _STEPS)} AS cluster FROM profile
             WHERE transfer_amount IS NOT NULL AND region IS NOT NULL),
ks AS (SELECT DISTINCT cluster AS k FROM assigned),
places AS (SELECT DISTINCT region AS place FROM assigned)"""


def _r_sql(x: str, y: str) -> str:
    both = f"stddev_pop({x}) * stddev_pop({y})"
    return f"round(CASE WHEN {both} > 0 THEN covar_pop({x}, {y}) / ({both}) END, 2) + 0.0"


@query("m07_explain_clusters", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, k AS cluster, {_r_sql('CAST(cluster = k AS DOUBLE)', f'CAST({c} AS DOUBLE)')} AS r "
    "FROM assigned CROSS JOIN ks GROUP BY k" for c in profiles.ACTIVITY)
    + f" UNION ALL SELECT place, k, {_r_sql('CAST(cluster = k AS DOUBLE)', 'CAST(region = place AS DOUBLE)')} "
    "FROM assigned CROSS JOIN ks CROSS JOIN places GROUP BY place, k", _M7)
def _(b: Business) -> DataFrame:
    rows = login_profile(b).dropna(subset=["transfer_amount", "region"])
    assigned = stable(rows.withColumn("prediction", clustering.nearest_center(["duration"], _STEPS)))
    return clustering.explain_clusters(assigned, profiles.ACTIVITY, "region")


_TOP = """,
top AS (SELECT region, row_number() OVER (ORDER BY region) AS place FROM (
        SELECT region FROM profile WHERE region IS NOT NULL GROUP BY region ORDER BY count(*) DESC, region LIMIT 2))"""


@query("m08_variant_all", "SELECT party_id, region, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in profiles.ACTIVITY) + " FROM unit", UNIT)
def _(b: Business) -> DataFrame:
    return tidy(profiles.profile_rows(login_profile(b), "all"), 9)


@query("m08_variant_pair_weighted", "SELECT party_id, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in profiles.ACTIVITY) + """,
CASE WHEN place = 1 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS first_place,
CASE WHEN place = 2 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS second_place FROM unit JOIN top USING (region)""", UNIT + _TOP)
def _(b: Business) -> DataFrame:
    profile = stable(login_profile(b))
    regions = profiles.common_regions(profile)
    rows = profiles.profile_vectors(profiles.profile_rows(profile, "pair", regions), weight=0.05)
    at = vector_to_array("features")
    names = [*profiles.ACTIVITY, "first_place", "second_place"]
    return tidy(rows.select(PARTY, *[at[i].alias(n) for i, n in enumerate(names)]), 9)


@query("m08_variant_none", "SELECT party_id, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in profiles.ACTIVITY) + " FROM unit JOIN top USING (region)", UNIT + _TOP)
def _(b: Business) -> DataFrame:
    profile = stable(login_profile(b))
    regions = profiles.common_regions(profile)
    return tidy(profiles.profile_rows(profile, "none", regions), 9)


@query("m07_explain_places", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, place AS cluster, "
    f"{_r_sql('CAST(coalesce(region = place, false) AS DOUBLE)', f'CAST({c} AS DOUBLE)')} AS r "
    "FROM profile CROSS JOIN places WHERE transfer_amount IS NOT NULL GROUP BY place" for c in profiles.ACTIVITY), PROFILE + """,
places AS (SELECT DISTINCT region AS place FROM profile WHERE transfer_amount IS NOT NULL AND region IS NOT NULL)""")
def _(b: Business) -> DataFrame:
    rows = stable(login_profile(b).dropna(subset=["transfer_amount"]))
    return clustering.explain_clusters(rows, profiles.ACTIVITY, cluster="region")


def _flag_r(rows: str, near: str, ks: str, features: list[str], places: str | None = None) -> str:
    """r of every cluster's flag with the activities and, where there are any, with the flags of the places."""
    inside = "CAST(n.e = c.e AS DOUBLE)"
    parts = [f"SELECT c.k, '{f}' AS feature, c.e AS cluster, {_r_sql(inside, f'CAST({f} AS DOUBLE)')} AS r "
             f"FROM {near} n JOIN {rows} ON party_id = n.id JOIN (SELECT DISTINCT k, e FROM {near}) c ON c.k = n.k WHERE c.k IN ({ks}) GROUP BY c.k, c.e" for f in features]
    if places:
        parts.append(f"SELECT c.k, place, c.e, {_r_sql(inside, 'CAST(coalesce(region = place, false) AS DOUBLE)')} "
                     f"FROM {near} n JOIN {rows} ON party_id = n.id JOIN (SELECT DISTINCT k, e FROM {near}) c ON c.k = n.k CROSS JOIN {places} "
                     f"WHERE c.k IN ({ks}) GROUP BY c.k, c.e, place")
    return " UNION ALL ".join(parts)


_BARE = f""",
bare AS (SELECT unit.* FROM unit JOIN top USING (region)),
bare_points AS (SELECT party_id AS id, {_POINTS} AS v FROM bare)"""


@query("m06_sweep", f"""SELECT k, feature, CAST(cluster AS INT) AS cluster, r FROM ({_flag_r('bare', 'm_near', '3, 4, 5, 6, 7', profiles.ACTIVITY)})""",
       UNIT + _TOP + _BARE + lloyd("m", "bare_points", [7, 6, 5, 4, 3]))
def _(b: Business) -> DataFrame:
    profile = stable(login_profile(b))
    return profiles.sweep_profile(profile, regions=profiles.common_regions(profile))


def _study_sql() -> tuple[str, str]:
    """All rows of the study, variant by variant, and the WITH entries before them."""
    ks = list(range(2, 16))
    parts, more = [], ""
    for variant, rows, wanted, places, flags in (
        ("all", "unit", "3", "all_places", "list_transform((SELECT list(place ORDER BY place) FROM all_places), lambda p: CASE WHEN region = p THEN 1.0 ELSE 0.0 END::DOUBLE)"),
        ("pair", "bare", "5", "pair_places", "list_transform((SELECT list(place ORDER BY place) FROM pair_places), lambda p: CASE WHEN region = p THEN 0.05 ELSE 0.0 END::DOUBLE)"),
        ("none", "bare", "3, 4, 5, 6, 7", None, "[]::DOUBLE[]"),
    ):
        # A row without a place has zeros.
        more += f""",
{variant}_points AS (SELECT party_id AS id, list_concat({_POINTS}, list_transform({flags}, lambda f: coalesce(f, 0.0))) AS v FROM {rows})"""
        more += lloyd(variant, f"{variant}_points", ks)
        squares = f"SELECT sum(q) FROM (SELECT sum(x * x) - count(*) * avg(x) * avg(x) AS q FROM (SELECT unnest(v) AS x, unnest(range(len(v))) AS i FROM {variant}_points) GROUP BY i)"
        parts.append(f"SELECT '{variant}' AS variant, 'cost' AS measure, 1 AS k, NULL AS feature, NULL AS item, round(({squares}), 6) AS value")
        parts.append(f"SELECT '{variant}', 'cost', k, NULL, NULL, round(cost, 6) FROM {variant}_cost")
        parts.append(f"SELECT '{variant}', 'cluster', k, feature, cluster::VARCHAR, r FROM ({_flag_r(rows, f'{variant}_near', wanted, profiles.ACTIVITY, places)})")
        for x in profiles.ACTIVITY:
            for y in profiles.ACTIVITY:
                parts.append(f"SELECT '{variant}', 'correlation', NULL, '{x}', '{y}', {_r_sql(f'CAST({x} AS DOUBLE)', f'CAST({y} AS DOUBLE)')} FROM {rows}")
            if places:
                parts.append(f"SELECT '{variant}', 'place', NULL, '{x}', place, {_r_sql('CAST(coalesce(region = place, false) AS DOUBLE)', f'CAST({x} AS DOUBLE)')} "
                             f"FROM {rows} CROSS JOIN {places} GROUP BY place")
        parts.append(f"SELECT '{variant}', 'parties', NULL, NULL, unnest(['clustered', 'left out']), unnest([count(*), (SELECT count(*) FROM profile) - count(*)])::DOUBLE FROM {rows}")
    return " UNION ALL ".join(parts), more


@query("q09_profile_clusters", _study_sql()[0], UNIT + _TOP + _BARE + """,
all_places AS (SELECT DISTINCT region AS place FROM unit WHERE region IS NOT NULL),
pair_places AS (SELECT DISTINCT region AS place FROM bare)""" + _study_sql()[1])
def _(b: Business) -> DataFrame:
    return tidy(profiles.profile_study(stable(login_profile(b), "profile")))


def spread_out(rows: DataFrame) -> DataFrame:
    """Combined rows in four groups far apart: a million times the party's remainder, the amounts made tiny."""
    tiny = {n: F.col(n) * 1e-9 for n, t in rows.dtypes if t == "double"}
    return rows.withColumns({**tiny, "lob_code": F.col(PARTY) % 4 * 1_000_000})


FAR_GROUPS = "SELECT party_id, min(party_id) OVER (PARTITION BY party_id % 4) AS first_party FROM combined"


@query("q10_train_clusters", FAR_GROUPS, COMBINED)
def _(b: Business) -> DataFrame:
    return _named(customers.train_clusters(spread_out(combined(b))).assigned)


@query("q10_skipped_rows", "SELECT count(*) AS points, CAST(0 AS BIGINT) AS skipped FROM combined", COMBINED)
def _(b: Business) -> DataFrame:
    found = customers.train_clusters(combined(b))
    return found.assigned.agg(F.count("prediction").alias("points")).withColumn(
        "skipped", F.lit(found.skipped).cast("long"))


@query("q10_skipped_rows_with_gaps", """SELECT count(*) FILTER (party_id % 5 <> 0) AS points, count(*) FILTER (party_id % 5 = 0) AS skipped FROM combined""", COMBINED)
def _(b: Business) -> DataFrame:
    rows = combined(b).withColumn("lob_code", F.when(F.col(PARTY) % 5 != 0, F.col("lob_code")))
    found = customers.train_clusters(rows)
    return found.assigned.agg(F.count("prediction").alias("points")).withColumn("skipped", F.lit(found.skipped).cast("long"))


@query("q15_size_report", "SELECT count(*) AS n FROM clean GROUP BY county ORDER BY n", CLEAN)
def _(b: Business) -> DataFrame:
    vectors, places = far_places(b)
    return customers.size_report(vectors.drop("features"), ["spot"], places).select("n")


@query("q15_place_size_report")
def _(b: Business) -> DataFrame:
    return customers.size_report(features.clean_static(b.static), ["region", "county"])
