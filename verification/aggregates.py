"""Joins, grouped statistics and encoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.functions.dates import period_days, whole_days
from partylens.operators import aggregates as agg
from partylens.operators import bitmaps, clustering, encoders, impute, joins, quality
from partylens.plans.features import clean_static, invoice_features, located, transfer_features
from verification.fixtures import Business
from verification.registry import query, r, tidy
from verification.sql_views import CLEAN, INVOICES, LOCATED, TRANSFERS, UNIT

PARTY = "party_id"


# Joins

@query("j01_inner_join_aggregates", """SELECT party_id, invoices, transfers FROM
(SELECT party_id, count(*) AS invoices FROM invoice_history GROUP BY party_id)
JOIN (SELECT party_id, count(*) AS transfers FROM transfer_history GROUP BY party_id) USING (party_id)""")
def _(b: Business) -> DataFrame:
    invoices = agg.histogram(b.invoices, PARTY).withColumnRenamed("n", "invoices")
    transfers = agg.histogram(b.transfers, PARTY).withColumnRenamed("n", "transfers")
    return joins.inner_on(PARTY, invoices, transfers)


@query("j02_three_way_join", """SELECT party_id, invoices_count, transfers_count, county FROM
(SELECT party_id, count(*) AS invoices_count FROM invoice_history GROUP BY party_id)
JOIN (SELECT party_id, count(*) AS transfers_count FROM transfer_history GROUP BY party_id) USING (party_id)
JOIN static_raw USING (party_id)""")
def _(b: Business) -> DataFrame:
    counts = [agg.histogram(df, PARTY).withColumnRenamed("n", "count") for df in (b.invoices, b.transfers)]
    return joins.inner_on(
        PARTY,
        counts[0].withColumnRenamed("count", "invoices_count"),
        counts[1].withColumnRenamed("count", "transfers_count"),
        b.static.select(PARTY, "county"),
    )


@query("j03_join_with_suffixes", """SELECT party_id, n_x, n_y FROM
(SELECT party_id, count(*) AS n_x FROM invoice_history GROUP BY party_id)
JOIN (SELECT party_id, count(*) AS n_y FROM transfer_history GROUP BY party_id) USING (party_id)""")
def _(b: Business) -> DataFrame:
    return joins.inner_with_suffixes(agg.histogram(b.invoices, PARTY), agg.histogram(b.transfers, PARTY), PARTY)


@query("j04_keys_in_all_tables", """SELECT party_id FROM static_raw
INTERSECT SELECT party_id FROM customer_login INTERSECT SELECT party_id FROM invoice_history
INTERSECT SELECT party_id FROM transfer_history""")
def _(b: Business) -> DataFrame:
    return joins.keys_in_all(PARTY, b.static, b.logins, b.invoices, b.transfers)


@query("j04_rows_of_kept_keys", """SELECT party_id, currency, count(*) AS n FROM invoice_history
WHERE party_id IN (SELECT party_id FROM customer_login) GROUP BY party_id, currency""")
def _(b: Business) -> DataFrame:
    return agg.pair_counts(joins.restricted(b.invoices, joins.keys(b.logins, PARTY), PARTY), PARTY, "currency")


@query("j05_left_join_default", """SELECT party_id, coalesce(n, 0) AS n FROM static_raw
LEFT JOIN (SELECT party_id, count(*) AS n FROM transfer_history GROUP BY party_id) USING (party_id)""")
def _(b: Business) -> DataFrame:
    return joins.left_with_defaults(b.static.select(PARTY), agg.histogram(b.transfers, PARTY), PARTY, {"n": 0})


@query("j06_left_join_gaps", """SELECT party_id, round(amount, 6) AS amount FROM static_raw
LEFT JOIN (SELECT party_id, sum(amount) AS amount FROM transfer_history GROUP BY party_id) USING (party_id)""")
def _(b: Business) -> DataFrame:
    sums = b.transfers.groupBy(PARTY).agg(F.sum("amount").alias("amount"))
    return tidy(joins.left_with_defaults(b.static.select(PARTY), sums, PARTY))


@query("j07_series_per_party", """SELECT party_id, round(sum(taxexclusiveamount), 6) AS sum_taxexclusiveamount,
round(sum(taxinclusiveamount), 6) AS sum_taxinclusiveamount, count(*) AS invoice_count,
min(inv_period) AS shortest, max(inv_period) AS longest FROM invoice_history GROUP BY party_id""")
def _(b: Business) -> DataFrame:
    rows = b.invoices.withColumn("days", whole_days(F.col("issuedate"), F.col("duedate")))
    return tidy(agg.statistics_by_key(
        rows, PARTY, {"taxexclusiveamount": ["sum"], "taxinclusiveamount": ["sum"]},
        F.count(F.lit(1)).alias("invoice_count"), F.min("days").alias("shortest"), F.max("days").alias("longest"),
    ))


_COUNTIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("j08_join_flag_block", "SELECT party_id, " + ", ".join(
    f"CAST(coalesce(county = '{c}', false) AS INT) AS \"{c}\"" for c in _COUNTIES) + " FROM static_raw")
def _(b: Business) -> DataFrame:
    values = encoders.listed_values(b.static, "county")
    return encoders.one_hot(b.static, "county", values).select(PARTY, *values)


@query("j09_fill_by_group_lookup", "SELECT party_id, county, region FROM located", LOCATED)
def _(b: Business) -> DataFrame:
    rows = impute.fill_most_common(b.static, "county")
    return impute.fill_most_common_by(rows, "region", "county").select(PARTY, "county", "region")


@query("j11_scalar_of_table", """SELECT party_id, date_diff('day', created_on, (SELECT max(created_on) FROM static_raw)) AS days
FROM static_raw""")
def _(b: Business) -> DataFrame:
    rows = joins.with_scalar(b.static, "present", b.static, F.max("created_on"))
    return rows.select(PARTY, whole_days(F.col("created_on"), F.col("present")).alias("days"))


# Grouped statistics

for _name, _statistic, _sql in [
    ("a01_grouped_sum", "sum", "sum"), ("a02_grouped_max", "max", "max"),
    ("a03_grouped_min", "min", "min"), ("a04_grouped_mean", "avg", "avg"),
]:
    @query(_name, f"""SELECT party_id, round({_sql}(taxinclusiveamount), {1 if _sql == 'avg' else 6}) AS {_statistic}_taxinclusiveamount,
round({_sql}(taxexclusiveamount), {1 if _sql == 'avg' else 6}) AS {_statistic}_taxexclusiveamount FROM invoice_history GROUP BY party_id""")
    def _(b: Business, statistic: str = _statistic) -> DataFrame:
        wanted = {c: [statistic] for c in ("taxinclusiveamount", "taxexclusiveamount")}
        return tidy(agg.statistics_by_key(b.invoices, PARTY, wanted))


@query("a05_grouped_count", "SELECT party_id, count(*) AS n FROM invoice_history GROUP BY party_id")
def _(b: Business) -> DataFrame:
    return agg.histogram(b.invoices, PARTY)


@query("a06_grouped_known_count", "SELECT county, count(lob_code) AS n FROM static_raw WHERE county IS NOT NULL GROUP BY county")
def _(b: Business) -> DataFrame:
    return b.static.dropna(subset=["county"]).groupBy("county").agg(F.count("lob_code").alias("n"))


@query("a07_distinct_count", "SELECT party_id, count(DISTINCT transfer_id) AS transfers FROM transfer_history GROUP BY party_id")
def _(b: Business) -> DataFrame:
    return b.transfers.groupBy(PARTY).agg(F.count_distinct("transfer_id").alias("transfers"))


@query("a08_collected_values", "SELECT party_id, curr FROM invoices", INVOICES)
def _(b: Business) -> DataFrame:
    lists = agg.value_lists(b.invoices, PARTY, "currency")
    return lists.select(PARTY, agg.entries_text(F.col("entries")).alias("curr"))


@query("a09_value_histogram", "SELECT currency, count(*) AS n FROM invoice_history GROUP BY currency")
def _(b: Business) -> DataFrame:
    return agg.ordered_histogram(b.invoices, "currency", descending=True)


@query("a10_histogram_in_group", """SELECT county, region, count(*) AS n FROM static_raw
WHERE county IS NOT NULL AND region IS NOT NULL GROUP BY county, region""")
def _(b: Business) -> DataFrame:
    return agg.histogram(b.static, "county", "region")


@query("a11_date_ranges", """SELECT epoch_us(min(issuedate)) AS min_issuedate, epoch_us(max(issuedate)) AS max_issuedate,
epoch_us(min(duedate)) AS min_duedate, epoch_us(max(duedate)) AS max_duedate FROM invoice_history""")
def _(b: Business) -> DataFrame:
    found = agg.ranges(b.invoices, "issuedate", "duedate")
    return found.select(*[F.unix_micros(c).alias(c) for c in found.columns])


@query("a12_sums_of_one_party", """SELECT round(sum(taxinclusiveamount), 6) AS inclusive, round(sum(taxexclusiveamount), 6) AS exclusive,
round(sum(taxinclusiveamount), 6) AS payable FROM invoice_history
WHERE party_id = (SELECT party_id FROM invoice_history GROUP BY party_id ORDER BY count(*) DESC, party_id LIMIT 1)""")
def _(b: Business) -> DataFrame:
    from verification.columns import busiest

    rows = b.invoices.where(F.col(PARTY) == busiest(b)).withColumn("payableamount", F.col("taxinclusiveamount"))
    names = {"taxinclusiveamount": "inclusive", "taxexclusiveamount": "exclusive", "payableamount": "payable"}
    return tidy(rows.agg(*[F.sum(c).alias(n) for c, n in names.items()]))


@query("a13_global_mean", "SELECT round(avg(lob_code), 6) AS lob_code FROM static_raw")
def _(b: Business) -> DataFrame:
    return tidy(b.static.agg(F.avg("lob_code").alias("lob_code")), 6)


@query("a14_most_common_value", """SELECT party_id, (SELECT county FROM static_raw WHERE county IS NOT NULL
GROUP BY county ORDER BY count(*) DESC, county LIMIT 1) AS county FROM static_raw WHERE county IS NULL""")
def _(b: Business) -> DataFrame:
    missing = b.static.where("county is null")
    return missing.select(PARTY, agg.most_common(b.static, "county").alias("county"))


@query("a15_most_common_by_group", """SELECT county, region FROM (
SELECT county, region, row_number() OVER (PARTITION BY county ORDER BY count(*) DESC, region) AS rn
FROM static_raw WHERE county IS NOT NULL AND region IS NOT NULL GROUP BY county, region) WHERE rn = 1""")
def _(b: Business) -> DataFrame:
    return agg.most_common_by(b.static, "county", "region")


_USED = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("a16_ever_used_flags", "SELECT party_id, " + ", ".join(
    f"max(CAST(currency = '{v}' AS INT)) AS currency_{v.lower()}" for v in _USED) + " FROM invoice_history GROUP BY party_id")
def _(b: Business) -> DataFrame:
    values = encoders.listed_values(b.invoices, "currency")
    return agg.flags_by_key(b.invoices, PARTY, "currency", values, "currency_")


@query("a16_flags_from_bitmaps", "SELECT party_id, " + ", ".join(
    f"max(CAST(currency = '{v}' AS INT)) AS currency_{v}" for v in _USED) + " FROM invoice_history GROUP BY party_id")
def _(b: Business) -> DataFrame:
    terms = encoders.alphabetic_codes(b.invoices, "currency", "pos")
    values = [v for v, _ in sorted(terms.collect(), key=lambda t: t["pos"])]  # six currencies
    return bitmaps.bitmap_columns(bitmaps.value_bitmaps(b.invoices, PARTY, "currency", terms), values, "currency_")


@query("a16_bitmap_of_many_values", """SELECT party_id, string_agg(pos, ',' ORDER BY pos) AS positions, count(*) AS n FROM (
SELECT DISTINCT party_id, pos FROM transfer_history JOIN (
  SELECT transfer_id, row_number() OVER (ORDER BY count(*) DESC, transfer_id) - 1 AS pos FROM transfer_history GROUP BY 1) USING (transfer_id))
GROUP BY 1""")
def _(b: Business) -> DataFrame:
    found = bitmaps.value_bitmaps(b.transfers, PARTY, "transfer_id")
    at = bitmaps.bitmap_positions(F.col("bits"))
    return found.select(PARTY, F.array_join(at.cast("array<string>"), ",").alias("positions"), F.size(at).cast("bigint").alias("n"))


@query("a17_summary", " UNION ALL ".join(
    f"SELECT '{s}' AS summary, round({f}(amount), 6) AS amount, round({f}(party_id)::DOUBLE, 6) AS party_id FROM transfer_history"
    for s, f in {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}.items()))
def _(b: Business) -> DataFrame:
    rows = quality.summary(b.transfers.select("amount", PARTY), "count", "mean", "stddev", "min", "max")
    return rows.select("summary", *[r(F.col(c).cast("double"), 6).alias(c) for c in ("amount", PARTY)])


@query("a17_summary_eight_numbers")
def _(b: Business) -> DataFrame:
    return quality.summary(b.invoices)


_SKETCHED = ["party_id", "taxexclusiveamount", "taxinclusiveamount", "inv_period"]


@query("a17_sketched_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS "count", round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
round(min({c})::DOUBLE, 5) AS min, round(max({c})::DOUBLE, 5) AS max, true AS p25_within, true AS p50_within, true AS p75_within
FROM invoice_history""" for c in _SKETCHED))
def _(b: Business) -> DataFrame:
    """The quartiles of the sketches by their exact ranks: none is off by more than the stated bound."""
    rows = b.invoices.withColumn("inv_period", period_days(F.col("issuedate"), F.col("duedate"))).select(*_SKETCHED)
    found = quality.sketched_summary(rows, _SKETCHED)
    values = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in _SKETCHED])))
    ranked = values.join(F.broadcast(found), "column_name").groupBy("column_name").agg(*[
        f(F.col("x"), F.col(p)).alias(f"{name}_{p}") for p in ("p25", "p50", "p75")
        for name, f in (("below", lambda x, q: F.count_if(x < q) / F.count("x")), ("upto", lambda x, q: F.count_if(x <= q) / F.count("x")))])
    bound = quality.sketch_error()
    within = [((F.col(f"below_{p}") - bound <= at) & (at <= F.col(f"upto_{p}") + bound)).alias(f"{p}_within") for p, at in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return tidy(found.drop("p25", "p50", "p75").join(ranked.select("column_name", *within), "column_name"), 5)


_DESCRIBED = [
    "sum_taxinclusiveamount", "avg_taxinclusiveamount", "min_taxinclusiveamount", "max_taxinclusiveamount", "sum_taxexclusiveamount",
    "avg_taxexclusiveamount", "min_taxexclusiveamount", "max_taxexclusiveamount", "min_inv_period", "max_inv_period", "avg_inv_period",
    "sum_amount", "avg_amount", "min_amount", "max_amount", "uniq_transfer_id_count",
]


@query("a18_exact_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({x}) AS "count", round(avg({x}), 5) AS mean, round(stddev_samp({x}), 5) AS std,
round(min({x})::DOUBLE, 5) AS min, round(max({x})::DOUBLE, 5) AS max, round(quantile_cont({x}, 0.25), 5) AS p25,
round(quantile_cont({x}, 0.5), 5) AS p50, round(quantile_cont({x}, 0.75), 5) AS p75
FROM invoices JOIN transfers USING (party_id)""" for c, x in
    [*[(c, c) for c in _DESCRIBED], ("count_x", "invoices.\"count\""), ("count_y", "transfers.\"count\"")]), INVOICES + TRANSFERS)
def _(b: Business) -> DataFrame:
    """Every numeric column of the joined feature tables but the key."""
    both = joins.inner_with_suffixes(
        tidy(invoice_features(b.invoices)), tidy(transfer_features(b.transfers)), PARTY)
    numeric = [n for n, t in both.dtypes if t in ("double", "bigint", "int") and n != PARTY]
    return tidy(quality.describe_exact(both, numeric), 5)


@query("a19_cluster_sizes", "SELECT CAST(party_id % 4 AS INT) AS prediction, count(*) AS n FROM static_raw GROUP BY 1")
def _(b: Business) -> DataFrame:
    assigned = b.static.withColumn("prediction", (F.col(PARTY) % 4).cast("int"))
    return clustering.cluster_sizes(assigned)


@query("a20_column_norms", """SELECT round(sqrt(sum(taxinclusiveamount * taxinclusiveamount)), 2) AS taxinclusiveamount,
round(sqrt(sum(taxexclusiveamount * taxexclusiveamount)), 2) AS taxexclusiveamount FROM invoice_history""")
def _(b: Business) -> DataFrame:
    return tidy(agg.column_norms(b.invoices, ["taxinclusiveamount", "taxexclusiveamount"]), 2)


_CORRELATED = ["taxinclusiveamount", "taxexclusiveamount", "inv_period", "party_id"]


@query("a21_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 2) + 0.0 AS r FROM invoice_history"
    for x in _CORRELATED for y in _CORRELATED))
def _(b: Business) -> DataFrame:
    rows = b.invoices.withColumn("inv_period", period_days(F.col("issuedate"), F.col("duedate")))
    return quality.correlation_matrix(rows, _CORRELATED)


# Sixty columns of different kinds, each with gaps in other rows.
_WIDE = [
    f"CASE WHEN party_id % {3 + i % 11} > 0 THEN " + (
        f"taxexclusiveamount * (party_id % {i + 2})", f"CAST(party_id * {i + 3} % 101 AS DOUBLE)", f"taxinclusiveamount - {i}.5 * inv_period",
        f"CAST(inv_period % {i + 5} AS DOUBLE)", f"1000000.0 + inv_period * {i}", f"CAST(inv_period AS DOUBLE) * inv_period + {i}",
    )[i % 6] + " END" for i in range(60)
]


@query("a21_correlation_of_sixty_columns", f"""SELECT 'c' || i AS a, 'c' || j AS b, round(r, 2) + 0.0 AS r FROM (
  SELECT unnest(range(3600)) // 60 AS i, unnest(range(3600)) % 60 AS j, unnest([{", ".join(f"r{min(i, j)}_{max(i, j)}" for i in range(60) for j in range(60))}]) AS r
  FROM (SELECT {", ".join(f"corr(c{i}, c{j}) AS r{i}_{j}" for i in range(60) for j in range(i, 60))}
    FROM (SELECT {", ".join(f"{x} AS c{i}" for i, x in enumerate(_WIDE))} FROM invoice_history)))""")
def _(b: Business) -> DataFrame:
    rows = b.invoices.withColumn("inv_period", period_days(F.col("issuedate"), F.col("duedate")))
    return quality.correlation_matrix(rows.select(*[F.expr(x).alias(f"c{i}") for i, x in enumerate(_WIDE)]), [f"c{i}" for i in range(60)])


# Encoders

@query("e01_frequency_index", """SELECT party_id, package, dense_rank() OVER (ORDER BY n DESC, package) - 1 AS code
FROM static_raw JOIN (SELECT package, count(*) AS n FROM static_raw GROUP BY package) USING (package)""")
def _(b: Business) -> DataFrame:
    codes = encoders.frequency_codes(b.static, "package")
    return b.static.select(PARTY, "package").join(codes, "package").select(PARTY, "package", "code")


@query("e01_one_hot_vector", """SELECT party_id, '(' || size || ',[' || code || '],[1.0])' AS vector FROM (
SELECT party_id, dense_rank() OVER (ORDER BY n DESC, package) - 1 AS code,
       (SELECT count(DISTINCT package) FROM static_raw) AS size
FROM static_raw JOIN (SELECT package, count(*) AS n FROM static_raw GROUP BY package) USING (package))""")
def _(b: Business) -> DataFrame:
    rows = encoders.one_hot_vector(b.static.dropna(subset=["package"]), "package", "v")
    return rows.select(PARTY, F.col("v").cast("string").alias("vector"))


@query("e02_one_hot_columns", "SELECT party_id, " + ", ".join(
    f"CAST(coalesce(county = '{c}', false) AS INT) AS county_{i}"
    for i, c in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])) + " FROM static_raw")
def _(b: Business) -> DataFrame:
    values = encoders.listed_values(b.static, "county")
    flags = encoders.one_hot(b.static.select(PARTY, "county"), "county", values, "county_").drop("county")
    return flags.toDF(PARTY, *[f"county_{i}" for i in range(len(values))])


@query("e03_label_codes", """SELECT party_id, dense_rank() OVER (ORDER BY coalesce(package, 'nan')) - 1 AS package FROM static_raw""")
def _(b: Business) -> DataFrame:
    from partylens.functions.text import as_text

    rows = b.static.select(PARTY, as_text(F.col("package")).alias("package"))
    return encoders.with_codes(rows, "package", encoders.alphabetic_codes(rows, "package"))


@query("w02_dense_codes", """SELECT DISTINCT transfer_id, dense_rank() OVER (ORDER BY transfer_id) - 1 AS code FROM transfer_history""")
def _(b: Business) -> DataFrame:
    return encoders.alphabetic_codes(b.transfers, "transfer_id")


@query("e04_count_vectors", "SELECT party_id, currency_vec AS vector FROM invoices", INVOICES)
def _(b: Business) -> DataFrame:
    from partylens.functions.vectors import sparse_text

    size = agg.vocabulary(b.invoices, "currency").agg(F.count(F.lit(1))).scalar()
    counts = encoders.count_vectors(b.invoices, PARTY, "currency")
    return counts.select(PARTY, sparse_text(size, F.col("entries")).alias("vector"))


@query("e05_assemble", "SELECT party_id, '[' || region || '.0,' || county || '.0]' AS features FROM clean", CLEAN)
def _(b: Business) -> DataFrame:
    from partylens.functions.vectors import vector_text

    rows = encoders.assembled(clean_static(b.static), ["region", "county"])
    return rows.select(PARTY, vector_text(F.col("features")).alias("features"))


@query("e06_assemble_and_skip", """SELECT count(*) AS all_rows, CAST(count_if(region IS NOT NULL AND lob_code IS NOT NULL) AS BIGINT) AS kept,
CAST(count_if(region IS NULL OR lob_code IS NULL) AS BIGINT) AS skipped FROM static_raw""")
def _(b: Business) -> DataFrame:
    columns = ["region", "lob_code"]
    kept = encoders.assembled(b.static, columns, invalid="skip").agg(F.count("features")).scalar()
    totals = b.static.agg(
        F.count(F.lit(1)).alias("all_rows"), F.count_if(~encoders.complete(columns)).alias("skipped")
    )
    return totals.withColumn("kept", kept)


@query("e07_unit_columns", """SELECT party_id, round(login_count, 9) AS login_count, round(transfer_count, 9) AS transfer_count,
round(transfer_amount, 9) AS transfer_amount, round(duration, 9) AS duration FROM unit""", UNIT)
def _(b: Business) -> DataFrame:
    from partylens.plans.profiles import ACTIVITY, login_profile

    profile = login_profile(located(b.static), b.logins, b.transfers)
    rows = encoders.unit_columns(profile.where(encoders.complete(ACTIVITY)), ACTIVITY)
    return tidy(rows.select(PARTY, *ACTIVITY), 9)
