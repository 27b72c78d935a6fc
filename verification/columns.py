"""Projections, filters, scalar functions, sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partylens.functions import dates, nulls, numbers, text, vectors
from partylens.operators import columns as ops
from partylens.operators import joins, quality
from partylens.operators.aggregates import histogram, ordered_histogram
from partylens.operators.encoders import assembled
from partylens.plans.features import located
from partylens.streaming.messages import field
from verification.fixtures import Business
from verification.registry import query, r, tidy
from verification.sql_views import ACTIVITY, LOCATED


@query("p01_select_columns", "SELECT index_ AS row_id, county, region FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select(F.col("index").alias("row_id"), "county", "region")


@query("p02_drop_columns", "SELECT party_id, size, package FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.drop("index", "created_on", "last_login", "county", "region", "lob_code", "not_there")


@query("p03_canonical_names", """SELECT party_id, round(sum(amount), 6) AS sum_amount, count(*) AS n
FROM transfer_history GROUP BY party_id""")
def _(b: Business) -> DataFrame:
    raw = b.transfers.withColumnsRenamed({"party_id": "PARTY_ID", "amount": "AMOUNT"})
    totals = raw.groupBy("PARTY_ID").agg(F.sum("AMOUNT"), F.count(F.lit(1)).alias("N"))
    return tidy(ops.canonical_columns(totals))


@query("p04_rename_column", "SELECT party_id, amount AS transfer_amount FROM transfer_history")
def _(b: Business) -> DataFrame:
    return b.transfers.select("party_id", "amount").withColumnRenamed("amount", "transfer_amount")


@query("p05_derived_column", """SELECT party_id, currency, CAST(inv_period AS DOUBLE) AS inv_period
FROM invoice_history""")
def _(b: Business) -> DataFrame:
    period = dates.period_days(F.col("issuedate"), F.col("duedate"))
    return b.invoices.withColumn("inv_period", period).select("party_id", "currency", "inv_period")


@query("p06_filter_text", """SELECT party_id, round(taxinclusiveamount, 6) AS amount
FROM invoice_history WHERE currency = 'AF'""")
def _(b: Business) -> DataFrame:
    rows = b.invoices.where(F.col("currency") == "AF")
    return rows.select("party_id", r("taxinclusiveamount").alias("amount"))


# The party looked up by key is the one with the most invoices.
BUSIEST = "(SELECT party_id FROM invoice_history GROUP BY party_id ORDER BY count(*) DESC, party_id LIMIT 1)"


def busiest(b: Business):
    return histogram(b.invoices, "party_id").orderBy(F.desc("n"), "party_id").limit(1).select("party_id").scalar()


@query("p07_filter_key", f"""SELECT currency, CAST(inv_period AS DOUBLE) AS inv_period, round(taxexclusiveamount, 6) AS amount
FROM invoice_history WHERE party_id = {BUSIEST}""")
def _(b: Business) -> DataFrame:
    rows = b.invoices.where(F.col("party_id") == busiest(b))
    period = dates.period_days(F.col("issuedate"), F.col("duedate")).alias("inv_period")
    return rows.select("currency", period, r("taxexclusiveamount").alias("amount"))


@query("p08_filter_any_flag", """SELECT party_id, CAST(county = 'ASIA' AS INT) AS asia, CAST(county = 'EUROPE' AS INT) AS europe
FROM static_raw WHERE county = 'ASIA' OR county = 'EUROPE'""")
def _(b: Business) -> DataFrame:
    flags = b.static.select(
        "party_id",
        (F.col("county") == "ASIA").cast("int").alias("asia"),
        (F.col("county") == "EUROPE").cast("int").alias("europe"),
    )
    return flags.where(ops.any_flag("asia", "europe"))


_GAPS = ["created_on", "last_login", "county", "region", "size", "package", "lob_code"]


@query("p09_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM static_raw" for c in _GAPS))
def _(b: Business) -> DataFrame:
    return quality.null_counts(b.static, _GAPS)


@query("p10_null_aware_mismatch", """SELECT s.party_id FROM static_raw s LEFT JOIN
(SELECT party_id, max(last_login) AS newest FROM customer_login GROUP BY party_id) l ON s.party_id = l.party_id
WHERE NOT coalesce(s.last_login = l.newest, false)""")
def _(b: Business) -> DataFrame:
    newest = b.logins.groupBy("party_id").agg(F.max("last_login").alias("newest"))
    both = b.static.join(newest, "party_id", "left")
    return both.where(nulls.differs(F.col("last_login"), F.col("newest"))).select("party_id")


@query("p11_drop_duplicate_rows", """SELECT min(index_) AS row_id, party_id, transfer_id, currency
FROM transfer_history GROUP BY party_id, transfer_id, currency""")
def _(b: Business) -> DataFrame:
    rows = b.transfers.select("index", "party_id", "transfer_id", "currency")
    return ops.drop_duplicate_rows(rows, "index").withColumnRenamed("index", "row_id")


@query("p12_distinct_keys", "SELECT DISTINCT party_id FROM customer_login")
def _(b: Business) -> DataFrame:
    return joins.keys(b.logins, "party_id")


@query("p13_replace_values", """SELECT party_id, CASE WHEN county = 'ASIA' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS asia
FROM static_raw WHERE county IS NOT NULL""")
def _(b: Business) -> DataFrame:
    flags = b.static.dropna(subset=["county"]).withColumn("asia", (F.col("county") == "ASIA").cast("int"))
    return flags.select("party_id", numbers.replaced(F.col("asia"), {1: 0.05}).alias("asia"))


@query("p14_add_row_aligned_columns", """SELECT index_ AS row_id, amount, CAST(currency = 'view' AS INT) AS is_view
FROM transfer_history""")
def _(b: Business) -> DataFrame:
    rows = b.transfers.withColumn("is_view", (F.col("currency") == "view").cast("int"))
    return rows.select(F.col("index").alias("row_id"), "amount", "is_view")


@query("p15_profile_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count({c}) AS known FROM static_raw"
    for c, t in {"party_id": "bigint", "county": "string", "region": "int", "size": "string",
                 "package": "string", "lob_code": "int"}.items()))
def _(b: Business) -> DataFrame:
    return quality.profile_table(b.static.drop("index", "created_on", "last_login"))


@query("w01_first_row_per_key", """SELECT party_id, index_ AS row_id, amount FROM transfer_history
QUALIFY row_number() OVER (PARTITION BY party_id ORDER BY index_) = 1""")
def _(b: Business) -> DataFrame:
    first = ops.first_rows(b.transfers, "party_id", [F.asc("index")])
    return first.select("party_id", F.col("index").alias("row_id"), "amount")


@query("o01_sort_by_count", """SELECT currency, count(*) AS n FROM transfer_history GROUP BY currency ORDER BY n, currency""")
def _(b: Business) -> DataFrame:
    return ordered_histogram(b.transfers, "currency")


@query("o02_sort_descending", """SELECT party_id, count(*) AS n FROM customer_login GROUP BY party_id ORDER BY n DESC, party_id""")
def _(b: Business) -> DataFrame:
    return ordered_histogram(b.logins, "party_id", descending=True)


@query("o03_top_rows", """SELECT party_id, count(*) AS n FROM customer_login GROUP BY party_id
ORDER BY n DESC, party_id LIMIT 20""")
def _(b: Business) -> DataFrame:
    return ops.top_rows(histogram(b.logins, "party_id"), 20, F.desc("n"), F.asc("party_id"))


@query("o04_preview", """SELECT party_id, epoch_us(issuedate) AS issuedate, epoch_us(duedate) AS duedate, currency, round(taxexclusiveamount, 6) AS taxexclusiveamount,
round(taxinclusiveamount, 6) AS taxinclusiveamount FROM invoice_history ORDER BY ALL LIMIT 20""")
def _(b: Business) -> DataFrame:
    """The first rows of the whole table, all columns."""
    rows = tidy(b.invoices.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("issuedate", "duedate")}))
    names = ["party_id", "issuedate", "duedate", "currency", "taxexclusiveamount", "taxinclusiveamount"]
    return ops.top_rows(rows.select(*names), 20, *[F.asc(c) for c in names])


@query("f01_parse_dates", """SELECT party_id, epoch_us(issuedate) AS issued, epoch_us(duedate) AS due FROM invoice_history""")
def _(b: Business) -> DataFrame:
    texts = b.invoices.select("party_id", *[
        F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("issuedate", "duedate")])
    return texts.select(
        "party_id",
        F.unix_micros(dates.as_timestamp(texts, "issuedate")).alias("issued"),
        F.unix_micros(dates.as_timestamp(texts, "duedate")).alias("due"),
    )


@query("f02_epoch_seconds", "SELECT index_ AS row_id, CAST(floor(epoch_us(last_login) / 1000000.0) AS BIGINT) AS seconds FROM customer_login")
def _(b: Business) -> DataFrame:
    return b.logins.select(F.col("index").alias("row_id"), dates.epoch_seconds(F.col("last_login")).alias("seconds"))


@query("f03_period_days", """SELECT party_id, CAST(date_diff('day', issuedate, duedate) AS DOUBLE) AS days FROM invoice_history""")
def _(b: Business) -> DataFrame:
    return b.invoices.select("party_id", dates.period_days(F.col("issuedate"), F.col("duedate")).alias("days"))


@query("f04_whole_days", """SELECT index_ AS row_id, CAST(floor((epoch_us((SELECT max(last_login) FROM customer_login))
- epoch_us(last_login)) / 86400000000.0) AS BIGINT) AS days FROM customer_login""")
def _(b: Business) -> DataFrame:
    newest = b.logins.agg(F.max("last_login")).scalar()
    return b.logins.select(F.col("index").alias("row_id"), dates.whole_days(F.col("last_login"), newest).alias("days"))


@query("f05_monthly_rate", """SELECT party_id, CAST(round_even(logins * 1.0::DOUBLE / nullif(duration, 0) * 30, 0) AS BIGINT) AS logins,
CAST(round_even(amount / nullif(duration, 0) * 30, 0) AS BIGINT) AS amount FROM driven""", ACTIVITY)
def _(b: Business) -> DataFrame:
    static = located(b.static)
    present = static.agg(F.max("created_on")).scalar()
    days = static.select("party_id", dates.whole_days(F.col("created_on"), present).alias("days"))
    logins = ops.drop_duplicate_rows(b.logins, "index").groupBy("party_id").agg(F.count(F.lit(1)).alias("logins"))
    sent = ops.drop_duplicate_rows(b.transfers, "index").groupBy("party_id").agg(F.sum("amount").alias("amount"))
    sent = sent.withColumn("amount", numbers.whole(F.col("amount")))
    rows = joins.left_with_defaults(logins, sent, "party_id", {"amount": 0}).join(days, "party_id", "left")
    return rows.select("party_id", *[
        numbers.monthly_rate(F.col(c), F.col("days")).alias(c) for c in ("logins", "amount")])


@query("f06_scale_by_norm", """SELECT index_ AS row_id, round(amount / sqrt(sum(amount * amount) OVER ()), 9) AS scaled
FROM transfer_history""")
def _(b: Business) -> DataFrame:
    norm = b.transfers.agg(F.sqrt(F.sum(F.col("amount") * F.col("amount")))).scalar()
    return b.transfers.select(
        F.col("index").alias("row_id"), r(numbers.scaled(F.col("amount"), norm), 9).alias("scaled"))


@query("f07_round", "SELECT party_id, round(avg(amount), 2) + 0.0 AS mean FROM transfer_history GROUP BY party_id")
def _(b: Business) -> DataFrame:
    return b.transfers.groupBy("party_id").agg(numbers.rounded(F.avg("amount")).alias("mean"))


@query("f08_cut_to_integer", "SELECT index_ AS row_id, CAST(trunc(amount) AS BIGINT) AS amount FROM transfer_history")
def _(b: Business) -> DataFrame:
    return b.transfers.select(F.col("index").alias("row_id"), numbers.whole(F.col("amount")).alias("amount"))


@query("f09_text_to_number", """SELECT index_ AS row_id, try_cast(transfer_id AS INT) AS good, CAST(NULL AS INT) AS bad FROM transfer_history""")
def _(b: Business) -> DataFrame:
    return b.transfers.select(
        F.col("index").alias("row_id"),
        numbers.number(F.col("transfer_id"), "int").alias("good"),
        numbers.number(F.col("currency"), "int").alias("bad"),
    )


@query("f10_any_to_text", "SELECT party_id, coalesce(package, 'nan') AS package, coalesce(CAST(region AS VARCHAR), 'nan') AS region FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", *[text.as_text(F.col(c)).alias(c) for c in ("package", "region")])


@query("f11_remove_unit", "SELECT party_id, replace(size, 'fő', '') AS size FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", text.without(F.col("size"), text.HEADCOUNT_UNIT).alias("size"))


@query("f12_second_part", "SELECT party_id, nullif(split_part(size, '-', 2), '') AS part FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", text.part(F.col("size"), "-", 1).alias("part"))


@query("f13_field_of_line", "SELECT index_ AS row_id, currency FROM transfer_history")
def _(b: Business) -> DataFrame:
    line = F.concat_ws(",", "index", "transfer_id", "currency", "amount")
    return b.transfers.select(F.col("index").alias("row_id"), field(line, 2).alias("currency"))


@query("f14_join_words", "SELECT party_id, county || ' ' || CAST(region AS VARCHAR) AS place FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", text.words(F.col("county"), F.col("region")).alias("place"))


@query("f16_strip_list_marks", "SELECT index_ AS row_id, currency || ', ' || transfer_id AS stripped FROM transfer_history")
def _(b: Business) -> DataFrame:
    listed = F.concat(F.lit('["'), "currency", F.lit('", "'), "transfer_id", F.lit('"]'))
    return b.transfers.select(F.col("index").alias("row_id"), text.without_list_marks(listed).alias("stripped"))


@query("f17_fill_constant", "SELECT party_id, coalesce(region, 0) AS region, coalesce(size, '1') AS size FROM static_raw")
def _(b: Business) -> DataFrame:
    return b.static.select(
        "party_id", nulls.filled(F.col("region"), 0).alias("region"), nulls.filled(F.col("size"), "1").alias("size"))


@query("f18_fill_from_data", """SELECT party_id, county, region,
round(coalesce(lob_code, (SELECT avg(lob_code) FROM located)), 6) AS lob_code FROM located""", LOCATED)
def _(b: Business) -> DataFrame:
    from partylens.operators.impute import fill_mean

    return tidy(fill_mean(located(b.static), "lob_code").select("party_id", "county", "region", "lob_code"), 6)


@query("f19_size_band", """SELECT party_id, coalesce(try_cast(nullif(split_part(regexp_replace(coalesce(size, 'nan'),
'fő', '', 'g'), '-', 2), '') AS INT), 1) AS size FROM static_raw""")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", text.size_band(F.col("size")).alias("size"))


@query("f19_size_band_lower_bound", """SELECT party_id, coalesce(try_cast(nullif(split_part(regexp_replace(size,
'fő', '', 'g'), '-', 2), '') AS INT), try_cast(nullif(regexp_extract(size, '[0-9]+'), '') AS INT), 1) AS size FROM static_raw""")
def _(b: Business) -> DataFrame:
    return b.static.select("party_id", text.size_band(F.col("size"), "lower_bound").alias("size"))


@query("f20_array_element", "SELECT index_ AS row_id, transfer_id AS second, CAST(NULL AS VARCHAR) AS fifth FROM transfer_history")
def _(b: Business) -> DataFrame:
    items = F.array("currency", "transfer_id")
    return b.transfers.select(
        F.col("index").alias("row_id"), F.get(items, F.lit(1)).alias("second"), F.get(items, F.lit(4)).alias("fifth"))


@query("f21_vector_text", """SELECT party_id, '[' || CAST(region AS VARCHAR) || '.0,' || CAST(party_id AS VARCHAR) || '.0]' AS vector
FROM static_raw WHERE region IS NOT NULL""")
def _(b: Business) -> DataFrame:
    rows = assembled(b.static.dropna(subset=["region"]), ["region", "party_id"])
    return rows.select("party_id", vectors.vector_text(F.col("features")).alias("vector"))


@query("u02_line_to_vector", """SELECT index_ AS row_id, '[' || index_ || '.0,' || party_id || '.0]' AS vector
FROM transfer_history""")
def _(b: Business) -> DataFrame:
    line = F.concat_ws(",", "index", "party_id", "amount")
    return b.transfers.select(
        F.col("index").alias("row_id"), vectors.vector_text(vectors.line_vector(line)).alias("vector"))
