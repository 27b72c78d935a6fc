"""WITH entries that several SQL queries share."""

INVOICES = """,
pc AS (SELECT party_id, currency, count(*) AS n FROM invoice_history GROUP BY ALL),
vocab AS (SELECT currency, row_number() OVER (ORDER BY count(*) DESC, currency) - 1 AS pos
          FROM invoice_history GROUP BY currency),
lists AS (SELECT party_id, string_agg(currency || ':' || n, ' ' ORDER BY currency) AS curr,
                 '(' || (SELECT count(*) FROM vocab) || ',[' || string_agg(pos, ',' ORDER BY pos) || '],['
                 || string_agg(n || '.0', ',' ORDER BY pos) || '])' AS currency_vec
          FROM pc JOIN vocab USING (currency) GROUP BY party_id),
inv_stats AS (SELECT party_id,
   round(sum(taxinclusiveamount), 6) AS sum_taxinclusiveamount, round(avg(taxinclusiveamount), 1) AS avg_taxinclusiveamount,
   round(min(taxinclusiveamount), 6) AS min_taxinclusiveamount, round(max(taxinclusiveamount), 6) AS max_taxinclusiveamount,
   round(sum(taxexclusiveamount), 6) AS sum_taxexclusiveamount, round(avg(taxexclusiveamount), 1) AS avg_taxexclusiveamount,
   round(min(taxexclusiveamount), 6) AS min_taxexclusiveamount, round(max(taxexclusiveamount), 6) AS max_taxexclusiveamount,
   CAST(min(inv_period) AS DOUBLE) AS min_inv_period, CAST(max(inv_period) AS DOUBLE) AS max_inv_period,
   round(avg(inv_period), 6) AS avg_inv_period, count(*) AS "count"
   FROM invoice_history WHERE party_id IS NOT NULL GROUP BY party_id),
invoices AS (SELECT * FROM lists JOIN inv_stats USING (party_id))"""

TRANSFERS = """,
tpc AS (SELECT party_id, currency, count(*) AS n FROM transfer_history GROUP BY ALL),
tvocab AS (SELECT currency, row_number() OVER (ORDER BY count(*) DESC, currency) - 1 AS pos
           FROM transfer_history GROUP BY currency),
tlists AS (SELECT party_id, string_agg(currency || ':' || n, ' ' ORDER BY currency) AS transfer_curr,
                  '(' || (SELECT count(*) FROM tvocab) || ',[' || string_agg(pos, ',' ORDER BY pos) || '],['
                  || string_agg(n || '.0', ',' ORDER BY pos) || '])' AS transfer_currency_vec
           FROM tpc JOIN tvocab USING (currency) GROUP BY party_id),
transfers AS (SELECT party_id, any_value(transfer_curr) AS transfer_curr,
   any_value(transfer_currency_vec) AS transfer_currency_vec,
   round(sum(amount), 6) AS sum_amount, round(avg(amount), 8) AS avg_amount,
   round(min(amount), 6) AS min_amount, round(max(amount), 6) AS max_amount,
   count(*) AS "count", count(DISTINCT transfer_id) AS uniq_transfer_id_count
   FROM transfer_history JOIN tlists USING (party_id) GROUP BY party_id)"""

LOCATED = """,
c1 AS (SELECT * REPLACE (coalesce(county, (SELECT county FROM static_raw WHERE county IS NOT NULL
              GROUP BY county ORDER BY count(*) DESC, county LIMIT 1)) AS county) FROM static_raw),
rm AS (SELECT county, region AS usual FROM (
         SELECT county, region, row_number() OVER (PARTITION BY county ORDER BY count(*) DESC, region) AS rn
         FROM c1 WHERE region IS NOT NULL GROUP BY county, region) WHERE rn = 1),
located AS (SELECT index_, party_id, created_on, last_login, county, coalesce(region, usual) AS region,
                   size, package, lob_code FROM c1 LEFT JOIN rm USING (county))"""

CLEAN = LOCATED + """,
clean AS (SELECT index_, party_id,
   CAST(trunc(coalesce(lob_code, (SELECT avg(lob_code) FROM located))) AS BIGINT) AS lob_code,
   coalesce(try_cast(nullif(split_part(regexp_replace(coalesce(size, 'nan'), 'fő', '', 'g'), '-', 2), '') AS INT), 1) AS size,
   CAST(dense_rank() OVER (ORDER BY coalesce(package, 'nan')) - 1 AS INT) AS package,
   CAST(region AS INT) AS region,
   CAST(dense_rank() OVER (ORDER BY county) - 1 AS INT) AS county
   FROM located)"""

COMBINED = INVOICES + TRANSFERS + CLEAN + """,
combined AS (SELECT i.* EXCLUDE ("count"), i."count" AS invoices_count,
                    t.* EXCLUDE (party_id, "count"), t."count" AS transfers_count,
                    s.index_, s.lob_code, s.size, s.package, s.region, s.county
             FROM invoices i JOIN transfers t USING (party_id) JOIN clean s USING (party_id))"""

ACTIVITY = LOCATED + """,
lg AS (SELECT party_id, count(*) AS login_count
       FROM (SELECT DISTINCT party_id, last_login FROM customer_login) GROUP BY party_id),
tr AS (SELECT party_id, count(*) AS transfer_count, sum(amount) AS transfer_amount
       FROM (SELECT DISTINCT party_id, transfer_id, amount, currency, value_date FROM transfer_history)
       GROUP BY party_id),
ms AS (SELECT party_id, county || ' ' || region AS region,
              CAST(floor((epoch_us((SELECT max(created_on) FROM located)) - epoch_us(created_on)) / 86400000000.0) AS BIGINT) AS duration
       FROM located),
strict AS (SELECT party_id, login_count AS logins, transfer_count AS transfers, transfer_amount AS amount, duration, region
           FROM lg JOIN tr USING (party_id) JOIN ms USING (party_id)
           WHERE party_id IN (SELECT party_id FROM invoice_history)),
driven AS (SELECT party_id, login_count AS logins, coalesce(transfer_count, 0) AS transfers,
                  trunc(coalesce(transfer_amount, 0)) AS amount, duration, region
           FROM lg LEFT JOIN tr USING (party_id) LEFT JOIN ms USING (party_id))"""


def rates(source: str, name: str) -> str:
    """Monthly rates of an activity view, as WITH entry ``name``."""
    def rate(column: str) -> str:
        return f"CAST(round_even({column} * 1.0::DOUBLE / nullif(duration, 0) * 30, 0) AS BIGINT)"

    return f""",
{name} AS (SELECT party_id, {rate('logins')} AS login_count, {rate('transfers')} AS transfer_count,
   {rate('amount')} AS transfer_amount, duration, region FROM {source})"""


PROFILE = ACTIVITY + rates("driven", "profile")

UNIT = PROFILE + """,
whole_rows AS (SELECT * FROM profile WHERE login_count IS NOT NULL AND transfer_count IS NOT NULL
               AND transfer_amount IS NOT NULL AND duration IS NOT NULL),
norms AS (SELECT """ + ", ".join(
    f"sqrt(sum({c}::DOUBLE * {c})) AS n_{c}" for c in ["login_count", "transfer_count", "transfer_amount", "duration"]
) + """ FROM whole_rows),
unit AS (SELECT party_id, region, """ + ", ".join(
    f"CASE WHEN n_{c} = 0 THEN {c}::DOUBLE ELSE {c} / n_{c} END AS {c}"
    for c in ["login_count", "transfer_count", "transfer_amount", "duration"]
) + """ FROM whole_rows CROSS JOIN norms)"""
