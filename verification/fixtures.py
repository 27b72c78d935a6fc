"""The four business tables as views over the supplied test tables (see FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Business:
    """Invoices, transfers, logins and master data of one test folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        """A supplied table; timestamps without zone are read as UTC."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        zoned = {n: F.col(n).cast("timestamp") for n, t in df.dtypes if t == "timestamp_ntz"}
        return df.withColumns(zoned) if zoned else df

    @cached_property
    def invoices(self) -> DataFrame:
        net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        joined = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.select(
            F.col("o_custkey").alias("party_id"),
            F.col("o_orderdate").alias("issuedate"),
            F.col("l_shipdate").alias("duedate"),
            F.concat("l_returnflag", "l_linestatus").alias("currency"),
            net.alias("taxexclusiveamount"),
            (net * (1 + F.col("l_tax"))).alias("taxinclusiveamount"),
        )

    @cached_property
    def transfers(self) -> DataFrame:
        return self.table("events").where("event_type <> 'click'").select(
            F.col("event_id").alias("index"),
            F.col("user_id").alias("party_id"),
            F.regexp_extract("props", "[0-9]+", 0).alias("transfer_id"),
            F.col("value").alias("amount"),
            F.col("event_type").alias("currency"),
            F.col("ts").cast("date").alias("value_date"),
        )

    @cached_property
    def logins(self) -> DataFrame:
        return self.table("events").where("event_type = 'click'").select(
            F.col("event_id").alias("index"), F.col("user_id").alias("party_id"), F.col("ts").alias("last_login")
        )

    @cached_property
    def static(self) -> DataFrame:
        created = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min("o_orderdate").alias("created_on")
        )
        newest = self.logins.groupBy(F.col("party_id").alias("c_custkey")).agg(F.max("last_login").alias("newest"))
        key = F.col("c_custkey")

        def gap(every: int, value: Column) -> Column:
            return F.when(key % every != 0, value)

        band = F.get(
            F.array(F.lit("1 fő"), F.lit("2-5 fő"), F.lit("10-19 fő"), F.lit("250+ fő")), (key % 5).cast("int")
        )
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(created, "c_custkey", "left")
            .join(newest, "c_custkey", "left")
            .select(
                key.alias("index"),
                key.alias("party_id"),
                "created_on",
                F.when(key % 2 == 0, F.col("newest")).otherwise(F.date_trunc("day", "newest")).alias("last_login"),
                gap(17, F.col("r_name")).alias("county"),
                gap(13, F.col("n_nationkey")).alias("region"),
                band.alias("size"),
                gap(11, F.col("c_mktsegment")).alias("package"),
                gap(7, F.floor("c_acctbal").cast("int")).alias("lob_code"),
            )
        )


# The same views for the SQL side.
SQL_VIEWS = """WITH invoice_history AS (
  SELECT o_custkey AS party_id, o_orderdate AS issuedate, l_shipdate AS duedate,
         concat(l_returnflag, l_linestatus) AS currency,
         l_extendedprice * (1 - l_discount) AS taxexclusiveamount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS taxinclusiveamount,
         date_diff('day', o_orderdate, l_shipdate) AS inv_period
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
transfer_history AS (
  SELECT event_id AS index_, user_id AS party_id, regexp_extract(props, '[0-9]+', 0) AS transfer_id,
         value AS amount, event_type AS currency, CAST(ts AS DATE) AS value_date
  FROM events WHERE event_type <> 'click'),
customer_login AS (
  SELECT event_id AS index_, user_id AS party_id, ts AS last_login FROM events WHERE event_type = 'click'),
static_raw AS (
  SELECT c_custkey AS index_, c_custkey AS party_id, o.created_on,
         CASE WHEN c_custkey % 2 = 0 THEN l.last_login ELSE date_trunc('day', l.last_login) END AS last_login,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE r_name END AS county,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_nationkey END AS region,
         CASE c_custkey % 5 WHEN 0 THEN '1 fő' WHEN 1 THEN '2-5 fő' WHEN 2 THEN '10-19 fő' WHEN 3 THEN '250+ fő' END AS size,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS package,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(floor(c_acctbal) AS INT) END AS lob_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created_on FROM orders GROUP BY o_custkey) o ON o.o_custkey = c_custkey
  LEFT JOIN (SELECT user_id, max(ts) AS last_login FROM events WHERE event_type = 'click' GROUP BY user_id) l
    ON l.user_id = c_custkey)"""
