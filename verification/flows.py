"""Sources, sinks and streams. Each run works in a fresh folder of the shared stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partylens import schemas
from partylens.operators.encoders import assembled
from partylens.plans import customers, features
from partylens.session import stable, stage_path
from partylens.sources import files, keyed
from partylens.streaming import messages, scoring
from verification.fixtures import Business
from verification.plans import FAR_GROUPS, combined, spread_out
from verification.registry import query, tidy
from verification.sql_views import CLEAN, COMBINED, INVOICES, TRANSFERS

PARTY = "party_id"
LINE = schemas.layout(index="long", party_id="long", transfer_id="text", amount="double", currency="text")
LINE_SQL = "SELECT index_ AS row_id, party_id, transfer_id, amount, currency FROM transfer_history"


def lines(b: Business) -> DataFrame:
    return b.transfers.select(*[f.name for f in LINE])


def published(b: Business) -> str:
    path = stage_path(b.spark, "messages")
    messages.publish(lines(b), path, order="index", files=4, schema=LINE)
    return path


def as_rows(texts: DataFrame) -> DataFrame:
    rows = messages.parsed(texts, LINE).where(F.col(messages.CORRUPT).isNull())
    return rows.drop("value", messages.CORRUPT, *messages.ARRIVAL).withColumnRenamed("index", "row_id")


# Files

@query("sc01_csv_scan", """SELECT party_id, currency, strftime(issuedate, '%Y-%m-%d') AS issuedate,
strftime(duedate, '%Y-%m-%d') AS duedate, round(taxinclusiveamount, 6) AS taxinclusiveamount FROM invoice_history""")
def _(b: Business) -> DataFrame:
    path = stage_path(b.spark, "invoices-csv")
    texts = {c: F.date_format(c, "yyyy-MM-dd") for c in ("issuedate", "duedate")}
    # In another order than declared below.
    names = ["taxinclusiveamount", "duedate", "currency", PARTY, "issuedate"]
    files.write_csv(b.invoices.withColumns(texts).select(*names), path)
    kinds = schemas.layout(
        party_id="long", currency="text", issuedate="text", duedate="text", taxinclusiveamount="double")
    return tidy(files.read_csv(b.spark, path, kinds))


@query("sc02_numbered_csv_scan", """SELECT index_ AS "index", party_id, epoch_us(created_on) AS created_on, epoch_us(last_login) AS last_login, county, region, size,
package, lob_code::BIGINT AS lob_code FROM static_raw""")
def _(b: Business) -> DataFrame:
    path = stage_path(b.spark, "static-csv")
    texts = {c: F.col(c).cast("string") for c in ("created_on", "last_login")}
    order = ["index", PARTY, "size", "county", "region", PARTY, "package", "lob_code", "last_login", "created_on"]
    header = ["Unnamed: 0", "PARTY_ID", "SIZE", "COUNTY", "REGION", "PARTY_ID", "PACKAGE", "LOB_CODE", "LAST_LOGIN", "CREATED_ON"]
    files.write_csv(b.static.withColumns(texts).select(*order).toDF(*header), path)
    rows = files.read_csv(b.spark, path, schemas.RAW_STATIC)
    return rows.withColumns({**{c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("created_on", "last_login")}, "lob_code": F.col("lob_code").cast("bigint")})


@query("sk02_csv_export", "SELECT party_id, curr, round(sum_taxinclusiveamount, 6) AS amount, \"count\" FROM invoices", INVOICES)
def _(b: Business) -> DataFrame:
    path = stage_path(b.spark, "features-csv")
    files.write_csv(features.invoice_features(b.invoices), path)
    rows = files.read_csv(b.spark, path, schemas.INVOICES)
    return tidy(rows.select(PARTY, "curr", F.col("sum_taxinclusiveamount").alias("amount"), "count"))


# Keyed tables

@query("sc03_keyed_table_scan", "SELECT * FROM transfers", TRANSFERS)
def _(b: Business) -> DataFrame:
    root = stage_path(b.spark, "tables")
    keyed.write_table(features.transfer_features(b.transfers), root, "transfer_history", F.current_timestamp())
    return tidy(keyed.read_table(b.spark, root, "transfer_history"))


@query("sk01_keyed_upsert", """SELECT party_id, CASE WHEN party_id % 2 = 0 THEN 2 ELSE 1 END AS version,
CASE WHEN party_id % 2 = 0 THEN lob_code + 1 ELSE lob_code END AS lob_code FROM static_raw""")
def _(b: Business) -> DataFrame:
    path, key = stage_path(b.spark, "upsert"), (PARTY,)
    first = b.static.select(PARTY, F.lit(1).alias("version"), "lob_code")
    second = first.where(F.col(PARTY) % 2 == 0).withColumns({"version": F.lit(2), "lob_code": F.col("lob_code") + 1})
    keyed.upsert(first, path, key, F.col("version"))
    keyed.upsert(first.where(F.col(PARTY) % 2 == 0).unionByName(second), path, key, F.col("version"))
    return keyed.read_keyed(b.spark, path, key)


@query("sk01_last_write_wins", "SELECT party_id, 'a' AS note FROM static_raw")
def _(b: Business) -> DataFrame:
    """The later row has the lower text, and a late repeat of the older row must not come back."""
    path, key = stage_path(b.spark, "last"), (PARTY,)
    old = b.static.select(PARTY, F.lit("z").alias("note"), F.lit(1).alias("at"))
    new = b.static.select(PARTY, F.lit("a").alias("note"), F.lit(2).alias("at"))
    keyed.upsert(old.unionByName(new), path, key, F.col("at"), "one", 0)
    keyed.upsert(old, path, key, F.col("at"), "two", 0)
    return keyed.read_keyed(b.spark, path, key).drop("at")


@query("sk01_upsert_after_compaction", """SELECT party_id, CASE WHEN party_id % 3 = 0 THEN 'new' ELSE county END AS county
FROM static_raw""")
def _(b: Business) -> DataFrame:
    """A table read and written as one new table goes on taking rows."""
    path, key = stage_path(b.spark, "compacted"), (PARTY,)
    rows = b.static.select(PARTY, "county")
    keyed.upsert(rows.where(F.col(PARTY) % 2 == 0), f"{path}/old", key, F.lit(0))
    keyed.upsert(rows, f"{path}/old", key, F.lit(1))
    keyed.upsert(keyed.read_keyed(b.spark, f"{path}/old", key), f"{path}/new", key, F.lit(1))
    keyed.upsert(rows.where(F.col(PARTY) % 3 == 0).withColumn("county", F.lit("new")), f"{path}/new", key, F.lit(2))
    return keyed.read_keyed(b.spark, f"{path}/new", key)


@query("sk01_merged_after_fifty_writes", """SELECT party_id, CASE WHEN party_id % 50 IN (7, 8) THEN 'late' ELSE county END AS county,
CASE WHEN party_id % 50 = 7 THEN 200 WHEN party_id % 50 = 8 THEN 201 ELSE 50 + party_id % 50 END AS at, 8 AS files FROM static_raw""")
def _(b: Business) -> DataFrame:
    """Fifty small writes, merged twice, cleaned, and two writes since: one file per bucket and the writes since remain."""
    path, key = stage_path(b.spark, "fifty"), (PARTY,)
    rows = stable(b.static.select(PARTY, "county"))
    for n in range(50):
        part = rows.where(F.col(PARTY) % 50 == n).withColumn("at", F.lit(50 + n))
        stale = rows.where(F.col(PARTY) % 50 == (n + 1) % 50).withColumn("at", F.lit(n))
        keyed.upsert(part.unionByName(stale).coalesce(1), path, key, F.col("at"), "stream", n)
        if n in (20, 49):
            keyed.merge(b.spark, path, key, 8)
    keyed.clean(b.spark, path)
    files = len({f for f in keyed.read_keyed(b.spark, path, key).inputFiles()})
    for n, at in ((7, 200), (8, 201)):
        late = rows.where(F.col(PARTY) % 50 == n).select(PARTY, F.lit("late").alias("county"), F.lit(at).alias("at"))
        keyed.upsert(late, path, key, F.col("at"), "other", n)
    return keyed.read_keyed(b.spark, path, key).withColumns({"at": F.col("at").cast("bigint"), "files": F.lit(files)})


@query("sk05_repeated_batch", "SELECT party_id, county FROM static_raw")
def _(b: Business) -> DataFrame:
    path, key = stage_path(b.spark, "repeated"), (PARTY,)
    rows = b.static.select(PARTY, "county")
    for _ in range(2):
        keyed.upsert(rows.where(F.col(PARTY) % 2 == 0), path, key, F.lit(0), "one", 0)
    keyed.upsert(rows.where(F.col(PARTY) % 2 == 1), path, key, F.lit(0), "one", 1)
    return keyed.read_keyed(b.spark, path, key)


@query("sk07_declared_tables", """SELECT 'invoices' AS name, count(*) AS n, count(DISTINCT party_id) AS keys FROM invoices
UNION ALL SELECT 'transfer_history', count(*), count(DISTINCT party_id) FROM transfers
UNION ALL SELECT 'static_data', count(*), count(DISTINCT party_id) FROM clean
UNION ALL SELECT 'customer_login', count(*), count(DISTINCT index_) FROM customer_login""", f"{COMBINED}")
def _(b: Business) -> DataFrame:
    """The feature jobs written to their tables, each twice, and read back."""
    root = stage_path(b.spark, "tables")
    written = {
        "invoices": features.invoice_features(b.invoices),
        "transfer_history": features.transfer_features(b.transfers),
        "static_data": features.static_features(features.clean_static(b.static)),
        "customer_login": b.logins.withColumnRenamed("index", "id"),
    }
    out = None
    for name, rows in written.items():
        _, (key,) = schemas.TABLES[name]
        for version in range(2):
            keyed.write_table(rows, root, name, F.lit(version))
        counts = keyed.read_table(b.spark, root, name).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys"))
        counts = counts.select(F.lit(name).alias("name"), "n", "keys")
        out = counts if out is None else out.unionByName(counts)
    return out


# Messages

@query("sc04_stream_source", LINE_SQL)
def _(b: Business) -> DataFrame:
    source, target = published(b), stage_path(b.spark, "echo")
    stream = messages.message_stream(b.spark, "text", path=source, maxFilesPerTrigger=2)
    scoring.echo(stream, f"{target}-checkpoint", scoring.ALL_AVAILABLE, target).awaitTermination()
    return as_rows(b.spark.read.text(target))


@query("sc05_decode_bytes", LINE_SQL)
def _(b: Business) -> DataFrame:
    bytes_ = messages.as_messages(lines(b), LINE).select(F.col("value").cast("binary").alias("value"))
    return as_rows(messages.decoded(bytes_))


@query("sc06_parse_lines", """SELECT * EXCLUDE (index_) FROM combined""", COMBINED)
def _(b: Business) -> DataFrame:
    sent = messages.as_messages(combined(b))
    return tidy(messages.parsed(sent).drop("value", messages.CORRUPT))


@query("sk06_replay_as_messages", LINE_SQL)
def _(b: Business) -> DataFrame:
    return as_rows(b.spark.read.text(published(b)))


@query("sk03_raw_echo", "SELECT count(*) AS messages FROM transfer_history")
def _(b: Business) -> DataFrame:
    source, target = published(b), stage_path(b.spark, "echo")
    stream = messages.message_stream(b.spark, path=source)
    scoring.echo(stream, f"{target}-checkpoint", scoring.ALL_AVAILABLE, target).awaitTermination()
    return b.spark.read.text(target).agg(F.count(F.lit(1)).alias("messages"))


@query("sk04_micro_batch_sink", LINE_SQL)
def _(b: Business) -> DataFrame:
    source, target = published(b), stage_path(b.spark, "sink")
    stream = messages.parsed(messages.message_stream(b.spark, path=source, maxFilesPerTrigger=1), LINE)
    rows = stream.drop("value", messages.CORRUPT)
    query = scoring.upsert_stream(
        rows, target, ("index",), messages.arrival(), f"{target}-checkpoint", scoring.ALL_AVAILABLE)
    query.awaitTermination()
    stored = keyed.read_keyed(b.spark, target, ("index",)).drop(*messages.ARRIVAL)
    return stored.withColumnRenamed("index", "row_id")


# Scoring streams

class Scoring:
    """A trained model, the combined rows it was trained on, and folders for one stream."""

    def __init__(self, b: Business, rows: DataFrame | None = None):
        self.spark = b.spark
        self.rows = stable(rows if rows is not None else combined(b), "combined")
        self.model = customers.train_clusters(self.rows).model
        self.root = stage_path(b.spark, "scoring")

    def send(self, rows: DataFrame, part: str) -> None:
        messages.publish(rows, f"{self.root}/messages/{part}", files=2)

    def run(self, part: str = "*", checkpoint: str = "checkpoint") -> None:
        stream = messages.message_stream(self.spark, path=f"{self.root}/messages/{part}", maxFilesPerTrigger=1)
        scoring.score_messages(
            stream, self.model, self.root, f"{self.root}/{checkpoint}", scoring.ALL_AVAILABLE
        ).awaitTermination()

    def predictions(self) -> DataFrame:
        return keyed.read_table(self.spark, self.root, "predictions")


@query("s01_scored_stream", "SELECT party_id, true AS same_as_batch FROM combined", COMBINED)
def _(b: Business) -> DataFrame:
    run = Scoring(b)
    run.send(run.rows, "all")
    run.run()
    batch = scoring.scored(run.rows, run.model).select(PARTY, F.col("prediction").alias("batch"))
    both = run.predictions().join(batch, PARTY)
    return both.select(PARTY, (F.col("prediction") == F.col("batch")).alias("same_as_batch"))


@query("s01_newest_row_by_state", """SELECT party_id, max(amount) AS amount, arg_max(transfer_id, index_) AS transfer_id, max(index_) AS "index"
FROM (SELECT *, max(index_) OVER (PARTITION BY party_id) AS newest FROM transfer_history) WHERE index_ = newest GROUP BY 1""")
def _(b: Business) -> DataFrame:
    """The newest transfer of each party: sent in three parts, the last ones repeated and out of order, with a restart between."""
    root = stage_path(b.spark, "newest")
    rows = b.transfers.select(PARTY, "index", "transfer_id", "amount", F.timestamp_seconds(F.col("index")).alias("at"))
    third = F.col("index") % 3
    for n, part in enumerate((third == 1, third != 2, third != 1)):
        rows.where(part).write.parquet(f"{root}/in/part={n}")
        stream = b.spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
        scoring.keep_newest(
            stream, f"{root}/out", (PARTY,), "index", "at", f"{root}/checkpoint", "400 days", "1 day", 2, 4, scoring.ALL_AVAILABLE
        ).awaitTermination()
    return keyed.read_keyed(b.spark, f"{root}/out", (PARTY,)).select(PARTY, "amount", "transfer_id", "index")


@query("s04_restarted_stream", "SELECT party_id, CAST(1 AS BIGINT) AS rows FROM combined", COMBINED)
def _(b: Business) -> DataFrame:
    run = Scoring(b)
    run.send(run.rows.where(F.col(PARTY) % 2 == 0), "first")
    run.run()
    run.send(run.rows.where(F.col(PARTY) % 2 == 1), "second")
    run.run()
    run.run()
    return run.predictions().groupBy(PARTY).agg(F.count(F.lit(1)).alias("rows"))


@query("s04_second_checkpoint", "SELECT 'prediction' AS kind, party_id FROM combined UNION ALL "
       "SELECT 'reject', 0 UNION ALL SELECT 'reject', 1", COMBINED)
def _(b: Business) -> DataFrame:
    """Two queries with checkpoints of their own fill the same tables."""
    run = Scoring(b)
    for digit in range(2):
        part = f"part{digit}"
        run.send(run.rows.where(F.col(PARTY) % 2 == digit), part)
        b.spark.range(digit, digit + 1).select(F.col("id").cast("string")).write.mode("append").text(f"{run.root}/messages/{part}")
        run.run(part, f"checkpoint{digit}")
    rejects = b.spark.read.parquet(f"{run.root}/rejects").select(F.lit("reject").alias("kind"), F.col("value").cast("long").alias(PARTY))
    return run.predictions().select(F.lit("prediction").alias("kind"), PARTY).unionByName(rejects)


@query("s05_rejected_messages", """SELECT 'unreadable' AS reason, count(*) AS n FROM combined WHERE party_id % 10 IN (0, 1)
UNION ALL SELECT 'missing value', count(*) FROM combined WHERE party_id % 10 = 2
UNION ALL SELECT 'scored', count(*) FROM combined WHERE party_id % 10 > 2""", COMBINED)
def _(b: Business) -> DataFrame:
    run = Scoring(b)
    digit = F.col(PARTY) % 10
    spoiled = run.rows.withColumn("sum_amount", F.when(digit != 2, F.col("sum_amount")))
    sent = messages.as_messages(spoiled).select(
        "value", F.element_at(F.split("value", ","), 1).cast("long").alias(PARTY))
    text = (
        F.when(digit == 0, F.substring_index("value", ",", 5))
        .when(digit == 1, F.concat(F.col("value"), F.lit("?")))
        .otherwise(F.col("value"))
    )
    sent.select(text.alias("value")).write.text(f"{run.root}/messages/all")
    run.run()
    rejects = b.spark.read.parquet(f"{run.root}/rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    good = run.predictions().agg(F.count(F.lit(1)).alias("n")).select(F.lit("scored").alias("reason"), "n")
    return rejects.unionByName(good)


@query("m09_batch_and_stream_model", "SELECT count(*) AS scored, true AS nearest FROM combined", COMBINED)
def _(b: Business) -> DataFrame:
    run = Scoring(b)
    run.send(run.rows, "all")
    run.run()
    from partylens.operators.clustering import nearest_center

    centers = [list(map(float, c)) for c in run.model.bestModel.stages[0].clusterCenters()]
    expected = run.rows.select(PARTY, nearest_center(schemas.FEATURE_COLUMNS, centers).alias("expected"))
    return run.predictions().join(expected, PARTY).agg(
        F.count(F.lit(1)).alias("scored"), F.bool_and(F.col("prediction") == F.col("expected")).alias("nearest"))


@query("q11_score_feature_stream", FAR_GROUPS, COMBINED)
def _(b: Business) -> DataFrame:
    run = Scoring(b, spread_out(combined(b)))
    run.send(run.rows, "all")
    run.run()
    first = F.min(PARTY).over(Window.partitionBy("prediction"))
    return run.predictions().select(PARTY, first.alias("first_party"))


@query("q12_replay_combined", """SELECT * EXCLUDE (index_) FROM combined""", COMBINED)
def _(b: Business) -> DataFrame:
    path = stage_path(b.spark, "combined-messages")
    messages.publish(combined(b), path)
    return tidy(messages.parsed(b.spark.read.text(path)).drop("value", messages.CORRUPT))


_THIRDS = [[3.0, 0.0], [12.0, 2.0], [20.0, 4.0]]
_THIRDS_SQL = ", ".join(f"(region - {x}) * (region - {x}) + (county - {y}) * (county - {y})" for x, y in _THIRDS)


@query("predictions_by_features", f"""SELECT CAST(list_position([{_THIRDS_SQL}], list_min([{_THIRDS_SQL}])) - 1 AS INT) AS prediction,
count(DISTINCT (region, county)) AS features FROM clean GROUP BY ALL""", CLEAN)
def _(b: Business) -> DataFrame:
    from partylens.functions.vectors import vector_text
    from partylens.operators.clustering import nearest_center

    rows = assembled(features.clean_static(b.static), ["region", "county"])
    scores = rows.select(PARTY, vector_text(F.col("features")).alias("features"),
                         nearest_center(["region", "county"], _THIRDS).alias("prediction"))
    return keyed.predictions_by_features(scores).groupBy("prediction").agg(F.count("features").alias("features"))
