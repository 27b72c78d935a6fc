import pytest
from pyspark.sql import functions as F

from partylens import schemas
from partylens.operators.clustering import fit_kmeans
from partylens.operators.encoders import assembled
from partylens.session import stage_path
from partylens.sources import keyed
from partylens.streaming import messages, scoring

LINE = schemas.layout(party_id="long", note="text", x="double", n="long")


def test_parse_is_aware_of_quotes(spark):
    values = ['1,"[a, b]",2.5,3', "1,a,2.5", "", "1,a,zz,3", "party_id,note,x,n", "2,a,1.0,4,5"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    found = {r.value: r for r in messages.parsed(df, LINE).collect()}
    good = found[values[0]]
    assert (good.party_id, good.note, good.x, good.n, good._corrupt_record) == (1, "[a, b]", 2.5, 3, None)
    for bad in (values[1], values[3], values[4]):
        assert found[bad]._corrupt_record == bad, bad


def test_message_round_trip(spark, rows):
    df = spark.createDataFrame(
        [(1, 'with "quotes", commas', 0.1 + 0.2, 3), (2, None, None, None), (3, "(3,[0],[1.0])", -1e-300, -5)], LINE)
    back = messages.parsed(messages.as_messages(df, LINE), LINE).select(*df.columns)
    assert rows(back) == rows(df)


def test_fields_of_plain_lines(spark):
    df = spark.createDataFrame([("a,b,c",)], "value string")
    assert tuple(df.select(messages.field(F.col("value"), 1), messages.field(F.col("value"), 7)).first()) == ("b", None)


def test_publish_keeps_order_and_limit(spark):
    path = stage_path(spark, "publish")
    df = spark.createDataFrame([(i % 7, f"n{i}", float(i), i) for i in range(50)], LINE)
    messages.publish(df, path, files=3, schema=LINE)
    texts = [r.value for r in spark.read.text(path).collect()]
    assert len(texts) == 50
    path = stage_path(spark, "publish")
    messages.publish(df, path, order="n", limit=10, schema=LINE)
    assert sorted(int(r.value.rsplit(",", 1)[1]) for r in spark.read.text(path).collect()) == list(range(10))


def test_upsert_stream_restarts(spark, rows):
    root = stage_path(spark, "stream")
    for part in range(2):
        data = [(k, "b" if part else "a", float(part), part) for k in range(part, part + 3)]
        messages.publish(spark.createDataFrame(data, LINE), f"{root}/in/{part}", files=1, schema=LINE)
        for _ in range(2):
            stream = messages.parsed(messages.message_stream(spark, path=f"{root}/in/*"), LINE)
            scoring.upsert_stream(
                stream.drop("value", messages.CORRUPT), f"{root}/out", ("party_id",), messages.arrival(), f"{root}/cp",
                scoring.ALL_AVAILABLE,
            ).awaitTermination()
    stored = keyed.read_keyed(spark, f"{root}/out", ("party_id",)).drop(*messages.ARRIVAL)
    assert rows(stored) == [
        (0, "a", 0.0, 0), (1, "b", 1.0, 1), (2, "b", 1.0, 1), (3, "b", 1.0, 1)]


def feature_rows(spark, n):
    def value(f, i):
        return i if f.name == "party_id" else ("t" if f.name in schemas.TEXT_COLUMNS else (100 if i % 2 else 0) + i % 3)

    data = [tuple(float(v) if f.dataType.simpleString() == "double" else v
                  for f, v in ((f, value(f, i)) for f in schemas.MESSAGE)) for i in range(n)]
    return spark.createDataFrame(data, schemas.MESSAGE)


def test_scoring_rejects_bad_lines(spark):
    root = stage_path(spark, "score")
    rows = feature_rows(spark, 12)
    model = fit_kmeans(assembled(rows, schemas.FEATURE_COLUMNS), 2)
    messages.publish(rows, f"{root}/in/good", files=3)
    bad = ["", "1,2,3", "header," * 27 + "x"]
    spark.createDataFrame([(v,) for v in bad], "value string").coalesce(1).write.text(f"{root}/in/bad")
    stream = messages.message_stream(spark, path=f"{root}/in/*", maxFilesPerTrigger=1)
    scoring.score_messages(stream, model, root, f"{root}/cp", scoring.ALL_AVAILABLE).awaitTermination()
    found = {r.party_id: r.prediction for r in keyed.read_table(spark, root, "predictions").collect()}
    assert len(found) == 12 and len({found[i] for i in range(0, 12, 2)}) == 1 and found[0] != found[1]
    assert spark.read.parquet(f"{root}/rejects").count() == 3


def test_echo_to_files(spark):
    root = stage_path(spark, "echo")
    messages.publish(feature_rows(spark, 4), f"{root}/in")
    stream = messages.message_stream(spark, path=f"{root}/in")
    scoring.echo(stream, f"{root}/cp", scoring.ALL_AVAILABLE, f"{root}/out").awaitTermination()
    assert spark.read.text(f"{root}/out").count() == 4


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.message_stream(spark, "kafka", subscribe="t", kafka__bootstrap__servers="localhost:1")


def test_the_last_line_of_a_party_counts(spark, rows):
    """Also where its text is the lower one, and within one file."""
    root = stage_path(spark, "lines")
    lines = [(f"1,{note},{x},{i}",) for i, (note, x) in enumerate([("z", 9.0), ("m", 5.0), ("a", 1.0)])]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{root}/in")
    stream = messages.parsed(messages.message_stream(spark, path=f"{root}/in"), LINE).drop("value", messages.CORRUPT)
    scoring.upsert_stream(stream, f"{root}/out", ("party_id",), messages.arrival(), f"{root}/cp",
                          scoring.ALL_AVAILABLE).awaitTermination()
    assert rows(keyed.read_keyed(spark, f"{root}/out", ("party_id",)).drop(*messages.ARRIVAL)) == [(1, "a", 1.0, 2)]


def test_log_messages_keep_their_offset(spark):
    log = spark.createDataFrame([(b"x", "t", 3, 7)], "value binary, topic string, partition int, offset long")
    found = messages.decoded(log.withColumn("timestamp", F.timestamp_seconds(F.lit(5)))).first()
    assert (found.value, found._source, found._place) == ("x", "t-3", 7)
    assert messages.decoded(log.select("value")).columns == ["value"]


def test_five_second_trigger(spark):
    root = stage_path(spark, "trigger")
    rows = feature_rows(spark, 8)
    model = fit_kmeans(assembled(rows, schemas.FEATURE_COLUMNS), 2)
    messages.publish(rows, f"{root}/in", files=1)
    query = scoring.score_messages(messages.message_stream(spark, path=f"{root}/in"), model, root, f"{root}/cp")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert keyed.read_table(spark, root, "predictions").count() == 8


def test_newest_rows_by_state(spark, rows):
    """Late, repeated and out-of-order messages and a restart; the table is merged after every second batch."""
    root = stage_path(spark, "state")
    kind = "party_id long, at timestamp, version long, x string"
    parts = [
        [(1, 100, 1, "a"), (2, 100, 1, "b"), (1, 150, 3, "c")],
        [(1, 150, 3, "c"), (1, 120, 2, "z"), (3, 90, 1, "d"), (None, 90, 1, "n")],
        [(2, 9000, 5, "e"), (4, 9000, 1, "f")],
        [(2, 100, 9, "too late"), (4, 8900, 0, "older"), (5, 8950, 1, "g")],
    ]
    for n, part in enumerate(parts):
        df = spark.createDataFrame([(k, v, x, at) for k, at, v, x in part], "party_id long, version long, x string, s long")
        df.select("party_id", F.timestamp_seconds("s").alias("at"), "version", "x").coalesce(1).write.parquet(f"{root}/in/part={n}")
        stream = spark.readStream.schema(kind).parquet(f"{root}/in/*")
        scoring.keep_newest(stream, f"{root}/out", ("party_id",), "version", "at", f"{root}/cp", "10 minutes", "10 minutes", 2, 2, scoring.ALL_AVAILABLE).awaitTermination()
    stored = keyed.read_keyed(spark, f"{root}/out", ("party_id",)).select("party_id", F.unix_seconds("at"), "version", "x")
    assert rows(stored) == [(1, 150, 3, "c"), (2, 9000, 5, "e"), (3, 90, 1, "d"), (4, 9000, 1, "f"), (5, 8950, 1, "g")]
    assert len(keyed._listed(spark, f"{root}/out/_merged/pointers/number=*")) >= 1


CONTINUOUS = """
import sys
from partylens.session import build_session
from partylens.streaming import scoring
spark = build_session("continuous", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
spark.sparkContext.setLogLevel("OFF")
rows = spark.readStream.format("rate").option("rowsPerSecond", 20).option("numPartitions", 2).load()
query = scoring.echo(rows.selectExpr("cast(value as string) as value"), sys.argv[1])
query.awaitTermination(10)
print("ACTIVE", query.isActive, query.exception(), flush=True)
query.stop()
query.awaitTermination(20)
print("STOPPED", query.isActive, flush=True)
"""


def test_continuous_echo_ends_when_stopped(tmp_path):
    """In a process of its own, which is ended if the query should not end."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.Popen([sys.executable, "-c", CONTINUOUS, str(tmp_path / "cp")], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True, start_new_session=True)
    try:
        out, _ = run.communicate(timeout=150)
    finally:
        if run.poll() is None:
            os.killpg(run.pid, 9)
    assert "ACTIVE True None" in out and "STOPPED False" in out
    assert out.count("Batch: ") >= 2
    shown = [int(line.strip("| ")) for line in out.splitlines() if line.strip("| ").isdigit()]
    assert len(shown) == len(set(shown)) > 0
