import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partylens import schemas
from partylens.session import stage_path
from partylens.sources import files, keyed

KEY = ("party_id",)


@pytest.fixture()
def path(spark):
    return stage_path(spark, "test")


def frame(spark, *data):
    return spark.createDataFrame(list(data), "party_id long, version long, x double")


AT = "version"


def test_last_write_wins_and_repeat_changes_nothing(spark, path, rows):
    keyed.upsert(frame(spark, (1, 1, 1.0), (1, 2, 0.5), (2, 1, 3.0), (None, 1, 9.0)), path, KEY, AT, "w", 0)
    keyed.upsert(frame(spark, (2, 2, -4.0), (3, 1, 5.0)), path, KEY, AT, "w", 1)
    want = [(1, 2, 0.5), (2, 2, -4.0), (3, 1, 5.0)]
    assert rows(keyed.read_keyed(spark, path, KEY)) == want
    keyed.upsert(frame(spark, (2, 2, -4.0), (3, 1, 5.0)), path, KEY, AT, "w", 1)
    assert rows(keyed.read_keyed(spark, path, KEY)) == want


def test_writers_keep_to_their_own_rows(spark, path, rows):
    keyed.upsert(frame(spark, (1, 1, 1.0), (2, 1, 1.0)), path, KEY, AT, "one", 0)
    keyed.upsert(frame(spark, (4, 1, 1.0)), path, KEY, AT, "two", 0)
    keyed.upsert(frame(spark, (5, 1, 1.0)), path, KEY, AT)
    keyed.upsert(frame(spark, (5, 0, 7.0)), path, KEY, AT)
    assert [r[0] for r in rows(keyed.read_keyed(spark, path, KEY))] == [1, 2, 4, 5]
    assert (5, 1, 1.0) in rows(keyed.read_keyed(spark, path, KEY))


def test_a_later_write_may_bring_a_null(spark, path, rows):
    keyed.upsert(frame(spark, (1, 1, 1.0)), path, KEY, AT)
    keyed.upsert(frame(spark, (1, 2, None)), path, KEY, AT)
    assert rows(keyed.read_keyed(spark, path, KEY)) == [(1, 2, None)]


def test_missing_table(spark, path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        keyed.read_keyed(spark, path, KEY)


def test_declared_tables_check_columns_and_cast(spark, path):
    good = spark.createDataFrame([(7, "[1.0]", 2.0)], "party_id int, features string, prediction double")
    assert schemas.conform(good, "predictions").schema == schemas.PREDICTIONS
    with pytest.raises(ValueError, match="prediction"):
        schemas.conform(good.drop("prediction"), "predictions")
    for name, (layout, key) in schemas.TABLES.items():
        assert set(key) <= set(layout.fieldNames()), name


def test_one_feature_order_for_training_and_scoring():
    assert len(schemas.FEATURE_COLUMNS) == 23
    assert all(not isinstance(schemas.MESSAGE[c].dataType, T.StringType) for c in schemas.FEATURE_COLUMNS)


def test_predictions_by_features(spark, rows):
    df = spark.createDataFrame([(1, "[1.0]", 0), (2, "[1.0]", 0), (3, "[2.0]", 1)], schemas.PREDICTIONS)
    assert rows(keyed.predictions_by_features(df)) == [("[1.0]", 0), ("[2.0]", 1)]


def test_connector_and_catalog_tables(spark, path, rows):
    frame(spark, (1, 1, 1.0)).createOrReplaceTempView("some_parties")
    assert rows(keyed.load_table(spark, "some_parties")) == [(1, 1, 1.0)]
    keyed.save_table(frame(spark, (1, 1, 1.0)), "t", "parquet", path=path)
    assert rows(keyed.load_table(spark, "t", "parquet", path=path)) == [(1, 1, 1.0)]


@pytest.mark.parametrize("infer", [True, False])
def test_numbered_csv(spark, path, infer):
    df = spark.createDataFrame([(0, 5, 5, "a,b"), (1, 6, 6, None)], ["Unnamed: 0", "PARTY_ID", "PARTY_ID.1", "COUNTY"])
    files.write_csv(df, path)
    found = files.read_csv(spark, path, infer=infer)
    assert found.columns == ["index", "party_id", "county"]
    assert sorted(str(r.county) for r in found.collect()) == ["None", "a,b"]


def test_csv_columns_go_by_name(spark, path):
    text = spark.createDataFrame([("AMOUNT,,PARTY_ID,PARTY_ID,TRANSFER_ID",), ("99.0,0,7,7,12.5",)], "value string")
    text.coalesce(1).write.text(path)
    wanted = schemas.layout(party_id="long", transfer_id="text", amount="double")
    assert [tuple(r) for r in files.read_csv(spark, path, wanted).collect()] == [(7, "12.5", 99.0)]
    assert files.read_csv(spark, path).columns == ["amount", "_c1", "party_id", "transfer_id"]
    with pytest.raises(ValueError, match="currency"):
        files.read_csv(spark, path, schemas.RAW_TRANSFERS)


@pytest.mark.parametrize("name", ["RAW_INVOICES", "RAW_TRANSFERS", "RAW_LOGINS", "RAW_STATIC", "CLEAN_STATIC"])
def test_declared_files_in_another_order(spark, path, name):
    wanted = getattr(schemas, name)
    names = [f.name for f in wanted][::-1]
    spark.range(1).select(*[F.lit(i).alias(n.upper()) for i, n in enumerate(names)]).write.option("header", True).csv(path)
    row = files.read_csv(spark, path, wanted).first()
    assert [int(float(row[n])) for n in names] == list(range(len(names)))


def test_csv_with_schema_turns_bad_numbers_to_null(spark, path):
    spark.createDataFrame([("1", "x"), ("2", "3.5")], ["a", "b"]).write.option("header", True).csv(path)
    found = files.read_csv(spark, path, schemas.layout(a="long", b="double"))
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, None), (2, 3.5)]


def test_features_from_csv_text_dates(spark, path):
    from partylens.plans.features import invoice_features

    data = [(0, 1, "2020-01-31", "2020-01-01", "2020-01-01", "HUF", 127.0, 100.0, 127.0),
            (1, 1, "bad", "2020-01-01", "2020-01-01", "EUR", 10.0, 8.0, 10.0),
            (2, None, "2020-01-31", "2020-01-01", "2020-01-01", "EUR", 1.0, 1.0, 1.0)]
    files.write_csv(spark.createDataFrame(data, schemas.RAW_INVOICES), path)
    raw = files.read_csv(spark, path, schemas.RAW_INVOICES)
    row = invoice_features(raw).first().asDict()
    assert row["party_id"] == 1 and row["count"] == 2 and row["curr"] == "EUR:1 HUF:1"
    assert row["currency_vec"] == "(2,[0,1],[1.0,1.0])"
    assert (row["sum_taxinclusiveamount"], row["avg_inv_period"]) == (137.0, 30.0)
    spelled = invoice_features(raw, spelled=True).first()
    assert spelled["curr"] == ["EUR", "HUF"]
    assert set(row) == set(schemas.INVOICES.fieldNames())


def test_merged_tables_read_the_same(spark, rows):
    path = stage_path(spark, "merge")
    keyed.upsert(frame(spark, (1, 1, 1.0), (2, 1, 2.0), (3, 1, 3.0)), path, KEY, AT, "w", 0)
    keyed.upsert(frame(spark, (2, 3, -2.0), (4, 1, 4.0)), path, KEY, AT, "w", 1)
    before = rows(keyed.read_keyed(spark, path, KEY))
    keyed.merge(spark, path, KEY, 3)
    assert rows(keyed.read_keyed(spark, path, KEY)) == before
    keyed.merge(spark, path, KEY, 3)  # nothing new
    assert len(keyed._listed(spark, f"{path}/_merged/pointers/number=*")) == 1
    # Older, equal, newer and new rows since; a repeat of a merged batch is not read.
    keyed.upsert(frame(spark, (1, 0, 9.0), (2, 3, -2.0), (3, 2, 33.0), (5, 1, 5.0)), path, KEY, AT, "w", 2)
    keyed.upsert(frame(spark, (1, 7, 70.0)), path, KEY, AT, "w", 1)
    want = [(1, 1, 1.0), (2, 3, -2.0), (3, 2, 33.0), (4, 1, 4.0), (5, 1, 5.0)]
    assert rows(keyed.read_keyed(spark, path, KEY)) == want
    keyed.merge(spark, path, KEY, 3)
    assert rows(keyed.read_keyed(spark, path, KEY)) == want
    keyed.clean(spark, path)
    assert rows(keyed.read_keyed(spark, path, KEY)) == want
    assert not keyed._listed(spark, f"{path}/writer=*/batch=*") and len(keyed._listed(spark, f"{path}/_merged/generations/*/*.parquet")) <= 3
    keyed.upsert(frame(spark, (6, 1, 6.0)), path, KEY, AT)
    assert rows(keyed.read_keyed(spark, path, KEY)) == [*want, (6, 1, 6.0)]


def test_merge_that_dies_changes_nothing(spark, rows, monkeypatch):
    path = stage_path(spark, "dies")
    keyed.upsert(frame(spark, (1, 1, 1.0)), path, KEY, AT, "w", 0)
    # A write without its end mark is not read and not merged.
    frame(spark, (8, 1, 8.0)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/writer=w/batch=1")
    system, where = keyed._files(spark, f"{path}/writer=w/batch=1/_SUCCESS")
    system.delete(where, False)
    monkeypatch.setattr(keyed, "_POINTER", "wrong")
    with pytest.raises(Exception):
        keyed.merge(spark, path, KEY, 2)
    monkeypatch.undo()
    assert rows(keyed.read_keyed(spark, path, KEY)) == [(1, 1, 1.0)]
    keyed.merge(spark, path, KEY, 2)
    assert rows(keyed.read_keyed(spark, path, KEY)) == [(1, 1, 1.0)]
    with pytest.raises(AnalysisException):
        keyed.read_keyed(spark, stage_path(spark, "nothing"), KEY)


def test_joins_on_the_key_of_a_merged_table_do_not_shuffle_it(spark):
    paths = [stage_path(spark, name) for name in ("left", "right")]
    for path in paths:
        keyed.upsert(frame(spark, *[(i, 1, float(i)) for i in range(50)]), path, KEY, AT, "w", 0)
        keyed.merge(spark, path, KEY, 4)
    left, right = (keyed.read_keyed(spark, path, KEY) for path in paths)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right.withColumnRenamed("x", "y"), list(KEY))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
