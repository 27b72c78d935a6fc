import datetime as dt

import pytest
from pyspark.sql import functions as F

from partylens.functions import dates, nulls, numbers, text, vectors


def one(spark, schema, values, column):
    return [r[0] for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
            .select(column).collect()]


def test_dates_bad_text_and_null_become_null(spark):
    df = spark.createDataFrame([("2020-02-29",), ("2020-02-30",), ("x",), (None,)], "d string")
    assert [r[0] for r in df.select(dates.as_timestamp(df, "d")).collect()] == [
        dt.datetime(2020, 2, 29), None, None, None]


def test_dates_already_parsed_stay(spark):
    df = spark.sql("select date'2020-01-02' d, timestamp_ntz'2020-01-02 03:04:05' t")
    row = df.select(dates.as_timestamp(df, "d"), dates.as_timestamp(df, "t")).first()
    assert tuple(row) == (dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5))


def test_period_keeps_sign_and_fraction(spark):
    df = spark.sql("select timestamp'2020-01-03 12:00:00' a, timestamp'2020-01-01' b")
    assert df.select(dates.period_days(F.col("a"), F.col("b"))).first()[0] == -2.5


def test_whole_days_round_down(spark):
    df = spark.sql("select timestamp'2020-01-01 18:00:00' a, timestamp'2020-01-03 06:00:00' b")
    assert tuple(df.select(dates.whole_days(F.col("a"), F.col("b")), dates.whole_days(F.col("b"), F.col("a")))
                 .first()) == (1, -2)


@pytest.mark.parametrize("amount, days, rate", [(1, 0, None), (1, None, None), (1, 60, 0), (3, 60, 2), (5, 60, 2), (10, 30, 10)])
def test_monthly_rate_half_to_even_and_zero_days(spark, amount, days, rate):
    df = spark.createDataFrame([(amount, days)], "n long, days int")
    assert df.select(numbers.monthly_rate(F.col("n"), F.col("days"))).first()[0] == rate


def test_scaling_by_zero_norm_keeps_value(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 2.0)], "x double, n double")
    assert [r[0] for r in df.select(numbers.scaled(F.col("x"), F.col("n"))).collect()] == [2.0, 4.0, None]


def test_numbers_from_text(spark):
    assert one(spark, "s string", [" 19 ", "x", "", None], numbers.number(F.col("s"), "int")) == [19, None, None, None]
    assert one(spark, "x double", [1.9, -1.9, None], numbers.whole(F.col("x"))) == [1, -1, None]


def test_rounding_has_no_negative_zero(spark):
    assert str(one(spark, "x double", [-0.001], numbers.rounded(F.col("x")))[0]) == "0.0"


def test_replace_keeps_other_values(spark):
    assert one(spark, "x int", [1, 0, 2, None], numbers.replaced(F.col("x"), {1: 0.05})) == [0.05, 0.0, 2.0, None]


BANDS = ["10-19 fő", "1 fő", "250+ fő", "", None, "2-5 fő"]


def test_size_band(spark):
    assert one(spark, "s string", BANDS, text.size_band(F.col("s"))) == [19, 1, 1, 1, 1, 5]
    assert one(spark, "s string", BANDS, text.size_band(F.col("s"), "lower_bound")) == [19, 1, 250, 1, 1, 5]
    with pytest.raises(ValueError):
        text.size_band(F.col("s"), "other")


def test_text_helpers(spark):
    assert one(spark, "s string", ['["a", "b"]'], text.without_list_marks(F.col("s"))) == ["a, b"]
    assert one(spark, "s string", ["a.b", "ab"], text.part(F.col("s"), ".", 1)) == ["b", None]
    assert one(spark, "s string", ["x", None], text.as_text(F.col("s"))) == ["x", "nan"]
    assert one(spark, "a string, b int", [("x", 1), ("x", None), (None, 1)], text.words(F.col("a"), F.col("b"))) == [
        "x 1", None, None]


def test_missing_values_always_differ(spark):
    pairs = [(1, 1), (1, 2), (None, 1), (1, None), (None, None)]
    assert one(spark, "a int, b int", pairs, nulls.differs(F.col("a"), F.col("b"))) == [False, True, True, True, True]


def test_line_vector_drops_last_field_and_marks_text(spark):
    found = one(spark, "s string", ["1,2.5,3", "1,x,3", "7"], vectors.line_vector(F.col("s")))
    assert list(found[0]) == [1.0, 2.5]
    assert found[1][0] == 1.0 and found[1][1] != found[1][1]
    assert len(found[2]) == 0
