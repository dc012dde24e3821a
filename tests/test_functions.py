from helpers import one, rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import functions as fn


def values(spark, expression, *texts):
    """The expression over a text column, in input order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_clean_currency(spark):
    texts = ("$1,234.50", " $ -7 ", "12", "abc", "", None)
    assert values(spark, fn.clean_currency, *texts) == [1234.5, -7.0, 12.0, None, None, None]
    assert values(spark, lambda c: fn.clean_currency(c, 0.0), *texts) == [1234.5, -7.0, 12.0, 0.0, 0.0, 0.0]


def test_zip_and_cvv_pad_but_do_not_truncate(spark):
    assert values(spark, fn.clean_zip, "123.0", " 7", "1234567", None) == ["00123", "00007", "1234567", None]
    assert values(spark, fn.clean_cvv, "7.0", "1234") == ["007", "1234"]


def test_merchant_zip_drops_sentinels_after_padding(spark):
    assert values(spark, fn.clean_merchant_zip, "", "nan", "0", None, "00nan", "501.0") == [None] * 5 + ["00501"]


def test_empty_to_null_and_null_if(spark):
    assert values(spark, fn.empty_to_null, "", " ", "nan", "Bad PIN") == [None, None, None, "Bad PIN"]
    assert values(spark, lambda c: fn.null_if(c, "x"), "x", "y", None) == [None, "y", None]


def test_email(spark):
    assert values(spark, lambda c: fn.make_email(c, F.lit(7)), " Ann O'Neil Lee ") == ["ann.oneil.lee.7@example.com"]


def test_mask_and_hash(spark):
    assert values(spark, fn.mask_card, "1234567890123456", "123") == ["***3456", "***123"]
    assert values(spark, fn.hash_pii, "a")[0].startswith("ca978112ca1bbdca")


def test_card_status_ignores_case_and_blanks(spark):
    assert values(spark, fn.card_status, " YES ", "no", None) == ["blocked", "active", "active"]


def test_description_is_cut(spark):
    assert len(values(spark, fn.payment_description, "m" * 400)[0]) == 255


def test_month_year_is_null_when_unreadable(spark):
    assert values(spark, fn.month_year, "09/2002", "9/2002", "2002", None) == [
        ts("2002-09-01"), ts("2002-09-01"), None, None,
    ]


def test_compose_ts(spark):
    df = spark.createDataFrame([("2020", "2", "3", "06:21"), ("2020", "2", "31", "06:21"), ("x", "2", "3", "06:21")], "y string, m string, d string, t string")
    got = [r[0] for r in df.select(fn.compose_ts(F.col("y"), F.col("m"), F.col("d"), F.col("t"))).collect()]
    assert got == [ts("2020-02-03T06:21"), None, None]


def test_minus_minutes(spark):
    df = spark.range(1).select(fn.minus_minutes(F.lit("2020-01-01 00:02:00").cast("timestamp"), 3))
    assert one(df) == (ts("2019-12-31T23:59"),)


def test_to_ts_goes_by_type(spark):
    micros = 1704067200000000
    df = spark.createDataFrame([(micros, float(micros), "2024-01-01T00:00:00", "rubbish")], "a long, b double, c string, d string")
    kinds = df.schema
    got = one(df.select(*[fn.to_ts(F.col(n), kinds[n].dataType) for n in df.columns]))
    assert got == (ts("2024-01-01"), ts("2024-01-01"), ts("2024-01-01"), None)
    real = spark.range(1).select(F.lit("2024-01-01").cast("timestamp").alias("t"))
    assert one(real.select(fn.to_ts(F.col("t"), T.TimestampType()))) == (ts("2024-01-01"),)


def test_nested_to_json_and_fill_strings(spark):
    df = spark.createDataFrame([(1, None, ("Dallas", None), [1, 2])], "i int, s string, l struct<city:string,state:string>, a array<int>")
    assert rows(fn.nested_to_json(fn.fill_strings(df))) == [(1, "", '{"city":"Dallas"}', "[1,2]")]


def test_fill_strings_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None)], "n int, s string")
    assert rows(fn.fill_strings(df)) == [(None, "")]


def test_hash_sample_is_repeatable_and_near_its_share(spark):
    df = spark.range(5000)
    first, second = rows(fn.hash_sample(df, "id")), rows(fn.hash_sample(df.repartition(3), "id"))
    assert first == second
    assert 0.27 < len(first) / 5000 < 0.33
