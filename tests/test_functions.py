import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from nightledger.functions import decimal_comma, fio, parse_dt, strip_blanks, within


def test_cleaning_expressions(spark):
    df = spark.createDataFrame(
        [("1234,565", "2024-01-05", "4000 0000 0000 0001 ", "Ivanov", "Ivan", None)],
        "amt string, d string, card string, a string, b string, c string")
    r = df.select(decimal_comma("amt").alias("amt"), parse_dt("d").alias("d"),
                  strip_blanks("card").alias("card"), fio("a", "b", "c").alias("fio")).first()
    assert r.amt == Decimal("1234.57")
    assert r.d == dt.datetime(2024, 1, 5)
    assert r.card == "4000000000000001"
    # NULL patronymic counts as empty text, the separators stay
    assert r.fio == "Ivanov Ivan "


def test_full_timestamp_and_bad_amount(spark):
    df = spark.createDataFrame([("2024-01-05 10:11:12", " 7,5 ")], "d string, amt string")
    r = df.select(parse_dt("d").alias("d"), decimal_comma("amt").alias("a")).first()
    assert r.d == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert r.a == Decimal("7.50")


def test_within_bounds(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(t0, t0 + dt.timedelta(seconds=s)) for s in (1199, 1200, 3600, 3601)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(within(F.col("b"), F.col("a"), "1 HOUR").alias("h"),
                    within(F.col("b"), F.col("a"), "20 MINUTES", inclusive=False).alias("m")).collect()
    assert [r.h for r in out] == [True, True, True, False]
    assert [r.m for r in out] == [True, False, False, False]
