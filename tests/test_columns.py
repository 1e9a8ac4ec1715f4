"""Scalar helpers (SCL1-SCL13), including the ANSI traps T1, T7, T9-T11."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import columns as C


def one(spark, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}")


def test_strip_prefix_cases(spark):
    df = spark.createDataFrame([("O000001",), ("O000000",), ("o0001",), (None,), ("O000001-I1",)], "v string")
    got = [r[0] for r in df.select(C.strip_prefix("v", "O")).collect()]
    assert got == ["1", "", "o0001", None, "1-I1"]


def test_strip_prefix_escapes_literal_prefix(spark):
    df = spark.createDataFrame([("Customer#000000042",), ("Customerx0042",)], "v string")
    got = [r[0] for r in df.select(C.strip_prefix("v", "Customer#")).collect()]
    assert got == ["42", "Customerx0042"]


def test_trim_lower_spaces_only_by_default(spark):
    df = spark.createDataFrame([(" PIX ",), ("\tPIX ",)], "v string")
    got = [r[0] for r in df.select(C.trim_lower("v")).collect()]
    assert got == ["pix", "\tpix"]
    got_all = [r[0] for r in df.select(C.trim_lower("v", all_whitespace=True)).collect()]
    assert got_all == ["pix", "pix"]


def test_money_rounds_half_up_and_overflow_is_null(spark):
    df = spark.createDataFrame([("1981.3",), ("899.995",), ("123456789.12",), ("abc",), (None,)], "v string")
    got = [r[0] for r in df.select(C.to_money("v")).collect()]
    assert got == [Decimal("1981.30"), Decimal("900.00"), None, None, None]


def test_int_try_cast_is_strict(spark):
    # T9: '5.0' is not an integer literal in Spark
    df = spark.createDataFrame([("5",), ("5.0",), ("-2",), ("x",)], "v string")
    assert [r[0] for r in df.select(C.to_int("v")).collect()] == [5, None, -2, None]


def test_bad_dates_become_null_under_ansi(spark):
    # T1: plain to_date raises under ANSI; ours yields NULL
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("2025-01-22",), ("2025-13-45",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(C.to_date("v")).collect()]
    assert str(got[0]) == "2025-01-22" and got[1:] == [None, None, None]


def test_zone_shift_values(spark):
    # T7: with session zone UTC, 12:00 UTC is 09:00 in Sao Paulo, 10:00 under 2018 DST
    df = spark.createDataFrame([("2025-01-01 12:00:00",), ("2018-12-01 12:00:00",)], "v string")
    got = [r[0] for r in df.select(F.date_format(C.utc_to_zone("v", "America/Sao_Paulo"), "HH:mm:ss")).collect()]
    assert got == ["09:00:00", "10:00:00"]


def test_zone_shift_accepts_timestamp_columns(spark):
    df = spark.createDataFrame([("2025-01-01 12:00:00",)], "v string").select(F.col("v").cast("timestamp_ntz").alias("t"))
    got = df.select(F.date_format(C.utc_to_zone("t", "America/Sao_Paulo"), "HH:mm")).first()[0]
    assert got == "09:00"


def test_defaults_null_and_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t",), ("x",)], "v string")
    nulls = [r[0] for r in df.select(C.default_if_null("v", "d")).collect()]
    blanks = [r[0] for r in df.select(C.default_if_blank("v", "d")).collect()]
    assert nulls == ["d", "", "  ", "\t", "x"]
    assert blanks == ["d", "d", "d", "d", "x"]


def test_strip_or_sentinel(spark):
    df = spark.createDataFrame([(None,), ("C00442",), ("",)], "v string")
    got = [r[0] for r in df.select(C.strip_or_sentinel("v", "C", "desconhecido")).collect()]
    assert got == ["desconhecido", "442", ""]
    got_blank = [r[0] for r in df.select(C.strip_or_sentinel("v", "C", "desconhecido", True)).collect()]
    assert got_blank == ["desconhecido", "442", "desconhecido"]


def test_now_in_zone_is_behind_utc_by_the_offset(spark):
    row = spark.range(1).select(
        ((F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(C.now_in_zone("America/Sao_Paulo")))
         / 3600).alias("h")).first()
    assert row.h in (2.0, 3.0)


def test_padded_id_matches_printf_for_all_widths(spark):
    values = [0, 7, 99999, 100000, 1234567890123, -5, -123456]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r[0] for r in df.select(C.padded_id("C", "v", 5)).collect()]
    assert got == ["C%05d" % v for v in values]
