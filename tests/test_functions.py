"""Unit tests of the expression helpers."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from procura.functions import (
    as_of_lit,
    concat_code,
    convert_amount,
    day,
    decode,
    effective_on,
    flag_is,
    norm_text,
    num_key,
    open_interval_on,
    typed_null,
)


def test_convert_amount_rate_null_zero_one_and_value(spark):
    # Converted amounts are never NULL when the base amount exists
    df = spark.createDataFrame(
        [(Decimal("100.00"), None), (Decimal("100.00"), Decimal("0")), (Decimal("100.00"), Decimal("1")),
         (Decimal("100.00"), Decimal("2.6")), (None, Decimal("2.6"))],
        "amt decimal(18,6), rate decimal(18,9)",
    )
    got = [r[0] for r in df.select(convert_amount("amt", "rate")).collect()]
    assert got == [Decimal("100.000000"), Decimal("100.000000"), Decimal("100.000000"), Decimal("260.000000"), None]


def test_concat_code_keeps_separators_for_null(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in df.select(concat_code(["x", "y", "z"])).collect()] == ["a..c", ".."]


def test_decode_without_default_is_null(spark):
    df = spark.createDataFrame([("SEALED_AUCTION",), ("SEALED_BIDDING",), ("OPEN",), (None,)], "v string")
    got = [r[0] for r in df.select(decode("v", [("SEALED_AUCTION", "SEALED"), ("SEALED_BIDDING", "BLIND")])).collect()]
    assert got == ["SEALED", "BLIND", None, None]


def test_flag_null_policies(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "f string")
    keep_null = [r[0] for r in df.select(~flag_is("f", "Y", "N")).collect()]  # NVL(f,'N') != 'Y'
    drop_null = [r[0] for r in df.select(flag_is("f", "N", "Y")).collect()]  # NVL(f,'Y') = 'N'
    assert keep_null == [False, True, True]
    assert drop_null == [False, True, False]


def test_effective_on_with_time_vs_truncated(spark):
    # an interval ending at as-of midnight is closed for the instant, open for its day
    df = spark.createDataFrame(
        [(dt.datetime(1990, 1, 1), dt.datetime(1998, 6, 15))], "s timestamp_ntz, e timestamp_ntz")
    at = as_of_lit("1998-06-15 10:00:00")
    r = df.select(effective_on(at, "s", "e").alias("now"), effective_on(day(at), "s", "e").alias("today")).first()
    assert (r.now, r.today) == (False, True)


def test_open_interval_null_bounds(spark):
    df = spark.createDataFrame(
        [(None, None), (dt.datetime(1999, 1, 1), None), (None, dt.datetime(1998, 6, 15, 0, 0)), (None, dt.datetime(1997, 1, 1))],
        "s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(open_interval_on(as_of_lit("1998-06-15 10:00:00"), "s", "e")).collect()]
    assert got == [True, False, True, False]


def test_norm_text_blank_is_null(spark):
    df = spark.createDataFrame([("  nation_1 ",), ("   ",), (None,)], "v string")
    assert [r[0] for r in df.select(norm_text("v")).collect()] == ["NATION_1", None, None]


def test_num_key_is_lenient(spark):
    df = spark.createDataFrame([("42",), ("junk",), (None,)], "v string")
    assert [r[0] for r in df.select(num_key("v")).collect()] == [42, None, None]


def test_typed_null_has_type(spark):
    df = spark.range(1).select(typed_null("x", "decimal(28,6)"))
    assert df.schema["x"].dataType.simpleString() == "decimal(28,6)"
    assert df.first()[0] is None
    assert spark.range(1).select(F.lit(None).alias("v")).union(spark.range(1).select(typed_null("v", "string"))).schema["v"].dataType.simpleString() == "string"
