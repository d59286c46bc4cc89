import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.errors import Refused
from lakeferry.functions import convert
from lakeferry.functions.collation import flags, spark_name
from lakeferry.functions.literals import like_escape, literal, quote
from lakeferry.functions.types import accepts, remote_type, spark_type, string_type


def test_literals():
    assert [literal(x) for x in (None, False, 2**63, -(2**70), 1.0, 0.1, b"\xab", Decimal("1.10"))] == ["NULL", "0", "CAST(9223372036854775808 AS DECIMAL(20,0))", f"CAST({-(2**70)} AS DECIMAL(38,0))", "1.0", "0.10000000000000001", "0xAB", "1.10"]
    assert literal(1 / 3, single=True) == "0.333333333"
    assert literal(dt.datetime(2024, 1, 1, tzinfo=dt.timezone(dt.timedelta(hours=2)))) == "CAST('2023-12-31T22:00:00.0000000+00:00' AS DATETIMEOFFSET(7))"
    assert quote("a]b") == "[a]]b]" and like_escape("5%[_]") == "5[%][[][_]]"
    for x in (float("nan"), float("inf")):
        with pytest.raises(Refused):
            literal(x)


def test_types():
    assert spark_type("tinyint") == T.ShortType() and spark_type("DECIMAL(10, 2)") == T.DecimalType(10, 2) and spark_type("money") == T.DecimalType(19, 4)
    assert spark_type("nvarchar(50)") == T.StringType() and spark_type("hierarchyid") == T.StringType() and spark_type("datetimeoffset(7)") == T.TimestampType()
    of = lambda t, **m: remote_type(T.StructField("c", t, True, m))
    assert of(T.ByteType()) == "smallint" and of(T.DecimalType(38, 10)) == "decimal(38,10)" and of(T.StringType()) == "nvarchar(max)" and of(T.DayTimeIntervalType()) == "nvarchar(50)"
    assert of(T.StringType(), **string_type("varchar", 20)) == "varchar(20)"
    for t in (T.ArrayType(T.IntegerType()), T.MapType(T.StringType(), T.StringType()), T.StructType([])):
        with pytest.raises(Refused, match="JSON"):
            of(t)
    with pytest.raises(Refused):
        string_type("nvarchar", 4001)
    assert accepts(T.LongType(), "tinyint") and accepts(T.StringType(), "ntext") and accepts(T.DateType(), "datetime2(3)")
    assert not accepts(T.DayTimeIntervalType(), "nvarchar(50)") and not accepts(T.IntegerType(), "date") and not accepts(T.DecimalType(5, 2), "float")


def test_collations():
    assert flags("Latin1_General_100_CI_AI_SC_UTF8") == (False, False, False, True)
    assert [spark_name(x) for x in ("Latin1_General_BIN2", "X_CS_AS", "X_CI_AS", "X_CI_AI")] == ["UTF8_BINARY", "UTF8_BINARY", "UNICODE_CI", "UNICODE_CI_AI"]
    assert spark_name("X_CI_AS", trailing_spaces=False) == "UNICODE_CI_RTRIM"


def test_narrowing_raises(spark):
    one = spark.range(1)
    for remote, ok, bad in (("tinyint", 255, 256), ("tinyint", 0, -1), ("smallint", -32768, 32768), ("int", 2**31 - 1, 2**31)):
        assert one.select(convert.narrow(F.lit(ok), remote)).first()[0] == ok
        with pytest.raises(Exception, match="range|OVERFLOW"):
            one.select(convert.narrow(F.lit(bad), remote)).collect()


def test_strings_are_cut_on_whole_characters(spark):
    for text in ("", "abc", "абв", "漢字", "a😀b😀", "é" * 9, "x" * 50):
        for n in range(1, 12):
            got = spark.createDataFrame([(text,)], "s string").select(convert.truncate_utf16(F.col("s"), n), convert.truncate_utf8(F.col("s"), n)).first()
            want16 = next(text[:k] for k in range(len(text), -1, -1) if len(text[:k].encode("utf-16-le")) <= 2 * n)
            want8 = next(text[:k] for k in range(len(text), -1, -1) if len(text[:k].encode()) <= n)
            assert tuple(got) == (want16, want8)
