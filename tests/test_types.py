import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import propgraph as pg
from propgraph.functions.types import DURATION, property_type, same_type, spark_type, widens
from propgraph.functions.values import instant, stored_value

UTC = datetime.timezone.utc

NAMED = {
    "BOOLEAN": T.BooleanType(), "INTEGER": T.IntegerType(), "LONG": T.LongType(), "SHORT": T.ShortType(),
    "BYTE": T.ByteType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "LOCAL_DATE": T.DateType(),
    "LOCAL_DATETIME": T.TimestampType(), "STRING": T.StringType(), "DURATION": DURATION,
    "DECIMAL(9,2)": T.DecimalType(9, 2),
}


@pytest.mark.parametrize("name", NAMED)
def test_names_and_types_agree_both_ways(name):
    dtype = NAMED[name]
    assert property_type(dtype) == name
    assert spark_type(name) == dtype
    assert property_type(T.ArrayType(dtype)) == name + "_ARRAY"
    assert spark_type(name + "_ARRAY") == T.ArrayType(dtype)


def test_types_that_only_read():
    assert spark_type("DATE") == T.TimestampType()
    assert spark_type("DATETIME") == T.TimestampType()
    assert spark_type("DATETIME_ARRAY") == T.ArrayType(T.TimestampType())
    assert spark_type("STREAMING") == T.BinaryType()
    assert spark_type("GEO_POINT") == spark_type("LOCAL_TIME_ARRAY") == T.StringType()


def test_types_without_a_name_are_text():
    assert property_type(T.MapType(T.StringType(), T.LongType())) == "STRING"
    assert property_type(T.DayTimeIntervalType()) == "STRING"
    assert property_type(T.ArrayType(T.ArrayType(T.LongType()))) == "STRING_ARRAY"
    assert property_type(T.TimestampNTZType()) == "LOCAL_DATETIME"


def test_structs_must_be_durations():
    with pytest.raises(ValueError, match="must be a duration"):
        property_type(T.StructType([T.StructField("x", T.LongType())]))


def test_lossless_widening():
    assert widens("INTEGER", "LONG") and widens("FLOAT", "DOUBLE") and widens("BYTE_ARRAY", "SHORT_ARRAY")
    assert not widens("LONG", "INTEGER") and not widens("LONG", "DOUBLE") and not widens("INTEGER", "STRING")


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


# Durations and their texts.
@pytest.mark.parametrize("parts, expected", [
    ({"days": 14, "hours": 16, "minutes": 12}, (0, 14, 58320, 0, "P14DT16H12M")),
    ({"months": 0.75}, (0, 22, 71509, 500_000_000, "P22DT19H51M49.5S")),
    ({"weeks": 2.5}, (0, 17, 43200, 0, "P17DT12H")),
    ({}, (0, 0, 0, 0, "PT0S")),
    ({"months": 14, "days": 400}, (14, 400, 0, 0, "P1Y2M400D")),
    ({"hours": 25}, (0, 0, 90000, 0, "PT25H")),
    ({"days": 0.5, "seconds": 0.000000001}, (0, 0, 43200, 1, "PT12H0.000000001S")),
    ({"seconds": -1.5}, (0, 0, -2, 500_000_000, "PT-1.5S")),
    ({"seconds": -60}, (0, 0, -60, 0, "PT-1M")),
    ({"months": -14, "hours": -25, "seconds": -0.25}, (-14, 0, -90001, 750_000_000, "P-1Y-2MT-25H-0.25S")),
    ({"months": -0.75}, (0, -22, -71510, 500_000_000, "P-22DT-19H-51M-49.5S")),
])
def test_durations(spark, parts, expected):
    assert tuple(one(spark, d=pg.make_duration(**parts)).d) == ("duration", *expected)


def test_duration_from_columns_and_nulls(spark):
    frame = spark.createDataFrame([(0.75, 1), (None, 2)], "m double, s int")
    rows = frame.select(pg.make_duration(months="m", seconds=F.col("s") * 0).alias("d")).collect()
    assert rows[0].d.value == "P22DT19H51M49.5S"
    assert rows[1].d is None


def test_duration_seconds_orders(spark):
    row = one(
        spark, a=pg.duration_seconds(pg.make_duration(months=1, days=1, seconds=1.5)),
        b=pg.duration_seconds(pg.make_duration(seconds=-0.5)),
    )
    assert row.a == Decimal(2_629_746 + 86_400) + Decimal("1.5")
    assert row.b == Decimal("-0.5")


def test_duration_plan_stays_small(spark):
    plan = spark.range(1).select(pg.make_duration(*["id"] * 6).alias("d"))
    assert len(plan._jdf.queryExecution().analyzed().toString()) < 100_000


FIVE = "struct<type:string,months:bigint,days:bigint,seconds:bigint,nanoseconds:bigint>"


def test_written_durations(spark):
    frame = spark.createDataFrame([(("duration", 1, 2, 3, 4),), (None,)], f"d {FIVE}")
    stored = frame.select(stored_value(F.col("d"), frame.schema["d"].dataType).alias("d"))
    assert same_type(stored.schema["d"].dataType, DURATION)
    rows = stored.collect()
    assert tuple(rows[0].d) == ("duration", 1, 2, 3, 4, "P1M2DT3.000000004S")
    assert rows[1].d is None


def test_written_duration_arrays(spark):
    frame = spark.createDataFrame([([("duration", 0, i, 0, 0) for i in (1, 2)],)], f"d array<{FIVE}>")
    stored = frame.select(stored_value(F.col("d"), frame.schema["d"].dataType).alias("d")).first()
    assert [x.value for x in stored.d] == ["P1D", "P2D"]


def test_structs_of_another_kind_fail(spark):
    frame = spark.createDataFrame([(("distance", 0, 0, 0, 0),)], f"d {FIVE}")
    with pytest.raises(PySparkException, match="'distance' is not a duration"):
        frame.select(stored_value(F.col("d"), frame.schema["d"].dataType)).collect()


def test_values_become_text_where_no_type_fits(spark):
    frame = spark.sql(
        "SELECT map('a', 1) AS m, array(array(1, 2)) AS a, interval '1' day AS i, array(map('b', 2)) AS am, "
        "timestamp_ntz'2020-01-01 01:02:03' AS n, array(timestamp_ntz'2020-01-01 01:02:03') AS an"
    )
    types = {f.name: f.dataType for f in frame.schema}
    row = frame.select(*[stored_value(F.col(n), t).alias(n) for n, t in types.items()])
    assert [t for _, t in row.dtypes] == ["string", "array<string>", "string", "array<string>", "timestamp", "array<timestamp>"]
    assert row.select("m", "a", "am").first() == ('{"a":1}', ["[1,2]"], ['{"b":2}'])


def test_instants(spark):
    row = one(
        spark, zoned=instant(F.lit("2015-06-24T12:50:35.556+01:00")).cast("string"),
        local=instant(F.lit("2007-12-03T10:15:30")).cast("string"),
    )
    assert row.zoned == "2015-06-24 11:50:35.556"
    assert row.local == "2007-12-03 10:15:30"
