import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sabermill.functions.coerce import measured

TEXTS = [
    "1.5", "2.345", "-2.345", "0.05", "-0.05", "-0.0", "0.25", "2.675", "1.005", "99999.95", "99999.94", "9999.95", "999.9995", "1e-20", "1e15", "1e308",
    "NaN", "inf", "-Infinity", "bad", "", " 7.25 ", "0x1p3", "12d", "٣", None,
]


@pytest.mark.parametrize("kind", [T.IntegerType(), T.DecimalType(4, 1), T.DecimalType(5, 2), T.DecimalType(8, 3), T.DecimalType(10, 0), T.DecimalType(38, 18)])
def test_measurements_are_those_of_plain_casts(spark, kind):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string").withColumn("d", F.col("s").try_cast("double")).withColumn("f", F.col("d").cast("float"))
    for name in ("s", "d", "f"):
        plain = F.col(name).try_cast("double") if name == "s" else F.col(name)
        plain = F.when(~F.isnan(plain), plain).try_cast(kind)
        out = df.select(plain.alias("plain"), measured(F.col(name), df.schema[name].dataType, kind).alias("made"))
        assert out.schema["plain"].dataType == out.schema["made"].dataType
        assert [r.made for r in out.collect()] == [r.plain for r in out.collect()]


def test_a_text_is_read_once_and_only_with_a_digit_and_a_double_goes_by_no_digits(spark):
    df = spark.createDataFrame([("bad", 1.25)], "s string, d double")

    def plan(column) -> str:
        return df.select(column)._jdf.queryExecution().optimizedPlan().toString()

    text = plan(measured(F.col("s"), T.StringType(), T.IntegerType()))
    assert text.count(" as double)") - text.count("null as double") == 1 and "RLIKE" in text
    assert "rint" in plan(measured(F.col("d"), T.DoubleType(), T.DecimalType(5, 2))).lower()
