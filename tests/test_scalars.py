import math
import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from kinweave.functions import scalars


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (0.0,), (None,)], "x double")
    found = [r[0] for r in df.select(scalars.round_half_up(F.col("x"))).collect()]
    assert found == [1.01, -1.01, 2.68, 0.0, None]


def test_truncation(spark):
    numbers = [2.679, -2.679, 0.0099999999999999985, -0.001, 1e300, 1e16 + 2, 2.67, 10000000000000.006,
               math.inf, -math.inf]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    found = [r[0] for r in df.select(scalars.truncate(F.col("x"))).collect()]
    assert found == [2.67, -2.67, 0.0, 0.0, 1e300, 1e16 + 2, 2.67, 10000000000000.0, math.inf, -math.inf]
    special = spark.createDataFrame([(math.nan,), (None,)], "x double").select(scalars.truncate(F.col("x")))
    assert math.isnan(special.collect()[0][0]) and special.collect()[1][0] is None


def test_any_number_as_in_decimal_notation(spark):
    rng = random.Random(5)
    numbers = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 17) for _ in range(3000)]
    numbers += [round(rng.uniform(-1e3, 1e3), 3) for _ in range(1000)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for digits in (0, 1, 2, 5):
        found = df.select(scalars.round_half_up(F.col("x"), digits), scalars.truncate(F.col("x"), digits)).collect()
        unit = Decimal(1).scaleb(-digits)
        for number, row in zip(numbers, found):
            exact = Decimal(repr(number))
            assert tuple(row) == (float(exact.quantize(unit, ROUND_HALF_UP)), float(exact.quantize(unit, ROUND_DOWN)))


TEXTS = ["\t a b \n", "\x00\x1f x\x20", " kept ", "end \u0085", "", " \n\t", None]
TRIMMED = ["a b", "x", " kept ", "end \u0085", "", "", None]


def test_trimming(spark):
    df = spark.createDataFrame([(t, [t], 7) for t in TEXTS], "t string, a array<string>, n int")
    assert [r[0] for r in df.select(scalars.trim(F.col("t"))).collect()] == TRIMMED
    assert [r[0] for r in df.select(scalars.trim_array(F.col("a"))).collect()] == [[t] for t in TRIMMED]
    row = scalars.trim_row(df.select("t", F.col("n").alias("odd.name")))
    assert row.dtypes == [("t", "string"), ("odd.name", "string")]
    assert [tuple(r) for r in row.collect()] == [(t, "7") for t in TRIMMED]


def test_first_or_default(spark):
    df = spark.createDataFrame([([1.005, 2.0],), ([],), (None,), ([None],)], "a array<double>")
    first = df.select(scalars.first_or_default(F.col("a"), 0.125),
                      scalars.first_rounded_or_default(F.col("a"), 0.125)).collect()
    assert [tuple(r) for r in first] == [(1.005, 1.01), (0.125, 0.125), (0.125, 0.125), (None, None)]
