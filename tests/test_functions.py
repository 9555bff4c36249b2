import math
import random
from decimal import Decimal
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from lagloom.functions import coerce, text
from lagloom.functions.stats import pearson_p, pearson_r
from tests.conftest import utc


def one(spark, schema, *values):
    return spark.createDataFrame([(value,) for value in values], schema)


def test_number_accepts_numbers_only(spark):
    raw = ["1", " 2.5 ", "1e3", ".5", "-7.", "inf", "-Infinity", "NaN", "nan", "1d", "1f", "0x10", "", ".", "abc", None]
    df = one(spark, "v string", *raw)
    got = [row.n for row in df.select(coerce.number_column(df, "v").alias("n")).collect()]
    inf = float("inf")
    assert got == [1.0, 2.5, 1000.0, 0.5, -7.0, inf, -inf, None, None, None, None, None, None, None, None, None]


def test_nan_of_a_double_column_is_missing(spark):
    df = one(spark, "v double", 1.0, float("nan"), None)
    assert [row.n for row in df.select(coerce.number_column(df, "v").alias("n")).collect()] == [1.0, None, None]


def test_timestamps_bad_input_is_missing_and_zones_are_converted(spark):
    df = one(spark, "v string", "2026-06-09T10:00:00+00:00", "2026-06-09T10:00:00+07:00", "2026-06-09 10:00:00", "soon", None)
    got = [row.t for row in df.select(F.date_format(coerce.utc_timestamp(F.col("v")), "yyyy-MM-dd HH:mm").alias("t")).collect()]
    assert got == ["2026-06-09 10:00", "2026-06-09 03:00", "2026-06-09 10:00", None, None]


def test_exact_decimal_keeps_every_digit(spark):
    df = one(spark, "v string", "155627413.3720149719851917", "12.75", "invalid", "")
    got = [row.d for row in df.select(coerce.exact_decimal(F.col("v")).alias("d")).collect()]
    assert got[:2] == [Decimal("155627413.372014971985191700"), Decimal("12.75")] and got[2:] == [None, None]


@pytest.mark.parametrize("hour, bucket", [(0, 0), (5, 0), (6, 6), (11, 6), (12, 12), (23, 18)])
def test_six_hour_bucket(spark, hour, bucket):
    df = one(spark, "v timestamp", utc(f"2026-06-09T{hour:02d}:59:59"))
    got = df.select(F.date_format(coerce.bucket_start(F.col("v")), "HH:mm:ss")).first()[0]
    assert got == f"{bucket:02d}:00:00"


def test_midnight_epoch_and_zone(spark):
    df = one(spark, "v string", "1780876800")
    row = df.select(
        F.date_format(coerce.epoch_seconds(F.col("v")), "yyyy-MM-dd'T'HH:mm").alias("s"),
        F.date_format(coerce.epoch_millis(F.lit("1780876800123")), "ss.SSS").alias("ms"),
        F.date_format(coerce.midnight_utc(F.lit("2026-06-08T17:30:00+00:00")), "yyyy-MM-dd HH:mm").alias("m"),
        F.date_format(coerce.zoned_to_utc(F.lit("2026-06-08 07:00:00"), "Asia/Jakarta"), "HH:mm").alias("z"),
    ).first()
    assert tuple(row) == ("2026-06-08T00:00", "00.123", "2026-06-08 00:00", "00:00")


def test_float_text_reads_like_the_number_was_written(spark):
    values = [0.0, 1.0, 98.0, 98.75, 4.5, 138677529.125854, 1e15, 1e16, 1e22, 1e-4, 1e-5, 1.5e-7, 123456789.0, 0.1 + 0.2]
    df = one(spark, "v double", *values)
    assert [row.t for row in df.select(text.float_text(F.col("v")).alias("t")).collect()] == [repr(v) for v in values]


def test_float_text_reads_back_as_the_same_double(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-7, 18) for _ in range(500)]
    df = one(spark, "v double", *values)
    assert [float(row.t) for row in df.select(text.float_text(F.col("v")).alias("t")).collect()] == values


def test_value_text_of_mixed_types(spark):
    rows = [("155627413.3720149719851917", Decimal("12.75"), 72, 138677529.125854), ("4.50", Decimal(100), 0, float("nan"))]
    df = spark.createDataFrame(rows, "s string, d decimal(38,18), i bigint, f double")
    got = df.select(*[text.value_text(F.col(name), df.schema[name].dataType) for name in df.columns]).collect()
    assert [tuple(row) for row in got] == [
        ("155627413.3720149719851917", "12.75", "72", "138677529.125854"),
        ("4.50", "100", "0", None),
    ]


def test_names_paths_and_clocks(spark):
    odd = "A B/c*~é+_-."
    row = (
        one(spark, "t timestamp", utc("2026-06-09T06:11:55"))
        .select(
            text.dataset_name(F.lit("fred"), F.lit("treasury_10y"), ["fred"]),
            text.dataset_name(F.lit("dxy"), F.lit("close"), ["fred"]),
            text.path_part(F.lit(odd)),
            text.clock_text(F.col("t")),
            text.clock_text(F.col("t"), "Asia/Jakarta"),
            text.iso_text(F.col("t")),
        )
        .first()
    )
    assert tuple(row) == (
        "macro_data.fred.treasury_10y", "alt_data.dxy.close", quote(odd, safe=""), "06:11", "13:11",
        "2026-06-09T06:11:55+00:00",
    )


def test_p_value_agrees_with_the_t_distribution(spark):
    cases = [(r, n) for r in (0.31, -0.71, 0.3, 0.05, 0.001, 0.99, -0.2) for n in (3, 4, 10, 30, 31, 120, 5000, 100_000)]
    got = spark.createDataFrame(cases, "r double, n bigint").withColumn("p", pearson_p(F.col("r"), F.col("n"))).collect()
    law = spark._jvm.org.apache.commons.math3.distribution.TDistribution
    for r, n, p in got:
        t = abs(r) * math.sqrt((n - 2) / (1 - r * r))
        assert p == pytest.approx(2 * law(float(n - 2)).cumulativeProbability(-t), rel=1e-9, abs=1e-300)


def test_p_value_at_the_ends(spark):
    df = spark.createDataFrame(
        [(1.0, 40), (-1.0, 40), (0.0, 40), (float("nan"), 40), (None, 40), (0.5, 2)], "r double, n bigint"
    )
    assert [row.p for row in df.select(pearson_p(F.col("r"), F.col("n")).alias("p")).collect()] == [0, 0, 1, None, None, None]


def test_pearson_r_ignores_incomplete_pairs_and_survives_a_constant_side(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, None), ("a", None, 9.0), ("a", 4.0, 8.0)]
    rows += [("flat", float(i), 5.0) for i in range(4)] + [("inf", float(i), float("inf")) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = dict(df.groupBy("k").agg(pearson_r(F.col("x"), F.col("y")).alias("r")).collect())
    assert got["a"] == pytest.approx(1.0) and got["flat"] is None and math.isnan(got["inf"])
