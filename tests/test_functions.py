import pytest
from pyspark.sql import functions as F

from conftest import ts
from mercato.functions import day_diff, month_label, month_start, round_half_away, safe_div


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "x,k,expected",
    [
        (0.285, 2, 0.28),  # stored as 0.28499999999999998: binary rounding (T9)
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (0.125, 2, 0.13),  # exact binary tie: away from zero
        (-0.125, 2, -0.13),
        (33.33333, 1, 33.3),
        (1e17 + 0.0, 1, 1e17),  # no bigint overflow
        (None, 2, None),
    ],
)
def test_round_half_away(spark, x, k, expected):
    assert _one(spark, round_half_away(F.col("x"), k), "x double", (x,)) == expected


def test_day_diff_counts_midnights(spark):
    v = _one(spark, day_diff(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz",
             (ts("2020-01-01 23:00:00"), ts("2020-01-02 01:00:00")))
    assert v == 1  # T8: 1 day, not 0


def test_month_start_and_label(spark):
    row = spark.createDataFrame([(ts("1999-07-19 13:45:00"),)], "t timestamp_ntz").select(
        month_start(F.col("t")).alias("m"), month_label(month_start(F.col("t"))).alias("l")
    ).first()
    assert row["m"] == ts("1999-07-01") and row["l"] == "1999-07"
    assert dict(spark.createDataFrame([(ts("1999-07-19"),)], "t timestamp_ntz")
                .select(month_start(F.col("t")).alias("m")).dtypes)["m"] == "timestamp_ntz"


def test_safe_div_zero_is_null(spark):
    assert _one(spark, safe_div(F.col("a"), F.col("b")), "a long, b long", (5, 0)) is None
    assert _one(spark, safe_div(F.col("a"), F.col("b")), "a long, b long", (1, 4)) == 0.25


def test_to_cents_exact(spark):
    from decimal import Decimal

    from mercato.functions import cents_to_double, to_cents

    vals = [Decimal("0.01"), Decimal("0.29"), Decimal("-0.29"), Decimal("123456789.99"),
            Decimal("9999999999999.99"), Decimal("0.00"), None]
    rows = spark.createDataFrame([(v,) for v in vals], "x decimal(18,2)").select(
        "x", to_cents(F.col("x")).alias("c"), cents_to_double(to_cents(F.col("x"))).alias("d")
    ).collect()
    for r in rows:
        if r["x"] is None:
            assert r["c"] is None
        else:
            assert r["c"] == int(r["x"] * 100)
            assert r["d"] == float(r["x"])  # same double as casting the exact decimal
