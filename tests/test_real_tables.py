"""Tables as users have them: text keys, half stars, unreadable files, missing columns, odd amounts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato import api
from mercato.operators import checks
from mercato.params import Params
from mercato.plans.batch import run_batch
from mercato.sources.tables import Tables

KEYS = ("order_id", "customer_id", "product_id", "seller_id", "customer_unique_id")


def hexed(t):
    """The tables with every key as 32 hexadecimal characters that sort like the number."""
    out = {}
    for name, df in t.items():
        out[name] = df.select([F.lower(F.lpad(F.hex(c), 32, "0")).alias(c) if c in KEYS else F.col(c) for c in df.columns])
    return out


@pytest.fixture(params=["true", "false"], ids=["ansi", "no ansi"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", old)


def test_text_keys_give_the_same_answers(spark, ansi, tmp_path):
    plain = Tables.from_tpch(spark, SF_SMALL)
    for name, df in hexed(plain).items():
        df.write.parquet(f"{tmp_path}/{name}")
    text = Tables.from_parquet(spark, str(tmp_path))
    assert dict(text["orders"].dtypes)["order_id"] == "string"
    for call in (api.get_seller_scorecard, api.get_abc_classification, api.get_cohort_retention, api.get_delivery_analysis, api.get_monthly_revenue):
        for state in ("", "NATION_3"):
            want, got = call(plain, seller_state=state), call(text, seller_state=state)
            key = lambda rows: [tuple(int(v, 16) if c in KEYS and isinstance(v, str) else v for c, v in r.asDict().items()) for r in rows]
            rows = key(got.collect())
            assert rows == key(want.collect())
            assert rows or state
    row = lambda t: [tuple(r.values()) for r in checks.run_checks(t, dt.datetime(2024, 1, 1))]
    assert row(text) == row(plain)


def test_half_stars_survive(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL)
    for name, df in t.items():
        if name == "order_reviews":
            df = df.select("order_id", F.lit(4.5).alias("review_score"))
        df.write.parquet(f"{tmp_path}/{name}")
    scores = {r["avg_review_score"] for r in api.get_seller_scorecard(Tables.from_parquet(spark, str(tmp_path))).collect()}
    assert scores <= {4.5, 0.0} and 4.5 in scores


def test_keys_of_two_types_are_refused(spark):
    t = Tables.from_tpch(spark, SF_SMALL)
    frames = dict(t) | {"order_items": hexed(t)["order_items"]}
    with pytest.raises(TypeError, match="orders.order_id is bigint but order_items.order_id is string"):
        Tables(frames)


def test_only_a_missing_path_is_an_absent_table(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL)
    t["orders"].write.parquet(f"{tmp_path}/orders")
    assert list(Tables.from_parquet(spark, str(tmp_path))) == ["orders"]
    os.makedirs(f"{tmp_path}/sellers")
    with open(f"{tmp_path}/sellers/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(RuntimeError, match="'sellers'"):
        Tables.from_parquet(spark, str(tmp_path))


def test_a_missing_column_fails_its_check_and_its_analyses_only(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL)
    frames = dict(t) | {"order_items": t["order_items"].drop("seller_id")}
    cut = Tables(frames)
    rows = checks.run_checks(cut)
    bad = [r for r in rows if r["table_name"] == "order_items" and not r["passed"]]
    assert [(r["column_name"], r["observed"]) for r in bad] == [("seller_id", "column missing")]
    assert len(rows) == len(checks.run_checks(t))
    res = run_batch(cut, f"{tmp_path}/out")
    assert "seller_scorecard" in res.errors and "abc_classification" not in res.errors
    assert res.written["cohort_retention"] and res.written["delivery_by_state"] and res.written["detail.parquet"]


def test_one_broken_table_keeps_the_other_checks(spark):
    t = Tables.from_tpch(spark, SF_SMALL)
    broken = t["sellers"].withColumn("seller_id", F.raise_error(F.lit("disk gone")).cast("bigint"))
    rows = checks.run_checks(Tables(dict(t) | {"sellers": broken}))
    failed = [r for r in rows if r["check_name"] == "readable"]
    assert [r["table_name"] for r in failed] == ["sellers"] and "disk gone" in failed[0]["observed"]
    assert any(r["table_name"] == "orders" and r["passed"] for r in rows)


def test_rounded_amounts_are_reported(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL)
    items = t["order_items"].withColumn("price", F.when(F.col("order_id") == 1, 0.004).otherwise(F.col("price").cast("double")))
    n = items.where("order_id = 1").count()
    got = {r["column_name"]: r for r in checks.run_checks(Tables.conformed(dict(t) | {"order_items": items}))
           if r["check_name"] == "money_two_decimals"}
    assert set(got) == {"price"} and got["price"]["observed"] == str(n) and not got["price"]["passed"]
    clean = t["order_items"].withColumn("price", F.col("price").cast("double"))
    got = [r for r in checks.run_checks(Tables.conformed(dict(t) | {"order_items": clean})) if r["check_name"] == "money_two_decimals"]
    assert [r["passed"] for r in got] == [True]


def test_dates_with_a_time_keep_their_microseconds():

    from mercato.functions import ts_literal

    with pytest.raises(ValueError, match="time zone"):
        ts_literal(dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc))
    assert Params(start_date=dt.datetime(2020, 1, 1, 1, 2, 3, 456)).start.microsecond == 456
